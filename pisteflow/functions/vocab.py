"""Domain vocabulary: fixed values that inputs and outputs are spelt with."""

# Fixed values.
STATUSES = ("operating", "disused", "abandoned", "proposed", "planned", "construction")
LIFECYCLE_STATES = ("disused", "abandoned", "proposed", "planned", "construction")
UNSUPPORTED_STATES = ("demolished", "removed", "razed")
RUN_USES = ("connection", "downhill", "hike", "ice_skate", "nordic", "playground", "sled", "skitour", "sleigh", "snow_park", "fatbike")
DIFFICULTIES = ("novice", "easy", "intermediate", "advanced", "expert", "freeride", "extreme")
GROOMINGS = ("classic+skating", "skating", "classic", "mogul", "scooter", "backcountry")
LIFT_TYPES = ("cable_car", "gondola", "chair_lift", "mixed_lift", "drag_lift", "t-bar", "j-bar", "platter", "rope_tow", "magic_carpet", "funicular", "railway")
SURFACE_LIFTS = ("t-bar", "j-bar", "platter", "rope_tow", "magic_carpet", "drag_lift")
RAILWAY_KINDS = ("narrow_gauge", "rail", "light_rail", "tram", "subway", "monorail")
SPOT_TYPES = ("crossing", "lift_station", "avalanche_transceiver_training", "avalanche_transceiver_checkpoint", "halfpipe")
ACTIVITIES = ("downhill", "nordic")
CONVENTIONS = ("europe", "japan", "north_america")

#: Lift type to the name shown with it.
LIFT_NAMES = {"cable_car": "Cable Car", "gondola": "Gondola", "chair_lift": "Chairlift", "mixed_lift": "Hybrid Lift", "drag_lift": "Drag lift", "t-bar": "T-bar", "j-bar": "J-bar", "platter": "Platter", "rope_tow": "Rope tow", "magic_carpet": "Magic Carpet", "funicular": "Funicular", "railway": "Railway"}

#: Values by priority: the first one present wins.
PRIORITIES = {
    "difficulty": DIFFICULTIES,
    "grooming": GROOMINGS,
    "status": ("operating", "construction", "planned", "proposed", "disused", "abandoned"),
    "gladed": (True, False),
    "patrolled": (True, False),
    "snowmaking": (True, False),
    "snowfarming": (True, False),
    "tunnel": (True, False),
    "lit": (True, False),
}

#: Colour name of a run by convention and difficulty; what is only known in part follows the
#: usual signage of that convention. Colour values by name.
RUN_COLOURS = {
    "europe": {"novice": "green", "easy": "blue", "intermediate": "red", "advanced": "black", "expert": "black", "extreme": "orange", "freeride": "orange"},
    "japan": {"novice": "green", "easy": "green", "intermediate": "red", "advanced": "black", "expert": "black", "extreme": "orange", "freeride": "orange"},
    "north_america": {"novice": "green", "easy": "green", "intermediate": "blue", "advanced": "black", "expert": "black", "extreme": "orange", "freeride": "orange"},
}
COLOUR_VALUES = {"green": "hsl(125, 100%, 33%)", "blue": "hsl(208, 100%, 33%)", "red": "hsl(359, 94%, 53%)", "black": "hsl(0, 0%, 0%)", "orange": "hsl(34, 100%, 50%)", "grey": "hsl(0, 0%, 35%)"}
LIFT_COLOURS = {"operating": "hsl(0, 82%, 42%)"}
LIFT_COLOUR_OTHER = "hsl(0, 53%, 42%)"

#: Closed ways become polygons by key: for any value (True), for these values, or for any but these.
#: Fixed values, in the order in which they are published.
POLYGON_TAGS: dict[str, bool | dict[str, tuple[str, ...]]] = {
    "building": True,
    "highway": {"only": ("services", "rest_area", "escape")},
    "natural": {"except": ("coastline", "ridge", "arete", "tree_row")},
    "landuse": True,
    "waterway": {"only": ("riverbank", "dock", "boatyard", "dam")},
    "amenity": True,
    "leisure": True,
    "barrier": {"only": ("city_wall", "ditch", "hedge", "retaining_wall", "wall", "spikes")},
    "railway": {"only": ("station", "turntable", "roundhouse", "platform")},
    "area": True,
    "boundary": True,
    "man_made": {"except": ("cutline", "embankment", "pipeline")},
    "power": {"only": ("generator", "station", "sub_station", "transformer")},
    "place": True,
    "shop": True,
    "aeroway": {"except": ("taxiway",)},
    "tourism": True,
    "historic": True,
    "public_transport": True,
    "office": True,
    "building:part": True,
    "military": True,
    "ruins": True,
    "area:highway": True,
    "craft": True,
    "piste:type": {"only": ("downhill",)},
}
