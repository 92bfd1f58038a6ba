"""Settings, path catalogue, download queries and retrying downloads."""

from __future__ import annotations

import os
import time
import urllib.parse
import urllib.request
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from pathlib import Path

LAYERS = ("ski_areas", "runs", "lifts", "spots")
#: Keys whose lifecycle prefixes are asked for as well.
_PREFIXES = ("", "disused:", "abandoned:", "proposed:", "planned:", "construction:")


@dataclass(frozen=True)
class Elevation:
    """Where elevations come from; zooms are tried in order."""

    url: str
    kind: str = "racemap"
    zooms: tuple[int, ...] = (12,)
    batch: int = 10_000
    encoding: str = "mapbox"
    tile_size: int = 512
    cache_dir: str = "data/tile-cache"
    cache_tiles: int = 100_000
    concurrency: int = 4


@dataclass(frozen=True)
class Geocoder:
    """Where places come from, and how long they stay fresh."""

    url: str
    kind: str = "photon"
    ttl_ms: int = 365 * 24 * 3600 * 1000


@dataclass(frozen=True)
class Store:
    """Folder of the caches, their table prefix, and who may write."""

    path: str = "data/cache"
    prefix: str = ""
    user: str = "postgres"
    password: str | None = None

    @staticmethod
    def for_tests(name: str) -> Store:
        """A store of its own for each test."""
        return Store(prefix=f"test_{name}_")


@dataclass(frozen=True)
class Settings:
    """All settings of a run."""

    working_dir: str = "data"
    bbox: tuple[float, float, float, float] | None = None
    output_dir: str = "data"
    elevation: Elevation | None = None
    geocoder: Geocoder | None = None
    #: None where snow cover is off, else which pixels are fetched.
    snow_policy: str | None = None
    tiles: bool = False
    store: Store = Store()


def elevation_settings(url: str | None, kind: str = "racemap", zooms: str | None = None, batch: str | None = None, env: Mapping[str, str] | None = None) -> Elevation | None:
    """S26; env: settings of tiles."""
    if not url:
        return None
    if kind not in ("racemap", "tileserver-gl", "tile"):
        raise ValueError(f"unknown kind of elevation server: {kind}")
    levels = tuple(int(z) for z in zooms.split(",")) if zooms else (12,)
    if any(not 0 <= z <= 30 for z in levels):
        raise ValueError(f"zoom out of range: {zooms}")
    size = int(batch) if batch else 10_000
    if size < 1:
        raise ValueError(f"batch size must be positive: {batch}")
    env = env or {}
    encoding = env.get("ELEVATION_SERVER_TILE_ENCODING", "mapbox")
    if encoding not in ("mapbox", "terrarium"):
        raise ValueError(f"unknown encoding of tiles: {encoding}")
    number = lambda name, default: int(env.get(f"ELEVATION_TILE_{name}") or default)
    return Elevation(url, kind, levels, size, encoding, number("SIZE", 512), env.get("ELEVATION_TILE_CACHE_DIR", "data/tile-cache"), number("CACHE_MAX_TILES", 100_000), number("CONCURRENCY", 4))


def from_environment(env: Mapping[str, str] = os.environ) -> Settings:
    """Settings named in the environment; wrong boxes and policies raise."""
    box = None
    if env.get("BBOX"):
        values = [float(v) for v in env["BBOX"].strip("[] ").split(",")]
        if len(values) != 4:
            raise ValueError(f"a bounding box has four numbers: {env['BBOX']}")
        box = tuple(values)
    policy = env.get("SNOW_COVER_FETCH_POLICY") or "full"
    if policy not in ("none", "incremental", "full"):
        raise ValueError(f"unknown snow cover policy: {policy}")
    elevation = elevation_settings(env.get("ELEVATION_SERVER_URL"), env.get("ELEVATION_SERVER_TYPE", "racemap"), env.get("ELEVATION_SERVER_ZOOM"), env.get("ELEVATION_SERVER_BATCH_SIZE"), env)
    url = env.get("GEOCODING_SERVER_URL")
    geocoder = None if url is None else Geocoder(url, env.get("GEOCODING_SERVER_TYPE") or "photon", int(env.get("GEOCODING_SERVER_URL_TTL") or Geocoder.ttl_ms))
    store = Store(user=env.get("POSTGRES_USER") or "postgres", password=env.get("POSTGRES_PASSWORD"))
    return Settings(env.get("WORKING_DIR", "data"), box, env.get("OUTPUT_DIR", "data"), elevation, geocoder, policy if env.get("ENABLE_SNOW_COVER") == "1" else None, env.get("GENERATE_TILES") == "1", store)


@dataclass(frozen=True)
class Paths:
    """Names of all files of a run; outputs may have a folder of their own."""

    root: Path
    layers: tuple[str, ...] = field(default=LAYERS)
    out: Path | None = None

    @property
    def target(self) -> Path:
        return self.out or self.root

    def osm_json(self, layer: str) -> Path:
        return self.root / f"input_{layer}.osmjson"

    def raw(self, layer: str) -> Path:
        return self.root / f"input_{layer}.geojson"

    def intermediate(self, layer: str) -> Path:
        return self.root / f"intermediate_{layer}.geojson"

    def output(self, layer: str, kind: str = "geojson") -> Path:
        if kind == "csv":
            return self.target / "csv" / f"{layer}.csv"
        return self.target / (f"{layer}.geojson" if kind == "geojson" else f"mapboxgl_{layer}.geojson")

    @property
    def package(self) -> Path:
        return self.target / "ski_data.gpkg"

    def make(self) -> Paths:
        self.root.mkdir(parents=True, exist_ok=True)
        (self.target / "csv").mkdir(parents=True, exist_ok=True)
        return self


def bbox_clause(box: tuple[float, float, float, float] | None) -> str:
    """The remainder keeps its sign, as in the column function."""
    if box is None:
        return ""
    from math import fmod

    lon = lambda v: fmod(v + 180, 360) - 180
    west, south, east, north = box
    return f"[bbox:{south:g},{lon(west):g},{north:g},{lon(east):g}]"


def layer_query(layer: str, box: tuple[float, float, float, float] | None = None) -> str:
    """The download query of a layer, members included."""
    ways = lambda key, value="": "".join(f'wr["{p}{key}"{value}];' for p in _PREFIXES)
    body = {
        "runs": 'wr["piste:type"];(._;>;);',
        "lifts": "rel[site=piste];>>;way(r)[railway]->.siterailways;((" + "".join(f'way["{p}aerialway"];' for p in _PREFIXES) + "way[railway=funicular];.siterailways;);>;);",
        "ski_areas": "(" + ways("landuse", "=winter_sports") + ");(._;>;);",
        "ski_area_sites": "rel[site=piste];",
        "spots": '(node["piste:dismount"];nw[aerialway=station];nw[amenity=avalanche_transceiver][avalanche_transceiver=training];nw[amenity=avalanche_transceiver][avalanche_transceiver=checkpoint];nw["man_made"="piste:halfpipe"];);(._;>;);',
    }[layer]
    return f"[out:json][timeout:1800]{bbox_clause(box)};{body}out;"


def query_url(endpoint: str, layer: str, box: tuple[float, float, float, float] | None = None) -> str:
    """S29."""
    return f"{endpoint}?data={urllib.parse.quote(layer_query(layer, box))}"


def download(url: str, path: str, retries: int = 10, wait_s: float = 60.0, timeout_s: float = 1800.0, opener: Callable = urllib.request.urlopen) -> int:
    """A file from a url, written aside and moved into place; failures are tried again."""
    target = Path(path)
    target.parent.mkdir(parents=True, exist_ok=True)
    part = target.with_suffix(target.suffix + ".part")
    for attempt in range(retries + 1):
        try:
            size = 0
            with opener(url, timeout=timeout_s) as source, part.open("wb") as out:
                while block := source.read(1 << 20):
                    out.write(block)
                    size += len(block)
            part.replace(target)
            return size
        except OSError:
            if attempt == retries:
                raise
            time.sleep(wait_s)
    return 0


def download_plan(paths: Paths, endpoints: tuple[str, str], second_source: str, box=None) -> list[list[tuple[str, Path]]]:
    """Lists of downloads that may go on side by side; within one they are taken in order."""
    first = [(query_url(endpoints[0], n, box), paths.osm_json(n)) for n in ("runs", "lifts", "ski_areas")]
    other = [(query_url(endpoints[1], n, box), paths.osm_json(n)) for n in ("ski_area_sites", "spots")]
    return [first, other, [(second_source, paths.root / "input_second_source.geojson")]]


def files_to_merge(directories: list[str], kind: str) -> list[Path]:
    """Outputs of a kind in each directory, in order; a missing directory raises."""
    names = {"geojson": [f"{n}.geojson" for n in LAYERS], "csv": [f"csv/{n}.csv" for n in LAYERS], "gpkg": ["ski_data.gpkg"]}[kind]
    for d in directories:
        if not Path(d).is_dir():
            raise NotADirectoryError(d)
    return [p for d in directories for n in names if (p := Path(d) / n).exists()]
