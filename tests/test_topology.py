import json

from pisteflow.operators import topology as t

A, B, C, D = (0.0, 0.0), (1.0, 0.0), (2.0, 0.0), (3.0, 0.0)


def run(name, coords, **props):
    return list(coords), {"id": name, "name": name, "uses": ["downhill"], "oneway": None, **props}


def test_equal_lines_merge_names():
    got = t.merge_overlaps([run("A", (A, B)), run("B", (A, B))])
    assert [(c, p["name"]) for c, p in got] == [([A, B], "A, B")]


def test_opposite_oneways_are_not_oneway():
    got = t.merge_overlaps([run("A", (A, B), oneway=True), run("B", (B, A), oneway=True)])
    assert len(got) == 1 and got[0][1]["oneway"] is False


def test_partial_overlap_splits():
    got = t.merge_overlaps([run("A", (A, B, C)), run("B", (B, C, D))])
    assert [(c, p["name"]) for c, p in got] == [([A, B], "A"), ([B, C], "A, B"), ([C, D], "B")]


def test_adjoining_lines_join_either_way():
    assert [c for c, _ in t.join_segments([run("X", (A, B)), run("X", (C, B)), run("X", (C, D))])] == [[A, B, C, D]]
    assert len(t.join_segments([run("X", (A, B), oneway=True), run("X", (C, B), oneway=True)])) == 2
    assert t.join_segments([run("X", (A, A))]) == []


def test_cycles_end():
    got = t.join_segments([run("X", (A, B)), run("X", (B, C)), run("X", (C, A))])
    assert len(got) == 1 and got[0][0][0] == got[0][0][-1]


def test_distributed_normalisation(spark):
    rows = [run("A", (A, B, C)), run("B", (B, C, D)), run("X", ((9.0, 9.0), (9.0, 10.0)), id=None), run("X", ((9.0, 10.0), (9.0, 11.0)), id=None)]
    df = spark.createDataFrame([(i, [list(p) for p in c], json.dumps(p)) for i, (c, p) in enumerate(rows)], "ordinal bigint, coords array<array<double>>, props string")
    got = sorted((json.loads(r.props)["name"], r.coords) for r in t.normalise_runs(df).collect())
    assert got == [("A", [[0.0, 0.0], [1.0, 0.0]]), ("A, B", [[1.0, 0.0], [2.0, 0.0]]), ("B", [[2.0, 0.0], [3.0, 0.0]]), ("X", [[9.0, 9.0], [9.0, 10.0], [9.0, 11.0]])]
