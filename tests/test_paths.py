"""Path search against plain searches."""

import random

import pytest
from pyspark.sql import functions as F

from cairnlake.operators import paths


def frame(spark, rows, schema="src string, dst string"):
    return spark.createDataFrame(rows, schema)


def brute_distances(edges, sources, depth):
    out = set()
    for s in {x for x in sources if x is not None}:
        front, seen, at = {s}, {s}, 0
        out.add((s, s, 0, None))
        while front and (depth is None or at < depth):
            at += 1
            new = {d for a, d in edges if a in front and d is not None and d not in seen}
            out |= {(s, d, at, min(a for a, b in edges if b == d and a in front)) for d in new}
            front, seen = new, seen | new
    return out


def brute_paths(edges, source, depth, targets):
    found, stack = [], [[source]]
    while stack:
        path = stack.pop()
        if len(path) > 1 and path[-1] in targets:
            found.append(tuple(path))
        if len(path) <= depth and not (len(path) > 1 and path[0] == path[-1]):
            stack += [[*path, d] for d in {d for a, d in edges if a == path[-1] and d is not None} if d == source or d not in path]
    return found


@pytest.fixture(scope="module")
def graph():
    rng = random.Random(4)
    return [(f"n{rng.randrange(14)}", f"n{rng.randrange(14)}") for _ in range(26)] + [("n1", "n1"), ("n2", None), (None, "n3"), ("n1", "n4"), ("n1", "n4")]


@pytest.mark.parametrize("depth", [0, 1, 3, None])
def test_distances(spark, graph, depth):
    sources = ["n1", "n2", "n1", None, "not there"]
    got = paths.distances(frame(spark, graph), frame(spark, [(s,) for s in sources], "source string"), depth)
    assert {tuple(r) for r in got.select("source", "node", "distance", "before").collect()} == brute_distances(graph, sources, depth) and got.count() == got.select("source", "node").distinct().count()


def test_a_deep_search_has_a_flat_plan(spark):
    """40 steps along a chain with circles: what is planned for a step doesn't grow with the steps."""
    chain = [(i, i + 1) for i in range(40)] + [(i + 5, i) for i in range(0, 35, 5)]
    got = paths.distances(frame(spark, chain, "src int, dst int"), frame(spark, [(0,)], "source int"))
    assert sorted((r["node"], r["distance"]) for r in got.collect()) == [(i, i) for i in range(41)]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("Relation") <= paths.TOGETHER


def test_shortest_paths(spark, graph):
    pairs = [("n1", f"n{i}") for i in range(14)] + [("n2", "n2"), ("n1", None), ("n1", "not there")]
    got = {(r["source"], r["target"]): (r["distance"], r["path"]) for r in paths.shortest_paths(frame(spark, graph), frame(spark, pairs, "source string, target string")).collect()}
    known = {(s, n): (d, b) for s, n, d, b in brute_distances(graph, ["n1", "n2"], None)}
    assert set(got) == {p for p in pairs if p in known}
    edges = set(graph)
    for (s, t), (d, path) in got.items():
        assert d == known[s, t][0] == len(path) - 1 and path[0] == s and path[-1] == t and all(e in edges for e in zip(path, path[1:], strict=False))
        at = t
        for x in reversed(path):
            assert x == at
            at = known[s, x][1]


@pytest.mark.parametrize("depth", [1, 4, 6])
def test_all_paths(spark, graph, depth):
    sources, targets = ["n1", "n2", "n5"], ["n4", "n1", "n7", "n9"]
    e, s, t = frame(spark, graph), frame(spark, [(x,) for x in sources], "source string"), frame(spark, [(x,) for x in [*targets, "n4"]], "target string")
    want = sorted(p for x in sources for p in brute_paths(graph, x, depth, targets))
    found = paths.all_paths(e, s, t, depth)
    assert sorted(tuple(r["path"]) for r in found.collect()) == want and all(r["length"] == len(r["path"]) - 1 and (r["path"][0], r["path"][-1]) == (r["source"], r["target"]) for r in found.collect())
    every = sorted(p for x in sources for p in brute_paths(graph, x, depth, {d for _, d in graph}))
    assert sorted(tuple(r["path"]) for r in paths.all_paths(e, s, None, depth).collect()) == every
    pairs = [("n1", "n4"), ("n2", "n9"), ("n5", "n5")]
    got = paths.all_paths(e, None, None, depth, pairs=frame(spark, pairs, "source string, target string"))
    assert sorted(tuple(r["path"]) for r in got.collect()) == sorted(p for x, y in pairs for p in brute_paths(graph, x, depth, [y]))


def test_a_bounded_number_of_paths(spark, graph):
    sources, targets = ["n1", "n2"], ["n4", "n1", "n7"]
    got = paths.all_paths(frame(spark, graph), frame(spark, [(x,) for x in sources], "source string"), frame(spark, [(x,) for x in targets], "target string"), 6, per_target=2).collect()
    want = []
    for s in sources:
        for t in targets:
            want += sorted(brute_paths(graph, s, 6, [t]), key=lambda p: (len(p), p))[:2]
    assert sorted(tuple(r["path"]) for r in got) == sorted(want)


def test_edges_of_paths(spark, graph):
    found = paths.all_paths(frame(spark, graph), frame(spark, [("n1",)], "source string"), frame(spark, [("n4",)], "target string"), 5)
    rows = paths.path_edges(found).collect()
    rebuilt = {}
    for r in sorted(rows, key=lambda r: (r["path_id"], r["edge"])):
        rebuilt.setdefault(r["path_id"], [r["start"]]).append(r["end"])
    assert list(map(tuple, rebuilt.values())) == sorted((tuple(r["path"]) for r in found.collect()), key=lambda p: (len(p), p))


def test_nothing_to_search(spark):
    none = frame(spark, [])
    assert paths.distances(none, frame(spark, [("a",)], "source string")).count() == 1
    assert paths.all_paths(none, frame(spark, [("a",)], "source string"), None, 3).count() == 0
    assert paths.shortest_paths(none, frame(spark, [], "source string, target string")).count() == 0


def test_edges_are_dealt_once(spark):
    from cairnlake.sources.scratch import tables

    with tables(spark) as own:
        edges = own.save_by(spark.createDataFrame([(i, i + 1) for i in range(30)], "src long, dst long"), "edges", "src")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            step = edges.select(edges["dst"].alias("at")).join(edges, F.col("at") == F.col("src"))
            assert step._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1 and step.count() == 29
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        names = list(own.names.values())
        own.drop()
        assert not own.names and not any(spark.catalog.tableExists(n) for n in names)


def test_what_was_reached_stays_where_it_is(spark, monkeypatch):
    """A step deals out its front and its finds, a step back its walks: tables of all that was reached are not dealt again."""
    from cairnlake.sources.scratch import Tables

    plans = []

    def noted(save):
        def run(self, df, name, *args, **kw):
            plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
            return save(self, df, name, *args, **kw)

        return run

    monkeypatch.setattr(Tables, "save", noted(Tables.save))
    monkeypatch.setattr(Tables, "save_by", noted(Tables.save_by))
    monkeypatch.setattr(paths, "TOGETHER", 100)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        chain = frame(spark, [(i, i + 1) for i in range(5)], "src int, dst int")
        got = paths.shortest_paths(chain, frame(spark, [(0, 5)], "source int, target int"))
        assert [(r["distance"], r["path"]) for r in got.collect()] == [(5, [0, 1, 2, 3, 4, 5])]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    steps = [p for name, p in plans if name == "reached"][1:]
    assert len(steps) == 6 and all(p.count("Exchange") == 2 for p in steps)
    back = [p for name, p in plans if name == "walk"][1:]
    assert len(back) == 6 and all(p.count("Exchange") == 1 for p in back)
