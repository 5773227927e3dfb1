"""The bitmap index against plain sets."""

import random

import pytest
from helpers import canonical
from pyspark.sql import functions as F

from cairnlake.plans import bitmaps
from cairnlake.plans.compose import COUNTS, whole_cube
from cairnlake.plans.explorer import FACETS
from cairnlake.roles import catalog


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    """70,000 items (three buckets): a value of all of them, dense and sparse ones, values in one bucket alone, and repeats."""
    rng = random.Random(2)
    items = [f"i{i:06d}" for i in range(70_000)]
    sets = {("v_edm_type", "all"): set(items), ("v_edm_type", "half"): set(rng.sample(items, 35_000)), ("edm:Agent", "few"): set(rng.sample(items, 900)), ("edm:Agent", "some"): set(rng.sample(items, 9_000)), ("edm:Agent", "one"): {items[5]}, ("edm:Place", "edge"): set(items[32_760:32_780]), ("x_content_tier", "1"): set(items[:30_000]), ("x_content_tier", "3"): set(items[30_000:50_000]), ("x_content_tier", "X"): set(items[60_000:])}
    numbers = bitmaps.numbered(spark.createDataFrame([(i,) for i in items + items[:5]], "k_iri string"), str(tmp_path_factory.mktemp("bitmaps") / "numbers"))
    pairs = spark.createDataFrame([(f, v, i) for (f, v), own in sets.items() for i in own] + [("edm:Agent", "one", items[5])], "facet string, value string, k_iri string").join(numbers, "k_iri")
    labels = pairs.select("facet", "value", F.upper("value").alias("label")).distinct()
    return bitmaps.FacetBitmaps(numbers, bitmaps.indexed(pairs).cache(), labels), sets, items


def test_numbers_have_no_gaps(index):
    own, _, items = index
    assert [tuple(r) for r in own.numbers.orderBy("n").collect()] == [(x, i) for i, x in enumerate(items)]


def test_lists_and_bitmaps(index):
    rows = index[0].index.collect()
    assert {r["bits"] is None for r in rows} == {True, False} and all((r["at"] is None) != (r["bits"] is None) and (r["items"] > bitmaps.DENSE) == (r["bits"] is not None) for r in rows)


def both(f):
    return {"kind": "in", "values": f}


@pytest.mark.parametrize(
    ("filters", "test"),
    [
        ({}, lambda s, i: True),
        ({"v_edm_type": both(["half"])}, lambda s, i: i in s["v_edm_type", "half"]),
        ({"v_edm_type": both(["half", "all"])}, lambda s, i: True),
        ({"edm:Agent": both(["few", "some"])}, lambda s, i: i in s["edm:Agent", "few"] and i in s["edm:Agent", "some"]),
        ({"edm:Agent": both(["few", "no such"])}, lambda s, i: False),
        ({"edm:Agent": both(["some"]), "v_edm_type": both(["half"]), "x_content_tier": {"kind": "range", "min": 1, "max": 2}}, lambda s, i: i in s["edm:Agent", "some"] and i in s["v_edm_type", "half"] and i in s["x_content_tier", "1"]),
        ({"x_content_tier": {"kind": "range", "min": 2}}, lambda s, i: i in s["x_content_tier", "3"]),
        ({"edm:Place": both(["edge"]), "unknown": both([]), "odd": 3}, lambda s, i: i in s["edm:Place", "edge"]),
    ],
)
def test_counts_under_filters(index, filters, test):
    own, sets, items = index
    chosen = {i for i in items if test(sets, i)}
    want = sorted((f, v, v.upper(), len(x & chosen)) for (f, v), x in sets.items() if x & chosen)
    assert sorted(map(tuple, own.counts(filters).collect())) == want
    assert own.total(filters).first()[0] == len(chosen)
    if len(chosen) < 40_000:
        assert {r[0] for r in own.items(filters).collect()} == chosen
    assert sorted(map(tuple, own.counts(filters, ["edm:Agent"]).collect())) == [w for w in want if w[0] == "edm:Agent"]


def test_rows_meet_by_bucket(index):
    """No edge, item or cube row is read for counts; nothing is crossed."""
    plan = index[0].counts({"v_edm_type": both(["half"])})._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "BroadcastNestedLoop" not in plan


def test_cube_without_counts(spark, sf_dir):
    """The index needs no counts of things, so no title and no resource is dealt out by its name."""
    t = catalog(spark, sf_dir)
    made = whole_cube(t, counts=False)
    assert "thing" not in made._jdf.queryExecution().optimizedPlan().toString()
    assert canonical(made.collect()) == canonical(whole_cube(t).drop(*COUNTS).collect())


def test_build(spark, sf_dir, tmp_path):
    """Pairs are grouped where their buckets were dealt to, not written with labels and dealt out once more."""
    before = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None)
    built = bitmaps.FacetBitmaps.build(catalog(spark, sf_dir), str(tmp_path))
    assert {p.name for p in tmp_path.iterdir()} == set(bitmaps.PARTS)  # and no table that was needed on the way
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) == before
    t = catalog(spark, sf_dir)
    linked = t("explorer_edm_entities")
    want = [(n, r["value"], r["label"], r["items"]) for n, f in FACETS.items() if f.cls for r in linked.where((F.col("x_entity_class") == f.cls) & ((F.col("x_property") == f.prop) if f.prop else F.lit(True))).groupBy(F.col("k_iri_entity").alias("value")).agg(F.min("x_label").alias("label"), F.count_distinct("k_iri_cho").alias("items")).collect()]
    cube = t("group_items")
    want += [("x_has_pdf", str(r[0]).lower(), str(r[0]).lower(), r[1]) for r in cube.groupBy("x_has_pdf").count().collect()] + [("v_edm_country", r[0], r[0], r[1]) for r in cube.where("v_edm_country is not null").groupBy("v_edm_country").count().collect()]
    assert len(want) > 100 and sorted(map(tuple, built.counts(None, [*(n for n, f in FACETS.items() if f.cls), "x_has_pdf", "v_edm_country"]).collect())) == sorted(want)
