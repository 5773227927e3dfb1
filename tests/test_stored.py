"""Buckets, sketches, samples, digests and tables whose writing broke off."""

import hashlib

import pytest
from pyspark.sql import functions as F

from cairnlake.functions import rights
from cairnlake.operators import graph, sampling
from cairnlake.plans import buckets, sketches
from cairnlake.plans.catalog import Catalog
from cairnlake.plans.compose import cube_parts, first_by
from cairnlake.roles import catalog
from cairnlake.sources import digests
from cairnlake.sources.triples import checked_files


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_stored_parts_join_without_exchange(spark, sf_dir, tmp_path, no_broadcast):
    t = catalog(spark, sf_dir)
    parts = buckets.store_cube_parts(t, str(tmp_path), 4)
    cube = buckets.bucketed_cube(parts)
    assert plan_of(cube).count("Join") == 10 and "Exchange" not in plan_of(cube)
    plain = t("group_items")
    assert plan_of(plain).count("Exchange") > 10
    rows = sorted(map(str, cube.collect()))
    assert rows == sorted(map(str, plain.collect()))
    other = spark.newSession()
    other.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    again = buckets.open_cube_parts(other, str(tmp_path), 4)
    assert list(again) == list(cube_parts(t)) and "Exchange" not in plan_of(buckets.bucketed_cube(again)) and sorted(map(str, buckets.bucketed_cube(again).collect())) == rows


def test_a_stored_table_keeps_its_rows(spark, tmp_path):
    df = spark.createDataFrame([(i % 7 if i % 5 else None, f"v{i}") for i in range(100)], "k bigint, v string")
    for _ in range(2):  # written over
        stored = buckets.store(df, str(tmp_path / "t"), "k", 3)
        assert sorted(map(str, stored.collect())) == sorted(map(str, df.collect()))
    assert sorted(map(str, buckets.opened(spark.newSession(), str(tmp_path / "t"), "k", 3).collect())) == sorted(map(str, df.collect()))


def test_buckets_grow_and_parts_are_dealt_once(spark, sf_dir, tmp_path, monkeypatch, no_broadcast):
    t = catalog(spark, sf_dir)
    monkeypatch.setattr(buckets, "BUCKET", 20_000)
    n = buckets.buckets_for(t)
    assert n > spark.sparkContext.defaultParallelism
    part, seen = cube_parts(t)["type"], []
    deal = type(part).repartition
    monkeypatch.setattr(buckets, "cube_parts", lambda c: {"type": part})
    monkeypatch.setattr(type(part), "repartition", lambda df, *by: seen.append(plan_of(deal(df, *by)).count("Exchange")) or deal(df, *by))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    stored = buckets.store_cube_parts(t, str(tmp_path))["type"]
    assert seen == [1] and spark.conf.get("spark.sql.shuffle.partitions") == before
    told = spark.sql(f"DESCRIBE EXTENDED {buckets._name(f'{tmp_path}/type')}").where("col_name = 'Num Buckets'").first()
    assert told["data_type"] == str(n) and sorted(map(str, stored.collect())) == sorted(map(str, part.collect()))


def test_first_by_takes_the_least(spark):
    rows = [(1, "b", 2), (1, "a", None), (1, "a", 5), (2, None, 1), (2, "z", None), (None, "q", 1), (None, "p", 9), (1, "a", 5)]
    df = spark.createDataFrame(rows, "k int, o string, x int")
    assert sorted(map(tuple, first_by(df, "k", ["o"]).collect()), key=str) == sorted([(1, "a", 5), (2, "z", None), (None, "p", 9)], key=str)
    assert first_by(df, "k", ["o"]).columns == df.columns and first_by(df.limit(0), "k", ["o"]).count() == 0


def test_sketches_err_little(spark):
    """Merged sketches against exact figures, over groups of very unequal sizes, nulls and values that groups share."""
    df = spark.range(200_000).select(F.when(F.col("id") % 10 < 7, "big").when(F.col("id") % 10 < 9, "mid").alias("g"), (F.col("id") % 3).alias("h"), F.when(F.col("id") % 11 > 0, F.col("id") % 23_000).alias("d"), F.when(F.col("id") % 13 > 0, F.pmod(F.xxhash64("id"), F.lit(1_000_000))).alias("x"))
    made = sketches.Sketches.of(df, ("g", "h"), ("d",), ("x",))
    stored = sketches.Sketches.read(made.table.cache(), ("g", "h"))
    assert (stored.distinct, stored.numbers) == (("d",), ("x",))
    for by, where in (((), None), (("g",), None), (("g", "h"), F.col("h") > 0), ((), F.col("g") == "mid")):
        rows = df if where is None else df.where(where)
        exact = {tuple(r[c] for c in by): r for r in rows.groupBy(*by).agg(F.count("*").alias("rows"), F.count_distinct("d").alias("n"), F.array_sort(F.collect_list("x")).alias("xs")).collect()}
        told = {tuple(r[c] for c in by): r for r in stored.estimates(by, where, (0.1, 0.5, 0.99)).collect()}
        assert set(told) == set(exact)
        for key, r in told.items():
            e = exact[key]
            assert r["rows"] == e["rows"] and abs(r["n_d"] - e["n"]) <= 4 * 1.04 / 64 * e["n"]
            for q, v in zip((0.1, 0.5, 0.99), r["q_x"], strict=True):
                assert abs(sum(x <= v for x in e["xs"]) / len(e["xs"]) - q) <= 0.03
    nothing = sketches.Sketches.of(spark.createDataFrame([("a", 1, None, None)], "g string, h int, d string, x bigint"), ("g", "h"), ("d",), ("x",)).estimates().first()
    assert (nothing["rows"], nothing["n_d"], nothing["q_x"]) == (1, 0, None)


def test_samples_by_hash(spark):
    df = spark.createDataFrame([(i, f"g{i % 4 if i % 3 else 0}") for i in range(500)] + [(None, "g0"), (7, "g9"), (7, "g8")], "k bigint, g string")
    order = lambda r: (hashlib.md5(str(r[0]).encode()).hexdigest(), r[1])
    rows = [tuple(r) for r in df.collect() if r[0] is not None]
    assert sorted(map(tuple, sampling.bottom_k(df.repartition(5), "k", 30).collect())) == sorted(sorted(rows, key=order)[:30])
    want = [r for g in {r[1] for r in rows} for r in sorted([x for x in rows if x[1] == g], key=order)[:3]]
    assert sorted(map(tuple, sampling.bottom_k(df.repartition(3), "k", 3, ["g"]).collect())) == sorted(want)
    parts = [sampling.bottom_k(df.where(F.col("k") % 2 == i), "k", 30) for i in range(2)]
    assert sorted(map(tuple, sampling.bottom_k(parts[0].unionByName(parts[1]), "k", 30).collect())) == sorted(sorted(rows, key=order)[:30])
    assert "WindowGroupLimit" in plan_of(sampling.bottom_k(df, "k", 3, ["g"]))
    urls = spark.createDataFrame([(f"i{i}", f"u{i}" if i % 2 else None) for i in range(40)], "k_iri string, v_edm_isShownBy string")
    assert {r["v_edm_isShownBy"] for r in sampling.url_sample(urls, 5).collect()} == set(sorted((f"u{i}" for i in range(1, 40, 2)), key=lambda u: hashlib.md5(u.encode()).hexdigest())[:5])


def test_digests_of_large_files(spark, tmp_path):
    """Equal to hashlib over the file, in memory that doesn't depend on it; an empty file too."""
    import subprocess
    import sys

    block = bytes(range(256)) * 4096
    with open(tmp_path / "large.bin", "wb") as f:
        for _ in range(300):
            f.write(block)
    (tmp_path / "empty.bin").write_bytes(b"")
    (tmp_path / "large.bin.md5").write_text(hashlib.md5(block * 300).hexdigest().upper() + " *large.bin\n")
    got = {r["path"].rsplit("/", 1)[1]: (r["length"], r["md5"], r["sha256"]) for r in digests.digests(digests.listed(spark, str(tmp_path), "*.bin"), "md5", "sha256").collect()}
    assert got == {"large.bin": (len(block) * 300, hashlib.md5(block * 300).hexdigest(), hashlib.sha256(block * 300).hexdigest()), "empty.bin": (0, hashlib.md5(b"").hexdigest(), hashlib.sha256(b"").hexdigest())}
    assert {r["path"].rsplit("/", 1)[1]: r["matches"] for r in checked_files(spark, str(tmp_path)).collect()} == {"large.bin": True, "empty.bin": None}
    code = (
        "import pyarrow as pa,sys;from cairnlake.sources import digests as d\n"
        "class Files:\n"
        " schema=[type('F',(),{'name':'path','dataType':type('T',(),{'simpleString':lambda s:'string'})()})()]\n"
        " def mapInArrow(self,run,schema): return run(iter([pa.RecordBatch.from_pydict({'path':[sys.argv[1]]})]))\n"
        "r=list(d.digests(Files(),'md5'));print(r[0].column('md5')[0],int(open('/proc/self/status').read().split('VmHWM:')[1].split()[0])//1024)"
    )
    told, mb = subprocess.run([sys.executable, "-c", code, str(tmp_path / "large.bin")], capture_output=True, text=True, check=True).stdout.split()
    assert told == hashlib.md5(block * 300).hexdigest() and int(mb) < 300


def test_a_write_that_broke_off_is_no_table(spark, tmp_path):
    (tmp_path / "group_items.parquet" / "_temporary" / "0").mkdir(parents=True)
    (tmp_path / "map_rights.parquet").mkdir()
    spark.range(3).write.parquet(str(tmp_path / "orgs.parquet"))
    (tmp_path / "orgs.parquet" / "_SUCCESS").unlink()
    stored = Catalog(spark, str(tmp_path))
    assert stored._stored("group_items") is None and stored._stored("map_rights") is None and stored._stored("orgs").count() == 3


def test_labels_with_version_and_port(spark):
    want = {
        "http://creativecommons.org/licenses/by-sa/3.0/au/": "Attribution-ShareAlike (CC BY-SA) 3.0 (AU)",
        "http://creativecommons.org/licenses/by/4.0/": "Attribution (CC BY) 4.0",
        "http://creativecommons.org/publicdomain/mark/1.0/": "Public Domain Mark 1.0",
        "http://creativecommons.org/publicdomain/zero/1.0": "Public Domain Dedication (CC0) 1.0",
        "http://rightsstatements.org/vocab/InC/1.0/": "In Copyright (RightsStatements.org)",
        "http://other/": "Unknown",
        None: "Unknown",
    }
    df = spark.createDataFrame([(u,) for u in want], "u string")
    assert {r[0]: r[1] for r in df.select("u", rights.full_label(F.col("u"))).collect()} == want


def test_inline_data(spark):
    left = spark.createDataFrame([("a", "x"), ("b", "y"), ("c", "x")], "s string, o string")
    given = graph.values(spark, ["o", "s", "more"], [("x", None, "1"), ("x", "a", None), (None, "b", "2"), ("z", None, "3")])
    assert sorted(map(tuple, graph.with_values(left, given).collect()), key=str) == sorted([("a", "x", "1"), ("a", "x", None), ("b", "y", "2"), ("c", "x", "1")], key=str)
