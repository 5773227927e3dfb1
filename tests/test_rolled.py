"""Text files of bounded size."""

import gzip
import os

import pytest
from pyspark.sql import functions as F

from cairnlake.sources import archives, rolled
from cairnlake.sources.triples import TRIPLES


def files(path):
    return sorted(p for p in path.iterdir() if not p.name.startswith((".", "_")))


def test_sizes_and_lines(spark, tmp_path):
    """Files are within 1 % of the bound but for a partition's last one, and hold all lines in order."""
    df = spark.range(0, 60_000, 1, 3).select(F.concat(F.lit("line é "), F.col("id").cast("string"), F.repeat(F.lit("x"), (F.col("id") % 50).cast("int"))).alias("value"))
    rolled.write_rolled(df, str(tmp_path / "out"), roll_bytes=100_000, header="# head\n")
    found = files(tmp_path / "out")
    sizes = {}
    for f in found:
        sizes.setdefault(f.name[:10], []).append(f.stat().st_size)
    assert len(sizes) == 3 and all(s <= 100_000 for own in sizes.values() for s in own) and all(s > 99_000 for own in sizes.values() for s in own[:-1])
    text = [f.read_text() for f in found]
    assert all(t.startswith("# head\n") and t.endswith("\n") for t in text)
    assert [x for t in text for x in t.split("\n")[1:-1]] == [r["value"] for r in df.collect()]
    assert (tmp_path / "out" / "_SUCCESS").exists() and sorted(p.name for p in tmp_path.iterdir()) == ["out"]


def test_odd_lines(spark, tmp_path):
    """Null and empty lines, a line longer than the bound, and nothing at all."""
    rows = [("a",), (None,), ("",), ("long " * 100,), ("b",)]
    rolled.write_rolled(spark.createDataFrame(rows, "value string").coalesce(1), str(tmp_path / "out"), roll_bytes=100, header="h\n")
    assert [f.read_text() for f in files(tmp_path / "out")] == ["h\na\n\n\n", "h\n" + "long " * 100 + "\n", "h\nb\n"]
    rolled.write_rolled(spark.createDataFrame([], "value string"), str(tmp_path / "none"))
    assert files(tmp_path / "none") == [] and (tmp_path / "none" / "_SUCCESS").exists()
    with pytest.raises(Exception, match="header"):
        rolled.write_rolled(spark.createDataFrame(rows, "value string"), str(tmp_path / "x"), roll_bytes=3, header="long header")


def test_modes_and_compression(spark, tmp_path):
    one = lambda x: spark.createDataFrame([(x,)], "value string").coalesce(1)
    for text, mode in (("a", "append"), ("b", "append"), ("c", "overwrite"), ("d", "append")):
        rolled.write_rolled(one(text), str(tmp_path / "out"), mode=mode, compression="gzip")
        if text == "b":
            assert sorted(gzip.decompress(f.read_bytes()) for f in files(tmp_path / "out")) == [b"a\n", b"b\n"]
    assert sorted(gzip.decompress(f.read_bytes()) for f in files(tmp_path / "out")) == [b"c\n", b"d\n"] and [p.name for p in tmp_path.iterdir()] == ["out"]


def test_a_failed_job_leaves_nothing(spark, tmp_path):
    bad = spark.range(0, 4000, 1, 2).select(F.when(F.col("id") == 3500, F.raise_error(F.lit("broken"))).otherwise(F.col("id").cast("string")).alias("value"))
    rolled.write_rolled(spark.createDataFrame([("kept",)], "value string"), str(tmp_path / "out"))
    with pytest.raises(Exception, match="broken"):
        rolled.write_rolled(bad, str(tmp_path / "out"), mode="overwrite", roll_bytes=1000)
    assert [p.name for p in tmp_path.iterdir()] == ["out"] and [f.read_text() for f in files(tmp_path / "out")] == ["kept\n"]


def test_attempts_that_do_not_count(spark, tmp_path):
    """Files of an attempt whose message the driver has not got are dropped at the commit."""
    writer = rolled.RolledWriter({"path": str(tmp_path / "out")}, False)
    _, _, own = writer._folder()
    os.makedirs(own)
    for name in ("part-00000-1-0000.txt", "part-00000-2-0000.txt"):
        with open(f"{own}/{name}", "w") as f:
            f.write("same\n")
    writer.commit([rolled.Written(["part-00000-2-0000.txt"], [5], [1]), None])
    assert [f.name for f in files(tmp_path / "out")] == ["part-00000-2-0000.txt"]


def test_turtle_round_trip(spark, tmp_path):
    rows = [("http://ex/a", "http://ex/p", 'q " \\ \n\t é', "literal", None, None), ("http://ex/a", "http://ex/sub/q", "x", "literal", "en-gb", None), ("_:b1", "http://ex/p", "7", "literal", None, "http://ex/sub/int"), ("http://ex/1a", "http://ex/p", "_:b1", "bnode", None, None), ("http://ex/sub/x/y", "http://ex/", "http://ex/oé", "iri", None, None)]
    df = spark.createDataFrame(rows * 50, TRIPLES)
    rolled.write_turtle(df, str(tmp_path / "out"), {"ex": "http://ex/", "sub": "http://ex/sub/"}, roll_bytes=600)
    back = archives.read_dump(spark, str(tmp_path / "out")).drop("file", "entry", "problem").collect()
    name = lambda x: "_" if x.startswith("_:") else x
    assert sorted(str((name(r[0]), r[1], name(r[2]), *r[3:])) for r in back) == sorted(str((name(r[0]), r[1], name(r[2]), *r[3:])) for r in rows * 50)
    text = files(tmp_path / "out")[0].read_text()
    assert text.startswith("@prefix ex: <http://ex/> .\n@prefix sub: <http://ex/sub/> .\n") and "ex:a ex:p" in text and "sub:q" in text and "<http://ex/1a>" in text
    assert len(files(tmp_path / "out")) > 10 and all(f.stat().st_size <= 600 for f in files(tmp_path / "out"))
