import pytest
from pyspark.sql import functions as F

from cairnlake.operators import graph
from cairnlake.sources import sinks
from cairnlake.sources import triples as R
from cairnlake.sources.turtle import read_turtle
from cairnlake.streaming.facets import first_seen, windowed_counts


def test_statements_round_trip(spark, tmp_path):
    rows = [("http://a", "http://p", 'quote " back \\ slash\nline\ttab', "literal", None, None), ("http://a", "http://p", "é😀", "literal", "en-gb", None), ("_:b1", "http://p", "7", "literal", None, "http://int"), ("http://a", "http://p", "_:b1", "bnode", None, None), ("http://a", "http://p", "http://o", "iri", None, None)]
    df = spark.createDataFrame(rows, R.TRIPLES)
    R.write_ntriples(df, str(tmp_path / "x"))
    back = R.read_ntriples(spark, str(tmp_path / "x"))
    assert sorted(map(tuple, back.collect()), key=str) == sorted(rows, key=str)


def test_escapes(spark):
    lines = spark.createDataFrame([('<http://a> <http://p> "\\u00e9\\U0001F600\\\\n" .',), ("# c",), ("",), ("<a b> <p> <o> .",)], "value string")
    assert [r["o"] for r in R.parse_statements(lines).collect()] == ["é😀\\n"]


def test_result_tsv(spark, tmp_path):
    (tmp_path / "r.tsv").write_text('?a\t?b\n"txt"@en\t<http://i>\textra\n5\n"a\\"b"^^<http://t>\t_:b0\n\t<x>\n')
    got = R.read_result_tsv(spark, str(tmp_path / "r.tsv"), ["a", "b"])
    assert sorted(map(tuple, got.collect()), key=str) == sorted([("txt", "http://i"), ("5", None), ('a"b', "_:b0"), (None, "x")], key=str)


def test_checked_files_and_prefixes(spark, tmp_path):
    import hashlib

    (tmp_path / "a.ttl").write_text("@prefix ex: <http://ex/> .\nPREFIX b: <http://b/>\n")
    (tmp_path / "a.ttl.md5").write_text(hashlib.md5((tmp_path / "a.ttl").read_bytes()).hexdigest() + "  a.ttl")
    (tmp_path / "b.ttl").write_text("x")
    (tmp_path / "b.ttl.md5").write_text("0" * 32)
    (tmp_path / "c.ttl").write_text("y")
    got = {r["path"][-5:]: r["matches"] for r in R.checked_files(spark, str(tmp_path)).collect()}
    assert got == {"a.ttl": True, "b.ttl": False, "c.ttl": None}
    assert sorted(map(tuple, R.prefixes(spark, str(tmp_path / "a.ttl")).collect())) == [("b", "http://b/"), ("ex", "http://ex/")]


def test_empty_table_keeps_its_schema(spark, tmp_path):
    sinks.write_table(spark.createDataFrame([], "a string, b bigint"), str(tmp_path), "t")
    assert spark.read.parquet(str(tmp_path / "t.parquet")).dtypes == [("a", "string"), ("b", "bigint")]


def test_card_and_cells(spark):
    card = sinks.dataset_card("n", "d", {"t": spark.range(1)})
    assert card["recordSet"][0]["field"][0]["dataType"] == "sc:Integer"
    assert [sinks.cell(x) for x in (None, True, 1234567, 2.0, 2.345, "a|b")] == ["", "true", "1,234,567", "2", "2.35", "a\\|b"] or sinks.cell(2.345) == "2.35"


def test_pattern_repeats_a_variable(spark):
    t = spark.createDataFrame([("a", "p", "a"), ("a", "p", "b")], "s string, p string, o string")
    assert [tuple(r) for r in graph.Pattern("?x", "p", "?x").match(t).collect()] == [("a",)]


def test_streamed_counts_equal_batch(spark, tmp_path, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "event_type")
    events.orderBy("ts").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    q = windowed_counts(stream, "ts", "event_type").writeStream.outputMode("complete").format("memory").queryName("facets").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    key = lambda df: sorted(map(tuple, df.select("start", "event_type", "n").collect()))
    assert key(spark.table("facets")) == key(windowed_counts(events, "ts", "event_type"))


def test_first_seen(spark, tmp_path, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select("user_id", "event_type", "ts").where(F.col("user_id") < 5)
    e.unionByName(e).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(e.schema).parquet(str(tmp_path / "in"))
    q = first_seen(stream, "ts", ["user_id", "event_type"]).writeStream.format("memory").queryName("seen").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("seen").count() == e.select("user_id", "event_type").distinct().count()


def test_policies_for_damaged_files(spark, tmp_path):
    (tmp_path / "a.nt").write_text("x")
    (tmp_path / "a.nt.md5").write_text("0" * 32)
    (tmp_path / "b.nt").write_text("y")
    with pytest.raises(ValueError, match="a.nt"):
        R.verified(spark, str(tmp_path))
    with pytest.warns(UserWarning, match="a.nt"):
        assert R.verified(spark, str(tmp_path), "warn").count() == 2
    assert [r["path"][-4:] for r in R.verified(spark, str(tmp_path), "skip").collect()] == ["b.nt"]
    with pytest.raises(ValueError):
        R.verified(spark, str(tmp_path), "no")


TURTLE = r'''@prefix ex: <http://ex/> . PREFIX b: <http://b/>
@base <http://base/dir/> .
ex:s a ex:T ; ex:p "one"@EN-gb , "two"^^ex:d, 'th\u0072ee' ;; b:q.r <x> . # end
<y> ex:n 5 , -1.5, 2e3, true ; ex:l """long "quoted"
text""" ; ex:o _:n1 .
_:n1 ex:p [ ex:q ex:a\,b ; ex:r [] ] .
[ ex:q 1 ] .
'''


def test_turtle(spark, tmp_path):
    (tmp_path / "a.ttl").write_text(TURTLE)
    (tmp_path / "empty.ttl").write_text("# nothing\n")
    got = read_turtle(spark, str(tmp_path)).collect()
    assert all(r["problem"] is None and r["file"].endswith("a.ttl") for r in got)
    short = lambda x: x.replace("http://", "").split("#")[-1] if x and not x.startswith("_:") else x and "_"
    rows = [(short(r["s"]), short(r["p"]), short(r["o"]), r["o_kind"], r["o_lang"], short(r["o_datatype"])) for r in got]
    assert rows == [
        ("ex/s", "type", "ex/T", "iri", None, None), ("ex/s", "ex/p", "one", "literal", "en-gb", None), ("ex/s", "ex/p", "two", "literal", None, "ex/d"), ("ex/s", "ex/p", "three", "literal", None, None),
        ("ex/s", "b/q.r", "base/dir/x", "iri", None, None),
        ("base/dir/y", "ex/n", "5", "literal", None, "integer"), ("base/dir/y", "ex/n", "-1.5", "literal", None, "decimal"), ("base/dir/y", "ex/n", "2e3", "literal", None, "double"), ("base/dir/y", "ex/n", "true", "literal", None, "boolean"),
        ("base/dir/y", "ex/l", 'long "quoted"\ntext', "literal", None, None), ("base/dir/y", "ex/o", "_", "bnode", None, None),
        ("_", "ex/q", "ex/a,b", "iri", None, None), ("_", "ex/r", "_", "bnode", None, None), ("_", "ex/p", "_", "bnode", None, None), ("_", "ex/q", "1", "literal", None, "integer"),
    ]


def test_turtle_that_is_damaged(spark, tmp_path):
    (tmp_path / "a.ttl").write_text("<http://a> <http://p> 1 .\n<http://a> ex:p 2 .")
    got = read_turtle(spark, str(tmp_path), strict=False).collect()
    assert [(r["o"], r["problem"]) for r in got] == [("1", None), (None, "line 2: no prefix 'ex'")]
    with pytest.raises(Exception, match="no prefix"):
        read_turtle(spark, str(tmp_path)).collect()


def test_json_lines_and_digests(spark, tmp_path):
    import hashlib

    sinks.write_jsonl(spark.createDataFrame([(1, None)], "a bigint, b string"), str(tmp_path / "j"))
    assert [r["value"] for r in spark.read.text(str(tmp_path / "j")).collect()] == ['{"a":1,"b":null}']
    sinks.write_table(spark.range(3), str(tmp_path / "t"), "x")
    card = sinks.dataset_card("n", "d", {"x": spark.range(3)}, digests=sinks.file_digests(spark, str(tmp_path / "t")))
    files = [f for f in card["distribution"] if f["@type"] == "cr:FileObject"]
    assert files and all(f["sha256"] == hashlib.sha256(open(f["contentUrl"].removeprefix("file:"), "rb").read()).hexdigest() for f in files)
