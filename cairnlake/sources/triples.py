"""Statements as a DataFrame: triples(s, p, o, o_kind, o_lang, o_datatype), and readers for their text forms."""

from __future__ import annotations

import warnings
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .digests import digests, listed

TRIPLES = "s string, p string, o string, o_kind string, o_lang string, o_datatype string"
IRI = r"<([^<>\"{}|^`\\\x00-\x20]*)>"
LITERAL = r'"((?:[^"\\\n\r]|\\.)*)"(?:@([A-Za-z]+(?:-[A-Za-z0-9]+)*)|\^\^' + IRI + ")?"
STATEMENT = rf"^\s*(?:{IRI}|(_:\S+))\s*{IRI}\s*(?:{IRI}|(_:[^\s.]+)|{LITERAL})\s*\.\s*(?:#.*)?$"
# Escapes of the N-Triples syntax.
ESCAPES = {r"\t": "\t", r"\n": "\n", r"\r": "\r", r"\b": "\b", r"\f": "\f", r"\"": '"', r"\'": "'"}


def unescaped(text: Column) -> Column:
    """A literal without backslash escapes, \\uXXXX and \\UXXXXXXXX too.

    The text is taken apart at its escapes, each is replaced, and the parts are joined again; a text without
    a backslash is left as it is.
    """
    simple = F.create_map(*[F.lit(x) for k, v in ESCAPES.items() for x in (k, v)])

    def one(token: Column) -> Column:
        code = F.conv(F.substring(token, 3, 8), 16, 10).cast("int")
        # decode from UTF-32 gives characters beyond the first plane as well
        char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        return F.coalesce(F.element_at(simple, token), F.when(token.rlike(r"^\\[uU]"), char), F.when(token == r"\\", "\\"), token)

    tokens = F.regexp_extract_all(text, F.lit(r"(\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|\\.|[^\\]+)"), F.lit(1))
    return F.when(text.contains("\\"), F.array_join(F.transform(tokens, one), "")).otherwise(text)


def parse_statements(lines: DataFrame, value: str = "value") -> DataFrame:
    """Triples of N-Triples lines; blank lines, comments and lines that aren't statements are left out."""
    v = F.col(value)
    part = lambda i: F.nullif(F.regexp_extract(v, STATEMENT, i), F.lit(""))
    rows = lines.where(v.rlike(STATEMENT))
    literal = part(4).isNull() & part(5).isNull()
    o = F.coalesce(part(4), part(5), unescaped(F.regexp_extract(v, STATEMENT, 6)))
    kind = F.when(part(4).isNotNull(), "iri").when(part(5).isNotNull(), "bnode").otherwise("literal")
    return rows.select(F.coalesce(part(1), part(2)).alias("s"), part(3).alias("p"), o.alias("o"), kind.alias("o_kind"), F.when(literal, F.lower(part(7))).alias("o_lang"), F.when(literal, part(8)).alias("o_datatype"))


def read_ntriples(spark: SparkSession, path: str) -> DataFrame:
    """Triples of N-Triples files, plain or compressed."""
    return parse_statements(spark.read.text(path))


def invalid_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, value) of lines that are neither blank, comment nor statement."""
    rows = spark.read.text(path).select(F.input_file_name().alias("file"), "value")
    return rows.where(~F.col("value").rlike(STATEMENT) & ~F.col("value").rlike(r"^\s*(#.*)?$"))


def checked_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, md5, expected, matches) of files, of any size, beside their .md5 files; matches is null without one."""
    files = listed(spark, path)
    sums = spark.read.format("binaryFile").option("pathGlobFilter", "*.md5").load(path).select("path", F.lower(F.regexp_extract(F.col("content").cast("string"), "([0-9A-Fa-f]{32})", 1)).alias("expected"))
    # Readers of Spark give the same places in other ways: their names tell which file a sum is of.
    inner = lambda c: F.regexp_replace(c, "^[a-z0-9]+:(//[^/]*)?", "")
    sums = sums.select(F.regexp_replace(inner(F.col("path")), r"\.md5$", "").alias("of"), "expected")
    data = digests(files.where(~F.col("path").endswith(".md5")), "md5")
    return data.withColumn("of", inner(F.col("path"))).join(sums, "of", "left").drop("of").withColumn("matches", F.col("md5") == F.col("expected"))


def verified(spark: SparkSession, path: str, policy: str = "strict") -> DataFrame:
    """checked_files under a policy for files that differ from their sum: "strict" raises, "warn" keeps them with a warning, "skip" leaves them out. Files without a sum are kept."""
    if policy not in ("strict", "warn", "skip"):
        raise ValueError(f"no policy {policy}")
    files = checked_files(spark, path)
    if policy == "skip":
        return files.where("matches is null or matches")
    bad = [r["path"] for r in files.where("not matches").select("path").orderBy("path").limit(10).collect()]
    if bad and policy == "strict":
        raise ValueError(f"files differ from their MD5 sums, among them {', '.join(bad)}")
    if bad:
        warnings.warn(f"files differ from their MD5 sums, among them {', '.join(bad)}", stacklevel=2)
    return files


def prefixes(spark: SparkSession, path: str) -> DataFrame:
    """Different (prefix, namespace) declarations of Turtle files."""
    found = F.regexp_extract("value", r"(?i)^\s*(?:@prefix|prefix)\s+([\w.-]*):\s*<([^>]*)>", 1), F.regexp_extract("value", r"(?i)^\s*(?:@prefix|prefix)\s+([\w.-]*):\s*<([^>]*)>", 2)
    return spark.read.text(path).select(found[0].alias("prefix"), found[1].alias("namespace")).where("namespace <> ''").distinct()


def statements(triples: DataFrame, short: Callable[[Column, Column], Column] = lambda text, iri: text) -> DataFrame:
    """(value) a line for each triple; short(text, iri) may give another text for an IRI."""
    iri = lambda c: short(F.concat(F.lit("<"), c, F.lit(">")), c)
    term = lambda c: F.when(c.startswith("_:"), c).otherwise(iri(c))
    text = F.col("o")
    for raw, escaped in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        text = F.replace(text, F.lit(raw), F.lit(escaped))
    tail = F.when(F.col("o_lang").isNotNull(), F.concat(F.lit("@"), "o_lang")).when(F.col("o_datatype").isNotNull(), F.concat(F.lit("^^"), iri(F.col("o_datatype")))).otherwise("")
    o = F.when(F.col("o_kind") == "literal", F.concat(F.lit('"'), text, F.lit('"'), tail)).otherwise(term(F.col("o")))
    return triples.select(F.concat(term(F.col("s")), F.lit(" "), iri(F.col("p")), F.lit(" "), o, F.lit(" .")).alias("value"))


def write_ntriples(triples: DataFrame, path: str, per_file: int = 10_000_000) -> None:
    """N-Triples text, at most per_file statements to a file; rolled.write_turtle bounds files by their bytes."""
    statements(triples).write.option("maxRecordsPerFile", per_file).text(path)


def term_text(cell: Column) -> Column:
    """Lexical value of a cell in N-Triples syntax: the text of a literal, an IRI without brackets, anything else as it is; null for ''."""
    literal = F.regexp_extract(cell, '^"((?:[^"\\\\]|\\\\.)*)"', 1)
    value = F.when(cell.startswith('"'), unescaped(literal)).when(cell.rlike("^<.*>$"), F.regexp_extract(cell, "^<(.*)>$", 1)).otherwise(cell)
    return F.nullif(value, F.lit(""))


def read_result_tsv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A query result in TSV with a header of ?names: short rows are padded with nulls, long ones cut, cells reduced to their text."""
    lines = spark.read.text(path).where(~F.col("value").rlike(r"^\?\w+(\t\?\w+)*\s*$"))
    cells = F.split(F.regexp_replace("value", r"\r$", ""), "\t")
    return lines.select(*[term_text(F.get(cells, F.lit(i))).alias(c) for i, c in enumerate(columns)])
