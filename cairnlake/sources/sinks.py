"""Writing tables, dataset cards and reports."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .digests import digests, listed


def write_table(df: DataFrame, folder: str, name: str, sorted_by: Sequence[str] = ()) -> str:
    """Parquet with zstd; links_* tables by x_property, sorted tables in ranges. An empty table keeps its schema."""
    if name.startswith("links_"):
        path, df = f"{folder}/{name}", df.repartition("x_property", F.pmod(F.xxhash64("k_iri"), F.lit(32)))
        df.write.mode("overwrite").option("compression", "zstd").partitionBy("x_property").parquet(path)
        return path
    path = f"{folder}/{name}.parquet"
    if sorted_by:
        df = df.repartitionByRange(*sorted_by).sortWithinPartitions(*sorted_by)
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return path


def delete_table(spark: SparkSession, folder: str, name: str) -> None:
    """Deletes a table that write_table wrote."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}" if name.startswith("links_") else f"{folder}/{name}.parquet")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def write_jsonl(df: DataFrame, path: str) -> None:
    """One JSON object a line, nulls written out."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def file_digests(spark: SparkSession, folder: str) -> DataFrame:
    """(path, bytes, sha256) of the data files under a folder, of any size, hashed where they are read."""
    return digests(listed(spark, folder, "*.parquet", recursive=True), "sha256").withColumnRenamed("length", "bytes")


CARD_TYPES = {"string": "sc:Text", "bigint": "sc:Integer", "int": "sc:Integer", "double": "sc:Float", "boolean": "sc:Boolean", "timestamp": "sc:DateTime"}


def dataset_card(name: str, description: str, tables: dict[str, DataFrame], licence: str | None = None, digests: DataFrame | None = None) -> dict:
    """A JSON-LD description: a file set and a record set with typed fields for each table.

    digests (of file_digests) adds each file with its size and SHA-256: a row of the description for each file.
    """
    files = [{"@type": "cr:FileSet", "@id": n, "name": n, "encodingFormat": "application/x-parquet", "includes": f"{n}.parquet/*.parquet"} for n in sorted(tables)]
    for r in digests.orderBy("path").collect() if digests is not None else []:
        files.append({"@type": "cr:FileObject", "@id": r["path"], "contentUrl": r["path"], "encodingFormat": "application/x-parquet", "contentSize": f"{r['bytes']} B", "sha256": r["sha256"]})
    records = [
        {"@type": "cr:RecordSet", "@id": f"{n}-records", "name": n, "field": [{"@type": "cr:Field", "@id": f"{n}/{f.name}", "name": f.name, "dataType": CARD_TYPES.get(f.dataType.simpleString(), "sc:Text"), "source": {"fileSet": {"@id": n}, "extract": {"column": f.name}}} for f in df.schema]}
        for n, df in sorted(tables.items())
    ]
    out = {"@context": {"@vocab": "https://schema.org/", "sc": "https://schema.org/", "cr": "http://mlcommons.org/croissant/"}, "@type": "sc:Dataset", "name": name, "description": description, "distribution": files, "recordSet": records}
    return out | ({"license": licence} if licence else {})


def cell(value: object) -> str:
    """A value for a Markdown table: thousands separated, two decimals unless whole, nothing for null."""
    if value is None:
        return ""
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, int):
        return f"{value:,}"
    if isinstance(value, float):
        return f"{int(value):,}" if value.is_integer() else f"{value:,.2f}"
    return str(value).replace("|", "\\|").replace("\n", " ")


def markdown_table(columns: Sequence[str], rows: Sequence[Sequence]) -> str:
    if not rows:
        return "_No results._"
    lines = ["| " + " | ".join(columns) + " |", "|" + "---|" * len(columns)]
    return "\n".join([*lines, *("| " + " | ".join(map(cell, r)) + " |" for r in rows)])


def to_json(value: object) -> str:
    return json.dumps(value, ensure_ascii=False, indent=2, default=str)
