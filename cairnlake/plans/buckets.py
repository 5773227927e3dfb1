"""Tables stored in buckets of a key, so that joins on the key need no shuffle.

The parts of the item cube are stored by item, in equal numbers of buckets: the cube's joins, and any later join of these tables on the
item, then read buckets side by side. A table in buckets can be read in another session too, as its buckets are declared again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources.scratch import partitions_for
from .catalog import Catalog
from .compose import cube_of, cube_parts

#: Buckets of a table that is stored alone.
BUCKETS = 64
#: Bytes of the statements' files for a bucket of the cube's parts: a bucket of each is read by one task, so buckets grow with the data.
BUCKET = 8 << 20


def _name(path: str) -> str:
    from hashlib import sha256

    return "cairnlake_" + sha256(path.encode()).hexdigest()[:24]


def store(df: DataFrame, path: str, key: str, buckets: int = BUCKETS) -> DataFrame:
    """Writes df at path in buckets of key, one file each, sorted by it, and reads it. Rows with a null key are in one bucket."""
    spark, name = df.sparkSession, _name(path)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(buckets))  # what is grouped by the key is then in its bucket, and isn't dealt again
    try:
        df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).format("parquet").option("path", path).mode("overwrite").saveAsTable(name)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    return spark.table(name)


def opened(spark: SparkSession, path: str, key: str, buckets: int = BUCKETS) -> DataFrame:
    """A table stored by store(), in a session that doesn't know it yet."""
    name = _name(path)
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def buckets_for(catalog: Catalog) -> int:
    """Buckets for the parts of a catalogue's cube, by the size of what they are made from; open_cube_parts() needs the same number."""
    return partitions_for(catalog("links_ore_Proxy"), catalog("values_edm_WebResource"), each=BUCKET)


def store_cube_parts(catalog: Catalog, folder: str, buckets: int | None = None) -> dict[str, DataFrame]:
    """The parts of the item cube, stored in buckets of the item under folder: as many as buckets_for() says, if not told."""
    buckets = buckets or buckets_for(catalog)
    return {name: store(df, f"{folder}/{name}", "k_iri_cho", buckets) for name, df in cube_parts(catalog).items()}


def open_cube_parts(spark: SparkSession, folder: str, buckets: int) -> dict[str, DataFrame]:
    names = ("items", "provider", "curator", "tiers", "primary", "type", "properties", "titles", "entities", "resources", "newspapers")
    return {name: opened(spark, f"{folder}/{name}", "k_iri_cho", buckets) for name in names}


def bucketed_cube(parts: dict[str, DataFrame]) -> DataFrame:
    """The item cube from stored parts: ten joins without a shuffle."""
    return cube_of(parts)
