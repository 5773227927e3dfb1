"""A bitmap index over facets: which items have which value, and counts of all facets under any filter in one pass.

Items are numbered without gaps. A value's items lie in buckets of as many numbers as Spark's bitmaps have bits; a bucket with few of
them is a list of places, one with many a bitmap, whichever is smaller. A filter is a bitmap for each bucket, made by `or` over the values of a clause
and `and` over the clauses; a facet's counts are the places that lie in it. Neither reads edges or the cube again, and
the rows that meet are those of equal buckets, which are as many as there are items by 32,768, whatever the skew of values.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.scratch import delete, fresh_path, shuffles_let_go
from .catalog import Catalog
from .compose import CURATED, english_labels, whole_cube
from .explorer import FACETS, Explorer

#: Bits of Spark's bitmaps, and the places beyond which a bitmap is smaller than the list (of 2 bytes each).
BITS, DENSE = 32_768, 2_048
#: Buckets that a task of the build holds, on the average.
TASK_BUCKETS = 4
#: Columns of the cube that are facets too.
COLUMNS = ("v_edm_country", "v_edm_dataProvider", "v_edm_provider", "v_edm_type", "v_edm_datasetName", "x_primary_language", "x_reuse_level", "x_rights_family", "x_content_tier", "x_metadata_tier", "x_has_content_url", "x_has_iiif", "x_has_pdf", "x_has_subject", "x_has_creator", "x_is_newspaper", "x_is_specimen")
PARTS = ("numbers", "index", "labels")


def numbered(items: DataFrame, path: str) -> DataFrame:
    """(k_iri, n) saved at path: numbers from 0 without gaps, in the order of the items. What else items have is saved beside it, see placed().

    Items are ranged over partitions, numbered within each by their place there, and moved on by the sizes of those before (a row for each partition).
    """
    spark = items.sparkSession
    one = items.repartitionByRange("k_iri").dropDuplicates(["k_iri"]).sortWithinPartitions("k_iri")
    one.withColumn("own", F.monotonically_increasing_id()).write.parquet(path + "-ranged")
    placed(spark, path).select("k_iri", "n").write.parquet(path)
    return spark.read.parquet(path)


def placed(spark: SparkSession, path: str) -> DataFrame:
    """The items that numbered() saved for path, with their n and other columns."""
    ranged = spark.read.parquet(path + "-ranged").withColumn("part", F.shiftright("own", 33))  # the number of the partition, then the row's there
    sizes = ranged.groupBy("part").agg(F.count("*").alias("size"))
    before = sizes.select("part", (F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size")).alias("first"))
    return ranged.join(F.broadcast(before), "part").withColumn("n", F.col("first") + F.col("own").bitwiseAND(F.lit((1 << 33) - 1))).drop("part", "own", "first")


def indexed(pairs: DataFrame) -> DataFrame:
    """(facet, value, bucket, items, at, bits) of pairs (facet, value, n): at has the places of few items, bits the bitmap of many."""
    return by_places(located(pairs))


def located(numbers: DataFrame) -> DataFrame:
    """n as its bucket and its place p there."""
    return numbers.withColumns({"bucket": F.bitmap_bucket_number("n"), "p": F.bitmap_bit_position("n").cast("int")}).drop("n")


def by_places(places: DataFrame) -> DataFrame:
    """indexed() of (facet, value, bucket, p); rows that were dealt out by bucket aren't dealt out again."""
    key = ["facet", "value", "bucket"]
    lists = places.groupBy(*key).agg(F.collect_set("p").alias("at"))  # at most BITS of them
    few = lists.where(F.size("at") <= DENSE).select(*key, F.size("at").alias("items"), F.transform("at", lambda x: x.cast("smallint")).alias("at"), F.lit(None).cast("binary").alias("bits"))
    each = lists.where(F.size("at") > DENSE).select(*key, F.explode("at").alias("p"))
    many = each.groupBy(*key).agg(F.count("*").cast("int").alias("items"), F.lit(None).cast("array<smallint>").alias("at"), F.bitmap_construct_agg(F.col("p").cast("bigint")).alias("bits"))
    return few.unionByName(many)


def words(bits: Column) -> Column:
    """A bitmap as 64-bit words, the first byte highest."""
    return F.transform(F.sequence(F.lit(0), F.lit(BITS // 64 - 1)), lambda i: F.conv(F.hex(F.substring(bits, i * 8 + 1, F.lit(8))), 16, -10).cast("bigint"))


def is_set(of: Column, p: Column) -> Column:
    """Whether bit p is set in words."""
    p = p.cast("int")
    word = F.get(of, F.floor(p / 64).cast("int"))
    turn = (7 - F.floor(p / 8).cast("int") % 8) * 8 + p % 8
    return F.shiftrightunsigned(word, 0).bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("bigint"), turn)) != 0


@dataclass
class FacetBitmaps:
    """The index of a catalogue's facets."""

    numbers: DataFrame
    index: DataFrame
    labels: DataFrame

    @classmethod
    def build(cls, catalog: Catalog, path: str | None = None, columns: tuple[str, ...] = COLUMNS) -> FacetBitmaps:
        """Writes the index under path (or in the shared folder) and reads it. Shuffles and tables on the way go as soon as they are of no use."""
        path = path or fresh_path(catalog.spark, "bitmaps")
        with shuffles_let_go(catalog.spark):
            cls._write(catalog, path, columns)
        return cls.read(catalog.spark, path)

    @classmethod
    def _write(cls, catalog: Catalog, path: str, columns: tuple[str, ...]) -> None:
        spark = catalog.spark
        # The edges serve the cube's flags and the facets: they are made once.
        catalog("map_cho_entities").write.parquet(f"{path}/edges")
        catalog = Catalog(spark, catalog.folder, catalog.known | {"map_cho_entities": spark.read.parquet(f"{path}/edges")}, catalog.where)
        cube = whole_cube(catalog, counts=False) if catalog.where is None and "group_items" not in catalog.known and catalog.folder is None else catalog("group_items")
        cube.select("k_iri", *columns).write.parquet(f"{path}/cube")
        numbers = numbered(spark.read.parquet(f"{path}/cube"), f"{path}/numbers")
        # Each table is read once: an edge belongs to all facets of its class and property, told by bits. Labels are a matter of the values, not of the edges.
        labelled, own = cls._curated(catalog)
        of = {name: (F.col("x_entity_class") == f.cls) & ((F.col("x_property") == f.prop) if f.prop else F.lit(True)) for name, f in FACETS.items() if f.cls}
        bit = {name: 1 << i for i, name in enumerate(FACETS)}
        facets = reduce(lambda a, b: a + b, (F.when(test, bit[name]).otherwise(0) for name, test in of.items()))
        linked = own.select(facets.alias("facets"), F.col("k_iri_entity").alias("value"), F.col("k_iri_cho").alias("k_iri"))
        explorer = Explorer(catalog)
        edges = [linked] + [explorer.edges(f).select(F.lit(bit[name]).alias("facets"), F.col("k_iri_entity").alias("value"), F.col("k_iri_cho").alias("k_iri")) for name, f in FACETS.items() if not f.cls]
        every = reduce(DataFrame.unionByName, edges).where("value is not null and facets > 0").join(numbers, "k_iri").select("facets", "value", "n")
        # Rows of items and of edges are dealt out by bucket before they stand for all their facets. Some buckets go to a task, so that files of the index are few.
        parts = max(spark.sparkContext.defaultParallelism, -(-numbers.count() // (BITS * TASK_BUCKETS)))
        flat = located(placed(spark, f"{path}/numbers").select("n", *columns)).repartition(parts, "bucket")
        flat = flat.select("bucket", "p", F.explode(F.array(*[F.struct(F.lit(c).alias("facet"), F.col(c).cast("string").alias("value")) for c in columns])).alias("f")).select("f.facet", "f.value", "bucket", "p")
        dealt = located(every).repartition(parts, "bucket")
        names = F.array_compact(F.array(*[F.when(F.col("facets").bitwiseAND(F.lit(b)) > 0, name) for name, b in bit.items()]))
        by_places(dealt.select(F.explode(names).alias("facet"), "value", "bucket", "p")).unionByName(by_places(flat.where("value is not null"))).write.partitionBy("facet").parquet(f"{path}/index")
        values = spark.read.parquet(f"{path}/index").select("facet", "value").distinct()
        named = values.where(F.col("facet").isin(*of)).join(labelled, "value", "left").select("facet", "value", F.coalesce("label", "value").alias("label"))
        named.unionByName(values.where(~F.col("facet").isin(*of)).withColumn("label", F.col("value"))).write.parquet(f"{path}/labels")
        for name in ("edges", "cube", "numbers-ranged"):
            delete(spark, f"{path}/{name}")

    @staticmethod
    def _curated(catalog: Catalog) -> tuple[DataFrame, DataFrame]:
        """(value, label) of curated entities, and the edges to them: of the explorer's table where it is given or stored, else of what it is made from."""
        if "explorer_edm_entities" in catalog.known or catalog.folder is not None:
            edges = catalog("explorer_edm_entities")
            return edges.groupBy(F.col("k_iri_entity").alias("value")).agg(F.min("x_label").alias("label")), edges
        labels = english_labels(catalog).groupBy(F.col("k_iri_entity").alias("value")).agg(F.max("v_skos_prefLabel").alias("label"))
        return labels, catalog("map_cho_entities").where(F.col("k_iri_entity").startswith(CURATED))

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> FacetBitmaps:
        return cls(*(spark.read.parquet(f"{path}/{p}") for p in PARTS))

    def _clause(self, name: str, f: dict) -> tuple[DataFrame, int] | None:
        """Index rows of a clause, and of how many values an item must have all; 0: any. None for one that restricts nothing."""
        own = self.index.where(F.col("facet") == name)
        if f.get("kind") == "in" and f.get("values"):
            values = sorted({str(v).lower() if isinstance(v, bool) else str(v) for v in f["values"]})
            return own.where(F.col("value").isin(values)), len(values) if name in FACETS else 0
        if f.get("kind") == "range" and name in COLUMNS:
            number = F.col("value").try_cast("double")
            tests = [number >= f["min"]] if f.get("min") is not None else []
            tests += [number <= f["max"]] if f.get("max") is not None else []
            return (own.where(reduce(lambda a, b: a & b, tests)), 0) if tests else (own, 0)
        return None

    def selected(self, filters: dict | None) -> DataFrame | None:
        """(bucket, bits) of the items under filters (see Explorer.filtered), None without any. One row for each bucket."""
        parts, wanted = [], []
        for name, f in sorted((filters or {}).items()):
            if isinstance(f, dict) and (found := self._clause(name, f)):
                rows, every = found
                parts.append(rows.withColumn("clause", F.lit(len(parts))))
                wanted.append(every)
        if not parts:
            return None
        rows = reduce(DataFrame.unionByName, parts)
        key = ["clause", "value", "bucket"]
        few = rows.where("bits is null").select(*key, F.explode("at").alias("p")).groupBy(*key).agg(F.bitmap_construct_agg(F.col("p").cast("bigint")).alias("bits"))
        each = rows.where("bits is not null").select(*key, "bits").unionByName(few)
        every = F.get(F.array(*[F.lit(n) for n in wanted]), F.col("clause"))
        clause = each.groupBy("clause", "bucket").agg(F.bitmap_or_agg("bits").alias("any"), F.bitmap_and_agg("bits").alias("all"), F.count("*").alias("values"))
        clause = clause.where((every == 0) | (F.col("values") == every)).select("bucket", F.when(every == 0, F.col("any")).otherwise(F.col("all")).alias("bits"))
        return clause.groupBy("bucket").agg(F.bitmap_and_agg("bits").alias("bits"), F.count("*").alias("clauses")).where(F.col("clauses") == len(parts)).select("bucket", "bits")

    def counts(self, filters: dict | None = None, facets: list[str] | None = None) -> DataFrame:
        """(facet, value, label, items) of all facets asked for, under filters, in one pass; values without items are left out."""
        rows = self.index if facets is None else self.index.where(F.col("facet").isin(facets))
        chosen = self.selected(filters)
        if chosen is None:
            found = rows.groupBy("facet", "value").agg(F.sum("items").alias("items"))
        else:
            both = rows.join(chosen.select("bucket", words(F.col("bits")).alias("chosen")), "bucket")
            few = F.size(F.filter("at", lambda p: is_set(F.col("chosen"), p)))
            many = F.aggregate(F.zip_with(words(F.col("bits")), F.col("chosen"), lambda a, b: F.bit_count(a.bitwiseAND(b))), F.lit(0), lambda a, b: a + b)
            found = both.groupBy("facet", "value").agg(F.sum(F.when(F.col("bits").isNull(), few).otherwise(many)).alias("items")).where("items > 0")
        return found.join(self.labels, ["facet", "value"], "left").select("facet", "value", "label", "items")

    def total(self, filters: dict | None = None) -> DataFrame:
        """(items) under filters."""
        chosen = self.selected(filters)
        if chosen is None:
            return self.numbers.agg(F.count("*").alias("items"))
        return chosen.agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias("items"))

    def items(self, filters: dict | None = None) -> DataFrame:
        """(k_iri) of the items under filters."""
        chosen = self.selected(filters)
        if chosen is None:
            return self.numbers.select("k_iri")
        places = self.numbers.select("k_iri", F.bitmap_bucket_number("n").alias("bucket"), F.bitmap_bit_position("n").alias("p"))
        return places.join(chosen.select("bucket", words(F.col("bits")).alias("chosen")), "bucket").where(is_set(F.col("chosen"), F.col("p"))).select("k_iri")
