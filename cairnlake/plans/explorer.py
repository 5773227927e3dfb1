"""The explorer: schema, summary, facet counts, samples and labels for a set of filters."""

from __future__ import annotations

import json
from collections import OrderedDict
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.storagelevel import StorageLevel

from ..functions.items import preferred_labels
from ..operators.aggregates import low_cardinality
from ..operators.filters import linked_to_all
from .catalog import Catalog
from .compose import ANY_PROPERTY, CLASS_FOLDER, CURATED, TOP_N, item_titles

MOST = 1000
CACHED_RESULTS, CACHED_FILTERS = 200, 8


@dataclass(frozen=True)
class Facet:
    """A facet over an edge table instead of a cube column; prop restricts it to one property."""

    cls: str | None
    table: str
    prop: str | None = None


FACETS = {
    "dc:subject": Facet("skos_Concept", "explorer_concepts", "v_dc_subject"),
    "dc:type": Facet("skos_Concept", "explorer_concepts", "v_dc_type"),
    "dcterms:medium": Facet("skos_Concept", "explorer_concepts", "v_dcterms_medium"),
    "dc:format": Facet("skos_Concept", "explorer_concepts", "v_dc_format"),
    "dc:creator": Facet("edm_Agent", "explorer_agents", "v_dc_creator"),
    "edm:Agent": Facet("edm_Agent", "explorer_agents"),
    "dcterms:spatial": Facet("edm_Place", "explorer_places", "v_dcterms_spatial"),
    "edm:Place": Facet("edm_Place", "explorer_places"),
    "edm:TimeSpan": Facet("edm_TimeSpan", "explorer_timespans"),
    "ebucore:hasMimeType": Facet(None, "map_cho_mimetypes"),
}


def clamp(n: int) -> int:
    return max(1, min(MOST, n))


class Explorer:
    """Answers are small; the filtered item ids are kept while their filter is in use."""

    def __init__(self, catalog: Catalog):
        self.catalog = catalog
        self._results: OrderedDict[str, object] = OrderedDict()
        self._ids: OrderedDict[str, DataFrame] = OrderedDict()

    def _remembered(self, key: tuple, make: Callable[[], object]) -> object:
        name = json.dumps(key, sort_keys=True, default=str)
        if name not in self._results:
            self._results[name] = make()
            if len(self._results) > CACHED_RESULTS:
                self._results.popitem(last=False)
        self._results.move_to_end(name)
        return self._results[name]

    def edges(self, facet: Facet) -> DataFrame:
        df = self.catalog(facet.table)
        if facet.table == "map_cho_mimetypes":
            df = df.select("k_iri_cho", F.col("v_mime_type").alias("k_iri_entity"), F.lit(None).cast("string").alias("x_property"), F.col("v_mime_type").alias("x_label"))
        return df.where(F.col("x_property") == facet.prop) if facet.prop else df

    def filtered(self, filters: dict | None) -> DataFrame:
        """The cube under filters {column or facet: {"kind": "in", "values": [..]}} or {"kind": "range", "min": .., "max": ..}.

        A column must have one of the values; an item must be linked to all values of a facet. Unknown
        names and empty value lists are left out.
        """
        df = self.catalog("group_items")
        for name, f in sorted((filters or {}).items()):
            values = f.get("values") or [] if isinstance(f, dict) else []
            if not isinstance(f, dict):
                continue
            if name in FACETS and f.get("kind") == "in" and values:
                df = df.join(linked_to_all(self.edges(FACETS[name]), values).withColumnRenamed("k_iri_cho", "k_iri"), "k_iri", "left_semi")
            elif name in df.columns and f.get("kind") == "in" and values:
                df = df.where(F.col(name).isin(values))
            elif name in df.columns and f.get("kind") == "range":
                df = df.where(reduce(lambda a, b: a & b, [F.col(name) >= f["min"] if f.get("min") is not None else F.lit(True), F.col(name) <= f["max"] if f.get("max") is not None else F.lit(True)]))
        return df

    def ids(self, filters: dict | None) -> DataFrame:
        """Matching item ids, materialised once per filter set; least recently used sets are let go."""
        key = json.dumps(filters or {}, sort_keys=True, default=str)
        if key not in self._ids:
            self._ids[key] = self.filtered(filters).select("k_iri").persist(StorageLevel.MEMORY_AND_DISK)
            if len(self._ids) > CACHED_FILTERS:
                self._ids.popitem(last=False)[1].unpersist()
        self._ids.move_to_end(key)
        return self._ids[key]

    def schema(self) -> dict:
        def kind(t: T.DataType) -> str:
            return "boolean" if isinstance(t, T.BooleanType) else "number" if isinstance(t, T.NumericType) else "iri_or_text"

        def make() -> dict:
            df = self.catalog("group_items")
            few = low_cardinality(df, [f.name for f in df.schema if f.name != "k_iri"])
            columns = [{"name": f.name, "kind": kind(f.dataType), "low_cardinality": few.get(f.name, False)} for f in df.schema]
            return {"rows": df.count(), "columns": columns, "facets": list(FACETS)}

        return self._remembered(("schema",), make)

    def summary(self, filters: dict | None = None, by: str = "v_edm_type", limit: int = 30) -> dict:
        """Number of items, approximate numbers of countries and providers, and the largest groups (nulls as a group)."""

        def make() -> dict:
            df = self.filtered(filters)
            head = df.agg(F.count("*").alias("items"), F.approx_count_distinct("v_edm_country").alias("countries"), F.approx_count_distinct("v_edm_dataProvider").alias("providers")).first().asDict()
            bars = df.groupBy(F.col(by).alias("value")).agg(F.count("*").alias("items")).orderBy(F.desc("items"), F.col("value").asc_nulls_last()).limit(limit)
            return head | {"by": by, "groups": [r.asDict() for r in bars.collect()]}

        return self._remembered(("summary", filters, by, limit), make)

    def counts(self, name: str, filters: dict | None = None) -> DataFrame:
        """(value, label, items) of a column or facet, nulls left out; items are counted once per value."""
        if name not in FACETS:
            df = self.filtered(filters).where(F.col(name).isNotNull())
            return df.groupBy(F.col(name).cast("string").alias("value")).agg(F.count("*").alias("items")).select("value", F.col("value").alias("label"), "items")
        f = FACETS[name]
        if not filters and f.cls:  # ranked beforehand
            top = self.catalog("explorer_facet_top_n").where((F.col("x_entity_class") == f.cls) & (F.col("x_property") == (f.prop or ANY_PROPERTY)))
            return top.select(F.col("k_iri_entity").alias("value"), F.col("x_label").alias("label"), F.col("x_item_count").alias("items"))
        edges = self.edges(f)
        if filters:
            edges = edges.join(self.ids(filters).withColumnRenamed("k_iri", "k_iri_cho"), "k_iri_cho", "left_semi")
        one = edges.groupBy("k_iri_entity", "k_iri_cho").agg(F.min("x_label").alias("label"))
        return one.groupBy(F.col("k_iri_entity").alias("value")).agg(F.min("label").alias("label"), F.count("*").alias("items"))

    def top_values(self, name: str, filters: dict | None = None, limit: int = 50) -> dict:
        """The values with most items, ties by value, and whether there are more; past the ranked rows the live count is taken."""
        n = clamp(limit)

        def make() -> dict:
            live = filters if filters or n < TOP_N else {"": None}
            rows = self.counts(name, live).orderBy(F.desc("items"), "value").limit(n + 1).collect()
            return {"values": [r.asDict() for r in rows[:n]], "truncated": len(rows) > n}

        return self._remembered(("top", name, filters, n), make)

    def sample(self, filters: dict | None = None, n: int = 20, seed: int | None = None) -> list[dict]:
        """Random items among those that match."""
        return [r.asDict() for r in self.filtered(filters).orderBy(F.rand(seed)).limit(clamp(n)).collect()]

    def label_table(self, iris: list[str]) -> DataFrame:
        """(k_iri, label) of IRIs, English before untagged before others; each IRI's namespace says where to look, unknown ones are absent. The first MOST IRIs are looked up: an answer is for a page of results."""
        iris = list(dict.fromkeys(iris))[:MOST]
        sources = {CURATED + folder: f"values_{cls}" for cls, folder in CLASS_FOLDER.items()} | {CURATED + "organization/": "values_foaf_Organization"}
        parts = []
        for start, table in sources.items():
            if own := [i for i in iris if i.startswith(start)]:
                parts.append(preferred_labels(self.catalog(table).where(F.col("k_iri").isin(own)), "k_iri", "v_skos_prefLabel", "x_prefLabel_lang"))
        if own := [i for i in iris if i.startswith(CURATED + "item/")]:
            parts.append(preferred_labels(item_titles(self.catalog).where(F.col("k_iri").isin(own)), "k_iri", "label", "lang"))
        empty = self.catalog.spark.createDataFrame([], "k_iri string, label string")
        return reduce(DataFrame.unionByName, parts, empty)

    def labels(self, iris: list[str]) -> dict[str, str]:
        return {r["k_iri"]: r["label"] for r in self.label_table(iris).collect()}
