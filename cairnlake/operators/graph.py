"""Graph patterns over triples: basic patterns, optional, union and negation as joins, and the raw tables made with them."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import LINKS, VALUES, WEB_RESOURCE, LinksTable, ValuesTable, column_of, expand

RDF_TYPE = expand("rdf:type")


@dataclass(frozen=True)
class Pattern:
    """A triple pattern: "?x" is a variable, anything else a term (an IRI or a literal's text)."""

    s: str
    p: str
    o: str

    def match(self, triples: DataFrame) -> DataFrame:
        """Bindings, a column for each variable; a variable that stands twice must match itself."""
        df, names, out = triples, {}, []
        for position in ("s", "p", "o"):
            term = getattr(self, position)
            if not term.startswith("?"):
                df = df.where(F.col(position) == term)
            elif term in names:
                df = df.where(F.col(position) == F.col(names[term]))
            else:
                names[term] = position
                out.append(F.col(position).alias(term[1:]))
        return df.select(*out)


def bgp(triples: DataFrame, *patterns: Pattern | tuple[str, str, str]) -> DataFrame:
    """Joins patterns on the variables they share, each with what came before; a pattern that shares none is an error."""

    def add(left: DataFrame, pattern: Pattern) -> DataFrame:
        right = pattern.match(triples)
        shared = [c for c in right.columns if c in left.columns]
        if not shared:
            raise ValueError(f"{pattern} shares no variable with the patterns before it")
        return left.join(right, shared)

    first, *rest = [p if isinstance(p, Pattern) else Pattern(*p) for p in patterns]
    return reduce(add, rest, first.match(triples))


def _shared(left: DataFrame, right: DataFrame) -> list[str]:
    return [c for c in right.columns if c in left.columns]


def optional(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left join on shared variables: several matches give several rows."""
    return left.join(right, _shared(left, right), "left")


def union(*parts: DataFrame) -> DataFrame:
    """All solutions of all parts, repeats kept; a variable that a part lacks is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def not_exists(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.join(right, _shared(left, right), "left_anti")


def exists(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.join(right, _shared(left, right), "left_semi")


def values(spark: SparkSession, names: list[str], rows: list[tuple]) -> DataFrame:
    """Inline data: solutions given as rows of terms, None for one that is unbound, which any term fits. Joined by with_values()."""
    return spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))


def with_values(left: DataFrame, given: DataFrame) -> DataFrame:
    """Solutions that agree with inline data; an unbound term in the data fits every value, and a variable that only the data has is added. The data is small, as it was written into a query."""
    shared = _shared(left, given)
    data = given.select(*[F.col(c).alias(f"__v_{c}") for c in given.columns])
    fits = reduce(lambda a, b: a & b, [F.col(f"__v_{c}").isNull() | (F.col(c) == F.col(f"__v_{c}")) for c in shared], F.lit(True))
    added = [F.col(f"__v_{c}").alias(c) for c in given.columns if c not in shared]
    return left.join(F.broadcast(data), fits).select(*left.columns, *added)


def page(df: DataFrame, order: list[str], limit: int, offset: int = 0) -> DataFrame:
    return df.orderBy(*order).offset(offset).limit(limit)


def of_class(triples: DataFrame, rdf_class: str) -> DataFrame:
    return Pattern("?k_iri", RDF_TYPE, expand(rdf_class)).match(triples)


def _typed(table: ValuesTable, prop: str, value: Column) -> Column:
    return value.cast("bigint") if prop in table.numbers else value.cast("double") if prop in table.doubles else value


def _columns(triples: DataFrame, table: ValuesTable, base: DataFrame) -> DataFrame:
    """base with a column for each required and optional property.

    All properties come from one pass over the statements: they are pivoted into arrays of values per subject, and
    a property with several values gives several rows, as optional patterns do.
    """
    properties = [*table.required, *table.optional]
    if properties:
        value = F.when(F.col("o") != "", F.col("o"))
        found = triples.where(F.col("p").isin([expand(p) for p in properties]))
        lists = [F.collect_list(F.when(F.col("p") == expand(p), value)).alias(column_of(p)) for p in properties]
        base = base.join(found.groupBy(F.col("s").alias("k_iri")).agg(*lists), "k_iri", "left")
        for p in properties:
            base = base.withColumn(column_of(p), F.explode_outer(column_of(p)))
        for p in properties:
            base = base.withColumn(column_of(p), _typed(table, p, F.col(column_of(p))))
        for p in table.required:
            base = base.where(F.col(column_of(p)).isNotNull())
    if table.labelled:
        labels = triples.where(F.col("p") == expand("skos:prefLabel")).select(F.col("s").alias("k_iri"), F.col("o").alias("v_skos_prefLabel"), F.nullif(F.coalesce("o_lang", F.lit("")), F.lit("")).alias("x_prefLabel_lang"))
        base = base.join(labels, "k_iri")
    return base.select(*sorted(base.columns))


def values_table(triples: DataFrame, table: ValuesTable) -> DataFrame:
    """Rows of a values table; the subject's class or the item that it is about decides which subjects there are."""
    base = of_class(triples, table.rdf_class) if table.rdf_class else None
    if table.about:
        about = Pattern("?k_iri", expand(table.about), f"?{table.about_column}").match(triples)
        base = about if base is None else base.join(about, "k_iri")
        if table.about == "ore:proxyFor":
            base = base.withColumn("v_ore_proxyFor", F.col(table.about_column))
    return _columns(triples, table, base)


def web_resources(triples: DataFrame) -> DataFrame:
    """Resources that an aggregation shows or views; one that does both stands twice."""
    item = Pattern("?a", expand("edm:aggregatedCHO"), "?k_iri_cho").match(triples)
    shown = union(*(Pattern("?a", expand(p), "?k_iri").match(triples) for p in ("edm:isShownBy", "edm:hasView")))
    return _columns(triples, WEB_RESOURCE, item.join(shown, "a").select("k_iri", "k_iri_cho"))


def services(triples: DataFrame) -> DataFrame:
    return Pattern("?k_iri_webresource", expand("svcs:has_service"), "?k_iri").match(triples).select("k_iri", "k_iri_webresource")


def publishing_tiers(triples: DataFrame) -> DataFrame:
    """Tier URIs of items by the quality annotations of the curator's aggregation."""
    bodies = bgp(triples, ("?a", RDF_TYPE, expand("edm:EuropeanaAggregation")), ("?a", expand("edm:aggregatedCHO"), "?k_iri"), ("?a", expand("dqv:hasQualityAnnotation"), "?q"), ("?q", expand("oa:hasBody"), "?body"))
    kind = lambda text: F.max(F.when(F.col("body").contains(text), F.col("body")))
    return bodies.groupBy("k_iri").agg(kind("contentTier").alias("x_content_tier_uri"), kind("metadataTier").alias("x_metadata_tier_uri")).where("x_content_tier_uri is not null or x_metadata_tier_uri is not null")


def links_table(triples: DataFrame, table: LinksTable) -> DataFrame:
    """One row per value of the table's properties; all properties in one pass."""
    subjects = of_class(triples, table.rdf_class) if table.rdf_class else triples.where(F.col("p") == expand(table.subject_of)).select(F.col("s").alias("k_iri"))
    names = F.create_map(*[F.lit(x) for p in table.properties for x in (expand(p), column_of(p))])
    values = triples.where(F.col("p").isin([expand(p) for p in table.properties]))
    rows = values.select(F.col("s").alias("k_iri"), F.element_at(names, F.col("p")).alias("x_property"), F.nullif("o", F.lit("")).alias("x_value"), (F.col("o_kind") == "iri").alias("x_value_is_iri"), F.nullif(F.coalesce("o_lang", F.lit("")), F.lit("")).alias("x_value_lang"))
    return rows.join(subjects.distinct(), "k_iri", "left_semi")


def raw_table(triples: DataFrame, name: str) -> DataFrame:
    special = {"values_edm_WebResource": web_resources, "values_svcs_Service": services, "values_publishing_tier": publishing_tiers}
    if name in special:
        return special[name](triples)
    return values_table(triples, VALUES[name]) if name in VALUES else links_table(triples, LINKS[name])


def sampled(table: DataFrame, items: DataFrame, key: str) -> DataFrame:
    """Rows of a table about the sampled items (column item)."""
    return table.join(items.select(F.col("item").alias(key)), key, "left_semi")
