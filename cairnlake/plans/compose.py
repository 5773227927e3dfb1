"""The composed tables: the item cube, the maps and the tables that the explorer reads.

Every function takes a catalogue, tables.get(name) -> DataFrame, and returns a lazy DataFrame; each
table is one Spark job when it is written. Inputs of the item cube are reduced to one row
per item before they are joined, so that the chain of left joins keeps one partitioning.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import items, rights, vocab
from ..sources.scratch import partitions_for
from ..sources.tables import ENTITY_CLASSES

Tables = Callable[[str], DataFrame]

CURATED = vocab.CURATED_HOST
CLASS_FOLDER = {"edm_Agent": "agent/", "edm_Place": "place/", "skos_Concept": "concept/", "edm_TimeSpan": "timespan/"}
TOP_N, ANY_PROPERTY = 500, "*"


def first_by(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row for each key: the least by order, then by all other columns, nulls last. Rows with a null key form one group.

    The least of structs is kept before the shuffle, so a key with many rows sends one from each task.
    """
    columns = [*order, *(c for c in df.columns if c not in {key, *order})]
    least = df.groupBy(key).agg(F.min(_ranked(columns)).alias("__least"))
    return least.select(*[F.col(key) if c == key else F.col(f"__least.v{columns.index(c)}").alias(c) for c in df.columns])


def _ranked(columns: list[str]) -> Column:
    """Columns as a struct whose least is the least by them in order, nulls last; v{i} is the i-th."""
    return F.struct(*[x for i, c in enumerate(columns) for x in (F.col(c).isNull().alias(f"n{i}"), F.col(c).alias(f"v{i}"))])


def provider_aggregation(tables: Tables) -> DataFrame:
    """The provider aggregation of least IRI for each item."""
    a = tables("values_ore_Aggregation").select("k_iri_cho", "k_iri", "v_edm_dataProvider", "v_edm_provider", "v_edm_isShownBy", "v_edm_rights")
    return first_by(a, "k_iri_cho", ["k_iri"])


def curator_aggregation(tables: Tables) -> DataFrame:
    """R2: the curator's aggregation of least IRI for each item."""
    a = tables("values_edm_EuropeanaAggregation").select("k_iri_cho", "k_iri", "v_edm_country", "v_edm_datasetName", "v_edm_language")
    return first_by(a, "k_iri_cho", ["k_iri"])


def publishing_tier(tables: Tables) -> DataFrame:
    """Tier URIs of each item, one row per item."""
    t = tables("values_publishing_tier")
    return first_by(t.select("k_iri", "x_content_tier_uri", "x_metadata_tier_uri"), "k_iri", ["x_content_tier_uri"])


def primary_resource(tables: Tables) -> DataFrame:
    """Whether the resource that an aggregation shows has any service, per item."""
    shown = provider_aggregation(tables).select("k_iri_cho", F.col("v_edm_isShownBy").alias("k_iri"))
    resources = tables("values_edm_WebResource").select("k_iri").distinct()
    served = tables("values_svcs_Service").select(F.col("k_iri_webresource").alias("k_iri"), F.lit(True).alias("served")).distinct()
    rows = shown.join(resources, "k_iri", "left_semi").join(served, "k_iri", "left")
    return rows.groupBy("k_iri_cho").agg(F.bool_or(F.coalesce("served", F.lit(False))).alias("x_has_iiif"))


def proxy_items(tables: Tables) -> DataFrame:
    """(k_iri, k_iri_cho, proxy_type) of every proxy."""
    return tables("values_ore_Proxy").select("k_iri", "k_iri_cho", items.proxy_type(F.col("v_edm_europeanaProxy")).alias("proxy_type"))


def provider_location(tables: Tables) -> DataFrame:
    """Greatest current location on the provider's proxies."""
    p = tables("values_ore_Proxy").where(items.is_provider(F.col("v_edm_europeanaProxy")))
    return p.groupBy("k_iri_cho").agg(F.max("v_edm_currentLocation").alias("v_edm_currentLocation"))


def curator_type(tables: Tables) -> DataFrame:
    """Greatest edm:type on the curator's proxies."""
    p = tables("values_ore_Proxy").where(F.col("v_edm_europeanaProxy") == "true")
    return p.groupBy("k_iri_cho").agg(F.max("v_edm_type").alias("v_edm_type"))


def provider_values(tables: Tables, *properties: str) -> DataFrame:
    """Values of the given properties on provider proxies: (k_iri_cho, x_property, x_value, x_value_is_iri, x_value_lang)."""
    values = tables("links_ore_Proxy").where(F.col("x_property").isin(*properties))
    proxies = proxy_items(tables).where("proxy_type = 'provider'").select("k_iri", "k_iri_cho")
    return values.join(proxies, "k_iri").select("k_iri_cho", "x_property", "x_value", "x_value_is_iri", "x_value_lang")


def property_flags(tables: Tables) -> DataFrame:
    """Which of creator, description and subject the provider gives, per item."""
    has = lambda p: F.bool_or(F.col("x_property") == f"v_dc_{p}").alias(f"x_has_{p}")
    return provider_values(tables, "v_dc_creator", "v_dc_description", "v_dc_subject").groupBy("k_iri_cho").agg(has("creator"), has("description"), has("subject"))


def title_languages(tables: Tables) -> DataFrame:
    """Number of different language tags on provider titles, empty tags left out."""
    tagged = provider_values(tables, "v_dc_title").where("x_value_lang <> ''")
    return tagged.groupBy("k_iri_cho").agg(F.count_distinct("x_value_lang").alias("x_title_languages"))


def entity_flags(tables: Tables) -> DataFrame:
    """Enrichment flags per item over entities of known vocabularies.

    Which vocabulary an entity has is told by its IRI alone, so that the edges aren't made and dealt a second time for map_entity_vocab.
    """
    edges = tables("map_cho_entities").where(vocabulary_of(F.col("k_iri_entity")).isNotNull())
    cls, any_ = F.col("x_entity_class"), lambda test, name: F.bool_or(test).alias(name)
    return edges.groupBy("k_iri_cho").agg(
        any_(cls == "skos_Concept", "x_has_concept_enrichment"),
        any_((cls == "skos_Concept") & (F.col("x_property") == "v_dc_subject"), "x_has_subject_enrichment"),
        any_(cls == "edm_Place", "x_has_place_enrichment"),
        any_(cls == "edm_TimeSpan", "x_has_time_enrichment"),
        any_(cls == "edm_Agent", "x_has_agent_enrichment"),
        any_(F.col("k_iri_entity") == items.SPECIMEN_CONCEPT, "x_is_specimen"),
        any_(F.col("k_iri_entity") == items.NEWSPAPER_CONCEPT, "x_news_concept"),
    )


def resource_counts(tables: Tables) -> DataFrame:
    """Resources, different resources and PDFs per item."""
    pdf = F.col("v_ebucore_hasMimeType") == "application/pdf"
    w = tables("values_edm_WebResource").groupBy("k_iri_cho")
    return w.agg(F.count("*").alias("x_web_resource_count"), F.count_distinct("k_iri").alias("x_distinct_web_resources"), F.count_if(pdf).alias("x_pdf_count"), F.coalesce(F.bool_or(pdf), F.lit(False)).alias("x_has_pdf"))


def newspaper_members(tables: Tables) -> DataFrame:
    """Items of which any proxy is part of a newspaper collection."""
    parts = tables("links_ore_Proxy").where((F.col("x_property") == "v_dcterms_isPartOf") & F.lower("x_value").like("%europeana newspapers%"))
    return parts.join(proxy_items(tables), "k_iri").select("k_iri_cho").distinct().withColumn("x_news_partof", F.lit(True))


def cube_parts(tables: Tables) -> dict[str, DataFrame]:
    """What the item cube is joined from, by name: items first, then one row for each item (k_iri_cho) that has any."""
    return {
        "items": tables("values_edm_ProvidedCHO").select(F.col("k_iri").alias("k_iri_cho")).distinct(),
        "provider": provider_aggregation(tables).drop("k_iri"),
        "curator": curator_aggregation(tables).drop("k_iri"),
        "tiers": publishing_tier(tables).withColumnRenamed("k_iri", "k_iri_cho"),
        "primary": _served_items(tables, partitions_for(tables("values_edm_WebResource"))).withColumn("x_has_iiif", F.lit(True)),
        "type": curator_type(tables),
        "properties": property_flags(tables),
        "titles": title_languages(tables),
        "entities": entity_flags(tables),
        "resources": resource_counts(tables),
        "newspapers": newspaper_members(tables),
    }


#: Bits of the flags that the cube collects for an item.
FLAGS = ("item", "x_has_creator", "x_has_description", "x_has_subject", "x_has_concept_enrichment", "x_has_subject_enrichment", "x_has_place_enrichment", "x_has_time_enrichment", "x_has_agent_enrichment", "x_is_specimen", "x_news_concept", "x_news_partof", "x_has_iiif")


#: Columns of the cube that count things.
COUNTS = ("x_distinct_web_resources", "x_pdf_count", "x_title_languages", "x_web_resource_count")


def _mask(**tests: Column) -> Column:
    """Flags as bits; a null test is none."""
    bits = [F.when(test, F.lit(1 << FLAGS.index(name)).cast("bigint")).otherwise(F.lit(0).cast("bigint")) for name, test in tests.items()]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def group_items(tables: Tables) -> DataFrame:
    """The item cube, one row per object, columns in alphabetical order; a question that needs few columns lets go of the joins of the others."""
    return cube_of(cube_parts(tables))


def whole_cube(tables: Tables, counts: bool = True) -> DataFrame:
    """R14 for those who need all columns, or all but the COUNTS: the same rows.

    Rows of every source with what it tells of an item are united, so that they come together by two shuffles and one join: one of values, and one of
    flags (as bits) and numbers, which are made one for each thing that is counted once (a title's language, a resource), then one for each item.
    Without counts no title and of the resources PDFs alone are dealt out, and no thing by its name.
    """
    c, links, resources = F.col, tables("links_ore_Proxy"), tables("values_edm_WebResource")
    n = partitions_for(links, resources)
    least = {
        "provider": (tables("values_ore_Aggregation"), "k_iri_cho", ["k_iri", "v_edm_dataProvider", "v_edm_provider", "v_edm_isShownBy", "v_edm_rights"]),
        "curator": (tables("values_edm_EuropeanaAggregation"), "k_iri_cho", ["k_iri", "v_edm_country", "v_edm_datasetName", "v_edm_language"]),
        "tiers": (tables("values_publishing_tier"), "k_iri", ["x_content_tier_uri", "x_metadata_tier_uri"]),
    }
    given = [df.select(c(key).alias("k_iri_cho"), _ranked(columns).alias(name)) for name, (df, key, columns) in least.items()]
    given.append(tables("values_ore_Proxy").where("v_edm_europeanaProxy = 'true'").select("k_iri_cho", "v_edm_type"))
    rows = [tables("values_edm_ProvidedCHO").select(c("k_iri").alias("k_iri_cho"), _mask(item=F.lit(True)).alias("flags"))]
    # Links are put together for each proxy before they go to its item.
    p, lang = c("x_property"), F.when((c("x_property") == "v_dc_title") & (c("x_value_lang") != ""), c("x_value_lang")) if counts else F.lit(None).cast("string")
    own = _mask(**{f"x_has_{x}": p == f"v_dc_{x}" for x in ("creator", "description", "subject")})
    news = _mask(x_news_partof=(p == "v_dcterms_isPartOf") & F.lower("x_value").like("%europeana newspapers%"))
    told = links.where(p.isin("v_dc_creator", "v_dc_description", "v_dc_subject", "v_dc_title", "v_dcterms_isPartOf")).select("k_iri", lang.alias("lang"), own.alias("own"), news.alias("news")).where("lang is not null or own > 0 or news > 0")
    told = told.repartition(n, "k_iri").groupBy("k_iri", "lang").agg(F.bit_or("own").alias("own"), F.bit_or("news").alias("news"))
    told = told.join(proxy_items(tables).repartition(n, "k_iri"), "k_iri").withColumn("given", c("proxy_type") == "provider")
    told = told.where("given or news > 0").select("k_iri_cho", F.when(c("given"), c("lang")).alias("thing"), F.when(c("given"), c("own").bitwiseOR(c("news"))).otherwise(c("news")).alias("flags"))
    rows.append(told.withColumn("kind", F.when(c("thing").isNotNull(), "title")))
    pdf = F.coalesce(c("v_ebucore_hasMimeType") == "application/pdf", F.lit(False)).cast("bigint")
    resources = resources if counts else resources.where(pdf > 0)
    rows.append(resources.select("k_iri_cho", F.lit("resource").alias("kind"), c("k_iri").alias("thing"), F.lit(1).cast("bigint").alias("resources"), pdf.alias("pdfs")))
    cls, e = c("x_entity_class"), c("k_iri_entity")
    enriched = _mask(
        x_has_concept_enrichment=cls == "skos_Concept",
        x_has_subject_enrichment=(cls == "skos_Concept") & (p == "v_dc_subject"),
        x_has_place_enrichment=cls == "edm_Place",
        x_has_time_enrichment=cls == "edm_TimeSpan",
        x_has_agent_enrichment=cls == "edm_Agent",
        x_is_specimen=e == items.SPECIMEN_CONCEPT,
        x_news_concept=e == items.NEWSPAPER_CONCEPT,
    )
    rows.append(tables("map_cho_entities").where(vocabulary_of(e).isNotNull()).select("k_iri_cho", enriched.alias("flags")).groupBy("k_iri_cho").agg(F.bit_or("flags").alias("flags")))
    rows.append(_served_items(tables, n).select("k_iri_cho", _mask(x_has_iiif=F.lit(True)).alias("flags")))

    def together(parts: list[DataFrame]) -> DataFrame:
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts).repartition(n, "k_iri_cho")

    values = together(given).groupBy("k_iri_cho").agg(*(F.min(x).alias(x) for x in least), F.max("v_edm_type").alias("v_edm_type"))
    numbers = [F.bit_or("flags").alias("flags"), *(F.sum(x).alias(x) for x in ("resources", "pdfs"))]
    rows = rows if counts else [r.drop("kind", "thing") for r in rows]
    things = together([rows[0], *(r.where("k_iri_cho is not null") for r in rows[1:])])
    things = things.groupBy("k_iri_cho", "kind", "thing").agg(*numbers) if counts else things.withColumns({"kind": F.lit(None), "thing": F.lit(None)})
    counted = [F.count_if((c("kind") == kind) & c("thing").isNotNull()).alias(name) for kind, name in (("title", "x_title_languages"), ("resource", "x_distinct_web_resources"))]
    one = things.groupBy("k_iri_cho").agg(*numbers, *counted).where(c("flags").bitwiseAND(F.lit(1)) > 0).join(values, "k_iri_cho", "left")
    known = {f"{name}.v{i}": x for name, (_, _, columns) in least.items() for i, x in enumerate(columns) if x != "k_iri"}
    flags = [(c("flags").bitwiseAND(F.lit(1 << i)) > 0).alias(x) for i, x in enumerate(FLAGS) if i]
    cube = _cube(one.select("k_iri_cho", "v_edm_type", *(c(at).alias(x) for at, x in known.items()), *flags, (c("pdfs") > 0).alias("x_has_pdf"), c("resources").alias("x_web_resource_count"), c("pdfs").alias("x_pdf_count"), "x_title_languages", "x_distinct_web_resources"))
    return cube if counts else cube.drop(*COUNTS)


def _served_items(tables: Tables, n: int) -> DataFrame:
    """(k_iri_cho) of the items whose provider aggregation shows a resource that is there and has a service."""
    a = tables("values_ore_Aggregation").select("k_iri_cho", "k_iri", "v_edm_dataProvider", "v_edm_provider", "v_edm_isShownBy", "v_edm_rights")
    shown = first_by(a.repartition(n, "k_iri_cho"), "k_iri_cho", ["k_iri"]).select("k_iri_cho", F.col("v_edm_isShownBy").alias("k_iri")).where("k_iri is not null")
    served = tables("values_svcs_Service").select(F.col("k_iri_webresource").alias("k_iri"))
    there = tables("values_edm_WebResource").select("k_iri")
    return shown.repartition(n, "k_iri").join(served.repartition(n, "k_iri"), "k_iri", "left_semi").join(there.repartition(n, "k_iri"), "k_iri", "left_semi").select("k_iri_cho")


def cube_of(parts: dict[str, DataFrame]) -> DataFrame:
    """The item cube from its parts."""
    base, *rest = parts.values()
    return _cube(reduce(lambda a, b: a.join(b, "k_iri_cho", "left"), rest, base))


def _cube(j: DataFrame) -> DataFrame:
    """The cube's columns from what is known of each item."""
    no, c = (lambda name: F.coalesce(name, F.lit(False))), F.col
    out: dict[str, Column] = {
        "k_iri": c("k_iri_cho"),
        **{n: c(n) for n in ("v_edm_country", "v_edm_dataProvider", "v_edm_datasetName", "v_edm_provider", "v_edm_type")},
        "x_content_tier": items.content_tier(c("x_content_tier_uri")),
        "x_has_content_url": c("v_edm_isShownBy").isNotNull(),
        "x_in_openup": items.in_openup(c("v_edm_provider")),
        "x_is_newspaper": items.is_newspaper(c("v_edm_datasetName"), c("x_news_partof"), c("x_news_concept")),
        "x_metadata_tier": items.metadata_tier(c("x_metadata_tier_uri")),
        "x_primary_language": c("v_edm_language"),
        "x_reuse_level": rights.reuse_level(c("v_edm_rights")),
        "x_rights_family": rights.rights_family(c("v_edm_rights")),
        **{n: no(n) for n in ("x_has_agent_enrichment", "x_has_concept_enrichment", "x_has_creator", "x_has_description", "x_has_iiif", "x_has_pdf", "x_has_place_enrichment", "x_has_subject", "x_has_subject_enrichment", "x_has_time_enrichment", "x_is_specimen")},
        **{n: F.coalesce(n, F.lit(0)).cast("bigint") for n in ("x_distinct_web_resources", "x_pdf_count", "x_title_languages", "x_web_resource_count")},
    }
    return j.select(*[out[n].alias(n) for n in sorted(out)])


def map_rights(tables: Tables) -> DataFrame:
    """Each rights URI with its level, family, openness and label."""
    u = F.col("k_iri")
    uris = tables("values_ore_Aggregation").where("v_edm_rights is not null").select(F.col("v_edm_rights").alias("k_iri")).distinct()
    return uris.select(u, rights.reuse_level(u).alias("x_category"), rights.rights_family(u).alias("x_family"), rights.is_open(u).alias("x_is_open"), rights.rights_label(u).alias("x_label"))


def map_same_as(tables: Tables) -> DataFrame:
    """Same-as links of all entities, checked and assigned to a vocabulary (null unless sound and known)."""

    def of(cls: str) -> DataFrame:
        links = tables(f"links_{cls}").where("x_property = 'v_owl_sameAs'")
        return links.select("k_iri", F.col("x_value").alias("v_owl_sameAs"), F.lit(cls).alias("x_entity_class"))

    v, links = F.col("v_owl_sameAs"), reduce(DataFrame.unionByName, map(of, ENTITY_CLASSES))
    links = links.withColumn("x_well_formed", vocab.is_well_formed(v)).withColumn("found", vocab.vocabulary(v))
    return links.select("k_iri", "v_owl_sameAs", F.when(F.col("x_well_formed"), F.col("found")).alias("x_authority"), "x_entity_class", F.col("found").isNotNull().alias("x_metis_known"), "x_well_formed")


def entity_iris(tables: Tables) -> DataFrame:
    """Different (k_iri, x_entity_class), by one aggregate for all classes."""
    return reduce(DataFrame.unionByName, (tables(f"values_{c}").select("k_iri", F.lit(c).alias("x_entity_class")) for c in ENTITY_CLASSES)).distinct()


def map_item_entities(tables: Tables) -> DataFrame:
    """Different (item, entity, class, property) of every proxy value that is a known entity.

    Edges are dealt by item into parts that grow with the links, so what a task holds doesn't.
    """
    links = tables("links_ore_Proxy")
    n = partitions_for(links)
    values = links.where("x_value_is_iri").select("k_iri", F.col("x_value").alias("k_iri_entity"), "x_property").repartition(n, "k_iri_entity")
    entities = entity_iris(tables).withColumnRenamed("k_iri", "k_iri_entity")
    edges = values.join(entities, "k_iri_entity").join(proxy_items(tables).select("k_iri", "k_iri_cho").repartition(n, "k_iri"), "k_iri")
    return edges.select("k_iri_cho", "k_iri_entity", "x_entity_class", "x_property").repartition(n, "k_iri_cho").distinct()


def map_curated_entities(tables: Tables) -> DataFrame:
    """Edges to curated entities, without the property."""
    m = tables("map_cho_entities").where(F.col("k_iri_entity").startswith(CURATED))
    return m.select("k_iri_cho", "k_iri_entity", "x_entity_class").distinct()


def vocabulary_of(entity: Column) -> Column:
    """The vocabulary of a linked entity, 'edm' for the curated ones, null for none."""
    return F.when(entity.rlike(r"^https?://data\.europeana\.eu/"), "edm").otherwise(vocab.vocabulary(entity))


def map_entity_vocabulary(tables: Tables) -> DataFrame:
    """The vocabulary of each linked entity, 'edm' for the curated ones; no soundness asked."""
    e = F.col("k_iri_entity")
    rows = tables("map_cho_entities").select("k_iri_entity").where(e.isNotNull()).distinct().withColumn("x_vocabulary", vocabulary_of(e))
    return rows.select("k_iri_entity", F.col("x_vocabulary").isNotNull().alias("x_is_metis"), "x_vocabulary")


def english_labels(tables: Tables) -> DataFrame:
    """(k_iri_entity, v_skos_prefLabel) of curated entities in English, several for some."""

    def labels(cls: str) -> DataFrame:
        v = tables(f"values_{cls}").where(F.col("k_iri").startswith(CURATED + CLASS_FOLDER[cls]) & (F.col("x_prefLabel_lang") == "en"))
        return v.select(F.col("k_iri").alias("k_iri_entity"), "v_skos_prefLabel")

    # A class's folder is its own, so that one aggregate finds the labels of all classes.
    return reduce(DataFrame.unionByName, map(labels, ENTITY_CLASSES))


def explorer_entities(tables: Tables) -> DataFrame:
    """Curated edges with their English label, the IRI where there is none."""
    edges = tables("map_cho_entities")
    n = partitions_for(edges)
    m = edges.where(F.col("k_iri_entity").startswith(CURATED)).repartition(n, "k_iri_entity")
    named = m.join(english_labels(tables).repartition(n, "k_iri_entity").groupBy("k_iri_entity").agg(F.max("v_skos_prefLabel").alias("label")), "k_iri_entity", "left")
    return named.select("k_iri_cho", "k_iri_entity", "x_entity_class", "x_property", F.coalesce("label", "k_iri_entity").alias("x_label"))


def explorer_class(tables: Tables, cls: str) -> DataFrame:
    """The slice of one entity class."""
    return tables("explorer_edm_entities").where(F.col("x_entity_class") == cls).drop("x_entity_class")


def map_item_mime_types(tables: Tables) -> DataFrame:
    """Different MIME types of each item."""
    w = tables("values_edm_WebResource").where("v_ebucore_hasMimeType <> ''")
    return w.select("k_iri_cho", F.col("v_ebucore_hasMimeType").alias("v_mime_type")).distinct()


def facet_top_n(tables: Tables, n: int = TOP_N) -> DataFrame:
    """The n entities with most items for each class and property, and for each class over all properties ('*').

    Items are made distinct first, so that a popular entity is counted by partial sums. Ties go to the least IRI.
    Edges are dealt by entity and item into parts that grow with them, and stand for their property and for all there, so that they are made once.
    """
    edges = tables("explorer_edm_entities")
    by = ["x_entity_class", "x_property", "k_iri_entity"]
    dealt = edges.repartition(partitions_for(edges), "k_iri_entity", "k_iri_cho").withColumn("x_property", F.explode(F.array("x_property", F.lit(ANY_PROPERTY))))
    one = dealt.groupBy(*by, "k_iri_cho").agg(F.min("x_label").alias("x_label"))
    counted = one.groupBy(*by).agg(F.min("x_label").alias("x_label"), F.count("*").alias("x_item_count"))
    rank = F.row_number().over(Window.partitionBy("x_entity_class", "x_property").orderBy(F.desc("x_item_count"), "k_iri_entity"))
    return counted.withColumn("x_rank", rank.cast("bigint")).where(F.col("x_rank") <= n).select("x_entity_class", "x_property", "x_rank", "k_iri_entity", "x_label", "x_item_count")


def organisations(tables: Tables) -> DataFrame:
    """(k_iri, name, country, acronym), the name English where there is one."""
    o = tables("values_foaf_Organization").groupBy("k_iri")
    english = F.max(F.when(F.col("x_prefLabel_lang") == "en", F.col("v_skos_prefLabel")))
    return o.agg(F.coalesce(english, F.max("v_skos_prefLabel")).alias("name"), F.max("v_edm_country").alias("country"), F.max("v_edm_acronym").alias("acronym"))


def item_titles(tables: Tables) -> DataFrame:
    """(k_iri, label, lang) of provider titles."""
    return provider_values(tables, "v_dc_title").select(F.col("k_iri_cho").alias("k_iri"), F.col("x_value").alias("label"), F.col("x_value_lang").alias("lang"))


def open_items(tables: Tables) -> DataFrame:
    """(item, type, rights) of openly licensed items by the curator's type."""
    a = tables("values_ore_Aggregation").where(rights.is_open(F.col("v_edm_rights"))).select("k_iri_cho", F.col("v_edm_rights").alias("rights"))
    p = tables("values_ore_Proxy").where("v_edm_europeanaProxy = 'true' and v_edm_type is not null").select("k_iri_cho", F.col("v_edm_type").alias("type"))
    return a.join(p, "k_iri_cho").select(F.col("k_iri_cho").alias("item"), "type", "rights")


def sample_items(tables: Tables, n: int) -> DataFrame:
    """N items, always the same ones: those of least MD5 hash."""
    return tables("values_edm_ProvidedCHO").select(F.col("k_iri").alias("item")).distinct().orderBy(F.md5(F.col("item").cast("binary")), "item").limit(n)


#: Composed table: how it is made and what it reads.
COMPOSED: dict[str, tuple[Callable[[Tables], DataFrame], tuple[str, ...]]] = {
    "map_rights": (map_rights, ("values_ore_Aggregation",)),
    "map_sameAs": (map_same_as, tuple(f"links_{c}" for c in ENTITY_CLASSES)),
    "map_cho_entities": (map_item_entities, ("links_ore_Proxy", "values_ore_Proxy", *(f"values_{c}" for c in ENTITY_CLASSES))),
    "map_edm_entities": (map_curated_entities, ("map_cho_entities",)),
    "map_entity_vocab": (map_entity_vocabulary, ("map_cho_entities",)),
    "map_cho_mimetypes": (map_item_mime_types, ("values_edm_WebResource",)),
    "explorer_edm_entities": (explorer_entities, ("map_cho_entities", *(f"values_{c}" for c in ENTITY_CLASSES))),
    "explorer_concepts": (lambda t: explorer_class(t, "skos_Concept"), ("explorer_edm_entities",)),
    "explorer_agents": (lambda t: explorer_class(t, "edm_Agent"), ("explorer_edm_entities",)),
    "explorer_places": (lambda t: explorer_class(t, "edm_Place"), ("explorer_edm_entities",)),
    "explorer_timespans": (lambda t: explorer_class(t, "edm_TimeSpan"), ("explorer_edm_entities",)),
    "explorer_facet_top_n": (facet_top_n, ("explorer_edm_entities",)),
    "group_items": (group_items, ("values_edm_ProvidedCHO", "values_ore_Aggregation", "values_edm_EuropeanaAggregation", "values_publishing_tier", "values_edm_WebResource", "values_svcs_Service", "values_ore_Proxy", "links_ore_Proxy", "map_cho_entities", "map_entity_vocab")),
}

#: Columns by which a table is written in ranges, so that filters on them skip row groups.
SORTED = {
    "explorer_edm_entities": ("x_entity_class", "x_property", "k_iri_entity"),
    "explorer_concepts": ("x_property", "k_iri_entity"),
    "explorer_agents": ("x_property", "k_iri_entity"),
    "explorer_places": ("x_property", "k_iri_entity"),
    "explorer_timespans": ("x_property", "k_iri_entity"),
    "map_cho_mimetypes": ("v_mime_type",),
    "explorer_facet_top_n": ("x_entity_class", "x_property", "x_rank"),
}
