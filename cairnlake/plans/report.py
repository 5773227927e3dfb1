"""The report: named questions over the composed tables, each a DataFrame.

Questions of a section share building blocks (open items, multi-page items, provider
values and so on); a block is a DataFrame, so that Catalyst sees one plan for each question.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.items import bucket, mime_family
from ..functions.vocab import host_of, link_fault
from ..operators.aggregates import count_distinct_if, flagged, histogram, percent, ranking, top, with_share
from ..sources.sinks import markdown_table
from ..sources.tables import ENTITY_CLASSES
from .compose import Tables, provider_values

Question = Callable[[Tables], DataFrame]
SECTIONS: dict[str, dict[str, Question]] = {}

KB, MB, GB = 1024, 1024**2, 1024**3
SIZES = [(100 * KB, "< 100 KB"), (MB, "100 KB - 1 MB"), (10 * MB, "1 MB - 10 MB"), (100 * MB, "10 MB - 100 MB"), (GB, "100 MB - 1 GB"), (None, ">= 1 GB")]
PIXELS = [(100_000, "< 0.1 MP"), (500_000, "0.1-0.5 MP"), (1_000_000, "0.5-1 MP"), (4_000_000, "1-4 MP"), (16_000_000, "4-16 MP"), (None, ">= 16 MP")]
LONG_CAPTION = 200
# Name patterns of natural-history institutions, in lower case.
NATURAL_HISTORY = (
    "naturalis biodiversity%",
    "meise botanic garden%",
    "%natural history museum, london%",
    "%natural history museum, paris%",
    "%muséum national d'histoire naturelle%",
    "royal botanic garden edinburgh%",
    "royal botanic gardens%kew%",
    "%berlin-dahlem%",
    "%botanischer garten%berlin%",
    "%natural history museum, vienna%",
    "%naturhistorisches museum wien%",
    "biology centre linz%",
    "biologiezentrum%linz%",
    "%tartu%natural history%",
)


def question(section: str, name: str) -> Callable[[Question], Question]:
    def put(f: Question) -> Question:
        SECTIONS.setdefault(section, {})[name] = f
        return f

    return put


# Building blocks


def cube(t: Tables) -> DataFrame:
    return t("group_items")


def open_items(t: Tables) -> DataFrame:
    return cube(t).where("x_reuse_level = 'open'")


def open_images(t: Tables) -> DataFrame:
    return open_items(t).where("v_edm_type = 'IMAGE' and x_has_content_url")


def resources(t: Tables) -> DataFrame:
    return t("values_edm_WebResource")


def pages(t: Tables) -> DataFrame:
    """(k_iri, pages): resources per item."""
    return resources(t).where("k_iri_cho is not null").groupBy(F.col("k_iri_cho").alias("k_iri")).agg(F.count("*").alias("pages"))


def multi_page(t: Tables) -> DataFrame:
    return pages(t).where("pages > 1")


def open_multi_page(t: Tables) -> DataFrame:
    """Open items of several pages, with the item's columns."""
    return multi_page(t).join(open_items(t), "k_iri")


def serving_items(t: Tables, prop: str, test: Column) -> DataFrame:
    """(k_iri) of items that own a resource whose service has a property value passing the test."""
    services = t("links_svcs_Service").where((F.col("x_property") == prop) & test).select("k_iri").distinct()
    served = t("values_svcs_Service").join(services, "k_iri", "left_semi").select(F.col("k_iri_webresource").alias("k_iri")).distinct()
    return resources(t).join(served, "k_iri", "left_semi").select(F.col("k_iri_cho").alias("k_iri")).distinct()


def image_api(t: Tables) -> DataFrame:
    return serving_items(t, "v_dcterms_conformsTo", F.col("x_value").startswith("http://iiif.io/api/image"))


def presentation_api(t: Tables) -> DataFrame:
    return serving_items(t, "v_dcterms_conformsTo", F.col("x_value").startswith("http://iiif.io/api/presentation"))


def implements_iiif(t: Tables) -> DataFrame:
    return serving_items(t, "v_doap_implements", F.lower("x_value").contains("iiif"))


def captions(t: Tables) -> DataFrame:
    """Provider descriptions that are long enough to serve as captions."""
    return provider_values(t, "v_dc_description").where(F.length("x_value") >= LONG_CAPTION)


def curated_subjects(t: Tables) -> DataFrame:
    """(k_iri, concept): subject IRIs on curator proxies; the item's IRI follows from the proxy's."""
    links = t("links_ore_Proxy").where("x_property = 'v_dc_subject' and x_value_is_iri").where(F.col("k_iri").contains("/proxy/europeana/"))
    item = F.replace("k_iri", F.lit("/proxy/europeana/"), F.lit("/item/"))
    return links.select(item.alias("k_iri"), F.col("x_value").alias("concept")).distinct()


def label_depth(t: Tables, cls: str) -> DataFrame:
    """(x_entity_class, k_iri_entity, depth): label languages of each entity."""
    labels = t(f"values_{cls}").where("x_prefLabel_lang <> ''")
    return labels.groupBy(F.lit(cls).alias("x_entity_class"), F.col("k_iri").alias("k_iri_entity")).agg(F.count_distinct("x_prefLabel_lang").alias("depth"))


def named(t: Tables, items: DataFrame, iri: str, name: str) -> DataFrame:
    """items with the organisation's name for its IRI, the IRI where it has none."""
    orgs = t("orgs").select(F.col("k_iri").alias("__org"), F.col("name").alias("__name"))
    return items.join(orgs, items[iri] == orgs["__org"], "left").withColumn(name, F.coalesce("__name", iri)).drop("__org", "__name")


def open_links(t: Tables) -> DataFrame:
    """Entity edges of open items."""
    return t("map_cho_entities").join(open_items(t).select(F.col("k_iri").alias("k_iri_cho")), "k_iri_cho", "left_semi")


def pdf_resources(t: Tables) -> DataFrame:
    return resources(t).where("v_ebucore_hasMimeType = 'application/pdf'").join(open_items(t).select(F.col("k_iri").alias("k_iri_cho")), "k_iri_cho", "left_semi")


def pdf_items(t: Tables) -> DataFrame:
    """Open items with a PDF, with the item's columns."""
    return open_items(t).join(pdf_resources(t).select(F.col("k_iri_cho").alias("k_iri")), "k_iri", "left_semi")


def natural_history(t: Tables) -> DataFrame:
    """Open items of natural-history institutions, with the institution's name."""
    name = F.lower("name")
    orgs = t("orgs").where(reduce(lambda a, b: a | b, [name.like(p) for p in NATURAL_HISTORY])).select(F.col("k_iri").alias("v_edm_dataProvider"), F.col("name").alias("data_provider"))
    return open_items(t).join(orgs, "v_edm_dataProvider")


def same_as(t: Tables) -> DataFrame:
    return t("map_sameAs").where("x_well_formed and x_metis_known")


def totals(df: DataFrame, **columns: Column) -> DataFrame:
    return df.agg(*[c.alias(n) for n, c in columns.items()])


def share(test: Column) -> Column:
    return percent(F.count_if(test), F.count("*"))


def with_total(t: DataFrame, rows: DataFrame, name: str) -> DataFrame:
    """t with the number of another table's rows in every row, as a scalar subquery."""
    return t.withColumn(name, rows.agg(F.count("*")).scalar())


def resolution(df: DataFrame) -> DataFrame:
    unknown, area = F.col("v_ebucore_width").isNull() | F.col("v_ebucore_height").isNull(), F.col("v_ebucore_width") * F.col("v_ebucore_height")
    label, key = bucket(area, PIXELS)
    return histogram(df.where(F.col("v_ebucore_hasMimeType").startswith("image/")), F.when(unknown, "unknown").otherwise(label), F.when(unknown, 0).otherwise(key), "resolution_bucket", "resources")


def simple(section: str, name: str, items: Callable[[Tables], DataFrame], column: str, alias: str, count: str, *, known: bool = False, limit: int | None = None, pct: str | None = "pct", org: bool = False, more: dict[str, Callable[[], Column]] | None = None) -> None:
    """A question that counts items by one column."""

    def run(t: Tables) -> DataFrame:
        df = items(t)
        if known:
            df = df.where(F.col(column).isNotNull())
        key = F.col(column)
        if org:
            df, key = named(t, df, column, "__by"), F.col("__by")
        return ranking(df, {alias: key}, count, pct, limit, {n: f() for n, f in (more or {}).items()})

    SECTIONS.setdefault(section, {})[name] = run


# Overview

question("overview", "total_items")(lambda t: totals(cube(t), total_items=F.count("*")))
simple("overview", "by_type", cube, "v_edm_type", "type", "count")
simple("overview", "by_reuse_level", cube, "x_reuse_level", "reuse_level", "count")
simple("overview", "by_rights_family", cube, "x_rights_family", "rights_family", "count")
simple("overview", "top_countries", cube, "v_edm_country", "country", "count", known=True, limit=25)
simple("overview", "top_institutions", cube, "v_edm_dataProvider", "institution", "count", known=True, limit=25, pct=None, org=True)
simple("overview", "top_aggregators", cube, "v_edm_provider", "aggregator", "count", known=True, limit=25, pct=None, org=True)
simple("overview", "top_languages", cube, "x_primary_language", "language", "count", known=True, limit=25)


@question("overview", "content_coverage")
def content_coverage(t: Tables) -> DataFrame:
    return totals(cube(t), total=F.count("*"), **{f"pct_{n}": share(F.col(f"x_has_{n}")) for n in ("content_url", "iiif", "description", "creator", "subject")})


@question("overview", "web_resource_stats")
def web_resource_stats(t: Tables) -> DataFrame:
    per = resources(t).groupBy("k_iri_cho").agg(F.count("*").alias("n"))
    out = totals(per, total_web_resources=F.sum("n"), items_with_web_resources=F.count("*"), avg_wr_per_item=F.round(F.avg("n"), 2), median_wr_per_item=F.percentile("n", 0.5), p90_wr_per_item=F.percentile("n", 0.9), max_wr_per_item=F.max("n"))
    return with_total(out, cube(t), "total_items")


@question("overview", "multi_page_items")
def multi_page_items(t: Tables) -> DataFrame:
    per = resources(t).groupBy("k_iri_cho").agg(F.count("*").alias("n"))
    return histogram(per, *bucket(F.col("n"), [(2, "1 (single)"), (6, "2-5"), (11, "6-10"), (51, "11-50"), (101, "51-100"), (None, "100+")]), "web_resources_per_item", "items")


@question("overview", "mime_family_breakdown")
def mime_family_breakdown(t: Tables) -> DataFrame:
    return ranking(resources(t), {"mime_family": mime_family(F.col("v_ebucore_hasMimeType"))}, "resources")


simple("overview", "top_mime_types", resources, "v_ebucore_hasMimeType", "mime_type", "resources", known=True, limit=25)
question("overview", "image_resolution_buckets")(lambda t: resolution(resources(t)))


@question("overview", "file_size_buckets")
def file_size_buckets(t: Tables) -> DataFrame:
    sized = resources(t).where("v_ebucore_fileByteSize is not null")
    return histogram(sized, *bucket(F.col("v_ebucore_fileByteSize"), SIZES), "size_bucket", "resources")


# External links


@question("external_links", "link_validity_breakdown")
def link_validity_breakdown(t: Tables) -> DataFrame:
    rows = t("map_sameAs").withColumn("bucket", link_fault(F.col("v_owl_sameAs"), F.col("x_metis_known")))
    out = rows.groupBy("bucket").agg(F.count("*").alias("sameas_links"), F.count_distinct("v_owl_sameAs").alias("distinct_iris"))
    return top(with_share(out, "sameas_links", "pct_of_links"), "sameas_links", ["bucket"])


@question("external_links", "links_by_authority")
def links_by_authority(t: Tables) -> DataFrame:
    out = same_as(t).groupBy(F.col("x_authority").alias("authority")).agg(F.count_distinct("v_owl_sameAs").alias("distinct_external_iris"), F.count("*").alias("sameas_links"))
    return top(out, "distinct_external_iris", ["authority"])


@question("external_links", "entities_linked_by_authority")
def entities_linked_by_authority(t: Tables) -> DataFrame:
    each = [t(f"values_{c}").agg(F.count_distinct("k_iri").alias("total_entities")).withColumn("entity_class", F.lit(c)) for c in ENTITY_CLASSES]
    linked = same_as(t).groupBy(F.col("x_entity_class").alias("entity_class"), F.col("x_authority").alias("authority")).agg(F.count_distinct("k_iri").alias("linked_entities"))
    out = linked.join(F.broadcast(reduce(DataFrame.unionByName, each)), "entity_class")  # four rows
    return out.select("entity_class", "authority", "linked_entities", "total_entities", percent(F.col("linked_entities"), F.col("total_entities")).alias("pct_of_class")).orderBy("entity_class", F.desc("linked_entities"), "authority")


def top_outside_hosts(t: Tables, least: int = 50_000) -> DataFrame:
    rows = t("map_sameAs").where("x_well_formed and not x_metis_known")
    out = rows.groupBy(host_of(F.col("v_owl_sameAs")).alias("host")).agg(F.count("*").alias("sameas_links"), F.count_distinct("v_owl_sameAs").alias("distinct_iris"), F.count_distinct("k_iri").alias("linked_entities"))
    return top(out.where(F.col("sameas_links") >= least), "sameas_links", ["host"], 25)


question("external_links", "top_outside_hosts")(top_outside_hosts)


@question("external_links", "item_coverage_by_authority")
def item_coverage_by_authority(t: Tables) -> DataFrame:
    links = same_as(t).select(F.col("k_iri").alias("k_iri_entity"), F.col("x_authority").alias("authority")).distinct()
    edges = t("map_cho_entities").select("k_iri_cho", "k_iri_entity").distinct()
    out = edges.join(links, "k_iri_entity").groupBy("authority").agg(F.count_distinct("k_iri_cho").alias("chos_linked"))
    out = with_total(out, cube(t), "n").withColumn("pct_of_chos", percent(F.col("chos_linked"), F.col("n"))).drop("n")
    return top(out, "chos_linked", ["authority"])


@question("external_links", "dereferencing_coverage")
def dereferencing_coverage(t: Tables) -> DataFrame:
    refs = same_as(t).select(F.col("x_authority").alias("authority"), F.col("v_owl_sameAs").alias("iri")).distinct()
    local = reduce(DataFrame.unionByName, [t(f"values_{c}").select("k_iri") for c in ENTITY_CLASSES]).distinct()
    out = flagged(refs, "iri", here=local).groupBy("authority").agg(F.count("*").alias("distinct_refs"), F.count_if("here").alias("dereferenced"), share(F.col("here")).alias("pct_dereferenced"))
    return top(out, "distinct_refs", ["authority"])


@question("external_links", "multi_authority_overlap")
def multi_authority_overlap(t: Tables) -> DataFrame:
    per = same_as(t).groupBy("k_iri").agg(F.count_distinct("x_authority").alias("n_authorities"))
    return with_share(per.groupBy("n_authorities").agg(F.count("*").alias("entities")), "entities").orderBy("n_authorities")


# Enrichment


@question("enrichment", "overall_coverage")
def overall_coverage(t: Tables) -> DataFrame:
    # A row per item and class first: all distinct counts are then plain counts over items.
    has = {n: F.bool_or(F.col("x_entity_class") == c).alias(n) for n, c in (("concept", "skos_Concept"), ("place", "edm_Place"), ("agent", "edm_Agent"), ("timespan", "edm_TimeSpan"))}
    per = open_links(t).groupBy("k_iri_cho").agg(*has.values())
    out = with_total(totals(per, with_any_entity=F.count("*"), **{f"with_{n}": F.count_if(n) for n in has}), open_items(t), "total_open_items")
    share_of = lambda n: percent(F.col(n), F.col("total_open_items"))
    each = [c for n in has for c in (F.col(f"with_{n}"), share_of(f"with_{n}").alias(f"pct_{n}"))]
    return out.select("total_open_items", "with_any_entity", share_of("with_any_entity").alias("pct_with_any"), *each)


@question("enrichment", "class_property_matrix")
def class_property_matrix(t: Tables) -> DataFrame:
    out = open_links(t).groupBy(F.col("x_entity_class").alias("entity_class"), F.col("x_property").alias("property")).agg(F.count_distinct("k_iri_cho").alias("items_linked"))
    out = with_total(out, open_items(t), "n").withColumn("pct_of_open", percent(F.col("items_linked"), F.col("n"))).drop("n")
    return top(out, "items_linked", ["entity_class", "property"])


@question("enrichment", "multi_class_items")
def multi_class_items(t: Tables) -> DataFrame:
    # The items without links are those of the left join that have no class: no second count is needed.
    per = open_links(t).groupBy(F.col("k_iri_cho").alias("k_iri")).agg(F.count_distinct("x_entity_class").alias("n"))
    rows = open_items(t).select("k_iri").join(per, "k_iri", "left").groupBy(F.coalesce("n", F.lit(0)).cast("bigint").alias("distinct_entity_classes")).agg(F.count("*").alias("items"))
    return with_share(rows, "items", "pct_of_open").orderBy("distinct_entity_classes")


@question("enrichment", "entity_density")
def entity_density(t: Tables) -> DataFrame:
    per = open_links(t).groupBy("k_iri_cho").agg(F.count("*").alias("n"))
    return histogram(per, *bucket(F.col("n"), [(2, "1"), (4, "2-3"), (6, "4-5"), (11, "6-10"), (21, "11-20"), (None, "20+")]), "links_per_item", "items")


@question("enrichment", "multilingual_depth_by_class")
def multilingual_depth_by_class(t: Tables) -> DataFrame:
    depth = reduce(DataFrame.unionByName, [label_depth(t, c) for c in ENTITY_CLASSES])
    links = open_links(t).select("k_iri_cho", "x_entity_class", "k_iri_entity").distinct()
    per = links.join(depth, ["x_entity_class", "k_iri_entity"], "left").groupBy("k_iri_cho", "x_entity_class").agg(F.max(F.coalesce("depth", F.lit(0))).alias("d"))
    steps = [c for n in (5, 10, 20) for c in (F.count_if(F.col("d") >= n).alias(f"with_{n}plus_langs"), share(F.col("d") >= n).alias(f"pct_{n}plus_langs"))]
    return top(per.groupBy(F.col("x_entity_class").alias("entity_class")).agg(F.count("*").alias("items_linked"), *steps), "items_linked", ["entity_class"])


def _top_entities(cls: str, name: str) -> Question:
    def run(t: Tables) -> DataFrame:
        best = open_links(t).where(F.col("x_entity_class") == cls).groupBy(F.col("k_iri_entity").alias("k_iri")).agg(F.count_distinct("k_iri_cho").alias("items_linked"))
        best = top(best, "items_linked", ["k_iri"], 50)
        labels = t(f"values_{cls}").groupBy("k_iri").agg(F.max(F.when(F.col("x_prefLabel_lang") == "en", F.col("v_skos_prefLabel"))).alias("preferred_label_en"), F.count_distinct("x_prefLabel_lang").alias("langs"))
        out = best.join(labels, "k_iri", "left").select(F.col("k_iri").alias(f"{name}_iri"), "preferred_label_en", F.coalesce("langs", F.lit(0)).alias("prefLabel_languages"), "items_linked")
        return top(out, "items_linked", [f"{name}_iri"])

    return run


for _cls, _name in (("skos_Concept", "concept"), ("edm_Place", "place"), ("edm_Agent", "agent")):
    question("enrichment", f"top_{_name}s")(_top_entities(_cls, _name))


def _enriched(t: Tables) -> DataFrame:
    return flagged(open_items(t), "k_iri", linked=t("map_cho_entities").select("k_iri_cho"))


@question("enrichment", "by_edm_type")
def enrichment_by_type(t: Tables) -> DataFrame:
    return ranking(_enriched(t), {"type": F.col("v_edm_type")}, "open_items", None, None, {"enriched_items": F.count_if("linked"), "pct_enriched": share(F.col("linked"))})


def enrichment_by_provider(t: Tables, least: int = 10_000) -> DataFrame:
    per = _enriched(t).where("v_edm_dataProvider is not null").groupBy("v_edm_dataProvider").agg(F.count("*").alias("open_items"), F.count_if("linked").alias("enriched_items"), share(F.col("linked")).alias("pct_enriched"))
    out = named(t, per.where(F.col("open_items") >= least), "v_edm_dataProvider", "data_provider").select("data_provider", "open_items", "enriched_items", "pct_enriched")
    return out.orderBy(F.desc("pct_enriched"), F.desc("open_items"), "data_provider").limit(25)


question("enrichment", "by_data_provider")(enrichment_by_provider)


# Open images


def _image_flags(t: Tables) -> DataFrame:
    return flagged(open_images(t).select("k_iri"), "k_iri", subject=provider_values(t, "v_dc_subject"), caption=captions(t), curated=curated_subjects(t))


@question("open_images", "tier_funnel")
def tier_funnel(t: Tables) -> DataFrame:
    s, c, e = F.col("subject"), F.col("caption"), F.col("curated")
    return totals(_image_flags(t), total_open_images=F.count("*"), with_any_subject=F.count_if(s), with_long_caption=F.count_if(c), caption_plus_any_subject=F.count_if(c & s), with_enriched_subject=F.count_if(e), caption_plus_enriched=F.count_if(c & e), premium_triple_all_three=F.count_if(c & s & e))


@question("open_images", "by_rights_family")
def images_by_rights_family(t: Tables) -> DataFrame:
    images = cube(t).where("v_edm_type = 'IMAGE' and x_has_content_url")
    return ranking(images, {"rights_family": F.col("x_rights_family"), "reuse_level": F.col("x_reuse_level")}, "image_items")


def _per_image(t: Tables, prop: str, **columns: Column) -> DataFrame:
    """Open images with aggregates over their provider values of a property."""
    v = provider_values(t, prop).withColumnRenamed("k_iri_cho", "k_iri")
    return open_images(t).select("k_iri").join(v, "k_iri", "left").groupBy("k_iri").agg(count_distinct_if(F.col("x_value_lang") != "", F.col("x_value_lang")).alias("langs"), *[c.alias(n) for n, c in columns.items()])


@question("open_images", "title_language_coverage")
def title_language_coverage(t: Tables) -> DataFrame:
    n = F.col("langs")
    per = _per_image(t, "v_dc_title", titles=F.count("x_value"))
    return totals(per, total_open_images=F.count("*"), no_title_at_all=F.count_if(F.col("titles") == 0), titles_but_no_lang_tag=F.count_if((F.col("titles") > 0) & (n == 0)), exactly_1_language=F.count_if(n == 1), exactly_2_languages=F.count_if(n == 2), three_plus_languages=F.count_if(n >= 3), pct_multilingual=share(n >= 2))


def _by_language(values: DataFrame, items: DataFrame, name: str) -> DataFrame:
    """Items per language of their values, with the share of all items."""
    lang = F.coalesce(F.nullif("x_value_lang", F.lit("")), F.lit("(untagged)")).alias(name)
    v = values.withColumnRenamed("k_iri_cho", "k_iri").join(items.select("k_iri"), "k_iri", "left_semi").select("k_iri", lang).distinct()
    out = with_total(v.groupBy(name).agg(F.count("*").alias("items")), items, "n").withColumn("pct", percent(F.col("items"), F.col("n"))).drop("n")
    return top(out, "items", [name], 20)


question("open_images", "top_title_languages")(lambda t: _by_language(provider_values(t, "v_dc_title"), open_images(t), "lang"))


@question("open_images", "description_language_coverage")
def description_language_coverage(t: Tables) -> DataFrame:
    n, longest = F.col("langs"), F.col("longest")
    long_ = longest >= LONG_CAPTION
    per = _per_image(t, "v_dc_description", longest=F.max(F.length("x_value")))
    return totals(per, total_open_images=F.count("*"), no_description=F.count_if((n == 0) & longest.isNull()), desc_but_no_lang_tag=F.count_if((n == 0) & longest.isNotNull()), desc_with_lang_tag=F.count_if(n >= 1), desc_in_2plus_langs=F.count_if(n >= 2), has_long_desc_200plus_chars=F.count_if(long_), long_desc_with_lang_tag=F.count_if(long_ & (n >= 1)))


@question("open_images", "enrichment_layer")
def enrichment_layer(t: Tables) -> DataFrame:
    depth = label_depth(t, "skos_Concept").select(F.col("k_iri_entity").alias("concept"), "depth")
    best = curated_subjects(t).join(depth, "concept", "left").groupBy("k_iri").agg(F.coalesce(F.max("depth"), F.lit(0)).alias("d"))
    per = open_images(t).select("k_iri").join(best, "k_iri", "left")
    d = F.col("d")
    return totals(per, open_images_total=F.count("*"), images_with_enriched_subject=F.count("d"), pct_enriched=percent(F.count("d"), F.count("*")), **{f"images_linked_to_{n}plus_lang_concept": F.count_if(d >= n) for n in (5, 10, 20)})


@question("open_images", "triple_funnel")
def triple_funnel(t: Tables) -> DataFrame:
    s, c, e = F.col("subject"), F.col("caption"), F.col("curated")
    return totals(_image_flags(t), total_open_images=F.count("*"), has_long_caption=F.count_if(c), has_enriched_subject=F.count_if(e), has_any_subject=F.count_if(s), caption_plus_enriched=F.count_if(c & e), caption_plus_any_subject=F.count_if(c & s), all_three=F.count_if(c & e & s))


question("open_images", "triple_languages")(lambda t: _by_language(captions(t), _image_flags(t).where("caption and curated"), "caption_lang"))
simple("open_images", "top_countries", open_images, "v_edm_country", "country", "open_images", known=True, limit=25)
simple("open_images", "top_data_providers", open_images, "v_edm_dataProvider", "data_provider", "open_images", known=True, limit=25, pct=None, org=True)


def _image_resources(t: Tables) -> DataFrame:
    return resources(t).join(open_images(t).select(F.col("k_iri").alias("k_iri_cho")), "k_iri_cho", "left_semi")


simple("open_images", "top_mime_types", _image_resources, "v_ebucore_hasMimeType", "mime_type", "resources", known=True, limit=25)
question("open_images", "image_resolution")(lambda t: resolution(_image_resources(t)))


# PDFs


@question("pdfs", "volume")
def pdf_volume(t: Tables) -> DataFrame:
    size = F.col("v_ebucore_fileByteSize")
    return totals(pdf_resources(t), total_pdf_resources=F.count("*"), distinct_items=F.count_distinct("k_iri_cho"), avg_size_mb=F.round(F.avg(size) / float(MB), 1), total_size_tb=F.round(F.sum(size) / float(1024**4), 1))


simple("pdfs", "by_type", pdf_items, "v_edm_type", "type", "items")
simple("pdfs", "by_rights_family", pdf_items, "x_rights_family", "rights_family", "items")


@question("pdfs", "by_dc_type")
def pdf_by_dc_type(t: Tables) -> DataFrame:
    v = provider_values(t, "v_dc_type").where("not x_value_is_iri and x_value <> ''").withColumnRenamed("k_iri_cho", "k_iri")
    v = v.join(pdf_items(t).select("k_iri"), "k_iri", "left_semi")
    return top(v.groupBy(F.col("x_value").alias("dc_type")).agg(F.count_distinct("k_iri").alias("items")), "items", ["dc_type"], 25)


simple("pdfs", "by_country", pdf_items, "v_edm_country", "country", "items", known=True, limit=25)
simple("pdfs", "top_data_providers", pdf_items, "v_edm_dataProvider", "data_provider", "items", known=True, limit=25, pct=None, org=True)
simple("pdfs", "top_datasets", pdf_items, "v_edm_datasetName", "dataset", "items", known=True, limit=25, pct=None)


@question("pdfs", "size_distribution")
def pdf_sizes(t: Tables) -> DataFrame:
    sized = pdf_resources(t).where("v_ebucore_fileByteSize is not null")
    return histogram(sized, *bucket(F.col("v_ebucore_fileByteSize"), SIZES), "size_bucket", "resources")


@question("pdfs", "multi_pdf_items")
def multi_pdf_items(t: Tables) -> DataFrame:
    per = pdf_resources(t).groupBy("k_iri_cho").agg(F.count("*").alias("n"))
    return histogram(per, *bucket(F.col("n"), [(2, "1 (single PDF)"), (6, "2-5"), (11, "6-10"), (51, "11-50"), (None, "50+")]), "pdfs_per_item", "items")


@question("pdfs", "pdf_plus_image")
def pdf_plus_image(t: Tables) -> DataFrame:
    # One pass over the resources instead of an intersection and a difference of two scans.
    mime = F.col("v_ebucore_hasMimeType")
    w = resources(t).join(open_items(t).select(F.col("k_iri").alias("k_iri_cho")), "k_iri_cho", "left_semi")
    per = w.groupBy("k_iri_cho").agg(F.coalesce(F.bool_or(mime == "application/pdf"), F.lit(False)).alias("pdf"), F.coalesce(F.bool_or(mime.startswith("image/")), F.lit(False)).alias("image"))
    p, i = F.col("pdf"), F.col("image")
    return totals(per, pdf_items=F.count_if(p), image_items=F.count_if(i), pdf_and_image_items=F.count_if(p & i), pdf_only_items=F.count_if(p & ~i))


@question("pdfs", "iiif_and_content_tier")
def pdf_iiif_and_tier(t: Tables) -> DataFrame:
    iiif = F.col("x_has_iiif")
    return ranking(pdf_items(t), {"content_tier": F.col("x_content_tier")}, "items", "pct_of_pdf_items", None, {"with_iiif": F.count_if(iiif), "pct_iiif": share(iiif)})


simple("pdfs", "top_languages", pdf_items, "x_primary_language", "language", "items", known=True, limit=25)


# IIIF books


def _iiif_multi_page(t: Tables) -> DataFrame:
    return flagged(open_multi_page(t), "k_iri", iiif=image_api(t))


@question("iiif_books", "volume")
def iiif_volume(t: Tables) -> DataFrame:
    own = F.when(F.col("iiif"), F.col("pages"))
    return totals(_iiif_multi_page(t), open_multi_page_items=F.count("*"), open_multi_page_pages=F.sum("pages"), iiif_items=F.count_if("iiif"), pct_iiif=share(F.col("iiif")), iiif_pages=F.sum(own), iiif_median_pages=F.percentile(own, 0.5), iiif_max_pages=F.max(own))


@question("iiif_books", "by_type")
def iiif_by_type(t: Tables) -> DataFrame:
    own = F.when(F.col("iiif"), F.col("pages"))
    return ranking(_iiif_multi_page(t), {"type": F.col("v_edm_type")}, "items", None, None, {"pages": F.sum("pages"), "median_pages": F.percentile("pages", 0.5), "iiif_items": F.count_if("iiif"), "iiif_pages": F.sum(own), "pct_iiif": share(F.col("iiif"))})


def _iiif_items(t: Tables) -> DataFrame:
    return open_multi_page(t).join(image_api(t), "k_iri", "left_semi")


_pages = {"pages": lambda: F.sum("pages"), "median_pages": lambda: F.percentile("pages", 0.5)}
simple("iiif_books", "iiif_top_providers", _iiif_items, "v_edm_dataProvider", "data_provider", "items", known=True, limit=25, pct=None, org=True, more=_pages | {"max_pages": lambda: F.max("pages")})
simple("iiif_books", "iiif_top_datasets", _iiif_items, "v_edm_datasetName", "dataset", "items", known=True, limit=25, pct=None, more=_pages)
simple("iiif_books", "iiif_by_country", _iiif_items, "v_edm_country", "country", "iiif_items", known=True, limit=25, pct=None, more={"iiif_pages": lambda: F.sum("pages")})


@question("iiif_books", "title_languages")
def multi_page_title_languages(t: Tables) -> DataFrame:
    lang = F.coalesce(F.nullif("x_value_lang", F.lit("")), F.lit("(untagged)")).alias("lang")
    v = provider_values(t, "v_dc_title").select(F.col("k_iri_cho").alias("k_iri"), lang).distinct()
    out = v.join(open_multi_page(t).select("k_iri", "pages"), "k_iri").groupBy("lang").agg(F.count("*").alias("items"), F.sum("pages").alias("pages"))
    return top(out, "items", ["lang"], 25)


@question("iiif_books", "presentation_diagnostic")
def presentation_diagnostic(t: Tables) -> DataFrame:
    rows = flagged(open_multi_page(t).select("k_iri"), "k_iri", pres=presentation_api(t), doap=implements_iiif(t))
    return totals(rows, open_multi_page_items=F.count("*"), with_presentation_conformsTo=F.count_if("pres"), with_doap_iiif=F.count_if("doap"), with_either_signal=F.count_if(F.col("pres") | F.col("doap")))


@question("iiif_books", "iiif_largest")
def iiif_largest(t: Tables) -> DataFrame:
    rows = named(t, _iiif_items(t).orderBy(F.desc("pages"), "k_iri").limit(50), "v_edm_dataProvider", "data_provider")
    return rows.select(F.col("k_iri").alias("cho"), "pages", F.col("v_edm_type").alias("type"), F.col("v_edm_country").alias("country"), "data_provider", F.col("v_edm_datasetName").alias("dataset")).orderBy(F.desc("pages"), "cho")


# Natural history

_coverage = {"with_content_url": lambda: F.count_if("x_has_content_url"), "with_iiif_service": lambda: F.count_if("x_has_iiif")}


@question("natural_history", "volume")
def nh_volume(t: Tables) -> DataFrame:
    url, iiif = F.col("x_has_content_url"), F.col("x_has_iiif")
    return totals(natural_history(t), nh_items_open=F.count("*"), with_content_url=F.count_if(url), pct_content_url=share(url), with_iiif_service=F.count_if(iiif), pct_iiif=share(iiif))


simple("natural_history", "by_modality", natural_history, "v_edm_type", "modality", "items", more=_coverage)
simple("natural_history", "by_provider", natural_history, "data_provider", "data_provider", "items", pct=None, more=_coverage | {"pct_iiif": lambda: share(F.col("x_has_iiif"))})


@question("natural_history", "subject_coverage")
def nh_subject_coverage(t: Tables) -> DataFrame:
    rows = flagged(natural_history(t).select("k_iri"), "k_iri", subject=provider_values(t, "v_dc_subject"), curated=curated_subjects(t))
    s, e = F.col("subject"), F.col("curated")
    return totals(rows, nh_items=F.count("*"), with_any_subject=F.count_if(s), pct_any_subject=share(s), with_enriched_concept=F.count_if(e), pct_enriched_concept=share(e))


@question("natural_history", "top_datasets")
def nh_top_datasets(t: Tables) -> DataFrame:
    return ranking(natural_history(t).where("v_edm_datasetName is not null"), {"dataset": F.col("v_edm_datasetName"), "modality": F.col("v_edm_type")}, "items", None, 25)


simple("natural_history", "audio_subset", lambda t: natural_history(t).where("v_edm_type = 'SOUND'"), "data_provider", "data_provider", "audio_items", pct=None, more={"with_content_url": lambda: F.count_if("x_has_content_url")})
question("natural_history", "taxonomic_titles")(lambda t: _by_language(provider_values(t, "v_dc_title"), natural_history(t), "lang"))
simple("natural_history", "top_countries", natural_history, "v_edm_country", "country", "items", known=True, limit=25)


# Multi-page items


@question("multi_page", "overview")
def multi_page_overview(t: Tables) -> DataFrame:
    several = F.when(F.col("pages") > 1, F.col("pages"))
    out = totals(pages(t), items_with_web_resources=F.count("*"), multi_page_items=F.count(several), pages_on_multi_page_items=F.sum(several), avg_pages=F.round(F.avg(several), 2), median_pages=F.percentile(several, 0.5), p95_pages=F.percentile(several, 0.95), max_pages=F.max(several))
    return with_total(out, cube(t), "total_items").withColumn("pct_of_total", percent(F.col("multi_page_items"), F.col("total_items")))


@question("multi_page", "page_count_distribution")
def page_count_distribution(t: Tables) -> DataFrame:
    return histogram(multi_page(t), *bucket(F.col("pages"), [(3, "2"), (6, "3-5"), (11, "6-10"), (51, "11-50"), (101, "51-100"), (501, "101-500"), (None, "500+")]), "pages_per_item", "items")


@question("multi_page", "iiif_compatibility")
def iiif_compatibility(t: Tables) -> DataFrame:
    rows = flagged(multi_page(t), "k_iri", image=image_api(t), pres=presentation_api(t))
    i, p = F.col("image"), F.col("pres")
    return totals(rows, multi_page_items=F.count("*"), with_image_api=F.count_if(i), pct_image_api=share(i), with_presentation_diagnostic=F.count_if(p), pct_presentation_diagnostic=share(p), with_both=F.count_if(i & p), without_iiif=F.count_if(~i), pct_without_iiif=share(~i))


@question("multi_page", "largest_items")
def largest_items(t: Tables) -> DataFrame:
    best = multi_page(t).orderBy(F.desc("pages"), "k_iri").limit(50).join(cube(t), "k_iri", "left")
    rows = flagged(named(t, best, "v_edm_dataProvider", "data_provider"), "k_iri", iiif_image_api=image_api(t))
    return rows.select(F.col("k_iri").alias("cho"), "pages", F.col("v_edm_type").alias("type"), F.col("v_edm_country").alias("country"), "data_provider", "iiif_image_api").orderBy(F.desc("pages"), "cho")


@question("multi_page", "sequencing")
def sequencing(t: Tables) -> DataFrame:
    per = resources(t).where("k_iri_cho is not null").groupBy("k_iri_cho").agg(F.count("*").alias("pages"), F.count("v_edm_isNextInSequence").alias("links")).where("pages > 1")
    links = F.when(F.col("links") > 0, F.col("links"))
    return totals(per, multi_page_items=F.count("*"), items_with_sequencing=F.count(links), pct_sequenced=percent(F.count(links), F.count("*")), total_sequence_links=F.coalesce(F.sum(links), F.lit(0)), avg_seq_links_when_present=F.coalesce(F.round(F.avg(links), 2), F.lit(0.0)))


def _multi_page_items(t: Tables) -> DataFrame:
    return flagged(cube(t).join(multi_page(t), "k_iri", "left_semi"), "k_iri", image=image_api(t))


_image = {"with_image_api": lambda: F.count_if("image"), "pct_image_api": lambda: share(F.col("image"))}
simple("multi_page", "by_type", _multi_page_items, "v_edm_type", "type", "multi_page_items", pct="pct_of_multi_page", more=_image)
simple("multi_page", "by_country", _multi_page_items, "v_edm_country", "country", "multi_page_items", known=True, limit=25, pct=None, more=_image)
simple("multi_page", "top_data_providers", _multi_page_items, "v_edm_dataProvider", "data_provider", "multi_page_items", known=True, limit=25, pct=None, org=True, more=_image)
simple("multi_page", "top_datasets", _multi_page_items, "v_edm_datasetName", "dataset", "multi_page_items", known=True, limit=25, pct=None, more=_image)
simple("multi_page", "by_reuse_level", _multi_page_items, "x_reuse_level", "reuse_level", "multi_page_items", pct="pct_of_multi_page", more=_image)


# Running


def select(sections: Iterable[str] = (), questions: Iterable[str] = ()) -> list[tuple[str, str]]:
    """(section, question) pairs: all of the named sections and the named questions ("name" or "section.name"); all for none."""
    sections, questions = set(sections), set(questions)
    if unknown := sections - set(SECTIONS):
        raise KeyError(f"no section {', '.join(sorted(unknown))}")
    found = [(s, q) for s, qs in SECTIONS.items() for q in qs]
    if not sections and not questions:
        return found
    return [(s, q) for s, q in found if s in sections or q in questions or f"{s}.{q}" in questions]


def run(t: Tables, chosen: Iterable[tuple[str, str]]) -> list[dict]:
    """Each question's columns and rows; one that fails is noted and the rest goes on. Results are small: totals, histograms, top lists."""
    out = []
    for section, name in chosen:
        try:
            df = SECTIONS[section][name](t)
            out.append({"section": section, "question": name, "columns": df.columns, "rows": [list(r) for r in df.collect()]})
        except Exception as e:
            out.append({"section": section, "question": name, "error": f"{type(e).__name__}: {e}"})
    return out


def to_markdown(results: list[dict], title: str = "Report") -> str:
    lines, section = [f"# {title}"], None
    for r in results:
        if r["section"] != section:
            section = r["section"]
            lines.append(f"\n## {section.replace('_', ' ').capitalize()}")
        lines += [f"\n### {r['question'].replace('_', ' ').capitalize()}\n", f"_{r['error']}_" if "error" in r else markdown_table(r["columns"], r["rows"])]
    return "\n".join(lines) + "\n"
