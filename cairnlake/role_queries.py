"""Composed tables, report questions and explorer answers on the driver's tables, as queries with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators.filters import parse
from .plans import buckets
from .plans.bitmaps import FacetBitmaps
from .plans.compose import COMPOSED, whole_cube
from .plans.explorer import FACETS, Explorer
from .plans.report import SECTIONS, enrichment_by_provider, top_outside_hosts
from .role_sql import QUESTIONS, with_tables
from .roles import catalog
from .sources.scratch import fresh_path

Query = Callable[[SparkSession, str], DataFrame]
D = "http://data.europeana.eu/"
FILTER = 'country=NATION_1,NATION_2,NATION_3 type=IMAGE content_tier>=1 has_subject'
FACET = {"v_edm_type": {"kind": "in", "values": ["IMAGE", "TEXT"]}, "x_content_tier": {"kind": "range", "min": 1, "max": 3}}
DIVISION = FACET | {"ebucore:hasMimeType": {"kind": "in", "values": ["application/pdf", "image/jpeg"]}}
#: The questions' bounds are made for a whole union's holdings; on the driver's tables they would leave nothing.
LEAST_LINKS, LEAST_ITEMS = 5, 3
FACET_SQL = "v_edm_type IN ('IMAGE', 'TEXT') AND x_content_tier BETWEEN 1 AND 3"


def _composed(name: str) -> Query:
    return lambda s, d: catalog(s, d)(name)


def _question(section: str, name: str) -> Query:
    return lambda s, d: SECTIONS[section][name](catalog(s, d))


def explorer_counts(s: SparkSession, d: str) -> DataFrame:
    """Facet counts under filters, for a facet over edges."""
    return Explorer(catalog(s, d)).counts("dc:subject", FACET).drop("label")


def explorer_cold_counts(s: SparkSession, d: str) -> DataFrame:
    """Facet counts without filters, from the ranked table."""
    return Explorer(catalog(s, d)).counts("edm:Agent")


def explorer_filtered(s: SparkSession, d: str) -> DataFrame:
    return Explorer(catalog(s, d)).filtered(DIVISION).select("k_iri")


def bitmap_counts(s: SparkSession, d: str) -> DataFrame:
    """Counts of all facets over edges, and of two of the cube's columns, under a filter, from the bitmap index in one pass."""
    return FacetBitmaps.build(catalog(s, d)).counts(FACET, [*FACETS, "v_edm_country", "x_reuse_level"]).drop("label")


def bitmap_division(s: SparkSession, d: str) -> DataFrame:
    """Items under a filter that are linked to all of two values, from the bitmap index."""
    return FacetBitmaps.build(catalog(s, d)).items(DIVISION)


def bucketed_item_cube(s: SparkSession, d: str) -> DataFrame:
    """The item cube from parts that are stored in buckets of the item."""
    return buckets.bucketed_cube(buckets.store_cube_parts(catalog(s, d), fresh_path(s, "buckets")))


def explorer_labels(s: SparkSession, d: str) -> DataFrame:
    return Explorer(catalog(s, d)).label_table([f"{D}{f}/{i}" for f in ("agent", "place", "concept", "timespan", "item", "organization") for i in range(40)])


def report_filtered(s: SparkSession, d: str) -> DataFrame:
    """A question under a filter of the small language, which restricts the cube alone."""
    t = catalog(s, d)
    return SECTIONS["overview"]["top_institutions"](t.filtered(parse(FILTER, t("group_items").schema)))


def open_items_view(s: SparkSession, d: str) -> DataFrame:
    from .plans.compose import open_items

    return open_items(catalog(s, d))


def sample_items_view(s: SparkSession, d: str) -> DataFrame:
    """A fixed sample of 100 items: the limit is the feature."""
    from .plans.compose import sample_items

    return sample_items(catalog(s, d), 100)


def rights_dimension(s: SparkSession, d: str) -> DataFrame:
    """The registry of rights statements joined to the rights in use."""
    from .functions.rights import rights_registry

    used = catalog(s, d)("values_ore_Aggregation").groupBy(F.col("v_edm_rights").alias("uri")).agg(F.count("*").alias("n"))
    return rights_registry(s, {"2.0": [None], "3.0": [None, "au"], "4.0": [None]}).join(used, "uri").select("uri", "reuse_level", "family", "n")


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {f"composed_{n}": _composed(n) for n in (*COMPOSED, "orgs")}
    out["composed_group_items"] = lambda s, d: whole_cube(catalog(s, d))
    out |= {f"report_{s}_{q}": _question(s, q) for s, qs in SECTIONS.items() for q in qs}
    out["report_external_links_top_outside_hosts"] = lambda s, d: top_outside_hosts(catalog(s, d), LEAST_LINKS)
    out["report_enrichment_by_data_provider"] = lambda s, d: enrichment_by_provider(catalog(s, d), LEAST_ITEMS)
    return out | {f.__name__: f for f in (explorer_counts, explorer_cold_counts, explorer_filtered, bitmap_counts, bitmap_division, bucketed_item_cube, explorer_labels, report_filtered, open_items_view, sample_items_view, rights_dimension)}


def oracle_sql() -> dict[str, str]:
    labels = "SELECT k_iri, arg_min(v_skos_prefLabel, (CASE WHEN x_prefLabel_lang = 'en' THEN 0 WHEN coalesce(x_prefLabel_lang, '') = '' THEN 1 ELSE 2 END, coalesce(x_prefLabel_lang, ''), v_skos_prefLabel)) AS label FROM {t} GROUP BY 1"
    every = " UNION ALL ".join(labels.format(t=t) for t in ("values_edm_Agent", "values_edm_Place", "values_skos_Concept", "values_edm_TimeSpan", "values_foaf_Organization", "(SELECT k AS k_iri, v AS v_skos_prefLabel, l AS x_prefLabel_lang FROM own WHERE p = 'v_dc_title')"))
    out = {f"composed_{n}": f'SELECT * FROM "{n}"' for n in (*COMPOSED, "orgs")}
    out |= {f"report_{s}_{q}": sql for s, qs in QUESTIONS.items() for q, sql in qs.items()}
    for name, bound, least in (("report_external_links_top_outside_hosts", 50000, LEAST_LINKS), ("report_enrichment_by_data_provider", 10000, LEAST_ITEMS)):
        out[name] = out[name].replace(f">= {bound}", f">= {least}")
    out |= {
        "sample_items_view": "SELECT item FROM (SELECT DISTINCT k_iri AS item FROM values_edm_ProvidedCHO) ORDER BY md5(item), item LIMIT 100",
        "explorer_counts": f"SELECT k_iri_entity AS value, count(DISTINCT k_iri_cho) AS items FROM explorer_concepts WHERE x_property = 'v_dc_subject' AND k_iri_cho IN (SELECT k_iri FROM group_items WHERE {FACET_SQL}) GROUP BY 1",
        "explorer_cold_counts": "SELECT k_iri_entity AS value, x_label AS label, x_item_count AS items FROM explorer_facet_top_n WHERE x_entity_class = 'edm_Agent' AND x_property = '*'",
        "explorer_filtered": f"SELECT k_iri FROM group_items WHERE {FACET_SQL} AND k_iri IN (SELECT k_iri_cho FROM map_cho_mimetypes WHERE v_mime_type = 'application/pdf') AND k_iri IN (SELECT k_iri_cho FROM map_cho_mimetypes WHERE v_mime_type = 'image/jpeg')",
        "bitmap_counts": bitmap_sql(),
        "explorer_labels": f"SELECT * FROM ({every}) WHERE TRY_CAST(regexp_extract(k_iri, '[0-9]+$') AS INT) < 40",
        "report_filtered": QUESTIONS["overview"]["top_institutions"].replace("FROM group_items WHERE", "FROM group_items WHERE v_edm_country IN ('NATION_1', 'NATION_2', 'NATION_3') AND v_edm_type = 'IMAGE' AND x_content_tier >= 1 AND x_has_subject AND"),
        "open_items_view": "SELECT a.k_iri_cho AS item, v_edm_type AS type, k_iri AS rights FROM values_ore_Aggregation a0 JOIN (SELECT k_iri_cho, k_iri AS x FROM values_ore_Aggregation) a ON a.x = a0.k_iri JOIN (SELECT k_iri, x_is_open FROM map_rights) r ON r.k_iri = a0.v_edm_rights AND x_is_open JOIN (SELECT k_iri_cho AS k, v_edm_type FROM values_ore_Proxy WHERE v_edm_europeanaProxy = 'true' AND v_edm_type IS NOT NULL) p ON p.k = a.k_iri_cho".replace("k_iri AS rights", "r.k_iri AS rights"),
        "rights_dimension": "SELECT v_edm_rights AS uri, x_category AS reuse_level, x_family AS family, count(*) AS n FROM values_ore_Aggregation JOIN map_rights m ON m.k_iri = v_edm_rights GROUP BY 1, 2, 3",
    }
    out["bitmap_division"] = out["explorer_filtered"]
    out["bucketed_item_cube"] = "SELECT * FROM group_items"
    return {n: with_tables(sql) for n, sql in out.items()}


def bitmap_sql() -> str:
    parts = []
    for name, f in FACETS.items():
        entity = "v_mime_type" if f.table == "map_cho_mimetypes" else "k_iri_entity"
        where = f"x_property = '{f.prop}' AND " if f.prop else ""
        parts.append(f"SELECT '{name}' AS facet, {entity} AS value, count(DISTINCT k_iri_cho) AS items FROM {f.table} WHERE {where}k_iri_cho IN (SELECT k_iri FROM group_items WHERE {FACET_SQL}) GROUP BY 2")
    parts += [f"SELECT '{c}', {c}, count(*) FROM group_items WHERE {FACET_SQL} AND {c} IS NOT NULL GROUP BY 2" for c in ("v_edm_country", "x_reuse_level")]
    return " UNION ALL ".join(parts)
