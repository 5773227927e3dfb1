"""SQL (DuckDB) for the composed tables and the report questions on the driver's tables in their roles.

An independent statement of the same results: every text is a chain of common table expressions
over the raw tables of roles.SQL, cut down to those that a result needs.
"""

from __future__ import annotations

import re

from .roles import SQL

D = "http://data.europeana.eu/"
CLASS_FOLDER = {"edm_Agent": "agent/", "edm_Place": "place/", "skos_Concept": "concept/", "edm_TimeSpan": "timespan/"}
CLASSES = tuple(CLASS_FOLDER)
# Expected of each rights URI in the roles' data, written out: level, family, label.
RIGHTS = {
    "http://creativecommons.org/publicdomain/mark/1.0/": ("open", "pdm", "Public Domain Mark"),
    "http://creativecommons.org/publicdomain/zero/1.0/": ("open", "cc0", "Public Domain Dedication (CC0)"),
    "http://creativecommons.org/licenses/by/4.0/": ("open", "cc-by", "Attribution (CC BY)"),
    "http://creativecommons.org/licenses/by-sa/3.0/au/": ("open", "cc-by-sa", "Attribution-ShareAlike (CC BY-SA)"),
    "http://creativecommons.org/licenses/by-nc/2.0/": ("restricted", "cc-by-nc", "Attribution-NonCommercial (CC BY-NC)"),
    "http://rightsstatements.org/vocab/InC/1.0/": ("prohibited", "rs-inc", "In Copyright (RightsStatements.org)"),
    "http://rightsstatements.org/vocab/NoC-NC/1.0/": ("restricted", "rs-noc", "No Copyright — Non-Commercial Use Only (RightsStatements.org)"),
}


def expected(uri: str, which: int, other: str) -> str:
    return f"CASE {uri} " + " ".join(f"WHEN '{u}' THEN '{told[which]}'" for u, told in RIGHTS.items()) + f" ELSE '{other}' END"


LEVEL, FAMILY, LABEL = expected("u", 0, "prohibited"), expected("u", 1, "unknown"), expected("u", 2, "Unknown")
OPEN = f"({LEVEL} = 'open')"
# Vocabularies of the IRIs in the roles' data, written out.
VOCABULARY = r"""CASE WHEN regexp_matches(i, '^https?://vocab\.getty\.edu/aat') THEN 'aat' WHEN regexp_matches(i, '^https?://vocab\.getty\.edu/tgn/') THEN 'tgn'
WHEN regexp_matches(i, '^https?://d-nb\.info/gnd') THEN 'gnd' WHEN regexp_matches(i, '^https?://www\.wikidata\.org/entity/') THEN 'wikidata' END"""
SOUND = r"coalesce(regexp_matches(i, '^https?://[A-Za-z0-9.-]+/') AND NOT regexp_matches(i, '\s') AND NOT regexp_matches(i, '\$[0-9]'), false)"


def _all(template: str) -> str:
    return " UNION ALL ".join(template.format(c=c, f=CLASS_FOLDER[c]) for c in CLASSES)


def pct(part: str, whole: str) -> str:
    return f"round(CAST({part} AS DOUBLE) * 100.0 / nullif(CAST({whole} AS DOUBLE), 0), 2)"


def share(test: str) -> str:
    return pct(f"count_if({test})", "count(*)")


ALL = pct("count(*)", "sum(count(*)) OVER ()")
COMPOSED = {
    "map_cho_entities": f"SELECT DISTINCT p.k_iri_cho, l.x_value AS k_iri_entity, e.c AS x_entity_class, l.x_property FROM links_ore_Proxy l JOIN values_ore_Proxy p ON p.k_iri = l.k_iri JOIN ({_all('SELECT DISTINCT k_iri, {c!r} AS c FROM values_{c}')}) e ON e.k_iri = l.x_value WHERE l.x_value_is_iri",
    "map_entity_vocab": f"SELECT k_iri_entity, v IS NOT NULL AS x_is_metis, v AS x_vocabulary FROM (SELECT i AS k_iri_entity, CASE WHEN regexp_matches(i, '^https?://data.europeana.eu/') THEN 'edm' ELSE {VOCABULARY} END AS v FROM (SELECT DISTINCT k_iri_entity AS i FROM map_cho_entities))",
    "map_edm_entities": f"SELECT DISTINCT k_iri_cho, k_iri_entity, x_entity_class FROM map_cho_entities WHERE starts_with(k_iri_entity, '{D}')",
    "map_sameAs": f"SELECT k_iri, i AS v_owl_sameAs, CASE WHEN ok THEN v END AS x_authority, c AS x_entity_class, v IS NOT NULL AS x_metis_known, ok AS x_well_formed FROM (SELECT k_iri, i, c, {SOUND} AS ok, {VOCABULARY} AS v FROM ({_all('SELECT k_iri, x_value AS i, {c!r} AS c FROM links_{c}')}))",
    "map_rights": f"SELECT u AS k_iri, {LEVEL} AS x_category, {FAMILY} AS x_family, {OPEN} AS x_is_open, {LABEL} AS x_label FROM (SELECT DISTINCT v_edm_rights AS u FROM values_ore_Aggregation WHERE v_edm_rights IS NOT NULL)",
    "map_cho_mimetypes": "SELECT DISTINCT k_iri_cho, v_ebucore_hasMimeType AS v_mime_type FROM values_edm_WebResource WHERE v_ebucore_hasMimeType <> ''",
    "explorer_edm_entities": f"SELECT DISTINCT m.*, coalesce(l.en, m.k_iri_entity) AS x_label FROM map_cho_entities m LEFT JOIN ({_all('SELECT k_iri, max(v_skos_prefLabel) FILTER (x_prefLabel_lang = $) AS en FROM values_{c} GROUP BY 1').replace('$', repr('en'))}) l ON l.k_iri = m.k_iri_entity WHERE starts_with(m.k_iri_entity, '{D}')",
    **{f"explorer_{n}": f"SELECT k_iri_cho, k_iri_entity, x_property, x_label FROM explorer_edm_entities WHERE x_entity_class = '{c}'" for n, c in (("concepts", "skos_Concept"), ("agents", "edm_Agent"), ("places", "edm_Place"), ("timespans", "edm_TimeSpan"))},
    "explorer_facet_top_n": "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY x_entity_class, x_property ORDER BY x_item_count DESC, k_iri_entity) AS x_rank FROM (SELECT x_entity_class, x_property, k_iri_entity, min(x_label) AS x_label, count(DISTINCT k_iri_cho) AS x_item_count FROM (SELECT * FROM explorer_edm_entities UNION ALL SELECT k_iri_cho, k_iri_entity, x_entity_class, '*', x_label FROM explorer_edm_entities) GROUP BY ALL)) WHERE x_rank <= 500",
    "orgs": "SELECT k_iri, coalesce(max(v_skos_prefLabel) FILTER (x_prefLabel_lang = 'en'), max(v_skos_prefLabel)) AS name, max(v_edm_country) AS country, max(v_edm_acronym) AS acronym FROM values_foaf_Organization GROUP BY 1",
    "own": "SELECT k_iri_cho AS k, x_property AS p, x_value AS v, x_value_is_iri AS is_iri, x_value_lang AS l FROM links_ore_Proxy JOIN values_ore_Proxy USING (k_iri) WHERE v_edm_europeanaProxy IS DISTINCT FROM 'true'",
    "group_items": f"""SELECT c.k_iri, e.v_edm_country, a.v_edm_dataProvider, e.v_edm_datasetName, a.v_edm_provider, t.ty AS v_edm_type, TRY_CAST(nullif(regexp_extract(q.x_content_tier_uri, 'contentTier([0-9])$', 1), '') AS INTEGER) AS x_content_tier,
coalesce(w.nd, 0) AS x_distinct_web_resources, coalesce(f.ag, false) AS x_has_agent_enrichment, coalesce(f.co, false) AS x_has_concept_enrichment, a.v_edm_isShownBy IS NOT NULL AS x_has_content_url, coalesce(o.cr, false) AS x_has_creator, coalesce(o.de, false) AS x_has_description,
coalesce(a.v_edm_isShownBy IN (SELECT k_iri FROM values_edm_WebResource) AND a.v_edm_isShownBy IN (SELECT k_iri_webresource FROM values_svcs_Service), false) AS x_has_iiif, coalesce(w.np > 0, false) AS x_has_pdf, coalesce(f.pl, false) AS x_has_place_enrichment, coalesce(o.su, false) AS x_has_subject,
coalesce(f.sc, false) AS x_has_subject_enrichment, coalesce(f.ts, false) AS x_has_time_enrichment, a.v_edm_provider = 'http://data.europeana.eu/organization/1609' AS x_in_openup,
coalesce(n.k IS NOT NULL, false) OR coalesce(f.nc, false) OR coalesce(lower(e.v_edm_datasetName) LIKE '%newspaper%', false) OR coalesce(regexp_extract(e.v_edm_datasetName, '^[^_]*') = '9200300', false) AS x_is_newspaper, coalesce(f.sp, false) AS x_is_specimen,
nullif(regexp_extract(q.x_metadata_tier_uri, 'metadataTier([0A-C])$', 1), '') AS x_metadata_tier, coalesce(w.np, 0) AS x_pdf_count, e.v_edm_language AS x_primary_language, {expected("a.v_edm_rights", 0, "prohibited")} AS x_reuse_level, {expected("a.v_edm_rights", 1, "unknown")} AS x_rights_family, coalesce(o.tl, 0) AS x_title_languages, coalesce(w.n, 0) AS x_web_resource_count
FROM values_edm_ProvidedCHO c LEFT JOIN (SELECT k_iri_cho, unnest(min_by(x, x.k_iri)) FROM (SELECT k_iri_cho, struct_pack(k_iri, v_edm_dataProvider, v_edm_provider, v_edm_isShownBy, v_edm_rights) AS x FROM values_ore_Aggregation) GROUP BY 1) a ON a.k_iri_cho = c.k_iri
LEFT JOIN values_edm_EuropeanaAggregation e ON e.k_iri_cho = c.k_iri LEFT JOIN values_publishing_tier q ON q.k_iri = c.k_iri LEFT JOIN (SELECT k_iri_cho AS k, max(v_edm_type) AS ty FROM values_ore_Proxy WHERE v_edm_europeanaProxy = 'true' GROUP BY 1) t ON t.k = c.k_iri
LEFT JOIN (SELECT k, bool_or(p = 'v_dc_creator') AS cr, bool_or(p = 'v_dc_description') AS de, bool_or(p = 'v_dc_subject') AS su, count(DISTINCT l) FILTER (p = 'v_dc_title' AND l <> '') AS tl FROM own GROUP BY 1) o ON o.k = c.k_iri
LEFT JOIN (SELECT k_iri_cho AS k, count(*) AS n, count(DISTINCT k_iri) AS nd, count_if(v_ebucore_hasMimeType = 'application/pdf') AS np FROM values_edm_WebResource GROUP BY 1) w ON w.k = c.k_iri
LEFT JOIN (SELECT k_iri_cho AS k, bool_or(x_entity_class = 'edm_Agent') AS ag, bool_or(x_entity_class = 'skos_Concept') AS co, bool_or(x_entity_class = 'edm_Place') AS pl, bool_or(x_entity_class = 'edm_TimeSpan') AS ts, bool_or(x_entity_class = 'skos_Concept' AND x_property = 'v_dc_subject') AS sc, bool_or(k_iri_entity = 'http://data.europeana.eu/concept/167') AS sp, bool_or(k_iri_entity = 'http://data.europeana.eu/concept/18') AS nc FROM map_cho_entities WHERE k_iri_entity IN (SELECT k_iri_entity FROM map_entity_vocab WHERE x_is_metis) GROUP BY 1) f ON f.k = c.k_iri
LEFT JOIN (SELECT DISTINCT k_iri_cho AS k FROM links_ore_Proxy JOIN values_ore_Proxy USING (k_iri) WHERE x_property = 'v_dcterms_isPartOf' AND lower(x_value) LIKE '%europeana newspapers%') n ON n.k = c.k_iri""",
    # Blocks of the report
    "oi": "SELECT * FROM group_items WHERE x_reuse_level = 'open'",
    "im": "SELECT * FROM oi WHERE v_edm_type = 'IMAGE' AND x_has_content_url",
    "pg": "SELECT k_iri_cho AS k_iri, count(*) AS pages FROM values_edm_WebResource GROUP BY 1",
    "srv": "SELECT DISTINCT w.k_iri_cho AS k, CASE WHEN x_property = 'v_doap_implements' AND lower(x_value) LIKE '%iiif%' THEN 'doap' WHEN x_value LIKE 'http://iiif.io/api/image%' THEN 'image' WHEN x_value LIKE 'http://iiif.io/api/presentation%' THEN 'pres' END AS api FROM links_svcs_Service JOIN values_svcs_Service s USING (k_iri) JOIN values_edm_WebResource w ON w.k_iri = s.k_iri_webresource",
    "mp": "SELECT g.*, pages, g.k_iri IN (SELECT k FROM srv WHERE api = 'image') AS image FROM pg JOIN group_items g USING (k_iri) WHERE pages > 1",
    "omp": "SELECT * FROM mp WHERE x_reuse_level = 'open'",
    "cap": "SELECT * FROM own WHERE p = 'v_dc_description' AND length(v) >= 200",
    "cur": "SELECT DISTINCT replace(k_iri, '/proxy/europeana/', '/item/') AS k, x_value AS concept FROM links_ore_Proxy WHERE x_property = 'v_dc_subject' AND x_value_is_iri AND contains(k_iri, '/proxy/europeana/')",
    "ol": "SELECT * FROM map_cho_entities WHERE k_iri_cho IN (SELECT k_iri FROM oi)",
    "dep": _all("SELECT {c!r} AS x_entity_class, k_iri AS k_iri_entity, count(DISTINCT x_prefLabel_lang) AS d FROM values_{c} WHERE x_prefLabel_lang <> '' GROUP BY 2"),
    "pdfr": "SELECT * FROM values_edm_WebResource WHERE v_ebucore_hasMimeType = 'application/pdf' AND k_iri_cho IN (SELECT k_iri FROM oi)",
    "pdfi": "SELECT * FROM oi WHERE k_iri IN (SELECT k_iri_cho FROM pdfr)",
    "nh": "SELECT g.*, o.name FROM oi g JOIN orgs o ON o.k_iri = g.v_edm_dataProvider WHERE (lower(o.name) LIKE 'naturalis biodiversity%' OR lower(o.name) LIKE '%berlin-dahlem%')",
    "sa": "SELECT * FROM map_sameAs WHERE x_well_formed AND x_metis_known",
    "imf": "SELECT k_iri, k_iri IN (SELECT k FROM own WHERE p = 'v_dc_subject') AS s, k_iri IN (SELECT k FROM cap) AS c, k_iri IN (SELECT k FROM cur) AS e FROM im",
    "imr": "SELECT * FROM values_edm_WebResource WHERE k_iri_cho IN (SELECT k_iri FROM im)",
}
ITEMS = {"cube": "group_items", "open_images": "im", "pdf_items": "pdfi", "natural_history": "nh", "_multi_page_items": "mp", "_iiif_items": "omp WHERE image", "resources": "values_edm_WebResource", "_image_resources": "imr"}


def simple(source: str, column: str, alias: str, count: str, *, known: bool = False, limit: int | None = None, share_as: str | None = "pct", org: bool = False, more: str = "") -> str:
    where = f" {'AND' if ' WHERE ' in source else 'WHERE'} {column} IS NOT NULL" if known else ""
    name = f"coalesce((SELECT name FROM orgs o WHERE o.k_iri = {column}), {column})" if org else column
    parts = [f"{name} AS {alias}", f"count(*) AS {count}", *([f"{ALL} AS {share_as}"] if share_as else []), *([more] if more else [])]
    return f"SELECT {', '.join(parts)} FROM (SELECT * FROM {source}{where}) GROUP BY 1 ORDER BY {count} DESC, {alias} NULLS LAST" + (f" LIMIT {limit}" if limit else "")


def steps(column: str, limits: list[tuple[int | None, str]]) -> str:
    return "CASE " + " ".join(f"WHEN {column} < {n} THEN '{x}'" for n, x in limits if n) + f" ELSE '{limits[-1][1]}' END"


def hist(source: str, case: str, name: str, count: str) -> str:
    return f"SELECT {case} AS {name}, count(*) AS {count}, {ALL} AS pct FROM {source} GROUP BY 1"


SIZES = steps("v_ebucore_fileByteSize", [(102400, "< 100 KB"), (1048576, "100 KB - 1 MB"), (10485760, "1 MB - 10 MB"), (104857600, "10 MB - 100 MB"), (1073741824, "100 MB - 1 GB"), (None, ">= 1 GB")])
PIXELS = "CASE WHEN v_ebucore_width IS NULL OR v_ebucore_height IS NULL THEN 'unknown' ELSE " + steps("v_ebucore_width * v_ebucore_height", [(100000, "< 0.1 MP"), (500000, "0.1-0.5 MP"), (1000000, "0.5-1 MP"), (4000000, "1-4 MP"), (16000000, "4-16 MP"), (None, ">= 16 MP")]) + " END"
NPAGES = [(2, "1 (single)"), (6, "2-5"), (11, "6-10"), (51, "11-50"), (101, "51-100"), (None, "100+")]
LANG = "coalesce(nullif(l, ''), '(untagged)')"
IMAGE = f"count_if(image) AS with_image_api, {share('image')} AS pct_image_api"
PAGES = "CAST(sum(pages) AS BIGINT) AS pages, quantile_cont(pages, 0.5) AS median_pages"
COVER = "count_if(x_has_content_url) AS with_content_url, count_if(x_has_iiif) AS with_iiif_service"


def by_language(values: str, source: str, name: str) -> str:
    return f"SELECT {LANG} AS {name}, count(DISTINCT k) AS items, {pct('count(DISTINCT k)', f'(SELECT count(*) FROM {source})')} AS pct FROM {values} WHERE k IN (SELECT k_iri FROM {source}) GROUP BY 1 ORDER BY items DESC, {name} LIMIT 20".replace("FROM own AND", "FROM own WHERE")


def top_entities(cls: str, name: str) -> str:
    return f"""SELECT r.k_iri_entity AS {name}_iri, max(v_skos_prefLabel) FILTER (x_prefLabel_lang = 'en') AS preferred_label_en, count(DISTINCT x_prefLabel_lang) AS "prefLabel_languages", r.n AS items_linked
FROM (SELECT k_iri_entity, count(DISTINCT k_iri_cho) AS n FROM ol WHERE x_entity_class = '{cls}' GROUP BY 1 ORDER BY n DESC, 1 LIMIT 50) r LEFT JOIN values_{cls} v ON v.k_iri = r.k_iri_entity GROUP BY r.k_iri_entity, r.n"""


TITLES, MP = "(SELECT * FROM own WHERE p = 'v_dc_title')", "multi_page_items"
QUESTIONS = {
    "overview": {
        "total_items": "SELECT count(*) AS total_items FROM group_items",
        "by_type": simple("group_items", "v_edm_type", "type", "count"),
        "by_reuse_level": simple("group_items", "x_reuse_level", "reuse_level", "count"),
        "by_rights_family": simple("group_items", "x_rights_family", "rights_family", "count"),
        "top_countries": simple("group_items", "v_edm_country", "country", "count", known=True, limit=25),
        "top_institutions": simple("group_items", "v_edm_dataProvider", "institution", "count", known=True, limit=25, share_as=None, org=True),
        "top_aggregators": simple("group_items", "v_edm_provider", "aggregator", "count", known=True, limit=25, share_as=None, org=True),
        "top_languages": simple("group_items", "x_primary_language", "language", "count", known=True, limit=25),
        "content_coverage": "SELECT count(*) AS total, " + ", ".join(f"{share(f'x_has_{n}')} AS pct_{n}" for n in ("content_url", "iiif", "description", "creator", "subject")) + " FROM group_items",
        "web_resource_stats": "SELECT CAST(sum(pages) AS BIGINT) AS total_web_resources, count(*) AS items_with_web_resources, round(avg(pages), 2) AS avg_wr_per_item, quantile_cont(pages, 0.5) AS median_wr_per_item, quantile_cont(pages, 0.9) AS p90_wr_per_item, max(pages) AS max_wr_per_item, (SELECT count(*) FROM group_items) AS total_items FROM pg",
        "multi_page_items": hist("pg", steps("pages", NPAGES), "web_resources_per_item", "items"),
        "mime_family_breakdown": hist("values_edm_WebResource", "CASE WHEN v_ebucore_hasMimeType IS NULL THEN 'unknown' WHEN NOT contains(v_ebucore_hasMimeType, '/') THEN 'malformed' ELSE regexp_extract(v_ebucore_hasMimeType, '^[^/]*') END", "mime_family", "resources"),
        "top_mime_types": simple("values_edm_WebResource", "v_ebucore_hasMimeType", "mime_type", "resources", known=True, limit=25),
        "image_resolution_buckets": hist("(SELECT * FROM values_edm_WebResource WHERE v_ebucore_hasMimeType LIKE 'image/%')", PIXELS, "resolution_bucket", "resources"),
        "file_size_buckets": hist("(SELECT * FROM values_edm_WebResource WHERE v_ebucore_fileByteSize IS NOT NULL)", SIZES, "size_bucket", "resources"),
    },
    "external_links": {
        "link_validity_breakdown": rf"""SELECT CASE WHEN x_well_formed THEN CASE WHEN x_metis_known THEN 'well-formed + known' ELSE 'well-formed + outside' END WHEN coalesce(v_owl_sameAs, '') = '' THEN 'malformed: empty' WHEN regexp_matches(v_owl_sameAs, '\s') THEN 'malformed: whitespace' WHEN regexp_matches(v_owl_sameAs, '\$[0-9]') THEN 'malformed: template_artefact'
WHEN starts_with(v_owl_sameAs, 'file://') THEN 'malformed: non_lod_scheme (file://)' WHEN NOT regexp_matches(v_owl_sameAs, '^https?://') THEN 'malformed: non_lod_scheme (other)' ELSE 'malformed: bad_authority' END AS bucket, count(*) AS sameas_links, count(DISTINCT v_owl_sameAs) AS distinct_iris, {ALL} AS pct_of_links FROM "map_sameAs" GROUP BY 1""",
        "links_by_authority": "SELECT x_authority AS authority, count(DISTINCT v_owl_sameAs) AS distinct_external_iris, count(*) AS sameas_links FROM sa GROUP BY 1",
        "entities_linked_by_authority": f"SELECT x_entity_class AS entity_class, x_authority AS authority, count(DISTINCT k_iri) AS linked_entities, any_value(n) AS total_entities, {pct('count(DISTINCT k_iri)', 'any_value(n)')} AS pct_of_class FROM sa JOIN ({_all('SELECT {c!r} AS c, count(DISTINCT k_iri) AS n FROM values_{c}')}) ON c = x_entity_class GROUP BY 1, 2",
        "top_outside_hosts": "SELECT regexp_extract(v_owl_sameAs, 'https?://([^/]+)', 1) AS host, count(*) AS sameas_links, count(DISTINCT v_owl_sameAs) AS distinct_iris, count(DISTINCT k_iri) AS linked_entities FROM \"map_sameAs\" WHERE x_well_formed AND NOT x_metis_known GROUP BY 1 HAVING count(*) >= 50000 ORDER BY sameas_links DESC, host LIMIT 25",
        "item_coverage_by_authority": f"SELECT x_authority AS authority, count(DISTINCT k_iri_cho) AS chos_linked, {pct('count(DISTINCT k_iri_cho)', '(SELECT count(*) FROM group_items)')} AS pct_of_chos FROM map_cho_entities m JOIN sa ON sa.k_iri = m.k_iri_entity GROUP BY 1",
        "dereferencing_coverage": f"SELECT authority, count(*) AS distinct_refs, count_if(here) AS dereferenced, {share('here')} AS pct_dereferenced FROM (SELECT DISTINCT x_authority AS authority, v_owl_sameAs AS i, v_owl_sameAs IN ({_all('SELECT k_iri FROM values_{c}')}) AS here FROM sa) GROUP BY 1",
        "multi_authority_overlap": hist("(SELECT count(DISTINCT x_authority) AS n FROM sa GROUP BY k_iri)", "n", "n_authorities", "entities"),
    },
    "enrichment": {
        "overall_coverage": "SELECT t AS total_open_items, count(DISTINCT k_iri_cho) AS with_any_entity, "
        + pct("count(DISTINCT k_iri_cho)", "t")
        + " AS pct_with_any, "
        + ", ".join(f"count(DISTINCT k_iri_cho) FILTER (x_entity_class = '{c}') AS with_{n}, {pct(f'count(DISTINCT k_iri_cho) FILTER (x_entity_class = {c!r})', 't')} AS pct_{n}" for n, c in (("concept", "skos_Concept"), ("place", "edm_Place"), ("agent", "edm_Agent"), ("timespan", "edm_TimeSpan")))
        + " FROM ol, (SELECT count(*) AS t FROM oi) GROUP BY t",
        "class_property_matrix": f"SELECT x_entity_class AS entity_class, x_property AS property, count(DISTINCT k_iri_cho) AS items_linked, {pct('count(DISTINCT k_iri_cho)', '(SELECT count(*) FROM oi)')} AS pct_of_open FROM ol GROUP BY 1, 2",
        "multi_class_items": f"SELECT coalesce(n, 0) AS distinct_entity_classes, count(*) AS items, {ALL} AS pct_of_open FROM oi LEFT JOIN (SELECT k_iri_cho, count(DISTINCT x_entity_class) AS n FROM ol GROUP BY 1) ON k_iri_cho = k_iri GROUP BY 1",
        "entity_density": hist("(SELECT count(*) AS n FROM ol GROUP BY k_iri_cho)", steps("n", [(2, "1"), (4, "2-3"), (6, "4-5"), (11, "6-10"), (21, "11-20"), (None, "20+")]), "links_per_item", "items"),
        "multilingual_depth_by_class": "SELECT x_entity_class AS entity_class, count(*) AS items_linked, " + ", ".join(f"count_if(m >= {n}) AS with_{n}plus_langs, {share(f'm >= {n}')} AS pct_{n}plus_langs" for n in (5, 10, 20)) + " FROM (SELECT k_iri_cho, x_entity_class, max(coalesce(d, 0)) AS m FROM ol LEFT JOIN dep USING (x_entity_class, k_iri_entity) GROUP BY 1, 2) GROUP BY 1",
        **{f"top_{n}s": top_entities(c, n) for c, n in (("skos_Concept", "concept"), ("edm_Place", "place"), ("edm_Agent", "agent"))},
        "by_edm_type": f"SELECT v_edm_type AS type, count(*) AS open_items, count_if(x) AS enriched_items, {share('x')} AS pct_enriched FROM (SELECT *, k_iri IN (SELECT k_iri_cho FROM map_cho_entities) AS x FROM oi) GROUP BY 1",
        "by_data_provider": f"SELECT coalesce(name, p) AS data_provider, open_items, enriched_items, pct_enriched FROM (SELECT v_edm_dataProvider AS p, count(*) AS open_items, count_if(x) AS enriched_items, {share('x')} AS pct_enriched FROM (SELECT *, k_iri IN (SELECT k_iri_cho FROM map_cho_entities) AS x FROM oi) WHERE p IS NOT NULL GROUP BY 1 HAVING count(*) >= 10000) LEFT JOIN orgs ON k_iri = p ORDER BY pct_enriched DESC, open_items DESC, data_provider LIMIT 25",
    },
    "open_images": {
        "tier_funnel": "SELECT count(*) AS total_open_images, count_if(s) AS with_any_subject, count_if(c) AS with_long_caption, count_if(c AND s) AS caption_plus_any_subject, count_if(e) AS with_enriched_subject, count_if(c AND e) AS caption_plus_enriched, count_if(c AND s AND e) AS premium_triple_all_three FROM imf",
        "by_rights_family": f"SELECT x_rights_family AS rights_family, x_reuse_level AS reuse_level, count(*) AS image_items, {ALL} AS pct FROM group_items WHERE v_edm_type = 'IMAGE' AND x_has_content_url GROUP BY 1, 2",
        "title_language_coverage": f"SELECT count(*) AS total_open_images, count_if(t = 0) AS no_title_at_all, count_if(t > 0 AND n = 0) AS titles_but_no_lang_tag, count_if(n = 1) AS exactly_1_language, count_if(n = 2) AS exactly_2_languages, count_if(n >= 3) AS three_plus_languages, {share('n >= 2')} AS pct_multilingual FROM (SELECT k_iri, count(v) AS t, count(DISTINCT nullif(l, '')) AS n FROM im LEFT JOIN {TITLES} ON k = k_iri GROUP BY 1)",
        "top_title_languages": by_language(TITLES, "im", "lang"),
        "description_language_coverage": "SELECT count(*) AS total_open_images, count_if(n = 0 AND m IS NULL) AS no_description, count_if(n = 0 AND m IS NOT NULL) AS desc_but_no_lang_tag, count_if(n >= 1) AS desc_with_lang_tag, count_if(n >= 2) AS desc_in_2plus_langs, count_if(m >= 200) AS has_long_desc_200plus_chars, count_if(m >= 200 AND n >= 1) AS long_desc_with_lang_tag FROM (SELECT k_iri, max(length(v)) AS m, count(DISTINCT nullif(l, '')) AS n FROM im LEFT JOIN (SELECT * FROM own WHERE p = 'v_dc_description') ON k = k_iri GROUP BY 1)",
        "enrichment_layer": f"SELECT count(DISTINCT k_iri) AS open_images_total, count(DISTINCT k) AS images_with_enriched_subject, {pct('count(DISTINCT k)', 'count(DISTINCT k_iri)')} AS pct_enriched, " + ", ".join(f"count(DISTINCT k) FILTER (d >= {n}) AS images_linked_to_{n}plus_lang_concept" for n in (5, 10, 20)) + " FROM im LEFT JOIN cur ON k = k_iri LEFT JOIN (SELECT * FROM dep WHERE x_entity_class = 'skos_Concept') ON k_iri_entity = concept",
        "triple_funnel": "SELECT count(*) AS total_open_images, count_if(c) AS has_long_caption, count_if(e) AS has_enriched_subject, count_if(s) AS has_any_subject, count_if(c AND e) AS caption_plus_enriched, count_if(c AND s) AS caption_plus_any_subject, count_if(c AND e AND s) AS all_three FROM imf",
        "triple_languages": by_language("cap", "(SELECT k_iri FROM imf WHERE c AND e)", "caption_lang"),
        "top_countries": simple("im", "v_edm_country", "country", "open_images", known=True, limit=25),
        "top_data_providers": simple("im", "v_edm_dataProvider", "data_provider", "open_images", known=True, limit=25, share_as=None, org=True),
        "top_mime_types": simple("imr", "v_ebucore_hasMimeType", "mime_type", "resources", known=True, limit=25),
        "image_resolution": hist("(SELECT * FROM imr WHERE v_ebucore_hasMimeType LIKE 'image/%')", PIXELS, "resolution_bucket", "resources"),
    },
    "pdfs": {
        "volume": "SELECT count(*) AS total_pdf_resources, count(DISTINCT k_iri_cho) AS distinct_items, round(avg(v_ebucore_fileByteSize) / 1048576.0, 1) AS avg_size_mb, round(CAST(sum(v_ebucore_fileByteSize) AS DOUBLE) / 1099511627776.0, 1) AS total_size_tb FROM pdfr",
        "by_type": simple("pdfi", "v_edm_type", "type", "items"),
        "by_rights_family": simple("pdfi", "x_rights_family", "rights_family", "items"),
        "by_dc_type": "SELECT v AS dc_type, count(DISTINCT k) AS items FROM own WHERE p = 'v_dc_type' AND NOT is_iri AND v <> '' AND k IN (SELECT k_iri FROM pdfi) GROUP BY 1 ORDER BY items DESC, dc_type LIMIT 25",
        "by_country": simple("pdfi", "v_edm_country", "country", "items", known=True, limit=25),
        "top_data_providers": simple("pdfi", "v_edm_dataProvider", "data_provider", "items", known=True, limit=25, share_as=None, org=True),
        "top_datasets": simple("pdfi", "v_edm_datasetName", "dataset", "items", known=True, limit=25, share_as=None),
        "size_distribution": hist("(SELECT * FROM pdfr WHERE v_ebucore_fileByteSize IS NOT NULL)", SIZES, "size_bucket", "resources"),
        "multi_pdf_items": hist("(SELECT count(*) AS n FROM pdfr GROUP BY k_iri_cho)", steps("n", [(2, "1 (single PDF)"), (6, "2-5"), (11, "6-10"), (51, "11-50"), (None, "50+")]), "pdfs_per_item", "items"),
        "pdf_plus_image": "SELECT count_if(p) AS pdf_items, count_if(i) AS image_items, count_if(p AND i) AS pdf_and_image_items, count_if(p AND NOT i) AS pdf_only_items FROM (SELECT k_iri IN (SELECT k_iri_cho FROM pdfr) AS p, k_iri IN (SELECT k_iri_cho FROM values_edm_WebResource WHERE v_ebucore_hasMimeType LIKE 'image/%') AS i FROM oi)",
        "iiif_and_content_tier": simple("pdfi", "x_content_tier", "content_tier", "items", share_as="pct_of_pdf_items", more=f"count_if(x_has_iiif) AS with_iiif, {share('x_has_iiif')} AS pct_iiif"),
        "top_languages": simple("pdfi", "x_primary_language", "language", "items", known=True, limit=25),
    },
    "iiif_books": {
        "volume": f"SELECT count(*) AS open_multi_page_items, CAST(sum(pages) AS BIGINT) AS open_multi_page_pages, count_if(image) AS iiif_items, {share('image')} AS pct_iiif, CAST(sum(pages) FILTER (image) AS BIGINT) AS iiif_pages, quantile_cont(pages, 0.5) FILTER (image) AS iiif_median_pages, max(pages) FILTER (image) AS iiif_max_pages FROM omp",
        "by_type": f"SELECT v_edm_type AS type, count(*) AS items, {PAGES}, count_if(image) AS iiif_items, CAST(sum(pages) FILTER (image) AS BIGINT) AS iiif_pages, {share('image')} AS pct_iiif FROM omp GROUP BY 1",
        "iiif_top_providers": simple("omp WHERE image", "v_edm_dataProvider", "data_provider", "items", known=True, limit=25, share_as=None, org=True, more=PAGES + ", max(pages) AS max_pages"),
        "iiif_top_datasets": simple("omp WHERE image", "v_edm_datasetName", "dataset", "items", known=True, limit=25, share_as=None, more=PAGES),
        "iiif_by_country": simple("omp WHERE image", "v_edm_country", "country", "iiif_items", known=True, limit=25, share_as=None, more="CAST(sum(pages) AS BIGINT) AS iiif_pages"),
        "title_languages": f"SELECT lang, count(*) AS items, CAST(sum(pages) AS BIGINT) AS pages FROM (SELECT DISTINCT k, {LANG} AS lang FROM {TITLES}) JOIN omp ON k_iri = k GROUP BY 1 ORDER BY items DESC, lang LIMIT 25",
        "presentation_diagnostic": 'SELECT count(*) AS open_multi_page_items, count_if(p) AS "with_presentation_conformsTo", count_if(d) AS with_doap_iiif, count_if(p OR d) AS with_either_signal FROM (SELECT k_iri IN (SELECT k FROM srv WHERE api = \'pres\') AS p, k_iri IN (SELECT k FROM srv WHERE api = \'doap\') AS d FROM omp)',
        "iiif_largest": "SELECT k_iri AS cho, pages, v_edm_type AS type, v_edm_country AS country, coalesce((SELECT name FROM orgs o WHERE o.k_iri = v_edm_dataProvider), v_edm_dataProvider) AS data_provider, v_edm_datasetName AS dataset FROM (SELECT * FROM omp WHERE image ORDER BY pages DESC, k_iri LIMIT 50)",
    },
    "natural_history": {
        "volume": f"SELECT count(*) AS nh_items_open, count_if(x_has_content_url) AS with_content_url, {share('x_has_content_url')} AS pct_content_url, count_if(x_has_iiif) AS with_iiif_service, {share('x_has_iiif')} AS pct_iiif FROM nh",
        "by_modality": simple("nh", "v_edm_type", "modality", "items", more=COVER),
        "by_provider": simple("nh", "name", "data_provider", "items", share_as=None, more=f"{COVER}, {share('x_has_iiif')} AS pct_iiif"),
        "subject_coverage": f"SELECT count(*) AS nh_items, count_if(s) AS with_any_subject, {share('s')} AS pct_any_subject, count_if(e) AS with_enriched_concept, {share('e')} AS pct_enriched_concept FROM (SELECT k_iri IN (SELECT k FROM own WHERE p = 'v_dc_subject') AS s, k_iri IN (SELECT k FROM cur) AS e FROM nh)",
        "top_datasets": "SELECT v_edm_datasetName AS dataset, v_edm_type AS modality, count(*) AS items FROM nh WHERE v_edm_datasetName IS NOT NULL GROUP BY 1, 2 ORDER BY items DESC, dataset, modality NULLS LAST LIMIT 25",
        "audio_subset": simple("nh WHERE v_edm_type = 'SOUND'", "name", "data_provider", "audio_items", share_as=None, more="count_if(x_has_content_url) AS with_content_url"),
        "taxonomic_titles": by_language(TITLES, "nh", "lang"),
        "top_countries": simple("nh", "v_edm_country", "country", "items", known=True, limit=25),
    },
    "multi_page": {
        "overview": f"SELECT count(*) AS items_with_web_resources, count_if(pages > 1) AS multi_page_items, CAST(sum(pages) FILTER (pages > 1) AS BIGINT) AS pages_on_multi_page_items, round(avg(pages) FILTER (pages > 1), 2) AS avg_pages, quantile_cont(pages, 0.5) FILTER (pages > 1) AS median_pages, quantile_cont(pages, 0.95) FILTER (pages > 1) AS p95_pages, max(pages) FILTER (pages > 1) AS max_pages, (SELECT count(*) FROM group_items) AS total_items, {pct('count_if(pages > 1)', '(SELECT count(*) FROM group_items)')} AS pct_of_total FROM pg",
        "page_count_distribution": hist("(SELECT * FROM pg WHERE pages > 1)", steps("pages", [(3, "2"), (6, "3-5"), (11, "6-10"), (51, "11-50"), (101, "51-100"), (501, "101-500"), (None, "500+")]), "pages_per_item", "items"),
        "iiif_compatibility": f"SELECT count(*) AS multi_page_items, count_if(i) AS with_image_api, {share('i')} AS pct_image_api, count_if(p) AS with_presentation_diagnostic, {share('p')} AS pct_presentation_diagnostic, count_if(i AND p) AS with_both, count_if(NOT i) AS without_iiif, {share('NOT i')} AS pct_without_iiif FROM (SELECT image AS i, k_iri IN (SELECT k FROM srv WHERE api = 'pres') AS p FROM mp)",
        "largest_items": "SELECT k_iri AS cho, pages, v_edm_type AS type, v_edm_country AS country, coalesce((SELECT name FROM orgs o WHERE o.k_iri = v_edm_dataProvider), v_edm_dataProvider) AS data_provider, image AS iiif_image_api FROM (SELECT * FROM mp ORDER BY pages DESC, k_iri LIMIT 50)",
        "sequencing": f"SELECT count(*) AS multi_page_items, count_if(n > 0) AS items_with_sequencing, {share('n > 0')} AS pct_sequenced, CAST(sum(n) AS BIGINT) AS total_sequence_links, coalesce(round(avg(nullif(n, 0)), 2), 0) AS avg_seq_links_when_present FROM (SELECT count(*) AS c, count(v_edm_isNextInSequence) AS n FROM values_edm_WebResource GROUP BY k_iri_cho) WHERE c > 1",
        "by_type": simple("mp", "v_edm_type", "type", MP, share_as="pct_of_multi_page", more=IMAGE),
        "by_country": simple("mp", "v_edm_country", "country", MP, known=True, limit=25, share_as=None, more=IMAGE),
        "top_data_providers": simple("mp", "v_edm_dataProvider", "data_provider", MP, known=True, limit=25, share_as=None, org=True, more=IMAGE),
        "top_datasets": simple("mp", "v_edm_datasetName", "dataset", MP, known=True, limit=25, share_as=None, more=IMAGE),
        "by_reuse_level": simple("mp", "x_reuse_level", "reuse_level", MP, share_as="pct_of_multi_page", more=IMAGE),
    },
}
EVERY = SQL | COMPOSED


def with_tables(sql: str) -> str:
    """The SQL after the common table expressions that it needs, each after what it needs."""
    order: list[str] = []

    def need(text: str) -> None:
        for name in EVERY:
            if name not in order and re.search(rf"\b(?:FROM|JOIN)\s+\"?{name}\b", text):
                need(EVERY[name])
                order.append(name)

    need(sql)
    # count_if gives a wider integer than count
    return ("WITH " + ", ".join(f'"{n}" AS ({EVERY[n]})' for n in order) + " " + sql).replace("count_if(", "count(*) FILTER (")
