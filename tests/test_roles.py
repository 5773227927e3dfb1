"""Composed tables, report and explorer on the driver's tables in their roles, against independent SQL."""

import pytest
from helpers import canonical

from cairnlake.plans.report import SECTIONS
from cairnlake.role_queries import oracle_sql, queries
from cairnlake.role_sql import QUESTIONS
from cairnlake.roles import SQL, TABLES, catalog

SOME = [
    "composed_group_items", "composed_map_sameAs", "composed_map_rights", "composed_explorer_facet_top_n", "composed_explorer_places", "composed_orgs", "report_overview_web_resource_stats", "report_external_links_link_validity_breakdown", "report_enrichment_overall_coverage",
    "report_enrichment_top_places", "report_open_images_enrichment_layer", "report_open_images_triple_languages", "report_pdfs_volume", "report_iiif_books_by_type", "report_iiif_books_title_languages", "report_natural_history_by_provider", "report_multi_page_largest_items", "report_multi_page_sequencing",
    "explorer_counts", "explorer_cold_counts", "explorer_filtered", "explorer_labels", "report_filtered", "open_items_view", "sample_items_view", "rights_dimension",
]


def test_every_question_has_sql():
    assert {s: set(q) for s, q in SECTIONS.items()} == {s: set(q) for s, q in QUESTIONS.items()}
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("name", SOME)
def test_role_query(spark, duck, sf_dir, name):
    df = queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    rows = [tuple(r) for r in df.select(*columns).collect()]
    quoted = ", ".join(f'"{c}"' for c in columns)
    assert canonical(rows) == canonical(duck.execute(f"SELECT {quoted} FROM ({oracle_sql()[name]})").fetchall())


def test_raw_tables_agree(spark, duck, sf_dir):
    t = catalog(spark, sf_dir)
    assert set(TABLES) >= {"orders", "lineitem", "part"}
    for name in ("values_ore_Aggregation", "links_ore_Proxy", "values_edm_WebResource"):
        df = t(name)
        assert canonical(map(tuple, df.collect())) == canonical(duck.execute(f"SELECT {', '.join(df.columns)} FROM ({SQL[name]})").fetchall())


def test_one_row_per_item(spark, sf_dir):
    t = catalog(spark, sf_dir)
    g = t("group_items")
    assert g.count() == g.select("k_iri").distinct().count() == t("values_edm_ProvidedCHO").count()
