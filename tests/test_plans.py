"""The composed tables, the report and the explorer on a small graph written as statements."""

import pytest
from pyspark.sql import functions as F

from cairnlake.operators import filters, graph
from cairnlake.plans import compose, registry, report
from cairnlake.plans.catalog import Catalog, read_by_name
from cairnlake.plans.explorer import Explorer
from cairnlake.sources import tables as T
from cairnlake.sources import triples as R

D = "http://data.europeana.eu/"
CC = "http://creativecommons.org/"


def statements():
    out = []

    def add(s, p, o, lang=None, iri=False):
        o = f"<{o}>" if iri else '"%s"%s' % (o, f"@{lang}" if lang else "")
        out.append(f"<{s}> <{T.expand(p)}> {o} .")

    def typed(s, c):
        add(s, "rdf:type", T.expand(c), iri=True)

    for n in range(1, 6):
        item, agg, cur, own, eur = f"{D}item/{n}", f"{D}aggregation/{n}", f"{D}aggregation/curated/{n}", f"{D}proxy/provider/{n}", f"{D}proxy/europeana/{n}"
        typed(item, "edm:ProvidedCHO")
        add(own, "ore:proxyFor", item, iri=True)
        add(eur, "ore:proxyFor", item, iri=True)
        add(eur, "edm:europeanaProxy", "true")
        add(eur, "edm:type", "IMAGE" if n < 4 else "TEXT")
        add(agg, "edm:aggregatedCHO", item, iri=True)
        add(agg, "edm:dataProvider", f"{D}organization/{n % 2}", iri=True)
        add(agg, "edm:provider", f"{D}organization/1609" if n == 1 else f"{D}organization/9", iri=True)
        add(agg, "edm:rights", CC + ("publicdomain/mark/1.0/" if n < 4 else "licenses/by-nc/4.0/"), iri=True)
        add(agg, "edm:isShownBy", f"http://img/{n}", iri=True)
        typed(cur, "edm:EuropeanaAggregation")
        add(cur, "edm:aggregatedCHO", item, iri=True)
        add(cur, "edm:country", "NL" if n < 3 else "FR")
        add(cur, "edm:datasetName", f"9200300_{n}" if n == 2 else f"{n}_set")
        add(cur, "edm:language", "nl")
        add(cur, "dqv:hasQualityAnnotation", f"http://q/{n}", iri=True)
        add(f"http://q/{n}", "oa:hasBody", f"http://t/contentTier{n % 5}", iri=True)
        add(f"http://img/{n}", "ebucore:hasMimeType", "image/jpeg")
        add(f"http://img/{n}", "ebucore:fileByteSize", str(1000 * n))
        add(own, "dc:title", f"title {n}", "en")
        add(own, "dc:title", f"titre {n}", "fr")
        add(own, "dc:description", "long \\\"caption\\\" " * 20 if n < 3 else "short")
        add(eur, "dc:subject", f"{D}concept/{n % 2}", iri=True)
        add(own, "dc:subject", "plain subject")
    add(f"{D}aggregation/1", "edm:hasView", "http://img/1b", iri=True)
    add("http://img/1b", "ebucore:hasMimeType", "application/pdf")
    add("http://img/1", "svcs:has_service", "http://srv/1", iri=True)
    typed("http://srv/1", "svcs:Service")
    add("http://srv/1", "dcterms:conformsTo", "http://iiif.io/api/image/2", iri=True)
    for n in range(2):
        typed(f"{D}concept/{n}", "skos:Concept")
        add(f"{D}concept/{n}", "skos:prefLabel", f"concept {n}", "en" if n else "de")
        add(f"{D}concept/{n}", "owl:sameAs", f"http://www.wikidata.org/entity/Q{n}", iri=True)
        typed(f"{D}organization/{n}", "foaf:Organization")
        add(f"{D}organization/{n}", "skos:prefLabel", f"Naturalis Biodiversity {n}", "en")
    return out


@pytest.fixture(scope="module")
def catalog(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("graph")
    (folder / "a.nt").write_text("\n".join([*statements(), "# comment", "", "not a statement"]))
    triples = R.read_ntriples(spark, str(folder)).cache()
    assert triples.count() == len(statements())
    assert [r["value"] for r in R.invalid_lines(spark, str(folder)).collect()] == ["not a statement"]
    return Catalog(spark, given={n: graph.raw_table(triples, n).cache() for n in registry.RAW})


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_raw_tables(catalog):
    assert catalog("values_edm_ProvidedCHO").count() == 5
    assert catalog("values_ore_Proxy").count() == 10
    assert catalog("values_edm_WebResource").count() == 6
    assert dict(catalog("values_edm_WebResource").dtypes)["v_ebucore_fileByteSize"] == "bigint"
    assert catalog("links_ore_Proxy").where("x_property = 'v_dc_title'").count() == 10
    for name in registry.RAW:
        assert catalog(name).columns == sorted(catalog(name).columns) or name.startswith("links_")


def test_item_cube(catalog):
    g = catalog("group_items")
    assert g.columns == sorted(g.columns) and len(g.columns) == 29
    assert g.count() == g.select("k_iri").distinct().count() == 5
    got = {r["k_iri"][-1]: r for r in g.collect()}
    assert got["1"]["x_has_iiif"] and not got["2"]["x_has_iiif"]
    assert got["1"]["x_has_pdf"] and got["1"]["x_web_resource_count"] == 2 and got["2"]["x_pdf_count"] == 0
    assert got["1"]["x_in_openup"] is True and got["2"]["x_in_openup"] is False
    assert got["2"]["x_is_newspaper"] and not got["3"]["x_is_newspaper"]
    assert got["1"]["x_title_languages"] == 2 and got["4"]["x_content_tier"] == 4
    assert [got[str(n)]["x_reuse_level"] for n in range(1, 6)] == ["open"] * 3 + ["restricted"] * 2
    assert all(r["x_has_subject_enrichment"] and r["x_has_subject"] and not r["x_has_creator"] for r in got.values())


def test_maps(catalog):
    assert rows(catalog("map_sameAs"), "x_authority", "x_well_formed") == [("wikidata", True)] * 2
    edges = catalog("map_cho_entities")
    assert edges.count() == 5 and catalog("map_edm_entities").count() == 5
    assert catalog("map_entity_vocab").where("x_is_metis <> (x_vocabulary is not null)").count() == 0
    assert rows(catalog("explorer_edm_entities").select("x_label").distinct(), "x_label") == [("concept 1",), (f"{D}concept/0",)]
    top = rows(catalog("explorer_facet_top_n"), "x_property", "x_rank", "k_iri_entity", "x_item_count")
    assert top == [("*", 1, f"{D}concept/1", 3), ("*", 2, f"{D}concept/0", 2), ("v_dc_subject", 1, f"{D}concept/1", 3), ("v_dc_subject", 2, f"{D}concept/0", 2)]
    assert rows(catalog("map_rights"), "x_family") == [("cc-by-nc",), ("pdm",)]


def test_every_question(catalog):
    found = report.run(catalog, report.select())
    assert len(found) == 82 and not [r for r in found if "error" in r]
    by = {(r["section"], r["question"]): r["rows"] for r in found}
    assert by["overview", "total_items"] == [[5]]
    assert by["overview", "by_type"] == [["IMAGE", 3, 60.0], ["TEXT", 2, 40.0]]
    assert by["open_images", "tier_funnel"] == [[3, 3, 2, 2, 3, 2, 2]]
    assert by["natural_history", "volume"] == [[3, 3, 100.0, 1, 33.33]]
    assert by["multi_page", "overview"][0][:3] == [5, 1, 2]
    assert by["pdfs", "pdf_plus_image"] == [[1, 3, 1, 0]]
    assert by["enrichment", "overall_coverage"][0][:3] == [3, 3, 100.0]
    text = report.to_markdown(found)
    assert "| IMAGE | 3 | 60 |" in text and "_No results._" in text


def test_filter_restricts_the_cube_only(catalog):
    where = filters.parse("country=NL type=IMAGE", catalog("group_items").schema)
    narrow = catalog.filtered(where)
    assert narrow("group_items").count() == 2 and narrow("values_edm_WebResource").count() == 6


@pytest.mark.parametrize("text", ["nothing=1", "country", "content_tier=x", "has_iiif=maybe", "=3"])
def test_bad_filters(catalog, text):
    with pytest.raises(ValueError):
        filters.parse(text, catalog("group_items").schema)


def test_good_filters(catalog):
    g = catalog("group_items")
    n = lambda text: g.where(filters.parse(text, g.schema)).count()
    assert (n("has_iiif"), n("content_tier>=3"), n("reuse_level!=open"), n("has_pdf=false"), n('country="FR"')) == (1, 2, 2, 4, 3)
    assert filters.parse("", g.schema) is None


def test_explorer(catalog):
    e = Explorer(catalog)
    assert e.schema()["rows"] == 5
    s = e.summary({"v_edm_country": {"kind": "in", "values": ["NL"]}})
    assert s["items"] == 2 and s["groups"] == [{"value": "IMAGE", "items": 2}]
    cold, live = e.top_values("dc:subject"), e.top_values("dc:subject", {"v_edm_type": {"kind": "in", "values": ["IMAGE"]}})
    assert [(v["label"], v["items"]) for v in cold["values"]] == [("concept 1", 3), (f"{D}concept/0", 2)]
    assert [v["items"] for v in live["values"]] == [2, 1] and not live["truncated"]
    assert e.top_values("v_edm_country", limit=1) == {"values": [{"value": "FR", "label": "FR", "items": 3}], "truncated": True}
    both = {"dc:subject": {"kind": "in", "values": [f"{D}concept/0", f"{D}concept/1"]}}
    assert e.filtered(both).count() == 0
    assert e.filtered({"x_content_tier": {"kind": "range", "min": 3}, "unknown": {"kind": "in", "values": [1]}}).count() == 2
    assert len(e.sample({"v_edm_type": {"kind": "in", "values": ["TEXT"]}}, 10)) == 2
    assert e.labels([f"{D}concept/1", f"{D}item/1", f"{D}organization/0", "http://unknown/"]) == {f"{D}concept/1": "concept 1", f"{D}item/1": "title 1", f"{D}organization/0": "Naturalis Biodiversity 0"}


def test_build(spark, catalog, tmp_path):
    out = registry.build(catalog, str(tmp_path), ["map_rights", "explorer_facet_top_n"])
    assert not out.failed and "map_cho_entities" in out.written
    again = registry.build(Catalog(spark, str(tmp_path)), str(tmp_path), ["map_rights"], overwrite=True)
    assert again.written == ["map_rights"] and "values_ore_Aggregation" in again.skipped
    stored = Catalog(spark, str(tmp_path))
    assert stored("explorer_facet_top_n").count() == 4
    plan = stored("links_ore_Proxy").where("x_property = 'v_dc_title'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(x_property" in plan


def test_closure_and_failures(spark, catalog, tmp_path):
    tables = {"a": registry.Table("a", ("b",)), "b": registry.Table("b", ("a",))}
    with pytest.raises(ValueError, match="a -> b -> a"):
        registry.closure(tables, ["a"])

    def bad(_):
        raise RuntimeError("no")

    tables = {"x": registry.Table("x", (), bad), "y": registry.Table("y", ("x",), lambda c: c("x")), "z": registry.Table("z", (), lambda c: c.spark.range(3))}
    out = registry.build(catalog, str(tmp_path), ["y", "z"], tables)
    assert out.written == ["z"] and set(out.failed) == {"x", "y"}


def test_helpers_can_be_dropped(spark, catalog, tmp_path):
    tables = {"h": registry.Table("h", (), lambda c: c.spark.range(3)), "t": registry.Table("t", ("h",), lambda c: c("h").selectExpr("id + 1 as id"))}
    out = registry.build(Catalog(spark), str(tmp_path), ["t"], tables, drop_helpers=True)
    assert out.written == ["h", "t"] and out.dropped == ["h"]
    stored = Catalog(spark, str(tmp_path))
    assert stored._stored("h") is None and rows(stored("t"), "id") == [(1,), (2,), (3,)]


def test_selection():
    assert registry.select(["x", "group_items"], ["group"]) == ["x", "group_items"]
    assert set(registry.select(everything=True)) == {*registry.RAW, *registry.SETS["pipeline"]}


def test_catalog_sql_and_lists(spark, tmp_path):
    catalog = Catalog(spark, given={"map_rights": spark.createDataFrame([("u", "cc-by-nc", False), ("v", "pdm", True)], "k_iri string, x_family string, x_is_open boolean")})
    catalog.register("map_rights")
    found, more = catalog.sql("SELECT x_family FROM map_rights ORDER BY 1", rows=1)
    assert found == [{"x_family": "cc-by-nc"}] and more
    assert catalog.sql("SELECT count(*) AS n FROM map_rights")[0] == [{"n": 2}]
    about = catalog.describe("map_rights", 1)
    assert about["table"] == "map_rights" and ("x_is_open", "boolean") in about["columns"] and len(about["sample"]) == 1
    spark.range(2).write.parquet(str(tmp_path / "mine.parquet"))
    listed = {x["table"]: x for x in Catalog(spark, str(tmp_path)).list_tables()}
    assert listed["mine"] == {"table": "mine", "columns": 1, "stored": True} and not listed["group_items"]["stored"]


def test_read_by_name(spark, tmp_path):
    spark.createDataFrame([(1, "x")], "a bigint, b string").write.parquet(str(tmp_path / "1.parquet"))
    spark.createDataFrame([("y", True)], "b string, c boolean").write.parquet(str(tmp_path / "2.parquet"))
    got = read_by_name(spark, str(tmp_path / "1.parquet"), str(tmp_path / "2.parquet"))
    assert sorted(map(tuple, got.select("a", "b", "c").collect()), key=str) == [(1, "x", None), (None, "y", True)]


def test_provider_location_and_sample(spark):
    proxies = spark.createDataFrame([("p1", "i1", None, "b"), ("p2", "i1", "false", "c"), ("p3", "i1", "true", "z"), ("p4", "i2", None, None)], "k_iri string, k_iri_cho string, v_edm_europeanaProxy string, v_edm_currentLocation string")
    got = compose.provider_location(Catalog(spark, given={"values_ore_Proxy": proxies}))
    assert rows(got, "k_iri_cho", "v_edm_currentLocation") == [("i1", "c"), ("i2", None)]
    items = spark.createDataFrame([("i1",), ("i9",)], "item string")
    assert rows(graph.sampled(proxies, items, "k_iri_cho"), "k_iri") == [("p1",), ("p2",), ("p3",)]


def test_invariants(catalog):
    share = report.SECTIONS["overview"]["by_rights_family"](catalog).agg(F.sum("pct")).first()[0]
    assert abs(share - 100) < 0.1
    edges = catalog("map_cho_entities").select("k_iri_cho", "k_iri_entity", "x_entity_class")
    assert catalog("map_edm_entities").select(edges.columns).subtract(edges).count() == 0
