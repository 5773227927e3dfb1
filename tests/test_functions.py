from pyspark.sql import functions as F

from cairnlake.functions import items, rights, vocab


def one(spark, values, *columns, schema="v string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [tuple(r) for r in df.select(*columns).collect()]


def test_rights(spark):
    cases = {
        "http://creativecommons.org/publicdomain/mark/1.0/": ("open", "pdm", True),
        "http://creativecommons.org/publicdomain/zero/1.0/": ("open", "cc0", True),
        "http://creativecommons.org/licenses/by-sa/3.0/au/": ("open", "cc-by-sa", True),
        "http://creativecommons.org/licenses/by-nd-nc/1.0/": ("restricted", "cc-by-nc-nd", False),
        "http://creativecommons.org/licenses/by-other/1.0/": ("restricted", "unknown", False),
        "http://rightsstatements.org/vocab/InC-EDU/1.0/": ("restricted", "rs-inc", False),
        "http://rightsstatements.org/vocab/InC-EDU/2.0/": ("prohibited", "rs-other", False),
        "http://rightsstatements.org/vocab/CNE/1.0/": ("prohibited", "cnb", False),
        "http://rightsstatements.org/vocab/XYZ/1.0/": ("prohibited", "rs-other", False),
        None: ("prohibited", "unknown", False),
        "": ("prohibited", "unknown", False),
    }
    v = F.col("v")
    assert one(spark, cases, rights.reuse_level(v), rights.rights_family(v), rights.is_open(v)) == list(cases.values())


def test_rights_labels_and_identifiers(spark):
    v = F.col("v")
    uris = ["http://creativecommons.org/licenses/by-sa/3.0/au/", "http://creativecommons.org/publicdomain/zero/1.0/", "http://rightsstatements.org/vocab/InC/1.0/", "http://rightsstatements.org/vocab/XYZ/1.0/", None]
    assert one(spark, uris, rights.rights_label(v), rights.rights_identifier(v)) == [
        ("Attribution-ShareAlike (CC BY-SA)", "CC-BY-SA-3.0-AU"),
        ("Public Domain Dedication (CC0)", "CC-PD-ZERO-1.0"),
        ("In Copyright (RightsStatements.org)", "InC-1.0"),
        ("Unknown", "XYZ-1.0"),
        ("Unknown", "Other"),
    ]


def test_registry_agrees_with_itself(spark):
    reg = rights.rights_registry(spark, {"1.0": [None, "nl"], "4.0": [None]})
    assert reg.count() == reg.select("uri").distinct().count() == 18 + 2 + 6
    assert reg.where("is_open <> (reuse_level = 'open')").count() == 0
    assert reg.where("family = 'unknown'").count() == 0


def test_iris(spark):
    v = F.col("v")
    cases = {"http://a.b/c": True, "http://a.b": False, "http://a b/c": False, "http://x/$1": False, "file://x/": False, "": False, None: False}
    assert [r[0] for r in one(spark, cases, vocab.is_well_formed(v))] == list(cases.values())
    names = {"https://www.wikidata.org/entity/Q1": "wikidata", "http://d-nb.info/gnd/1": "gnd", "http://d-nb.info/gndXYZ": "gnd", "http://data.europeana.eu/concept/1": None, "http://data.europeana.eu/concept/loc9": "europeana_ww1", "http://other/x": None, None: None, "ftp://viaf.org/viaf/1": None}
    assert [r[0] for r in one(spark, names, vocab.vocabulary(v))] == list(names.values())


def test_vocabulary_equals_linear_search(spark):
    iris = [f"{s}://{a}{t}" for name, found in vocab.VOCABULARIES.items() for a in found for s in ("http", "https") for t in ("", "/1", "x")]
    got = [r[0] for r in one(spark, iris, vocab.vocabulary(F.col("v")))]
    flat = [(a, n) for n, found in vocab.VOCABULARIES.items() for a in found]
    assert got == [next(n for a, n in flat if i.split("://")[1].startswith(a)) for i in iris]


def test_tiers_and_newspapers(spark):
    v = F.col("v")
    assert one(spark, ["x/contentTier4", "x/contentTierX", "x/metadataTierB", None], items.content_tier(v), items.metadata_tier(v)) == [(4, None), (None, None), (None, "B"), (None, None)]
    no = F.lit(None).cast("boolean")
    assert [r[0] for r in one(spark, ["a_Newspaper", "9200300_x", "other", None], items.is_newspaper(v, no, no))] == [True, True, False, False]
    assert one(spark, ["other"], items.is_newspaper(v, F.lit(True), no)) == [(True,)]
    assert [r[0] for r in one(spark, [None, items.OPENUP_PROVIDERS[0], "x"], items.in_openup(v))] == [None, True, False]


def test_proxies(spark):
    assert [r[0] for r in one(spark, ["true", None, "false"], items.proxy_type(F.col("v")))] == ["europeana", "provider", "provider"]


def test_labels(spark):
    rows = [("a", "en1", "en"), ("a", "plain", None), ("b", "plain", ""), ("b", "fr", "fr"), ("c", "fr", "fr"), ("c", "de", "de"), ("d", None, "en"), ("d", "x", "xx"), (None, "y", "en")]
    df = spark.createDataFrame(rows, "k string, label string, lang string")
    assert {r[0]: r[1] for r in items.preferred_labels(df, "k", "label", "lang").collect()} == {"a": "en1", "b": "plain", "c": "de", "d": "x"}
    assert {r[0]: r[1] for r in items.main_or_greatest_label(df.where("k is not null"), "k", "label", "lang").collect()} == {"a": "en1", "b": "plain", "c": "fr", "d": "x"}
