"""Queries on the driver's tables, one for each operator, with the SQL that gives the same rows.

Roles: an order is an object, a line item its web resource, a part an entity with the part type as
its class and the return flag as the linking property, a customer or supplier an organisation, a
document a language-tagged text, a page's URL an IRI, an event a property value or an aggregation.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions import items, rights, vocab
from .operators import aggregates as A
from .operators import filters, graph, paths, sampling
from .operators.textsearch import TextIndex
from .plans import sketches
from .plans.compose import first_by
from .sources.archives import read_dump
from .sources.rolled import write_turtle
from .sources.scratch import fresh_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def put(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return put


def read(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


PCT = "round(100.0 * {0} / nullif(CAST({1} AS DOUBLE), 0), 2)"
SHARE = PCT.format("count(*)", "sum(count(*)) OVER ()")


# Counting and shares


@query("SELECT count(*) AS total_items FROM orders")
def total_items(s: SparkSession, d: str) -> DataFrame:
    return read(s, d, "orders").agg(F.count("*").alias("total_items"))


@query(f"SELECT o_orderstatus AS type, count(*) AS count, {SHARE} AS pct FROM orders GROUP BY 1")
def share_by_category(s: SparkSession, d: str) -> DataFrame:
    return A.ranking(read(s, d, "orders"), {"type": F.col("o_orderstatus")}, "count")


@query(f"SELECT o_orderstatus AS status, o_orderpriority AS priority, count(*) AS items, {SHARE} AS pct FROM orders GROUP BY 1, 2")
def share_two_keys(s: SparkSession, d: str) -> DataFrame:
    return A.ranking(read(s, d, "orders"), {"status": F.col("o_orderstatus"), "priority": F.col("o_orderpriority")}, "items")


def _orders_by_nation(s: SparkSession, d: str) -> DataFrame:
    c, n = read(s, d, "customer"), read(s, d, "nation")
    named = c.join(n, c["c_nationkey"] == n["n_nationkey"]).select(F.col("c_custkey").alias("o_custkey"), F.col("n_name").alias("country"))
    return read(s, d, "orders").join(named, "o_custkey")


@query(f"""SELECT n_name AS country, count(*) AS items, {SHARE} AS pct FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
WHERE o_orderstatus = 'O' GROUP BY 1 ORDER BY items DESC, country LIMIT 10""")
def top_k_filtered_share(s: SparkSession, d: str) -> DataFrame:
    return A.ranking(_orders_by_nation(s, d).where("o_orderstatus = 'O'"), {"country": F.col("country")}, "items", limit=10)


@query("""SELECT coalesce(c_name, CAST(o_custkey AS VARCHAR)) AS institution, count(*) AS count FROM orders
LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING') c ON o_custkey = c_custkey GROUP BY 1 ORDER BY count DESC, institution LIMIT 25""")
def org_leaderboard(s: SparkSession, d: str) -> DataFrame:
    named = read(s, d, "customer").where("c_mktsegment <> 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    joined = read(s, d, "orders").select("o_custkey").join(named, "o_custkey", "left")
    return A.ranking(joined, {"institution": F.coalesce("c_name", F.col("o_custkey").cast("string"))}, "count", None, 25)


@query(f"""WITH r AS (SELECT l_orderkey, bool_or(l_returnflag = 'R') AS returned, bool_or(l_discount > 0.05) AS discounted FROM lineitem GROUP BY 1)
SELECT count(*) AS total, {PCT.format("count(*) FILTER (WHERE l_orderkey IS NOT NULL)", "count(*)")} AS pct_resources, {PCT.format("count(*) FILTER (WHERE returned)", "count(*)")} AS pct_returned,
{PCT.format("count(*) FILTER (WHERE discounted)", "count(*)")} AS pct_discounted FROM orders LEFT JOIN r ON o_orderkey = l_orderkey""")
def coverage_flags(s: SparkSession, d: str) -> DataFrame:
    li = read(s, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.bool_or(F.col("l_returnflag") == "R").alias("returned"), F.bool_or(F.col("l_discount") > 0.05).alias("discounted"), F.lit(True).alias("any"))
    j = read(s, d, "orders").select("o_orderkey").join(li, "o_orderkey", "left")
    share = lambda c: A.percent(F.count_if(c), F.count("*"))
    return j.agg(F.count("*").alias("total"), share("any").alias("pct_resources"), share("returned").alias("pct_returned"), share("discounted").alias("pct_discounted"))


@query("""WITH p AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1)
SELECT CAST(sum(n) AS BIGINT) AS resources, (SELECT count(*) FROM orders) AS total_items, count(*) AS items_with_resources, round(avg(n), 2) AS avg_n, quantile_cont(n, 0.5) AS median_n, quantile_cont(n, 0.9) AS p90_n, max(n) AS max_n FROM p""")
def per_object_density(s: SparkSession, d: str) -> DataFrame:
    p = read(s, d, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"))
    out = p.agg(F.sum("n").alias("resources"), F.count("*").alias("items_with_resources"), F.round(F.avg("n"), 2).alias("avg_n"), F.percentile("n", 0.5).alias("median_n"), F.percentile("n", 0.9).alias("p90_n"), F.max("n").alias("max_n"))
    return out.withColumn("total_items", read(s, d, "orders").agg(F.count("*")).scalar())


@query(f"""WITH p AS (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey)
SELECT CASE WHEN n = 1 THEN '1 (single)' WHEN n <= 3 THEN '2-3' WHEN n <= 5 THEN '4-5' ELSE '6+' END AS per_item, count(*) AS items, {SHARE} AS pct FROM p GROUP BY 1""")
def count_histogram(s: SparkSession, d: str) -> DataFrame:
    p = read(s, d, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"))
    return A.histogram(p, *items.bucket(F.col("n"), [(2, "1 (single)"), (4, "2-3"), (6, "4-5"), (None, "6+")]), "per_item", "items")


@query(f"""SELECT CASE WHEN l_extendedprice < 10240 THEN '< 10 KB' WHEN l_extendedprice < 20480 THEN '10-20 KB' WHEN l_extendedprice < 40960 THEN '20-40 KB' ELSE '>= 40 KB' END AS size_bucket,
count(*) AS resources, {SHARE} AS pct FROM lineitem WHERE l_extendedprice IS NOT NULL GROUP BY 1""")
def size_histogram(s: SparkSession, d: str) -> DataFrame:
    sized = read(s, d, "lineitem").where("l_extendedprice is not null")
    return A.histogram(sized, *items.bucket(F.col("l_extendedprice"), [(10240, "< 10 KB"), (20480, "10-20 KB"), (40960, "20-40 KB"), (None, ">= 40 KB")]), "size_bucket", "resources")


@query(f"""SELECT CASE WHEN u IS NULL THEN 'unknown' WHEN position('/' IN u) = 0 THEN 'malformed' ELSE split_part(u, '/', 1) END AS family, count(*) AS resources, {SHARE} AS pct
FROM (SELECT CASE WHEN page_id % 7 = 0 THEN NULL WHEN page_id % 11 = 0 THEN 'plain' ELSE url END AS u FROM pages) GROUP BY 1""")
def family_split(s: SparkSession, d: str) -> DataFrame:
    u = F.when(F.col("page_id") % 7 == 0, F.lit(None)).when(F.col("page_id") % 11 == 0, "plain").otherwise(F.col("url"))
    return A.ranking(read(s, d, "pages"), {"family": items.mime_family(u)}, "resources")


@query("SELECT o_orderpriority AS priority, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) >= 100")
def having_threshold(s: SparkSession, d: str) -> DataFrame:
    return read(s, d, "orders").groupBy(F.col("o_orderpriority").alias("priority")).agg(F.count("*").alias("n")).where("n >= 100")


@query("""SELECT o_orderstatus AS status, round(quantile_cont(o_totalprice, 0.5), 2) AS median_all, round(quantile_cont(o_totalprice, 0.95) FILTER (WHERE o_orderpriority = '1-URGENT'), 0) AS p95_urgent,
max(o_totalprice) FILTER (WHERE o_orderpriority = '1-URGENT') AS max_urgent, count(DISTINCT o_custkey) FILTER (WHERE o_orderpriority = '1-URGENT') AS urgent_customers FROM orders GROUP BY 1""")
def percentile_filtered(s: SparkSession, d: str) -> DataFrame:
    urgent = F.col("o_orderpriority") == "1-URGENT"
    price = F.when(urgent, F.col("o_totalprice"))
    return read(s, d, "orders").groupBy(F.col("o_orderstatus").alias("status")).agg(F.round(F.percentile("o_totalprice", 0.5), 2).alias("median_all"), F.round(F.percentile(price, 0.95), 0).alias("p95_urgent"), F.max(price).alias("max_urgent"), A.count_distinct_if(urgent, F.col("o_custkey")).alias("urgent_customers"))


# IRIs and rights

URLS = """(SELECT page_id, CASE page_id % 9 WHEN 0 THEN replace(url, 'http://', 'file://') WHEN 1 THEN url || ' x' WHEN 2 THEN '' WHEN 3 THEN regexp_extract(url, '^https?://[^/]+') WHEN 4 THEN 'http://x.example/$1' WHEN 5 THEN 'http://ex_ample.com/a' WHEN 6 THEN NULL ELSE url END AS u FROM pages)"""


def _faulty_urls(s: SparkSession, d: str) -> DataFrame:
    url, k = F.col("url"), F.col("page_id") % 9
    u = F.when(k == 0, F.replace(url, F.lit("http://"), F.lit("file://"))).when(k == 1, F.concat(url, F.lit(" x"))).when(k == 2, "").when(k == 3, F.regexp_extract(url, "^https?://[^/]+", 0))
    u = u.when(k == 4, "http://x.example/$1").when(k == 5, "http://ex_ample.com/a").when(k == 6, F.lit(None)).otherwise(url)
    return read(s, d, "pages").select("page_id", u.alias("u"))


@query(f"""WITH c AS (SELECT u, u IS NOT NULL AND regexp_matches(u, '^https?://[A-Za-z0-9.-]+/') AND NOT regexp_matches(u, '\\s') AND NOT regexp_matches(u, '\\$[0-9]') AS ok, coalesce(regexp_matches(u, '^https?://[^/]*\\.com/en'), false) AS known FROM {URLS})
SELECT CASE WHEN ok AND known THEN 'well-formed + known' WHEN ok THEN 'well-formed + outside' WHEN u IS NULL OR u = '' THEN 'malformed: empty' WHEN regexp_matches(u, '\\s') THEN 'malformed: whitespace'
WHEN regexp_matches(u, '\\$[0-9]') THEN 'malformed: template_artefact' WHEN u LIKE 'file://%' THEN 'malformed: non_lod_scheme (file://)' WHEN NOT regexp_matches(u, '^https?://') THEN 'malformed: non_lod_scheme (other)' ELSE 'malformed: bad_authority' END AS bucket,
count(*) AS links, count(DISTINCT u) AS distinct_iris, {SHARE} AS pct FROM c GROUP BY 1""")
def link_validity_breakdown(s: SparkSession, d: str) -> DataFrame:
    known = F.coalesce(F.col("u").rlike(r"^https?://[^/]*\.com/en"), F.lit(False))
    out = _faulty_urls(s, d).groupBy(vocab.link_fault(F.col("u"), known).alias("bucket")).agg(F.count("*").alias("links"), F.count_distinct("u").alias("distinct_iris"))
    return A.with_share(out, "links")


@query("""SELECT regexp_extract(url, 'https?://([^/]+)', 1) AS host, count(*) AS links, count(DISTINCT url) AS distinct_iris FROM pages GROUP BY 1 HAVING count(*) >= 2 ORDER BY links DESC, host LIMIT 25""")
def url_hosts(s: SparkSession, d: str) -> DataFrame:
    out = read(s, d, "pages").groupBy(vocab.host_of(F.col("url")).alias("host")).agg(F.count("*").alias("links"), F.count_distinct("url").alias("distinct_iris"))
    return A.top(out.where("links >= 2"), "links", ["host"], 25)


PAGE_VOCABULARIES = {"english": ("ththre.example.com/en", "thre.example.com/en"), "french": ("ththre.example.com/fr",)}
IRIS = (
    "http://vocab.getty.edu/aat/300",
    "https://vocab.getty.edu/tgn/7",
    "http://vocab.getty.edu/ulanX",
    "https://d-nb.info/gnd/4",
    "http://www.wikidata.org/entity/Q1",
    "http://data.europeana.eu/concept/18",
    "http://data.europeana.eu/concept/loc/5",
    "http://semantics.gr/authorities/ekt-unesco/9",
    "http://nowhere.example/1",
    "ftp://viaf.org/viaf/1",
)
IRI_CASE = "CASE CAST(o_orderkey % 11 AS INTEGER) " + " ".join(f"WHEN {i} THEN '{x}'" for i, x in enumerate(IRIS)) + " END"
FLAT = [(n, a) for n, found in vocab.VOCABULARIES.items() for a in found]


def _case(key: Column, values: tuple[str, ...]) -> Column:
    return F.get(F.array(*[F.lit(x) for x in values]), key.cast("int"))


@query(f"""WITH o AS (SELECT {IRI_CASE} AS iri FROM orders), c AS (SELECT iri, CASE {" ".join(f"WHEN starts_with(regexp_replace(iri, '^https?://', ''), '{a}') AND regexp_matches(iri, '^https?://') THEN '{n}'" for n, a in FLAT)} END AS vocabulary FROM o)
SELECT vocabulary, count(*) AS links, count(DISTINCT iri) AS iris FROM c GROUP BY 1""")
def vocabulary_classify(s: SparkSession, d: str) -> DataFrame:
    iri = _case(F.col("o_orderkey") % 11, IRIS)
    return read(s, d, "orders").select(iri.alias("iri")).groupBy(vocab.vocabulary(F.col("iri")).alias("vocabulary")).agg(F.count("*").alias("links"), F.count_distinct("iri").alias("iris"))


RIGHTS = (
    "http://creativecommons.org/publicdomain/mark/1.0/",
    "http://creativecommons.org/publicdomain/zero/1.0/",
    "http://creativecommons.org/licenses/by/4.0/",
    "http://creativecommons.org/licenses/by-sa/3.0/au/",
    "http://creativecommons.org/licenses/by-nd-nc/1.0/",
    "http://creativecommons.org/licenses/by-nc/2.0/",
    "http://rightsstatements.org/vocab/InC/1.0/",
    "http://rightsstatements.org/vocab/InC-EDU/1.0/",
    "http://rightsstatements.org/vocab/NoC-NC/1.0/",
    "http://rightsstatements.org/vocab/CNE/1.0/",
    "http://rightsstatements.org/vocab/XYZ/1.0/",
    "http://rights.example/own",
)
RIGHTS_SQL = "(SELECT CASE CAST(o_orderkey % 13 AS INTEGER) " + " ".join(f"WHEN {i} THEN '{x}'" for i, x in enumerate(RIGHTS)) + " END AS u FROM orders)"
LICENCES = ("by-nc-nd", "by-nd-nc", "by-nc-sa", "by-nc", "by-nd", "by-sa", "by")


def _rights(s: SparkSession, d: str) -> DataFrame:
    return read(s, d, "orders").select(_case(F.col("o_orderkey") % 13, RIGHTS).alias("u"))


def _counted(df: DataFrame, name: str, c: Column) -> DataFrame:
    return df.groupBy("u", c.alias(name)).agg(F.count("*").alias("n"))


def _rights_case(tool: dict[str, str], licence: dict[str, str], statement: dict[str, str], any_statement: str | None, other: str) -> str:
    cases = [f"WHEN starts_with(u, 'http://creativecommons.org/publicdomain/{k}/') THEN '{v}'" for k, v in tool.items()]
    cases += [f"WHEN starts_with(u, 'http://creativecommons.org/licenses/{k}/') THEN '{v}'" for k, v in licence.items()]
    cases += [f"WHEN u = 'http://rightsstatements.org/vocab/{k}/1.0/' THEN '{v}'" for k, v in statement.items()]
    cases += [f"WHEN starts_with(u, 'http://rightsstatements.org/vocab/') THEN '{any_statement}'"] if any_statement else []
    return f"CASE {' '.join(cases)} ELSE '{other}' END"


@query(f"""SELECT u, CASE WHEN starts_with(u, 'http://creativecommons.org/publicdomain/') OR starts_with(u, 'http://creativecommons.org/licenses/by/') OR starts_with(u, 'http://creativecommons.org/licenses/by-sa/') THEN 'open'
WHEN starts_with(u, 'http://creativecommons.org/licenses/') OR u IN ('http://rightsstatements.org/vocab/NoC-NC/1.0/', 'http://rightsstatements.org/vocab/NoC-OKLR/1.0/', 'http://rightsstatements.org/vocab/InC-EDU/1.0/') THEN 'restricted' ELSE 'prohibited' END AS level, count(*) AS n FROM {RIGHTS_SQL} GROUP BY 1, 2""")
def rights_reuse_level(s: SparkSession, d: str) -> DataFrame:
    return _counted(_rights(s, d), "level", rights.reuse_level(F.col("u")))


@query(f"SELECT u, {_rights_case(rights.TOOL_FAMILY, rights.LICENSE_FAMILY, rights.STATEMENT_FAMILY, 'rs-other', 'unknown')} AS family, count(*) AS n FROM {RIGHTS_SQL} GROUP BY 1, 2")
def rights_family(s: SparkSession, d: str) -> DataFrame:
    return _counted(_rights(s, d), "family", rights.rights_family(F.col("u")))


@query(f"SELECT u, {_rights_case(*[{k: rights.FAMILY_LABEL[v] for k, v in t.items()} for t in (rights.TOOL_FAMILY, rights.LICENSE_FAMILY, rights.STATEMENT_FAMILY)], None, 'Unknown')} AS label, count(*) AS n FROM {RIGHTS_SQL} GROUP BY 1, 2")
def rights_label(s: SparkSession, d: str) -> DataFrame:
    return _counted(_rights(s, d), "label", rights.rights_label(F.col("u")))


@query(f"SELECT u, coalesce(starts_with(u, 'http://creativecommons.org/publicdomain/') OR starts_with(u, 'http://creativecommons.org/licenses/by/') OR starts_with(u, 'http://creativecommons.org/licenses/by-sa/'), false) AS is_open, count(*) AS n FROM {RIGHTS_SQL} GROUP BY 1, 2")
def rights_is_open(s: SparkSession, d: str) -> DataFrame:
    return _counted(_rights(s, d), "is_open", rights.is_open(F.col("u")))


@query("""WITH t AS (SELECT 'http://x/' || CASE CAST(o_orderkey % 5 AS INTEGER) WHEN 0 THEN 'contentTierX' WHEN 1 THEN 'metadataTierB' ELSE 'contentTier' || CAST(o_orderkey % 5 AS VARCHAR) END AS u FROM orders)
SELECT u, TRY_CAST(nullif(regexp_extract(u, 'contentTier([0-9])$', 1), '') AS INTEGER) AS content_tier, nullif(regexp_extract(u, 'metadataTier([0A-C])$', 1), '') AS metadata_tier, count(*) AS n FROM t GROUP BY 1, 2, 3""")
def tier_extract(s: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey") % 5
    u = F.concat(F.lit("http://x/"), F.when(k == 0, "contentTierX").when(k == 1, "metadataTierB").otherwise(F.concat(F.lit("contentTier"), k.cast("string"))))
    t = read(s, d, "orders").select(u.alias("u"))
    return t.groupBy("u", items.content_tier(F.col("u")).alias("content_tier"), items.metadata_tier(F.col("u")).alias("metadata_tier")).agg(F.count("*").alias("n"))


# Picks, flags, cube


@query("SELECT user_id, event_id, event_type FROM (SELECT user_id, event_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r FROM events) WHERE r = 1")
def distinct_on_pick(s: SparkSession, d: str) -> DataFrame:
    e = read(s, d, "events").select("user_id", "ts", "event_id", "event_type")
    return first_by(e, "user_id", ["ts", "event_id"]).drop("ts")


@query("""SELECT l_orderkey AS k_iri, bool_or(p_type LIKE '%BRASS') AS has_brass, bool_or(p_type LIKE '%STEEL' AND l_returnflag = 'R') AS has_returned_steel, bool_or(p_size > 40) AS has_large FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""")
def flags_bool_or(s: SparkSession, d: str) -> DataFrame:
    p = read(s, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type", "p_size")
    j = read(s, d, "lineitem").select("l_orderkey", "l_partkey", "l_returnflag").join(p, "l_partkey")
    t = F.col("p_type")
    return j.groupBy(F.col("l_orderkey").alias("k_iri")).agg(F.bool_or(t.endswith("BRASS")).alias("has_brass"), F.bool_or(t.endswith("STEEL") & (F.col("l_returnflag") == "R")).alias("has_returned_steel"), F.bool_or(F.col("p_size") > 40).alias("has_large"))


@query("""SELECT user_id, bool_or(event_type = 'purchase') AS has_purchase, bool_or(event_type = 'signup') AS has_signup, bool_or(event_type = 'error') AS has_error FROM events WHERE event_type IN ('purchase', 'signup', 'error') GROUP BY 1""")
def property_presence_flags(s: SparkSession, d: str) -> DataFrame:
    kinds = ("purchase", "signup", "error")
    e = read(s, d, "events").where(F.col("event_type").isin(*kinds))
    return e.groupBy("user_id").agg(*[F.bool_or(F.col("event_type") == k).alias(f"has_{k}") for k in kinds])


@query("SELECT source, count(DISTINCT lang) AS languages FROM documents WHERE lang <> '' GROUP BY 1")
def lang_count_per_group(s: SparkSession, d: str) -> DataFrame:
    return read(s, d, "documents").where("lang <> ''").groupBy("source").agg(F.count_distinct("lang").alias("languages"))


RESOURCES_SQL = "SELECT l_orderkey, count(*) AS x_web_resource_count, count(DISTINCT (l_partkey, l_suppkey)) AS x_distinct_web_resources, count(*) FILTER (WHERE l_returnflag = 'R') AS x_pdf_count, bool_or(l_returnflag = 'R') AS x_has_pdf FROM lineitem GROUP BY 1"


def _resources(s: SparkSession, d: str) -> DataFrame:
    pdf = F.col("l_returnflag") == "R"
    return read(s, d, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("x_web_resource_count"), F.count_distinct("l_partkey", "l_suppkey").alias("x_distinct_web_resources"), F.count_if(pdf).alias("x_pdf_count"), F.bool_or(pdf).alias("x_has_pdf"))


@query(RESOURCES_SQL)
def resource_counts(s: SparkSession, d: str) -> DataFrame:
    return _resources(s, d)


@query(f"""WITH r AS ({RESOURCES_SQL}), e AS (SELECT l_orderkey, bool_or(p_type LIKE '%BRASS') AS b, bool_or(p_size > 40) AS l FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1)
SELECT o_orderkey AS k_iri, n_name AS v_edm_country, c_name AS v_edm_dataProvider, o_orderstatus AS v_edm_type, (o_totalprice > 100000) AS x_has_content_url, coalesce(b, false) AS x_has_concept, coalesce(l, false) AS x_has_place,
coalesce(x_has_pdf, false) AS x_has_pdf, coalesce(x_pdf_count, 0) AS x_pdf_count, coalesce(x_web_resource_count, 0) AS x_web_resource_count, coalesce(x_distinct_web_resources, 0) AS x_distinct_web_resources
FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN r ON r.l_orderkey = o_orderkey LEFT JOIN e ON e.l_orderkey = o_orderkey""")
def item_cube(s: SparkSession, d: str) -> DataFrame:
    flags = flags_bool_or(s, d).select(F.col("k_iri").alias("o_orderkey"), F.col("has_brass").alias("b"), F.col("has_large").alias("l"))
    res = _resources(s, d).withColumnRenamed("l_orderkey", "o_orderkey")
    c, n = read(s, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_nationkey"), read(s, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    j = read(s, d, "orders").join(c, "o_custkey", "left").join(n, "c_nationkey", "left").join(res, "o_orderkey", "left").join(flags, "o_orderkey", "left")
    zero, no = (lambda x: F.coalesce(x, F.lit(0)).cast("bigint").alias(x)), (lambda x, name: F.coalesce(x, F.lit(False)).alias(name))
    return j.select(F.col("o_orderkey").alias("k_iri"), F.col("n_name").alias("v_edm_country"), F.col("c_name").alias("v_edm_dataProvider"), F.col("o_orderstatus").alias("v_edm_type"), (F.col("o_totalprice") > 100000).alias("x_has_content_url"), no("b", "x_has_concept"), no("l", "x_has_place"), no("x_has_pdf", "x_has_pdf"), zero("x_pdf_count"), zero("x_web_resource_count"), zero("x_distinct_web_resources"))


# Edges and facets

EDGES_SQL = "SELECT DISTINCT l_orderkey AS k_iri_cho, l_partkey AS k_iri_entity, p_type AS x_entity_class, l_returnflag AS x_property FROM lineitem JOIN part ON l_partkey = p_partkey"


def _edges(s: SparkSession, d: str) -> DataFrame:
    p = read(s, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    j = read(s, d, "lineitem").select("l_orderkey", "l_partkey", "l_returnflag").join(p, "l_partkey")
    return j.select(F.col("l_orderkey").alias("k_iri_cho"), F.col("l_partkey").alias("k_iri_entity"), F.col("p_type").alias("x_entity_class"), F.col("l_returnflag").alias("x_property")).distinct()


@query(EDGES_SQL)
def entity_edges(s: SparkSession, d: str) -> DataFrame:
    return _edges(s, d)


@query(f"SELECT DISTINCT k_iri_cho, k_iri_entity, x_entity_class FROM ({EDGES_SQL}) WHERE x_entity_class LIKE 'STANDARD%'")
def entity_edges_curated(s: SparkSession, d: str) -> DataFrame:
    return _edges(s, d).where(F.col("x_entity_class").startswith("STANDARD")).drop("x_property").distinct()


@query(f"""SELECT k_iri_cho, k_iri_entity, x_property, coalesce(label, CAST(k_iri_entity AS VARCHAR)) AS x_label FROM ({EDGES_SQL}) LEFT JOIN (SELECT p_partkey, max(CASE WHEN p_size > 10 THEN p_name END) AS label FROM part GROUP BY 1) ON p_partkey = k_iri_entity""")
def entity_labels_fallback(s: SparkSession, d: str) -> DataFrame:
    labels = read(s, d, "part").where("p_size > 10").groupBy(F.col("p_partkey").alias("k_iri_entity")).agg(F.max("p_name").alias("label"))
    return _edges(s, d).join(labels, "k_iri_entity", "left").select("k_iri_cho", "k_iri_entity", "x_property", F.coalesce("label", F.col("k_iri_entity").cast("string")).alias("x_label"))


@query(f"""WITH e AS ({EDGES_SQL}), m AS (SELECT x_entity_class, x_property, k_iri_entity, count(DISTINCT k_iri_cho) AS x_item_count FROM e GROUP BY 1, 2, 3 UNION ALL SELECT x_entity_class, '*', k_iri_entity, count(DISTINCT k_iri_cho) FROM e GROUP BY 1, 3),
r AS (SELECT *, row_number() OVER (PARTITION BY x_entity_class, x_property ORDER BY x_item_count DESC, k_iri_entity) AS x_rank FROM m) SELECT x_entity_class, x_property, x_rank, k_iri_entity, x_item_count FROM r WHERE x_rank <= 5""")
def facet_top_n(s: SparkSession, d: str) -> DataFrame:
    from .plans.compose import facet_top_n as plan

    edges = _edges(s, d).withColumn("x_label", F.lit(""))
    return plan(lambda _: edges, 5).drop("x_label")


@query("""WITH f AS (SELECT DISTINCT l_orderkey, l_returnflag FROM lineitem WHERE l_returnflag IN ('A', 'N')) SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM f GROUP BY 1 HAVING count(*) = 2)""")
def facet_filter_all_of(s: SparkSession, d: str) -> DataFrame:
    edges = read(s, d, "lineitem").select(F.col("l_orderkey").alias("k_iri_cho"), F.col("l_returnflag").alias("k_iri_entity"))
    found = filters.linked_to_all(edges, ["A", "N"]).withColumnRenamed("k_iri_cho", "o_orderkey")
    return read(s, d, "orders").select("o_orderkey", "o_orderstatus").join(found, "o_orderkey", "left_semi")


@query("""SELECT l_returnflag AS value, count(DISTINCT l_orderkey) AS items FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority IN ('1-URGENT', '2-HIGH')) GROUP BY 1""")
def facet_counts_filtered(s: SparkSession, d: str) -> DataFrame:
    ids = read(s, d, "orders").where("o_orderstatus = 'O' and o_orderpriority in ('1-URGENT', '2-HIGH')").select(F.col("o_orderkey").alias("l_orderkey"))
    one = read(s, d, "lineitem").select("l_orderkey", "l_returnflag").join(ids, "l_orderkey", "left_semi").distinct()
    return one.groupBy(F.col("l_returnflag").alias("value")).agg(F.count("*").alias("items"))


@query("""SELECT 'o_orderstatus' AS name, count(DISTINCT o_orderstatus) <= 10 AS low FROM orders UNION ALL SELECT 'o_orderpriority', count(DISTINCT o_orderpriority) <= 10 FROM orders UNION ALL SELECT 'o_custkey', count(DISTINCT o_custkey) <= 10 FROM orders""")
def low_cardinality_columns(s: SparkSession, d: str) -> DataFrame:
    found = A.low_cardinality(read(s, d, "orders"), ["o_orderstatus", "o_orderpriority", "o_custkey"])
    return s.createDataFrame(list(found.items()), "name string, low boolean")


@query("""WITH t AS (SELECT source, text, CASE WHEN doc_id % 3 = 0 THEN '' ELSE lang END AS lang FROM documents WHERE text IS NOT NULL), r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY CASE WHEN lang = 'en' THEN 0 WHEN lang = '' THEN 1 ELSE 2 END, lang, text) AS n FROM t)
SELECT source, text AS label FROM r WHERE n = 1""")
def label_arg_min(s: SparkSession, d: str) -> DataFrame:
    t = read(s, d, "documents").withColumn("lang", F.when(F.col("doc_id") % 3 == 0, "").otherwise(F.col("lang")))
    return items.preferred_labels(t, "source", "text", "lang")


@query("""SELECT s_nationkey AS k_iri, coalesce(max(s_name) FILTER (WHERE s_acctbal > 5000), max(s_name)) AS label FROM supplier GROUP BY 1""")
def label_main_or_greatest(s: SparkSession, d: str) -> DataFrame:
    t = read(s, d, "supplier").withColumn("lang", F.when(F.col("s_acctbal") > 5000, "en").otherwise("xx"))
    return items.main_or_greatest_label(t, "s_nationkey", "s_name", "lang").withColumnRenamed("s_nationkey", "k_iri")


# Joins and sets


@query("SELECT o_orderpriority AS priority, count(*) AS items, count(*) FILTER (WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')) AS returned FROM orders GROUP BY 1")
def existence_in_filter(s: SparkSession, d: str) -> DataFrame:
    r = read(s, d, "lineitem").where("l_returnflag = 'R'").select("l_orderkey")
    return A.flagged(read(s, d, "orders"), "o_orderkey", returned=r).groupBy(F.col("o_orderpriority").alias("priority")).agg(F.count("*").alias("items"), F.count_if("returned").alias("returned"))


@query("SELECT o_orderkey, o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') AS has_return, o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') AS is_building FROM orders")
def existence_projected(s: SparkSession, d: str) -> DataFrame:
    r = read(s, d, "lineitem").where("l_returnflag = 'R'").select("l_orderkey")
    b = read(s, d, "customer").where("c_mktsegment = 'BUILDING'").select("c_custkey")
    one = A.flagged(read(s, d, "orders").select("o_orderkey", "o_custkey"), "o_orderkey", has_return=r)
    return A.flagged(one, "o_custkey", is_building=b).drop("o_custkey")


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45)")
def semi_join(s: SparkSession, d: str) -> DataFrame:
    li = read(s, d, "lineitem").where("l_quantity > 45").select(F.col("l_orderkey").alias("o_orderkey"))
    return read(s, d, "orders").select("o_orderkey", "o_totalprice").join(li, "o_orderkey", "left_semi")


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def anti_join(s: SparkSession, d: str) -> DataFrame:
    li = read(s, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return read(s, d, "orders").select("o_orderkey", "o_orderstatus").join(li, "o_orderkey", "left_anti")


@query("""WITH r AS (SELECT l_orderkey, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1, 2) SELECT o_orderkey, o_orderstatus, coalesce(n, 0) AS n FROM orders LEFT JOIN r ON l_orderkey = o_orderkey AND l_linestatus = o_orderstatus""")
def composite_key_join(s: SparkSession, d: str) -> DataFrame:
    r = read(s, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey"), F.col("l_linestatus").alias("o_orderstatus")).agg(F.count("*").alias("n"))
    j = read(s, d, "orders").select("o_orderkey", "o_orderstatus").join(r, ["o_orderkey", "o_orderstatus"], "left")
    return j.select("o_orderkey", "o_orderstatus", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


@query("""WITH a AS (SELECT doc_id, 'http://x/proxy/curated/' || CAST(doc_id % 250 AS VARCHAR) AS p FROM documents), b AS (SELECT page_id, 'http://x/item/' || CAST(page_id AS VARCHAR) AS i FROM pages)
SELECT page_id, count(*) AS n FROM a JOIN b ON replace(p, '/proxy/curated/', '/item/') = i GROUP BY 1""")
def rewrite_key_join(s: SparkSession, d: str) -> DataFrame:
    proxy = F.concat(F.lit("http://x/proxy/curated/"), (F.col("doc_id") % 250).cast("string"))
    a = read(s, d, "documents").select(F.replace(proxy, F.lit("/proxy/curated/"), F.lit("/item/")).alias("i"))
    b = read(s, d, "pages").select("page_id", F.concat(F.lit("http://x/item/"), F.col("page_id").cast("string")).alias("i"))
    return a.join(b, "i").groupBy("page_id").agg(F.count("*").alias("n"))


@query(f"""WITH p AS (SELECT l_orderkey, count(DISTINCT l_returnflag) AS n FROM lineitem GROUP BY 1) SELECT coalesce(n, 0) AS flags, count(*) AS items, {SHARE} AS pct FROM orders LEFT JOIN p ON l_orderkey = o_orderkey GROUP BY 1""")
def zero_bucket_distribution(s: SparkSession, d: str) -> DataFrame:
    p = read(s, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count_distinct("l_returnflag").alias("n"))
    rows = read(s, d, "orders").select("o_orderkey").join(p, "o_orderkey", "left").groupBy(F.coalesce("n", F.lit(0)).cast("bigint").alias("flags")).agg(F.count("*").alias("items"))
    return A.with_share(rows, "items")


@query("""WITH a AS (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_returnflag = 'R'), b AS (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_quantity > 40), c AS (SELECT DISTINCT event_id AS k FROM events WHERE event_type = 'purchase')
SELECT count(*) AS total, count(a.k) AS in_a, count(b.k) AS in_b, count(c.k) AS in_c, count(*) FILTER (WHERE a.k IS NOT NULL AND b.k IS NOT NULL) AS a_b, count(*) FILTER (WHERE a.k IS NOT NULL AND b.k IS NOT NULL AND c.k IS NOT NULL) AS all_three
FROM orders LEFT JOIN a ON a.k = o_orderkey LEFT JOIN b ON b.k = o_orderkey LEFT JOIN c ON c.k = o_orderkey""")
def funnel_overlap(s: SparkSession, d: str) -> DataFrame:
    li = read(s, d, "lineitem")
    rows = A.flagged(read(s, d, "orders").select("o_orderkey"), "o_orderkey", a=li.where("l_returnflag = 'R'").select("l_orderkey"), b=li.where("l_quantity > 40").select("l_orderkey"), c=read(s, d, "events").where("event_type = 'purchase'").select("event_id"))
    a, b, c = F.col("a"), F.col("b"), F.col("c")
    return rows.agg(F.count("*").alias("total"), F.count_if(a).alias("in_a"), F.count_if(b).alias("in_b"), F.count_if(c).alias("in_c"), F.count_if(a & b).alias("a_b"), F.count_if(a & b & c).alias("all_three"))


@query(f"""WITH dep AS (SELECT source, count(DISTINCT lang) AS n FROM documents WHERE length(text) >= 200 GROUP BY 1), m AS (SELECT doc_id % 10 AS grp, max(coalesce(n, 0)) AS d FROM documents LEFT JOIN dep USING (source) GROUP BY doc_id % 10, doc_id)
SELECT grp, count(*) AS items, count(*) FILTER (WHERE d >= 2) AS with_2plus, {PCT.format("count(*) FILTER (WHERE d >= 4)", "count(*)")} AS pct_4plus FROM m GROUP BY 1""")
def max_depth_thresholds(s: SparkSession, d: str) -> DataFrame:
    docs = read(s, d, "documents")
    dep = docs.where(F.length("text") >= 200).groupBy("source").agg(F.count_distinct("lang").alias("n"))
    m = docs.select("doc_id", "source").join(dep, "source", "left").groupBy((F.col("doc_id") % 10).alias("grp"), "doc_id").agg(F.max(F.coalesce("n", F.lit(0))).alias("d"))
    return m.groupBy("grp").agg(F.count("*").alias("items"), F.count_if(F.col("d") >= 2).alias("with_2plus"), A.percent(F.count_if(F.col("d") >= 4), F.count("*")).alias("pct_4plus"))


@query(f"""WITH refs AS (SELECT DISTINCT o_orderpriority AS authority, o_orderkey AS iri FROM orders), loc AS (SELECT DISTINCT l_orderkey AS iri FROM lineitem WHERE l_returnflag = 'R' UNION SELECT l_orderkey FROM lineitem WHERE l_quantity > 49)
SELECT authority, count(*) AS refs, count(loc.iri) AS dereferenced, {PCT.format("count(loc.iri)", "count(*)")} AS pct FROM refs LEFT JOIN loc USING (iri) GROUP BY 1""")
def dereference_coverage(s: SparkSession, d: str) -> DataFrame:
    li = read(s, d, "lineitem")
    local = li.where("l_returnflag = 'R'").select("l_orderkey").union(li.where("l_quantity > 49").select("l_orderkey")).distinct()
    refs = A.flagged(read(s, d, "orders").select(F.col("o_orderpriority").alias("authority"), F.col("o_orderkey").alias("iri")).distinct(), "iri", here=local)
    return refs.groupBy("authority").agg(F.count("*").alias("refs"), F.count_if("here").alias("dereferenced"), A.percent(F.count_if("here"), F.count("*")).alias("pct"))


def _keys(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return read(s, d, "orders").where("o_orderstatus = 'O'").select(F.col("o_orderkey").alias("k")), read(s, d, "lineitem").where("l_returnflag = 'N'").select(F.col("l_orderkey").alias("k"))


KA, KB = "SELECT o_orderkey AS k FROM orders WHERE o_orderstatus = 'O'", "SELECT l_orderkey AS k FROM lineitem WHERE l_returnflag = 'N'"


@query(f"{KA} UNION {KB}")
def set_union_distinct(s: SparkSession, d: str) -> DataFrame:
    a, b = _keys(s, d)
    return a.union(b).distinct()


@query(f"{KA} INTERSECT {KB}")
def set_intersect(s: SparkSession, d: str) -> DataFrame:
    a, b = _keys(s, d)
    return a.intersect(b)


@query(f"{KA} EXCEPT {KB}")
def set_except(s: SparkSession, d: str) -> DataFrame:
    a, b = _keys(s, d)
    return a.subtract(b)


@query("SELECT 'customer' AS class, c_name AS name FROM customer UNION ALL SELECT 'supplier', s_name FROM supplier")
def union_all(s: SparkSession, d: str) -> DataFrame:
    one = lambda t, c: read(s, d, t).select(F.lit(t).alias("class"), F.col(c).alias("name"))
    return one("customer", "c_name").unionByName(one("supplier", "s_name"))


WHITELIST = ("ECONOMY%", "%BRUSHED%", "small%steel", "%TIN", "PROMO % NICKEL")


@query("SELECT p_partkey, p_type FROM part WHERE " + " OR ".join(f"lower(p_type) LIKE '{x.lower()}'" for x in WHITELIST))
def like_whitelist(s: SparkSession, d: str) -> DataFrame:
    t = F.lower("p_type")
    return read(s, d, "part").where(reduce(lambda a, b: a | b, [t.like(x.lower()) for x in WHITELIST])).select("p_partkey", "p_type")


@query("SELECT doc_id, length(text) AS length FROM documents WHERE length(text) >= 200 AND regexp_matches(text, '[.!?]$')")
def length_and_regex(s: SparkSession, d: str) -> DataFrame:
    return read(s, d, "documents").where((F.length("text") >= 200) & F.col("text").rlike(r"[.!?]\z")).select("doc_id", F.length("text").cast("bigint").alias("length"))


@query("SELECT event_type, avg(TRY_CAST(nullif(regexp_extract(props, '[0-9]+'), '') AS BIGINT)) AS average, min(value) AS least, max(value) AS most FROM events GROUP BY 1")
def cast_average(s: SparkSession, d: str) -> DataFrame:
    number = F.nullif(F.regexp_extract("props", "[0-9]+", 0), F.lit("")).try_cast("bigint")
    return read(s, d, "events").groupBy("event_type").agg(F.avg(number).alias("average"), F.min("value").alias("least"), F.max("value").alias("most"))


@query("SELECT url, page_id FROM pages WHERE url SIMILAR TO 'https?://[a-z]+\\.[a-z.]+/(en|de)/.*'")
def similar_to(s: SparkSession, d: str) -> DataFrame:
    return read(s, d, "pages").where(F.col("url").rlike(r"^https?://[a-z]+\.[a-z.]+/(en|de)/.*$")).select("url", "page_id")


@query("SELECT o_orderkey, split_part(o_orderpriority, '-', 2) AS word, position('-' IN o_orderpriority) AS dash, length(o_orderpriority) AS n, lower(o_orderpriority) AS low, coalesce(nullif(o_orderstatus, 'F'), 'none') AS status FROM orders")
def string_functions(s: SparkSession, d: str) -> DataFrame:
    p = F.col("o_orderpriority")
    return read(s, d, "orders").select("o_orderkey", F.split_part(p, F.lit("-"), F.lit(2)).alias("word"), F.instr(p, "-").cast("bigint").alias("dash"), F.length(p).cast("bigint").alias("n"), F.lower(p).alias("low"), F.coalesce(F.nullif("o_orderstatus", F.lit("F")), F.lit("none")).alias("status"))


# Graph patterns


def _triples(s: SparkSession, d: str) -> DataFrame:
    iri = lambda kind, c: F.concat(F.lit(f"{kind}/"), F.col(c).cast("string"))
    t = lambda df, a, p, o: df.select(a.alias("s"), F.lit(p).alias("p"), o.alias("o"))
    c, n, r, o = (read(s, d, x) for x in ("customer", "nation", "region", "orders"))
    parts = [t(c, iri("customer", "c_custkey"), "nation", iri("nation", "c_nationkey")), t(n, iri("nation", "n_nationkey"), "region", iri("region", "n_regionkey")), t(r, iri("region", "r_regionkey"), "name", F.col("r_name")), t(n, iri("nation", "n_nationkey"), "name", F.col("n_name")), t(o.where("o_orderpriority = '1-URGENT'"), iri("order", "o_orderkey"), "by", iri("customer", "o_custkey"))]
    return graph.union(*parts)


@query("SELECT 'customer/' || CAST(c_custkey AS VARCHAR) AS c, r_name AS region FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def bgp_two_hop(s: SparkSession, d: str) -> DataFrame:
    return graph.bgp(_triples(s, d), ("?c", "nation", "?n"), ("?n", "region", "?r"), ("?r", "name", "?region")).select("c", "region")


@query("SELECT 'customer/' || CAST(c_custkey AS VARCHAR) AS c, 'order/' || CAST(o_orderkey AS VARCHAR) AS o FROM customer LEFT JOIN (SELECT * FROM orders WHERE o_orderpriority = '1-URGENT') ON o_custkey = c_custkey")
def optional_pattern(s: SparkSession, d: str) -> DataFrame:
    t = _triples(s, d)
    return graph.optional(graph.Pattern("?c", "nation", "?n").match(t), graph.Pattern("?o", "by", "?c").match(t)).select("c", "o")


@query("SELECT 'nation/' || CAST(n_nationkey AS VARCHAR) AS x, n_name AS label FROM nation UNION ALL SELECT 'region/' || CAST(r_regionkey AS VARCHAR), r_name FROM region")
def union_pattern(s: SparkSession, d: str) -> DataFrame:
    t = _triples(s, d)
    nations, regions = (graph.exists(graph.Pattern("?x", "name", "?label").match(t), p) for p in (graph.Pattern("?x", "region", "?y").match(t), graph.Pattern("?z", "region", "?x").match(t)))
    return graph.union(nations, regions)


@query("SELECT 'customer/' || CAST(c_custkey AS VARCHAR) AS c FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')")
def not_exists_pattern(s: SparkSession, d: str) -> DataFrame:
    t = _triples(s, d)
    return graph.not_exists(graph.Pattern("?c", "nation", "?n").match(t), graph.Pattern("?o", "by", "?c").match(t)).select("c")


@query("SELECT 'customer/' || CAST(c_custkey AS VARCHAR) AS c, 'nation/' || CAST(c_nationkey AS VARCHAR) AS n, CASE WHEN c_nationkey = 3 THEN 'three' ELSE 'any' END AS tag FROM customer WHERE c_nationkey = 3 UNION ALL SELECT 'customer/' || CAST(c_custkey AS VARCHAR), 'nation/' || CAST(c_nationkey AS VARCHAR), 'seven' FROM customer WHERE c_custkey = 7")
def inline_values(s: SparkSession, d: str) -> DataFrame:
    """A pattern with inline data, one term of which is unbound."""
    given = graph.values(s, ["c", "n", "tag"], [(None, "nation/3", "three"), ("customer/7", None, "seven")])
    return graph.with_values(graph.Pattern("?c", "nation", "?n").match(_triples(s, d)), given)


@query("SELECT count(*) AS triples FROM (SELECT 1 FROM customer UNION ALL SELECT 1 FROM nation UNION ALL SELECT 1 FROM nation UNION ALL SELECT 1 FROM region UNION ALL SELECT 1 FROM orders WHERE o_orderpriority = '1-URGENT')")
def graph_count(s: SparkSession, d: str) -> DataFrame:
    return _triples(s, d).agg(F.count("*").alias("triples"))


@query("SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderkey LIMIT 50 OFFSET 100")
def limit_offset_page(s: SparkSession, d: str) -> DataFrame:
    return graph.page(read(s, d, "orders").select("o_orderkey", "o_orderdate"), ["o_orderkey"], 50, 100)


# Filters, samples


@query("SELECT o_orderkey, country FROM (SELECT o_orderkey, o_orderstatus, o_totalprice, n_name AS country FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey) WHERE country IN ('FRANCE', 'GERMANY', 'NATION_1', 'NATION_7') AND o_totalprice >= 100000 AND o_orderstatus <> 'F' AND o_totalprice > 150000")
def filter_dsl(s: SparkSession, d: str) -> DataFrame:
    df = _orders_by_nation(s, d).withColumn("large", F.col("o_totalprice") > 150000)
    where = filters.parse("country=FRANCE,GERMANY,NATION_1,NATION_7 price>=100000 status!=F large", df.schema, {"price": "o_totalprice", "status": "o_orderstatus"})
    return df.where(where).select("o_orderkey", "country")


@query("SELECT * FROM orders WHERE o_orderstatus = 'O' ORDER BY md5(CAST(o_orderkey AS VARCHAR)) LIMIT 20")
def sample_rows(s: SparkSession, d: str) -> DataFrame:
    """A sample of 20 filtered rows by least hash: the limit is the feature."""
    return sampling.bottom_k(read(s, d, "orders").where("o_orderstatus = 'O'"), "o_orderkey", 20)


@query("SELECT o_custkey, o_orderkey FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY md5('a' || CAST(o_orderkey AS VARCHAR))) AS r FROM orders) WHERE r <= 3")
def sample_by_group(s: SparkSession, d: str) -> DataFrame:
    """Three orders of each customer by least hash, drawn from samples of two halves: the limit is the feature."""
    orders = read(s, d, "orders").select("o_custkey", "o_orderkey")
    halves = [sampling.bottom_k(orders.where(F.col("o_orderkey") % 2 == i), "o_orderkey", 3, ["o_custkey"], "a") for i in range(2)]
    return sampling.bottom_k(halves[0].unionByName(halves[1]), "o_orderkey", 3, ["o_custkey"], "a")


@query("""SELECT o_orderstatus, count(*) AS "rows", true AS distinct_within, true AS median_within FROM (SELECT * FROM orders WHERE o_orderpriority <> '5-LOW') GROUP BY 1""")
def sketched_orders(s: SparkSession, d: str) -> DataFrame:
    """Sketches by status and priority, merged by status under a filter, and whether they lie within their error of exact figures (5 %; 3 % in rank)."""
    orders = read(s, d, "orders").withColumn("cents", F.round(F.col("o_totalprice") * 100).cast("bigint"))
    made = sketches.Sketches.of(orders, ("o_orderstatus", "o_orderpriority"), ("o_custkey",), ("cents",))
    told = made.estimates(("o_orderstatus",), F.col("o_orderpriority") != "5-LOW", (0.5,))
    rows = orders.where("o_orderpriority <> '5-LOW'")
    exact = rows.groupBy("o_orderstatus").agg(F.count_distinct("o_custkey").alias("n"))
    median = told.select("o_orderstatus", F.col("q_cents")[0].alias("median"))
    rank = rows.join(F.broadcast(median), "o_orderstatus").groupBy("o_orderstatus").agg(F.avg((F.col("cents") <= F.col("median")).cast("int")).alias("below"))
    out = told.join(exact, "o_orderstatus").join(rank, "o_orderstatus")
    return out.select("o_orderstatus", "rows", (F.abs(F.col("n_o_custkey") - F.col("n")) <= 0.05 * F.col("n")).alias("distinct_within"), (F.abs(F.col("below") - 0.5) <= 0.03).alias("median_within"))


@query()
def approx_distinct(s: SparkSession, d: str) -> DataFrame:
    return read(s, d, "orders").groupBy("o_orderstatus").agg(F.approx_count_distinct("o_custkey").alias("customers"))


@query("SELECT event_type, count(*) AS n, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS start FROM events GROUP BY 1, 3")
def windowed_facet_counts(s: SparkSession, d: str) -> DataFrame:
    """Hourly facet counts; streaming/facets.py runs the same over a stream."""
    from .streaming.facets import windowed_counts

    return windowed_counts(read(s, d, "events"), "ts", "event_type").select("event_type", "n", F.col("start").cast("timestamp_ntz").alias("start"))


@query()
def graph_paths(s: SparkSession, d: str) -> DataFrame:
    """Everything within two steps of each customer."""
    t = _triples(s, d).where("p <> 'name'").select(F.col("s").alias("src"), F.col("o").alias("dst"))
    start = read(s, d, "customer").select(F.concat(F.lit("customer/"), F.col("c_custkey").cast("string")).alias("source"))
    return paths.paths(t, start, 2)


ORACLE["graph_paths"] = """SELECT 'customer/' || CAST(c_custkey AS VARCHAR) AS source, 'customer/' || CAST(c_custkey AS VARCHAR) AS node, CAST(0 AS INTEGER) AS distance FROM customer
UNION ALL SELECT 'customer/' || CAST(c_custkey AS VARCHAR), 'nation/' || CAST(c_nationkey AS VARCHAR), 1 FROM customer
UNION ALL SELECT 'customer/' || CAST(c_custkey AS VARCHAR), 'region/' || CAST(n_regionkey AS VARCHAR), 2 FROM customer JOIN nation ON c_nationkey = n_nationkey"""


def _next_orders(s: SparkSession, d: str, steps: tuple[int, ...]) -> DataFrame:
    """(src, dst, o_custkey): from each order of a customer, in the order of their keys, to the ones so many places on."""
    of_customer = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    each = read(s, d, "orders").select("o_custkey", F.col("o_orderkey").alias("src"), *[F.lead("o_orderkey", n).over(of_customer).alias(f"n{n}") for n in steps])
    return each.select("o_custkey", "src", F.explode(F.array_compact(F.array(*[f"n{n}" for n in steps]))).alias("dst"))


def _ends(s: SparkSession, d: str, rows: str = "true") -> DataFrame:
    return read(s, d, "orders").where(rows).groupBy("o_custkey").agg(F.min("o_orderkey").alias("source"), F.max("o_orderkey").alias("target"))


NEXT = "SELECT o_custkey, o_orderkey AS src, lead(o_orderkey, {n}) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS dst FROM orders"
EDGES = "edge AS (SELECT * FROM (" + " UNION ALL ".join(NEXT.format(n=n) for n in (1, 3)) + ") WHERE dst IS NOT NULL)"
ENDS = "pair AS (SELECT o_custkey, min(o_orderkey) AS source, max(o_orderkey) AS target FROM orders GROUP BY 1)"


@query(f"""WITH RECURSIVE {EDGES}, {ENDS},
walk AS (SELECT source, source AS node, 0 AS distance FROM pair UNION SELECT source, dst, distance + 1 FROM walk JOIN edge ON src = node WHERE distance < 20)
SELECT source, node, CAST(min(distance) AS INTEGER) AS distance FROM walk GROUP BY 1, 2""")
def graph_distances(s: SparkSession, d: str) -> DataFrame:
    """Orders within twenty steps of each customer's first one, at their least distance."""
    return paths.distances(_next_orders(s, d, (1, 3)), _ends(s, d).select("source"), 20).select("source", "node", "distance")


@query(f"""WITH RECURSIVE {EDGES}, {ENDS},
walk AS (SELECT source, target, source AS node, [source] AS path FROM pair UNION ALL SELECT source, target, dst, list_append(path, dst) FROM walk JOIN edge ON src = node WHERE len(path) <= 6)
SELECT source, target, array_to_string(path, ' ') AS path, CAST(len(path) - 1 AS INTEGER) AS length FROM walk WHERE node = target AND len(path) > 1""")
def graph_all_paths(s: SparkSession, d: str) -> DataFrame:
    """Every path of at most six steps from each customer's first order to the last."""
    found = paths.all_paths(_next_orders(s, d, (1, 3)), None, None, 6, pairs=_ends(s, d).select("source", "target"))
    return found.select("source", "target", F.array_join(F.transform("path", lambda x: x.cast("string")), " ").alias("path"), "length")


@query(f"""WITH RECURSIVE {EDGES}, {ENDS},
walk AS (SELECT source, target, source AS node, [source] AS path FROM pair UNION ALL SELECT source, target, dst, list_append(path, dst) FROM walk JOIN edge ON src = node WHERE len(path) <= 12),
found AS (SELECT *, row_number() OVER (PARTITION BY source, target ORDER BY len(path), list_reverse(path)) AS r FROM walk WHERE node = target)
SELECT source, target, CAST(len(path) - 1 AS INTEGER) AS distance, array_to_string(path, ' ') AS path FROM found WHERE r = 1""")
def graph_shortest_paths(s: SparkSession, d: str) -> DataFrame:
    """One shortest path, of at most twelve steps, from each customer's first order to the last."""
    found = paths.shortest_paths(_next_orders(s, d, (1, 3)), _ends(s, d).select("source", "target"), 12)
    return found.select("source", "target", "distance", F.array_join(F.transform("path", lambda x: x.cast("string")), " ").alias("path"))


@query("""SELECT 'http://d/order/' || CAST(o_orderkey AS VARCHAR) AS s, 'http://v#' || p AS p, o, kind AS o_kind, lang AS o_lang, datatype AS o_datatype FROM (
SELECT o_orderkey, 'by' AS p, 'http://d/customer/' || CAST(o_custkey AS VARCHAR) AS o, 'iri' AS kind, CAST(NULL AS VARCHAR) AS lang, CAST(NULL AS VARCHAR) AS datatype FROM orders
UNION ALL SELECT o_orderkey, 'comment', o_orderpriority || ' "' || o_orderstatus || '" ' || chr(10) || chr(92), 'literal', 'en', NULL FROM orders
UNION ALL SELECT o_orderkey, 'custkey', CAST(o_custkey AS VARCHAR), 'literal', NULL, 'http://www.w3.org/2001/XMLSchema#integer' FROM orders)""")
def dump_round_trip(s: SparkSession, d: str) -> DataFrame:
    """Statements about all orders, written as Turtle files of bounded size with prefixes, and read back through the dump source."""
    orders = read(s, d, "orders")
    key, none = F.col("o_orderkey").cast("string"), F.lit(None).cast("string")
    t = lambda p, o, kind, lang=none, of=none: F.struct(F.concat(F.lit("http://d/order/"), key).alias("s"), F.lit("http://v#" + p).alias("p"), o.alias("o"), F.lit(kind).alias("o_kind"), lang.alias("o_lang"), of.alias("o_datatype"))
    who = F.col("o_custkey").cast("string")
    note = F.concat("o_orderpriority", F.lit(' "'), "o_orderstatus", F.lit('" \n\\'))
    each = orders.select(F.explode(F.array(t("by", F.concat(F.lit("http://d/customer/"), who), "iri"), t("comment", note, "literal", F.lit("en")), t("custkey", who, "literal", of=F.lit("http://www.w3.org/2001/XMLSchema#integer")))).alias("t"))
    path = fresh_path(s, "dump")
    write_turtle(each.select("t.*"), path, {"v": "http://v#", "xsd": "http://www.w3.org/2001/XMLSchema#"}, roll_bytes=8 << 20)
    return read_dump(s, path).select("s", "p", "o", "o_kind", "o_lang", "o_datatype")


WORDS = r"word AS (SELECT doc_id, w, i FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')) AS w, generate_subscripts(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+'), 1) AS i FROM documents))".replace("\\\\", "\\")


@query(f"""WITH {WORDS}, slot AS (SELECT doc_id, 'the' AS q, count(*) AS n FROM word WHERE w = 'the' GROUP BY 1 UNION ALL SELECT doc_id, 'wh*', count(*) FROM word WHERE starts_with(w, 'wh') GROUP BY 1),
texts AS (SELECT q, count(*) AS t FROM slot GROUP BY 1)
SELECT doc_id AS key, CAST(sum(n) AS BIGINT) AS matches, round(sum(n * ln(1 + (SELECT count(*) FROM documents) / t)), 3) AS score FROM slot JOIN texts USING (q) GROUP BY 1 HAVING count(*) = 2""")
def text_search(s: SparkSession, d: str) -> DataFrame:
    """Documents that have one word and one beginning of a word, from an inverted index."""
    found = TextIndex.build(read(s, d, "documents"), "doc_id", "text", fresh_path(s, "text")).search("the wh*")
    return found.select("key", "matches", F.round("score", 3).alias("score"))


@query(f"WITH {WORDS} SELECT a.doc_id AS key, count(*) AS matches FROM word a JOIN word b ON a.doc_id = b.doc_id AND b.i = a.i + 1 WHERE a.w = 'of' AND b.w = 'the' GROUP BY 1")
def text_phrase(s: SparkSession, d: str) -> DataFrame:
    """Documents in which two words follow each other, from an inverted index."""
    return TextIndex.build(read(s, d, "documents"), "doc_id", "text", fresh_path(s, "text")).phrase("of the")
