"""The queries of this package, and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, langid, linededup, neardup, packing, phrases, quality, tokencount, topk, toxicity, vafile, warc, wavelet
from .common import crc_part


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that overlap with a benchmark item, and where."""
    return decontaminate.overlaps(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def _classified(spark: SparkSession, sf_dir: str, module, label: str, parts: int, held: int, least: float) -> DataFrame:
    docs, labels = _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels")
    model = module.train(docs, labels.where(crc_part("doc_id", parts) != held), label_col=label)
    scored = module.score(docs, model)
    return scored.select("doc_id", (crc_part("doc_id", parts) == held).alias("held_out"), "score", (F.col("score") >= least).cast("int").alias("predicted"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classified(spark, sf_dir, toxicity, "toxic", 3, 1, 0.7)


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_read(spark, sf_dir, "documents"), percent=85)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the boilerplate lines of its source."""
    out = linededup.drop_boilerplate(_read(spark, sf_dir, "documents"))
    return out.select("doc_id", "text", F.col("__cl_lines").alias("n_lines"), F.col("__cl_dropped").alias("n_dropped"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metadata and conversion records of all pages; source_headers as JSON, an array of names and values in the order of names."""
    out = warc.derivatives(warc.responses_from_pages(_read(spark, sf_dir, "pages")), "page_id")
    return out.withColumn("source_headers", F.to_json(F.array_sort(F.map_entries("source_headers"))))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_read(spark, sf_dir, "documents"))


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best of each query; the contract's components give scores of 64 bits."""
    return topk.top_k(_read(spark, sf_dir, "embeddings"))


def op8_wavelet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wavelet.token_shards(_read(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classified(spark, sf_dir, quality, "quality", 5, 0, 0.3)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.token_counts(_read(spark, sf_dir, "documents"))


def op11_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages by a model of the documents that are not held out; a row without an id is neither learned from nor held out."""
    docs, held = _read(spark, sf_dir, "documents"), crc_part("doc_id", 4) == 2
    out = langid.predict(docs, langid.train(docs.where(~held)))
    return out.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op12_vafile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vafile.compress(_read(spark, sf_dir, "embeddings"))[0]


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.phrases(_read(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_decontamination, op2_toxicity, op3_minhash, op4_line_dedup, op5_warc, op6_packing, op7_topk, op8_wavelet, op9_quality, op10_token_counts, op11_langid, op12_vafile, op13_phrases)}


def oracle_sql() -> dict[str, str]:
    d = decontaminate
    words = r"list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '')"
    # Every diagonal on which enough words agree, with no seeds.
    sql1 = f"""
WITH doc AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM (SELECT doc_id, {words} AS w FROM documents)),
item AS (SELECT item_id, len(w) AS n, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS j FROM (SELECT item_id, {words} AS w FROM benchmark)),
diagonal AS (SELECT doc_id, item_id, n, least(n, {d.WINDOW}) AS wid, p - j AS start, list(j ORDER BY j) AS js FROM doc JOIN item USING (x)
             GROUP BY doc_id, item_id, n, p - j HAVING count(*) >= least({d.RUN}, ceil({d.SHARE} * least(n, {d.WINDOW})))),
agreed AS (SELECT *, list_max(list_transform(js, lambda a: len(list_filter(js, lambda b: b >= a AND b < a + wid)))) AS matched, list_transform(js, lambda a, i: a - i) AS steps FROM diagonal),
runs AS (SELECT *, list_max(list_transform(list_distinct(steps), lambda v: len(list_filter(steps, lambda u: u = v)))) AS run FROM agreed),
best AS (SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY matched DESC, run DESC, start) AS r FROM runs WHERE matched >= ceil({d.SHARE} * wid) OR run >= {d.RUN})
SELECT doc_id, item_id, CAST(n AS BIGINT) AS item_words, CAST(matched AS BIGINT) AS matched, CAST(wid AS BIGINT) AS "window", CAST(run AS BIGINT) AS run, CAST(start AS BIGINT) AS start FROM best WHERE r = 1
"""
    ratio, pages = linededup.RATIO, linededup.MIN_PAGES
    sql4 = f"""
WITH doc AS (SELECT doc_id, source, text, string_split(text, chr(10)) AS lines FROM documents),
line AS (SELECT DISTINCT text, source, trim(x) AS x FROM (SELECT text, source, unnest(lines) AS x FROM doc) WHERE trim(x) <> ''),
total AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
bad AS (SELECT source, x FROM (SELECT source, x, count(*) AS c FROM line GROUP BY source, x) JOIN total USING (source) WHERE c >= {pages} AND CAST(c AS DOUBLE) / n > {ratio}),
sites AS (SELECT source, list(x) AS b FROM bad GROUP BY source),
kept AS (SELECT doc_id, text, lines, CASE WHEN b IS NULL THEN lines ELSE list_filter(lines, lambda x: NOT list_contains(b, trim(x))) END AS k FROM doc LEFT JOIN sites USING (source))
SELECT doc_id, CASE WHEN len(k) < len(lines) THEN array_to_string(k, chr(10)) ELSE text END AS text, CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(k) AS BIGINT) AS n_dropped FROM kept
"""
    scale = topk_sql()
    return {"op1_decontamination": sql1, "op4_line_dedup": sql4, "op7_topk": scale, "op12_vafile": vafile_sql(), "op13_phrases": phrases_sql()}


def topk_sql() -> str:
    return """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


def vafile_sql(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """All distances, round by round."""
    assign = """
SELECT s.i, s.part, arg_min(c.entry, struct_pack(d := list_sum(list_transform(range(1, len(s.x) + 1), lambda k: (s.x[k] - c.x[k]) * (s.x[k] - c.x[k]))), e := c.entry)) AS entry,
       min(list_sum(list_transform(range(1, len(s.x) + 1), lambda k: (s.x[k] - c.x[k]) * (s.x[k] - c.x[k])))) AS d
FROM part s JOIN {book} c USING (part) GROUP BY s.i, s.part"""
    steps = [
        """v AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id, embedding) AS i, vec_id, label, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"part AS MATERIALIZED (SELECT i, p AS part, x[p * len(x) // {parts} + 1 : (p + 1) * len(x) // {parts}] AS x FROM v, (SELECT unnest(range({parts})) AS p))",
        f"c0 AS MATERIALIZED (SELECT part, i - 1 AS entry, x FROM part WHERE i <= {entries})",
    ]
    for r in range(rounds):
        steps += [
            f"a{r} AS MATERIALIZED ({assign.format(book=f'c{r}')})",
            f"""s{r} AS MATERIALIZED (SELECT part, entry, k, sum(x[k]) AS s, count(*) AS n FROM (SELECT a.part, a.entry, s.x, unnest(range(1, len(s.x) + 1)) AS k FROM a{r} a JOIN part s USING (i, part)) GROUP BY part, entry, k)""",
            f"""m{r} AS MATERIALIZED (SELECT part, entry, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY k) AS x FROM s{r} GROUP BY part, entry)""",
            f"c{r + 1} AS MATERIALIZED (SELECT c.part, c.entry, coalesce(m.x, c.x) AS x FROM c{r} c LEFT JOIN m{r} m USING (part, entry))",
        ]
    return f"""
WITH {", ".join(steps)},
a AS MATERIALIZED ({assign.format(book=f"c{rounds}")}),
coded AS (SELECT i, string_agg(printf('%02x', CAST(entry AS INTEGER)), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM a GROUP BY i),
book AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS h FROM c{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256 FROM coded JOIN v USING (i), book
"""


def phrases_sql() -> str:
    return r"""
WITH piece AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS t FROM documents),
cut AS (SELECT lang, list_filter(string_split_regex(t, '[\x20\x09]+'), lambda x: x <> '') AS w FROM piece),
spot AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM cut),
gram AS (SELECT lang, w[i : i + k - 1] AS g FROM spot, (SELECT unnest([1, 2, 3]) AS k) WHERE i + k - 1 <= len(w)),
f AS MATERIALIZED (SELECT lang, g, count(*) AS c FROM gram GROUP BY lang, g),
total AS (SELECT lang, sum(c) AS n FROM f WHERE len(g) = 1 GROUP BY lang),
cand AS MATERIALIZED (SELECT lang, g, c AS a FROM f WHERE len(g) > 1 AND c >= 10),
cuts AS (SELECT lang, g, a, k, g[1 : k] AS lg, g[k + 1 :] AS rg FROM cand, (SELECT unnest([1, 2]) AS k) WHERE k < len(g)),
scored AS (SELECT cuts.lang, cuts.g, a, k, x.c AS l, y.c AS r, CAST(1000000 * CAST(a AS HUGEINT) * a // (CAST(x.c AS HUGEINT) * y.c) AS BIGINT) AS score
           FROM cuts JOIN f x ON cuts.lang = x.lang AND lg = x.g JOIN f y ON cuts.lang = y.lang AND rg = y.g),
weak AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, g ORDER BY score, k) AS o FROM scored) WHERE o = 1),
inner_g AS (SELECT lang, unnest([g[1 : 2], g[2 : 3]]) AS g, a FROM cand WHERE len(g) = 3),
longer AS (SELECT lang, g, max(a) AS most FROM inner_g GROUP BY lang, g),
kept AS (SELECT weak.lang, weak.g, weak.a, weak.l, weak.r, weak.score FROM weak LEFT JOIN longer o ON weak.lang = o.lang AND weak.g = o.g WHERE most IS NULL OR 100 * most < 50 * a),
ranked AS (SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, score FROM kept),
r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM ranked)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r.r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, score FROM r JOIN total USING (lang) WHERE rank <= 2000
"""
