"""Exact top-k inner products by columnar branch and bound.

Candidates lie in blocks of bounded size, dimension by dimension (vertical layout).
For a query, scores are accumulated one block of dimensions after another;
after each, a candidate stays only if its partial score plus the most that the remaining
dimensions can add (Cauchy-Schwarz on the remaining mass of both vectors) reaches the
k-th best full score known so far. The survivors are compacted before the next block.

Accumulation is in floating point, scaled by powers of two so that nothing overflows, and every bound is
widened by the most that rounding can amount to. What is left at the end, the k best and what lies within rounding of
them, is scored anew in whole numbers, of any size.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DIMENSIONS, CANDIDATES, QUERIES = 16, 8192, 4096
#: Sums below this are added in 64 bits.
SAFE = 1 << 62


def whole(x: float, scale: int) -> int:
    """floor(scale * x) as doubles give it; exact where the product is too large for a double."""
    y = x * scale
    return math.floor(y) if math.isfinite(y) else int(x) * scale


def scaled(vectors: np.ndarray, scale: int) -> tuple[np.ndarray, int, float]:
    """floor(scale * x) of rows of doubles over a power of two; its exponent; the greatest size of a component."""
    with np.errstate(over="ignore"):
        v = np.floor(vectors * scale)
    wide = ~np.isfinite(v)
    most = float(np.abs(v).max(initial=0.0))
    exponent = max(0, (math.frexp(most)[1] if math.isfinite(most) else 1024 + scale.bit_length()) - 400)
    out = np.ldexp(v, -exponent)
    out[wide] = np.ldexp(vectors[wide], -exponent) * scale
    return out, exponent, most


def best_of_block(queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int, scale: int) -> list[tuple[int, int, int]]:
    """(query id, candidate id, score) of each query's k best among the rows of vectors; queries and vectors are doubles not yet multiplied, and ids rise."""
    asked, exponent_q, most_q = scaled(queries, scale)
    rows, exponent_c, most_c = scaled(vectors, scale)
    block, dims = np.ascontiguousarray(rows.T), rows.shape[1]
    edges = list(range(0, dims, DIMENSIONS))
    # Mass that is left from each block of dimensions on; a little is added for rounding.
    square = np.square(block)
    left = [np.sqrt(square[e:].sum(0)) * (1 + 1e-9) for e in edges[1:]]
    size = np.sqrt(square.sum(0))
    # What rounding can amount to: of products and sums, and of components so far below the greatest one that their squares vanish.
    slack = size * ((dims + 8) * 2.0**-50)
    vanished = dims * 1e-149 * float(np.abs(asked).max(initial=0) + np.abs(rows).max(initial=0)) if max(exponent_q, exponent_c) > 490 else 0.0
    order = np.argsort(-size, kind="stable")[: 4 * k]
    fits = most_q * most_c * dims < SAFE
    exact = np.floor(vectors * scale).astype(np.int64) if fits else None
    out = []
    for q, raw, name in zip(asked, queries, query_ids.tolist(), strict=True):
        mass = [math.sqrt(float(np.square(q[e:]).sum())) * (1 + 1e-9) for e in edges]
        error = slack * mass[0] + vanished
        first = order[ids[order] != name]
        lower = np.sort(q @ block[:, first] - error[first])
        least = lower[-k] if len(lower) >= k else -math.inf
        alive = np.flatnonzero(ids != name)
        score = np.zeros(len(alive))
        for i, e in enumerate(edges):
            score = score + q[e : e + DIMENSIONS] @ block[e : e + DIMENSIONS, alive]
            if i < len(left):
                keep = score + left[i][alive] * mass[i + 1] + error[alive] >= least
                if not keep.all():
                    alive, score = alive[keep], score[keep]
        if len(alive) > k:
            lower = score - error[alive]
            alive = alive[score + error[alive] >= np.partition(lower, len(lower) - k)[len(lower) - k]]
        if fits:
            scores = (exact[alive] @ np.floor(raw * scale).astype(np.int64)).tolist()
        else:
            terms = [whole(x, scale) for x in raw.tolist()]
            scores = [sum(whole(x, scale) * y for x, y in zip(v, terms, strict=True)) for v in vectors[alive].tolist()]
        found = sorted(zip([-s for s in scores], ids[alive].tolist(), strict=True))[:k]
        out += [(name, i, -s) for s, i in found]
    return out


def as_columns(score: int) -> tuple[int, str, int]:
    """(side, digits, score) of a whole number, whose order is that of the numbers: side is 0 for those of 64 bits; 1 and -1 for those above and below, told apart by digits."""
    if -(1 << 63) <= score < 1 << 63:
        return 0, "", score
    digits = str(abs(score))
    if score > 0:
        return 1, f"{len(digits):04d}{digits}", (1 << 63) - 1
    return -1, f"{9999 - len(digits):04d}" + digits.translate(str.maketrans("0123456789", "9876543210")), -(1 << 63)


def top_k(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", query_every: int = 50, k: int = 5, scale: int = 256, beyond: bool = False) -> DataFrame:
    """The k best candidates of every query by integer inner product: (query_id, rank, vec_id, score).

    Queries are the rows whose id is divisible by query_every, candidates all rows but
    the query's own id; ties go to the smaller id. Vectors that are null or hold a null or
    non-finite component, and rows with a null id, take no part. Vectors of another
    length than the query's are no candidates; the score of empty vectors is 0. A repeated row (same id and vector) counts
    once; other columns take no part. An empty table gives an empty result.

    Ranks are exact for every finite vector. A score that doesn't fit in 64 bits is given as the greatest or least
    long, on its side; with beyond, a column of that name says whether it is so.

    Queries come in blocks of QUERIES and candidates in blocks of about CANDIDATES, and each
    pair of blocks meets in one task by an equal key; what a task holds doesn't grow with the data.
    """
    x = F.col(vector_col)
    fine = x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    rows = df.where(F.col(id_col).isNotNull() & fine).select(F.col(id_col).cast("bigint").alias("id"), x.cast("array<double>").alias("v")).distinct()
    n, asked = rows.select("id").agg(F.count("*"), F.count_if(F.col("id") % query_every == 0)).first()
    blocks = max(1, -(-n // CANDIDATES))
    query_blocks = max(1, -(-asked // QUERIES))
    spread = lambda salt, most: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(most)).cast("int")
    each = lambda most: F.explode(F.sequence(F.lit(0), F.lit(most - 1)))
    queries = rows.where(F.col("id") % query_every == 0).withColumn("qb", spread(1, query_blocks)).withColumn("cb", each(blocks))
    candidates = rows.withColumn("cb", spread(2, blocks)).withColumn("qb", each(query_blocks))
    keys = ["qb", "cb", F.size("v").alias("dims")]

    def run(q, c):
        import pandas as pd

        found: list[tuple[int, int, int]] = []
        if len(q) and len(c):
            c = c.sort_values("id", kind="stable")
            table = lambda t: np.array(t["v"].tolist(), np.float64).reshape(len(t), -1)
            found = best_of_block(table(q), q["id"].to_numpy(), table(c), c["id"].to_numpy(), k, scale)
        names = ["query_id", "vec_id", "side", "digits", "score"]
        return pd.DataFrame([(a, b, *as_columns(s)) for a, b, s in found], columns=names).astype(dict.fromkeys(["query_id", "vec_id", "side", "score"], "int64"))

    found = queries.groupBy(*keys).cogroup(candidates.groupBy(*keys)).applyInPandas(run, "query_id bigint, vec_id bigint, side bigint, digits string, score bigint")
    # A query id with several vectors is several queries in one; equal pairs keep their best score.
    best = [F.desc("side"), F.desc("digits"), F.desc("score")]
    first = F.row_number().over(Window.partitionBy("query_id", "vec_id").orderBy(*best))
    found = found.withColumn("of_pair", first).where("of_pair = 1")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(*best, "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score", *([(F.col("side") != 0).alias("beyond")] if beyond else []))
