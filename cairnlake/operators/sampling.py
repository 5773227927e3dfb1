"""Samples by least hash: the same rows whenever and wherever they are drawn, and mergeable."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def hash_of(key: str | Column, seed: str = "") -> Column:
    """The hash of a key by which rows are drawn: MD5 of the seed and the key's text, which other engines have too. A null key has none and isn't drawn."""
    text = (F.col(key) if isinstance(key, str) else key).cast("string")
    return F.md5((F.concat(F.lit(seed), text) if seed else text).cast("binary"))


def bottom_k(df: DataFrame, key: str, k: int, by: list[str] | None = None, seed: str = "") -> DataFrame:
    """The k rows of least hash of key, of all or of each group `by`; ties (equal keys) by the rows' other columns in order.

    Each task keeps the k least it has seen, so a hot group sends no more than that (to the engine's limit of 1000 for groups; beyond, groups are sorted where they meet).
    The k least of a union are among the k least of its parts: samples that were stored are merged by drawing from them again.
    """
    order = [hash_of(key, seed), *[F.col(c) for c in df.columns if c != key and not df.schema[c].dataType.simpleString().startswith("map")]]
    rows = df.where(F.col(key).isNotNull())
    if not by:
        return rows.orderBy(*order).limit(k)
    return rows.withColumn("__rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("__rank") <= k).drop("__rank")


def url_sample(items: DataFrame, k: int, seed: str = "") -> DataFrame:
    """(k_iri, v_edm_isShownBy) of k items with an address, drawn by hash: what a prober takes."""
    return bottom_k(items.where(F.col("v_edm_isShownBy").isNotNull()).select("k_iri", "v_edm_isShownBy"), "v_edm_isShownBy", k, seed=seed)
