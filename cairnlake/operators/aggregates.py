"""Aggregation patterns that the questions share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def percent(part: Column, whole: Column) -> Column:
    """part of whole in per cent, two decimals; null for nothing."""
    return F.round(part.cast("double") * 100.0 / F.nullif(whole.cast("double"), F.lit(0.0)), 2)


def with_share(df: DataFrame, count: str, name: str = "pct") -> DataFrame:
    """Share of each row's count in the sum over all rows; df has a row per group, few by then."""
    return df.withColumn(name, percent(F.col(count), F.sum(count).over(Window.partitionBy())))


def ranking(df: DataFrame, by: dict[str, Column], count: str, share: str | None = "pct", limit: int | None = None, more: dict[str, Column] | None = None) -> DataFrame:
    """Rows of each group counted, largest first, ties in the order of the keys; the share is of all groups, before the limit."""
    out = df.groupBy(*[c.alias(n) for n, c in by.items()]).agg(F.count("*").alias(count), *[c.alias(n) for n, c in (more or {}).items()])
    if share:
        out = with_share(out, count, share)
    return top(out, count, list(by), limit)


def top(df: DataFrame, count: str, keys: list[str], limit: int | None = None) -> DataFrame:
    out = df.orderBy(F.desc(count), *[F.col(k).asc_nulls_last() for k in keys])
    return out.limit(limit) if limit else out


def histogram(df: DataFrame, label: Column, key: Column, name: str, count: str, share: str = "pct") -> DataFrame:
    """Rows per bucket in bucket order, with shares."""
    rows = df.select(label.alias(name), key.alias("__key")).groupBy(name, "__key").agg(F.count("*").alias(count))
    return with_share(rows, count, share).orderBy("__key").drop("__key")


def count_distinct_if(test: Column, value: Column) -> Column:
    return F.count_distinct(F.when(test, value))


def flagged(df: DataFrame, key: str, **sets: DataFrame) -> DataFrame:
    """df with a boolean column for each named set (its first column) that says whether the key is in it; duplicates in a set do no harm."""
    for name, other in sets.items():
        column = other.columns[0]
        marks = other.select(F.col(column).alias(f"__{name}")).distinct().withColumn(name, F.lit(True))
        df = df.join(marks, df[key] == marks[f"__{name}"], "left").withColumn(name, F.coalesce(name, F.lit(False))).drop(f"__{name}")
    return df


def low_cardinality(df: DataFrame, columns: list[str], most: int = 10) -> dict[str, bool]:
    """Whether a column has at most `most` different values: one probe each, which ends early."""
    return {c: df.select(c).distinct().limit(most + 1).count() <= most for c in columns}
