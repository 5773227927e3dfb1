"""The corpus pipeline: toxicity, line dedup, near-dedup, decontamination, packing.

Every stage takes null texts, null, repeated and unordered ids and empty tables, and judges whole texts; all
but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnlake.llm import decontaminate, linededup, neardup, packing, toxicity
from cairnlake.llm.common import drop_saved, fresh_path, scratch

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.7; a null text counts as empty.

    The model learns from all labelled documents of sf_dir, those that op2 holds out too.
    """
    labels, source = spark.read.parquet(f"{sf_dir}/labels.parquet"), spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = toxicity.train(source, labels)
    return toxicity.keep_below(docs, model, 0.7)


def without_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that their source repeats; n_chars is the new length where lines went. Null texts stay null."""
    out = linededup.drop_boilerplate(docs)
    changed = F.when(F.col("__cl_dropped") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", changed).select(*docs.columns)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one of least id. Texts without words are no duplicates; null ids stay."""
    return neardup.deduplicated(docs)


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap with no benchmark item. Texts without words stay."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens, a row for each piece; a null or empty text is one piece of one id."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("line dedup", without_boilerplate),
    ("near-dedup", without_copies),
    ("decontamination", without_leaks),
    ("packing", packed),
]

#: Learned scores, MinHash and a tokenizer have no form in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over documents, each written to the shared folder and read again.

    What a stage saves on its way goes with it, and its result goes once the next one is written; the last result stays and is the caller's. Tables of other results aren't touched.
    """
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in STAGES:
        path = fresh_path(spark, "pipeline-" + name.replace(" ", "-"))
        try:
            with scratch(spark):
                stage(spark, docs, sf_dir).write.parquet(path)
        except BaseException:
            drop_saved(spark, [*last, path])
            raise
        drop_saved(spark, last)
        docs, last = spark.read.parquet(path), [path]
    return docs
