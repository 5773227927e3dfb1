"""Expressions over single item columns: tiers, proxies, newspaper and specimen flags, MIME families, labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Identifiers in the source data.
NEWSPAPER_DATASETS = ("9200300", "9200301", "9200338", "9200339", "9200355", "9200356", "9200357", "9200396")
OPENUP_PROVIDERS = ("http://data.europeana.eu/organization/1609", "http://data.europeana.eu/organization/1482250000004671150")
NEWSPAPER_CONCEPT = "http://data.europeana.eu/concept/18"
SPECIMEN_CONCEPT = "http://data.europeana.eu/concept/167"


def is_provider(flag: Column) -> Column:
    """A proxy is the provider's unless it is flagged 'true'; a null flag is the provider's."""
    return flag.isNull() | (flag != "true")


def proxy_type(flag: Column) -> Column:
    return F.when(is_provider(flag), "provider").otherwise("europeana")


def content_tier(uri: Column) -> Column:
    """Digit at the end of a content-tier URI as int, null otherwise."""
    return F.nullif(F.regexp_extract(uri, "contentTier([0-9])$", 1), F.lit("")).try_cast("int")


def metadata_tier(uri: Column) -> Column:
    """0, A, B or C at the end of a metadata-tier URI, null otherwise."""
    return F.nullif(F.regexp_extract(uri, "metadataTier([0A-C])$", 1), F.lit(""))


def is_newspaper(dataset: Column, part_of_news: Column, news_concept: Column) -> Column:
    """True if any sign says newspaper: collection, concept, dataset name or dataset number; never null."""
    signs = [part_of_news, news_concept, F.lower(dataset).contains("newspaper"), F.split_part(dataset, F.lit("_"), F.lit(1)).isin(*NEWSPAPER_DATASETS)]
    return F.greatest(*[F.coalesce(x, F.lit(False)) for x in signs])


def in_openup(provider: Column) -> Column:
    """Null for a null provider."""
    return provider.isin(*OPENUP_PROVIDERS)


def mime_family(mime: Column) -> Column:
    """Part of a MIME type before the slash; 'unknown' for null, 'malformed' without a slash."""
    return F.when(mime.isNull(), "unknown").when(F.instr(mime, "/") == 0, "malformed").otherwise(F.split_part(mime, F.lit("/"), F.lit(1)))


def bucket(value: Column, steps: list[tuple[float | None, str]]) -> tuple[Column, Column]:
    """(label, sort key) of a value by upper limits: the first step whose limit is above it; limit None takes the rest.

    A null value falls into the last step, as no comparison holds for it.
    """
    label = key = None
    for i, (limit, name) in enumerate(steps, 1):
        if limit is None:
            return (label.otherwise(name), key.otherwise(i)) if label is not None else (F.lit(name), F.lit(i))
        test = value < limit
        label = F.when(test, name) if label is None else label.when(test, name)
        key = F.when(test, i) if key is None else key.when(test, i)
    return label, key


def preferred_labels(labels: DataFrame, key: str, label: str, lang: str, main: str = "en") -> DataFrame:
    """(key, label): one label for each key, main language before untagged before any other; ties to the least language and label.

    Null labels are no labels; a key without any is absent.
    """
    tag = F.coalesce(F.col(lang), F.lit(""))
    order = F.struct(F.when(tag == main, 0).when(tag == "", 1).otherwise(2), tag, F.col(label))
    return labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(key).agg(F.min_by(F.col(label), order).alias("label"))


def main_or_greatest_label(labels: DataFrame, key: str, label: str, lang: str, main: str = "en") -> DataFrame:
    """(key, label): the greatest label of the main language, else the greatest of all."""
    return labels.groupBy(key).agg(F.coalesce(F.max(F.when(F.col(lang) == main, F.col(label))), F.max(label)).alias("label"))
