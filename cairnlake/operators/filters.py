"""Filters on items: a small text form, and the explorer's JSON form, both as a Column."""

from __future__ import annotations

import re
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Short name: cube column.
ALIASES = {
    "country": "v_edm_country",
    "type": "v_edm_type",
    "provider": "v_edm_provider",
    "data_provider": "v_edm_dataProvider",
    "dataset": "v_edm_datasetName",
    "language": "x_primary_language",
    "reuse_level": "x_reuse_level",
    "rights_family": "x_rights_family",
    "content_tier": "x_content_tier",
    "metadata_tier": "x_metadata_tier",
    "has_content_url": "x_has_content_url",
    "has_creator": "x_has_creator",
    "has_description": "x_has_description",
    "has_iiif": "x_has_iiif",
    "has_subject": "x_has_subject",
    "has_pdf": "x_has_pdf",
    "title_languages": "x_title_languages",
    "pdf_count": "x_pdf_count",
    "web_resources": "x_web_resource_count",
    "newspaper": "x_is_newspaper",
    "specimen": "x_is_specimen",
}
TERM = re.compile(r"(?P<name>\w+)(?:(?P<op>>=|<=|!=|=|>|<)(?P<value>\"[^\"]*\"|\S+))?$")
WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _value(text: str, kind: T.DataType, name: str) -> Column:
    if isinstance(kind, T.BooleanType):
        if text.lower() not in {"true", "false"}:
            raise ValueError(f"{name} is true or false, not {text}")
        return F.lit(text.lower() == "true")
    if isinstance(kind, (*WHOLE, T.FloatType, T.DoubleType, T.DecimalType)):
        return F.lit(int(text) if isinstance(kind, WHOLE) else float(text))
    return F.lit(text)


def parse(text: str, schema: T.StructType, aliases: dict[str, str] = ALIASES) -> Column | None:
    """A Column from terms between spaces, all of which must hold; None for no term.

    country=NL,FR means one of them; country!=NL not it (nulls kept out, as in SQL); has_iiif means true; content_tier>=3
    compares. Values with spaces stand in double quotes. An unknown name, a value of the wrong
    kind or a bare name that isn't boolean is an error.
    """
    tests: list[Column] = []
    for term in re.findall(r"(?:[^\s\"]|\"[^\"]*\")+", text):
        if not (m := TERM.match(term)):
            raise ValueError(f"not a filter: {term}")
        name = aliases.get(m["name"], m["name"])
        if name not in schema.fieldNames():
            raise ValueError(f"no field {m['name']}")
        kind, c = schema[name].dataType, F.col(name)
        if m["op"] is None:
            if not isinstance(kind, T.BooleanType):
                raise ValueError(f"{m['name']} needs a value")
            tests.append(c)
            continue
        value = m["value"].strip('"')
        if m["op"] in {"=", "!="}:
            values = [_value(v, kind, m["name"]) for v in (value.split(",") if m["value"][:1] != '"' else [value])]
            one = reduce(lambda a, b: a | b, [c == v for v in values])
            tests.append(one if m["op"] == "=" else ~one)
        else:
            v = _value(value, kind, m["name"])
            tests.append({">=": c >= v, "<=": c <= v, ">": c > v, "<": c < v}[m["op"]])
    return reduce(and_, tests) if tests else None


def linked_to_all(edges: DataFrame, values: list[str], prop: str | None = None, item: str = "k_iri_cho", entity: str = "k_iri_entity") -> DataFrame:
    """Relational division: items that are linked to every one of the values, by the given property if any."""
    values = list(dict.fromkeys(values))
    found = edges.where(F.col(entity).isin(values))
    if prop:
        found = found.where(F.col("x_property") == prop)
    return found.groupBy(item).agg(F.count_distinct(entity).alias("n")).where(F.col("n") == len(values)).select(item)
