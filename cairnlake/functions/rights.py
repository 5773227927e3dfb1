"""Rights statements: reuse level, family, label and openness of a rights URI, as Column expressions."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Namespaces, families and labels of rights statements.
CC_LICENSE = "http://creativecommons.org/licenses/"
CC_PUBLIC_DOMAIN = "http://creativecommons.org/publicdomain/"
RIGHTS_STATEMENTS = "http://rightsstatements.org/vocab/"
OPEN_LICENSES = ("by", "by-sa")
RESTRICTED_STATEMENTS = ("NoC-NC", "NoC-OKLR", "InC-EDU")
PROHIBITED_STATEMENTS = ("InC", "InC-OW-EU", "CNE")
LICENSE_FAMILY = {
    "by-nc-nd": "cc-by-nc-nd",
    "by-nd-nc": "cc-by-nc-nd",
    "by-nc-sa": "cc-by-nc-sa",
    "by-nc": "cc-by-nc",
    "by-nd": "cc-by-nd",
    "by-sa": "cc-by-sa",
    "by": "cc-by",
}
TOOL_FAMILY = {"zero": "cc0", "mark": "pdm"}
STATEMENT_FAMILY = {
    "InC": "rs-inc",
    "InC-EDU": "rs-inc",
    "InC-OW-EU": "rs-inc",
    "NoC-NC": "rs-noc",
    "NoC-OKLR": "rs-noc",
    "CNE": "cnb",
    "NKC": "rs-other",
    "UND": "rs-other",
}
FAMILY_LABEL = {
    "cc0": "Public Domain Dedication (CC0)",
    "pdm": "Public Domain Mark",
    "cc-by": "Attribution (CC BY)",
    "cc-by-sa": "Attribution-ShareAlike (CC BY-SA)",
    "cc-by-nd": "Attribution-NoDerivs (CC BY-ND)",
    "cc-by-nc": "Attribution-NonCommercial (CC BY-NC)",
    "cc-by-nc-sa": "Attribution-NonCommercial-ShareAlike (CC BY-NC-SA)",
    "cc-by-nc-nd": "Attribution-NonCommercial-NoDerivs (CC BY-NC-ND)",
    "rs-inc": "In Copyright (RightsStatements.org)",
    "rs-noc": "No Copyright — Non-Commercial Use Only (RightsStatements.org)",
    "rs-other": "RightsStatements.org (other)",
    "cnb": "Copyright Not Evaluated / Non-Commercial Basis",
}

# What the namespace leaves of a URI decides everything: its first step, and for statements all of it.


def _step(uri: Column, namespace: str) -> Column:
    """The path step after a namespace, null if the URI lies elsewhere or the step isn't closed by a slash."""
    tail = F.substring(uri, len(namespace) + 1, 1 << 20)
    return F.when(uri.startswith(namespace) & tail.contains("/"), F.split_part(tail, F.lit("/"), F.lit(1)))


def _statement(uri: Column) -> Column:
    """The name of a version 1.0 statement, null for any other URI."""
    name = F.regexp_extract(uri, "^" + RIGHTS_STATEMENTS.replace(".", r"\.") + "([^/]+)/1\\.0/$", 1)
    return F.when(name != "", name)


def _lookup(key: Column, table: dict[str, str]) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), key)


def is_open(uri: Column) -> Column:
    """True for public-domain tools and the licences by and by-sa; a null URI is not open."""
    tests = [uri.startswith(CC_PUBLIC_DOMAIN), *(uri.startswith(f"{CC_LICENSE}{x}/") for x in OPEN_LICENSES)]
    return F.coalesce(reduce(or_, tests), F.lit(False))


def reuse_level(uri: Column) -> Column:
    """'open', 'restricted' or 'prohibited'; null and unknown URIs are prohibited."""
    restricted = uri.startswith(CC_LICENSE) | F.coalesce(_statement(uri).isin(*RESTRICTED_STATEMENTS), F.lit(False))
    return F.when(is_open(uri), "open").when(restricted, "restricted").otherwise("prohibited")


def rights_family(uri: Column) -> Column:
    """Family code of a rights URI, 'unknown' where none applies."""
    return F.coalesce(
        _lookup(_step(uri, CC_PUBLIC_DOMAIN), TOOL_FAMILY),
        _lookup(_step(uri, CC_LICENSE), LICENSE_FAMILY),
        _lookup(_statement(uri), STATEMENT_FAMILY),
        F.when(uri.startswith(RIGHTS_STATEMENTS), "rs-other"),
        F.lit("unknown"),
    )


def rights_label(uri: Column) -> Column:
    """Label of a rights URI, without version or port; 'Unknown' for others, also for statements without an entry."""
    named = {k: FAMILY_LABEL[v] for k, v in STATEMENT_FAMILY.items()}
    return F.coalesce(
        _lookup(_statement(uri), named),
        _lookup(_step(uri, CC_PUBLIC_DOMAIN), {k: FAMILY_LABEL[v] for k, v in TOOL_FAMILY.items()}),
        _lookup(_step(uri, CC_LICENSE), {k: FAMILY_LABEL[v] for k, v in LICENSE_FAMILY.items()}),
        F.lit("Unknown"),
    )


def full_label(uri: Column) -> Column:
    """The label with the version of a licence or tool and, in brackets, the port of a licence: Attribution (CC BY) 3.0 (AU)."""
    licence, tool = (F.split(F.rtrim(F.substring(uri, len(n) + 1, 1 << 20), F.lit("/")), "/") for n in (CC_LICENSE, CC_PUBLIC_DOMAIN))
    port = F.coalesce(F.concat(F.lit(" ("), F.upper(F.get(licence, F.lit(2))), F.lit(")")), F.lit(""))
    version = lambda steps: F.coalesce(F.concat(F.lit(" "), F.get(steps, F.lit(1))), F.lit(""))
    tail = F.when(uri.startswith(CC_LICENSE), F.concat(version(licence), port)).when(uri.startswith(CC_PUBLIC_DOMAIN), version(tool)).otherwise("")
    return F.concat(rights_label(uri), F.coalesce(tail, F.lit("")))


def rights_identifier(uri: Column) -> Column:
    """Short name such as CC-BY-SA-3.0-AU, CC-PD-ZERO-1.0 or InC-1.0; 'Other' for any other URI."""

    def tail(namespace: str) -> Column:
        rest = F.substring(uri, len(namespace) + 1, 1 << 20)
        return F.when(uri.startswith(namespace), F.replace(F.rtrim(rest, F.lit("/")), F.lit("/"), F.lit("-")))

    upper = lambda x, lead: F.concat(F.lit(lead), F.upper(tail(x)))
    return F.coalesce(upper(CC_LICENSE, "CC-"), upper(CC_PUBLIC_DOMAIN, "CC-PD-"), tail(RIGHTS_STATEMENTS), F.lit("Other"))


def rights_registry(spark: SparkSession, versions: dict[str, list[str | None]]) -> DataFrame:
    """(uri, identifier, reuse_level, family, is_open, label, full_label) of every licence, version and port given, tool and statement.

    versions maps a licence version to its ports, None for the international text.
    """
    licences = [x for x in LICENSE_FAMILY if x != "by-nd-nc"]
    uris = [f"{CC_LICENSE}{'by-nd-nc' if v == '1.0' and x == 'by-nc-nd' else x}/{v}/" + (f"{p}/" if p else "") for v, ports in versions.items() for x in licences for p in ports]
    uris += [f"{CC_PUBLIC_DOMAIN}{x}/1.0/" for x in TOOL_FAMILY]
    uris += [f"{RIGHTS_STATEMENTS}{x}/1.0/" for x in (*RESTRICTED_STATEMENTS, *PROHIBITED_STATEMENTS)]
    u = F.col("uri")
    return spark.createDataFrame([(x,) for x in uris], "uri string").select("uri", rights_identifier(u).alias("identifier"), reuse_level(u).alias("reuse_level"), rights_family(u).alias("family"), is_open(u).alias("is_open"), rights_label(u).alias("label"), full_label(u).alias("full_label"))
