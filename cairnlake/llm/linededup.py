"""Line dedup by site-relative frequency.

Documents are pages of a site (the host column). For each site and line, the pages that contain the line
are divided by the site's pages; a line whose share exceeds the boilerplate ratio, on
MIN_PAGES pages at least, is dropped wherever the site has it. Only DataFrame functions are used.

Pages of equal text count once for a line, so that copies of a text don't make its lines boilerplate; the total is of all pages.

A page with L different lines adds to L counts, so a site has at most (mean lines per page) / ratio
boilerplate lines: they are few whatever the site's size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved

RATIO, MIN_PAGES = 0.02, 5
#: Up to so many boilerplate lines in all (24 bytes each and the host) go to every executor; more are joined by shuffle,
#: a site's pages dealt over SALTS tasks and its list copied to each.
BROADCAST_LINES, SALTS = 200_000, 64


def url_host(url: Column) -> Column:
    """Host of a URL in lower case, '' where there is none."""
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))


def line_key(line: Column) -> Column:
    """96 bits that stand for a trimmed line."""
    return F.struct(F.xxhash64(line).alias("a"), F.hash(line).alias("b"))


def keys_of(text: Column) -> Column:
    """The key of each line, null for blank lines."""
    return F.transform(F.split(text, "\n"), lambda x: F.when(F.trim(x) != "", line_key(F.trim(x))))


def boilerplate(df: DataFrame, host: Column, text: Column, ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, line, pages, share) of the lines over the ratio; line is the key of the trimmed line, pages the number of different texts that hold it.

    A null host is a site of its own; every row is a page of its site, repeated rows too.
    """
    pages = df.select(host.alias("host"), text.alias("text"))
    lines = pages.select("host", F.explode(F.array_distinct(F.filter(keys_of(F.col("text")), lambda k: k.isNotNull()))).alias("line"))
    counts = lines.groupBy("host", "line").agg(F.count("*").alias("pages")).where(F.col("pages") >= min_pages)
    totals = pages.groupBy("host").agg(F.count("*").alias("total"))  # a row per site
    both = counts.join(totals, counts["host"].eqNullSafe(totals["host"])).select(site(counts["host"]).alias("site"), counts["host"], "line", "pages", "total")
    # Different texts are counted for the few lines that are over the ratio with all pages.
    often = saved(both.where(F.col("pages") / F.col("total") > ratio), "often").drop("pages")
    share = F.col("pages") / F.col("total")
    found = often.join(texts_with(pages, often.select("site", "line")), ["site", "line"]).withColumn("share", share)
    return found.where((F.col("pages") >= min_pages) & (F.col("share") > ratio)).select("host", "line", "pages", "share")


def site(host: Column) -> Column:
    """The host as a key that is never null."""
    return F.coalesce(F.concat(F.lit("h"), host), F.lit("n"))


def with_lists(rows: DataFrame, text: Column, sites: DataFrame, few: bool, how: str) -> DataFrame:
    """rows (with site) joined with the sites' lists, so that no task gets all pages of a site."""
    if few:
        return rows.join(F.broadcast(sites), "site", how)
    # Copies of a text in different input partitions go to different tasks.
    rows = rows.withColumn("salt", F.pmod(F.xxhash64(text) + F.spark_partition_id(), F.lit(SALTS)).cast("int"))
    dealt = sites.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.join(dealt, ["site", "salt"], how)


def texts_with(pages: DataFrame, often: DataFrame) -> DataFrame:
    """(site, line, pages) of the lines in often: different texts of (host, text) that hold them."""
    sites = often.groupBy("site").agg(F.collect_list("line").alias("bad"))  # bounded for each site, see above
    rows = with_lists(pages.select(site(F.col("host")).alias("site"), "text"), F.col("text"), sites, often.count() <= BROADCAST_LINES, "inner")
    held = F.array_distinct(F.filter(keys_of(F.col("text")), lambda k: k.isNotNull() & F.array_contains("bad", k)))
    rows = rows.select("site", line_key(F.col("text")).alias("page"), F.explode(held).alias("line"))
    return rows.distinct().groupBy("site", "line").agg(F.count("*").alias("pages"))


def drop_boilerplate(df: DataFrame, host_col: str = "source", text_col: str = "text", ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """df with each site's boilerplate lines taken out of text_col, plus __cl_lines and __cl_dropped (lines before, lines dropped).

    All rows and columns stay, whatever their names; only columns of those two names are replaced. Blank lines stay;
    a null text stays null (0 lines); a text left with no line is empty. Lines are compared without the spaces around
    them, whole, however long, and their order is kept. Repeated rows are pages each. An empty table gives an empty result.
    """
    host, text = F.col(host_col).cast("string"), F.col(text_col).cast("string")
    found = saved(boilerplate(df, host, text, ratio, min_pages).select("host", "line"), "boilerplate")
    sites = found.groupBy("host").agg(F.collect_list("line").alias("bad")).select(site(F.col("host")).alias("site"), "bad")  # bounded for each site, see above
    # The columns of df travel in one, so that their names meet no other.
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), site(host).alias("site"))
    text = F.col("row").getField(text_col).cast("string")
    rows = with_lists(rows, text, sites, found.count() <= BROADCAST_LINES, "left")
    lines = F.split(text, "\n")
    bad = lambda x: F.array_contains("bad", line_key(F.trim(x)))
    kept = F.when(F.col("bad").isNull(), lines).otherwise(F.filter(lines, lambda x: (F.trim(x) == "") | ~bad(x)))
    size = lambda x: F.when(text.isNull(), 0).otherwise(F.size(x)).cast("bigint")
    rows = rows.withColumn("kept", kept).withColumn("before", size(lines)).withColumn("dropped", F.col("before") - size(F.col("kept")))
    left = F.when(F.col("dropped") > 0, F.array_join("kept", "\n")).otherwise(text)
    own = [left.alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in df.columns if c not in ("__cl_lines", "__cl_dropped")]
    return rows.select(*own, F.col("before").alias("__cl_lines"), F.col("dropped").alias("__cl_dropped"))
