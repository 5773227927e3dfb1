"""Text search by an inverted index: all words, beginnings of words, and phrases, with scores.

The index has a row for each word of a text, with its places. It is stored in segments, each of which has the words of some texts, sorted by word: a search
reads the pages of its words alone, by the statistics that Parquet keeps. A text's words are put together in its row, so that texts are dealt out
once and postings never. Texts that hold all words are found by counting which of them each text has, so a frequent word costs its rows and
no join of texts with texts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import partitions_for

WORD = r"[\p{L}\p{N}]+"
#: Bytes of the texts' files for a segment of the index, which one task sorts in memory.
SEGMENT = 8 << 20


def words_of(text: Column) -> Column:
    """The words of a text in lower case, in order; none of a null text."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def postings(df: DataFrame, key: str, text: str) -> DataFrame:
    """(term, key, n, places) of every word of every text: how often it stands there and where, from 0. A row is a text: give unique keys.

    A text's words are sorted with their places, so that equal words stand together, and cut where another word begins: no row leaves its task.
    """
    each = df.where(F.col(key).isNotNull()).select(F.col(key).alias("key"), F.sort_array(F.transform(words_of(F.col(text)), lambda w, i: F.struct(w.alias("term"), i.alias("place")))).alias("words"))
    begins = F.transform("words", lambda w, i: F.when((i == 0) | (w["term"] != F.get("words", i - 1)["term"]), i))
    each = each.select("key", F.array_compact(begins).alias("begins"), F.col("words.term").alias("terms"), F.col("words.place").alias("places"))

    def posting(begin: Column, i: Column) -> Column:
        n = F.coalesce(F.get("begins", i + 1), F.size("terms")) - begin
        return F.struct(F.get("terms", begin).alias("term"), n.cast("bigint").alias("n"), F.slice("places", begin + 1, n).alias("places"))

    return each.select("key", F.explode(F.transform("begins", posting)).alias("posting")).select("posting.term", "key", "posting.n", "posting.places")


class TextIndex:
    """An index that is stored at a path: postings in segments of texts, and for each word the number of texts that have it."""

    def __init__(self, spark: SparkSession, path: str):
        self.postings, self.terms, self.size = spark.read.parquet(f"{path}/postings"), spark.read.parquet(f"{path}/terms"), spark.read.parquet(f"{path}/size")

    @classmethod
    def build(cls, df: DataFrame, key: str, text: str, path: str) -> TextIndex:
        spark = df.sparkSession
        dealt = df.select(key, text).repartition(partitions_for(df, each=SEGMENT), key)
        postings(dealt, key, text).sortWithinPartitions("term", "key").write.parquet(f"{path}/postings")
        made = spark.read.parquet(f"{path}/postings")
        made.groupBy("term").agg(F.count("*").alias("texts")).sortWithinPartitions("term").write.parquet(f"{path}/terms")
        df.where(F.col(key).isNotNull()).agg(F.count("*").alias("texts")).write.parquet(f"{path}/size")
        return cls(spark, path)

    @staticmethod
    def _test(word: str) -> Column:
        """word itself, or all that begins with it if it ends with *; both reach the scan as comparisons."""
        term = F.col("term")
        return term.startswith(word[:-1].lower()) if word.endswith("*") else term == word.lower()

    def _found(self, words: list[str]) -> DataFrame:
        """Postings of the words, with their slot in the query and the number of texts that have one of the slot's terms."""
        tests = [self._test(w) for w in words]
        any_of = reduce(lambda a, b: a | b, tests)
        slots = F.explode(F.array_compact(F.array(*[F.when(t, F.lit(i)) for i, t in enumerate(tests)])))
        return self.postings.where(any_of).withColumn("slot", slots)

    def search(self, query: str) -> DataFrame:
        """(key, matches, score) of the texts that have all words of a query; word* stands for every word that begins so.

        matches counts the places of all words. score adds, over the query's words, places * ln(1 + texts / texts that have the word); a
        beginning counts each text once. A query without words finds nothing.
        """
        words = list(dict.fromkeys(w.lower() for w in query.split() if w.strip("*")))
        if not words:
            return self.postings.select("key", F.lit(0).cast("bigint").alias("matches"), F.lit(0.0).alias("score")).where("false")
        found = self._found(words).groupBy("key", "slot").agg(F.sum("n").alias("n"))
        texts = found.groupBy("slot").agg(F.count("*").alias("texts"))  # a row for each word of the query
        every = self.size.first()["texts"]
        weighted = found.join(F.broadcast(texts), "slot").withColumn("part", F.col("n") * F.log(1 + every / F.col("texts")))
        return weighted.groupBy("key").agg(F.count("*").alias("slots"), F.sum("n").alias("matches"), F.sum("part").alias("score")).where(F.col("slots") == len(words)).select("key", "matches", "score")

    def phrase(self, query: str) -> DataFrame:
        """(key, matches) of the texts in which the words of a query follow each other, and how often; beginnings as in search()."""
        words = [w.lower() for w in query.split() if w.strip("*")]
        if not words:
            return self.postings.select("key", F.lit(0).cast("bigint").alias("matches")).where("false")
        found = self._found(words).groupBy("key").agg(F.collect_list(F.struct("slot", "places")).alias("found"))

        def starts(slot: int) -> Column:
            """Where the phrase begins if its word of this slot stands where it was found."""
            own = F.filter("found", lambda x: x["slot"] == slot)
            return F.transform(F.flatten(F.transform(own, lambda x: x["places"])), lambda place: place - slot)

        whole = reduce(F.array_intersect, [starts(i) for i in range(len(words))])
        return found.select("key", F.size(F.array_distinct(whole)).cast("bigint").alias("matches")).where(F.col("matches") > 0)
