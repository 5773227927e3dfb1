"""Harmonic packing of token sequences.

A document's ids are cut into full sequences and, for the rest, into pieces of
reciprocal sizes capacity // k for k up to FINEST, the largest that fits first; the last few
ids (less than the smallest such size) form one more piece. A piece belongs to the class
k = capacity // length, and each sequence of class k takes exactly k pieces, so that each
class fills its sequences alone: the number of a piece within its class decides its
sequence, whichever worker made it. What doesn't fill the last sequence of a class, fewer than
k pieces, is packed first-fit by falling length, in groups of about GROUP pieces; those pieces are at
most the sum of k - 1 over the classes, a bound that doesn't depend on the data.
"""

from __future__ import annotations

from collections import Counter as Tally
from collections.abc import Iterator
from zlib import crc32

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import saved, slices, text_of
from .tokens import default_vocabulary, encoder, for_task

#: The smallest regular piece is capacity // FINEST.
FINEST = 32
#: Pieces that no class takes are packed in groups of so many.
GROUP = 400
END_ID = 1


def cuts(length: int, capacity: int) -> list[tuple[int, int, int]]:
    """(start, length, class) of the pieces of a document, in order."""
    out, start = [], 0
    while start < length:
        left = length - start
        k = 1 if left >= capacity else -(-capacity // left)
        while k <= FINEST and capacity // k > left:
            k += 1
        size = capacity // k if k <= FINEST and capacity // k else left
        out.append((start, size, capacity // size))
        start += size
    return out


def first_fit(lengths: list[int], capacity: int) -> list[tuple[int, int]]:
    """(sequence, offset) of pieces given by falling length."""
    filled: list[int] = []
    out = []
    for n in lengths:
        at = next((i for i, x in enumerate(filled) if x + n <= capacity), len(filled))
        if at == len(filled):
            filled.append(0)
        out.append((at, filled[at]))
        filled[at] += n
    return out


def pieces(df: DataFrame, id_col: str, text_col: str, capacity: int, vocabulary: str) -> DataFrame:
    """The pieces of all documents; (part, at) numbers those of a class within the task that cut them."""
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        part, made, model = TaskContext.get().partitionId(), Tally(), encoder(vocabulary)
        end, names = END_ID.to_bytes(4, "little"), [id_col, "start", "length", "ids_crc32", "doc_tokens", "class", "part", "at"]
        with for_task():
            for batch in (x for whole in batches for x in slices(whole)):
                rows: list[tuple] = []
                for i, found in enumerate(model.many(batch.column(1))):
                    ids = memoryview(found.tobytes() + end)
                    for start, size, k in cuts(len(ids) // 4, capacity):
                        rows.append((i, start, size, crc32(ids[4 * start : 4 * (start + size)]), len(ids) // 4, k, part, made[k]))
                        made[k] += 1
                doc, *rest = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(doc, pa.int64())), *(pa.array(x, pa.int64()) for x in rest)], names=names)

    return df.select(F.col(id_col), text_of(text_col).alias("text")).mapInArrow(run, f"`{id_col}` {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, class bigint, part bigint, at bigint")


def pack(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 2048, vocabulary: str | None = None) -> DataFrame:
    """Packs all documents into sequences of at most `capacity` tokens; one row per piece.

    Returns (id, start, length, ids_crc32, doc_tokens, sequence_id, offset); numbers of sequences may have
    gaps at the end. A null or empty text is one piece, its end id. A text of any length is encoded whole and cut into pieces. Repeated rows are packed each; ids may be null or
    repeat, as no step looks rows up by them. Other columns take no part, whatever their
    names. An empty table gives an empty result. Only one sequence in all, or
    a few, is not filled by a whole class.
    """
    p = saved(pieces(df, id_col, text_col, capacity, vocabulary or default_vocabulary()), "pieces")
    by_class = Window.partitionBy("class")
    # One row for each task and class: where the task's pieces begin in the class, and how many the class has.
    counts = p.groupBy("class", "part").agg(F.max("at").alias("n")).withColumn("n", F.col("n") + 1)
    counts = saved(counts.withColumn("before", F.sum("n").over(by_class.orderBy("part")) - F.col("n")).withColumn("all", F.sum("n").over(by_class)), "piece-counts", max(1, p.rdd.getNumPartitions()))
    k = F.col("class")
    firsts = counts.select("class", F.floor(F.col("all") / k).alias("full"), (F.col("all") % k).alias("over")).distinct()
    firsts = firsts.withColumn("first", F.sum("full").over(Window.orderBy("class")) - F.col("full"))  # a row per class, at most 100
    total, left = firsts.agg(F.coalesce(F.sum("full"), F.lit(0)), F.coalesce(F.sum("over"), F.lit(0))).first()
    groups = max(1, left // GROUP)
    where = counts.join(F.broadcast(firsts), "class").select("class", "part", "before", "full", "first")
    placed = p.join(where, ["class", "part"]).withColumn("rank", F.col("before") + F.col("at"))
    whole, names = F.col("rank") < F.col("full") * k, [id_col, "start", "length", "ids_crc32", "doc_tokens"]
    turn = F.col("rank") % k
    # Pieces of a class differ in length only below the regular sizes, each length then being its own class but for
    # the shortest classes' neighbours; offsets step by the class's largest length, and are closed up below.
    regular = placed.where(whole).withColumn("sequence_id", F.col("first") + F.floor(F.col("rank") / k))
    step = Window.partitionBy("sequence_id").orderBy("turn")
    regular = regular.withColumn("turn", turn).withColumn("offset", F.sum("length").over(step) - F.col("length"))

    def rest(table):
        import pandas as pd

        t = table.sort_values(["length", "class", "rank"], ascending=[False, True, True])
        spots = first_fit(t["length"].tolist(), capacity)
        out = t[names].copy()
        # Groups number their sequences in turn, so that no two share a number.
        out["sequence_id"] = pd.Series([total + groups * x + int(t["group"].iloc[0]) for x, _ in spots], index=t.index, dtype="int64")
        out["offset"] = pd.Series([y for _, y in spots], index=t.index, dtype="int64")
        return out

    kind = df.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
    dealt = placed.where(~whole).withColumn("group", F.pmod(F.xxhash64("class", "rank"), F.lit(groups)))
    last = dealt.groupBy("group").applyInPandas(rest, schema)
    return regular.select(*names, "sequence_id", "offset").unionByName(last)
