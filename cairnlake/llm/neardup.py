"""Near-duplicate documents by b-bit MinHash, confirmed on full shingle sets.

1. A document's set of word shingles gives HASHES minima. Bands of ROWS minima are the
   keys of candidate buckets; of each minimum the low BITS bits stay, packed into 64-bit words.
2. Documents with equal sets become one node, known by its least id.
3. In every bucket each node meets the bucket's leader, the node of least hash with the
   bucket's key; leaders differ from band to band, so a group of copies is tied together by a few
   links per node instead of all pairs.
4. Where a bucket then still holds several components, all nodes outside its largest
   component meet all nodes of other components.
5. A pair that met is kept if the similarity estimated from its packed bits, corrected for chance agreement
   (BITS equal bits by accident), isn't SIGMAS standard errors below the threshold, and is then confirmed
   on the full sets. Confirmed links give the components.

A pair of similarity s shares a band with probability 1 - (1 - s**ROWS)**(HASHES / ROWS):
0.99999998 at 0.85, 0.999997 at 0.8.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved, slices, text_of
from .components import components

WORDS, HASHES, ROWS, BITS, SIGMAS = 5, 96, 4, 4, 5.0


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit integers over all bits."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Shingles:
    """set_of(text): the hashes of a text's distinct word shingles, ascending."""

    def __init__(self, words: int = WORDS):
        import xxhash

        self.words, self.hash = words, xxhash.xxh3_64_intdigest

    def set_of(self, text: str) -> np.ndarray:
        # On bytes, lower() changes A-Z alone and split() cuts at space and 0x09-0x0D alone.
        words = text.encode().lower().split()
        h = np.fromiter(map(self.hash, words), np.uint64, len(words))
        size = min(self.words, len(h))
        if not size:
            return h
        out = np.full(len(h) - size + 1, size, np.uint64)
        for i in range(size):
            out = out * np.uint64(0x9E3779B97F4A7C15) + h[i : len(h) - size + 1 + i]
        return np.unique(mixed(out))


class Sketcher:
    """Band keys and packed low bits of a set."""

    def __init__(self, hashes: int = HASHES, rows: int = ROWS, bits: int = BITS):
        rng = np.random.default_rng(20240229)
        self.times = rng.integers(0, 2**31, hashes, np.uint32) * np.uint32(2) + np.uint32(1)
        self.plus = rng.integers(0, 2**32, hashes, np.uint32)
        self.rows, self.bits, self.bands = rows, bits, hashes // rows

    def minima(self, shingles: np.ndarray) -> np.ndarray:
        x = (shingles >> np.uint64(32)).astype(np.uint32)
        out = np.full(len(self.times), 2**32 - 1, np.uint32)
        for i in range(0, len(x), 4096):
            out = np.minimum(out, (x[None, i : i + 4096] * self.times[:, None] + self.plus[:, None]).min(1))
        return out

    def sketch(self, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        m = self.minima(shingles).astype(np.uint64)
        keys = np.arange(self.bands, dtype=np.uint64)
        for column in m.reshape(self.bands, self.rows).T:
            keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + column)
        low = mixed(m + np.uint64(1)) & np.uint64(2**self.bits - 1)
        per = 64 // self.bits
        low = np.pad(low, (0, -len(low) % per)).reshape(-1, per)
        packed = (low << (np.arange(per, dtype=np.uint64) * np.uint64(self.bits))).sum(1, dtype=np.uint64)
        return keys.view(np.int64), packed.view(np.int64)


def sketches(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, n_shingles, set_key, bands, low): one row per row; set_key is null for an empty set."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import xxhash

        sets, sketcher = Shingles(), Sketcher()
        for batch in (x for whole in batches for x in slices(whole)):
            sizes, keys, bands, low = [], [], [], []
            for text in batch.column(1).to_pylist():
                s = sets.set_of(text)
                sizes.append(len(s))
                keys.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                x, y = sketcher.sketch(s) if len(s) else (None, None)
                bands.append(x)
                low.append(y)
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(bands, longs), pa.array(low, longs)], names=["id", "n_shingles", "set_key", "bands", "low"])

    rows = df.select(F.col(id_col).cast("bigint").alias("id"), text_of(text_col).alias("text"))
    return rows.mapInArrow(run, "id bigint, n_shingles bigint, set_key binary, bands array<bigint>, low array<bigint>")


def full_sets(df: DataFrame, id_col: str, text_col: str, nodes: DataFrame) -> DataFrame:
    """(node, shingles) of the documents that are nodes."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        sets = Shingles()
        for batch in (x for whole in batches for x in slices(whole)):
            found = [sets.set_of(t).view(np.int64) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], names=["node", "shingles"])

    rows = df.select(F.col(id_col).cast("bigint").alias("node"), text_of(text_col).alias("text"))
    # Always a merge join: whether few or many documents are asked for, texts are shuffled once and no table grows into a broadcast.
    return rows.join(nodes.hint("merge"), "node", "left_semi").mapInArrow(run, "node bigint, shingles array<bigint>")


def estimate(a: Column, b: Column, hashes: int = HASHES, bits: int = BITS) -> Column:
    """Similarity from packed low bits: the share of equal groups of bits, corrected for equality by chance."""
    ones = sum(1 << (i * bits) for i in range(64 // bits))
    ones = ones - (1 << 64) if ones >> 63 else ones

    def differ(x: Column, y: Column) -> Column:
        z = x.bitwiseXOR(y)
        any_bit = z
        for i in range(1, bits):
            any_bit = any_bit.bitwiseOR(F.shiftrightunsigned(z, i))
        return F.bit_count(any_bit.bitwiseAND(F.lit(ones)))

    words = -(-hashes // (64 // bits))
    unequal = differ(F.get(a, F.lit(0)), F.get(b, F.lit(0)))
    for i in range(1, words):
        unequal = unequal + differ(F.get(a, F.lit(i)), F.get(b, F.lit(i)))
    chance = 2.0**-bits
    return ((1 - unequal / F.lit(float(hashes))) - chance) / (1 - chance)


def least_estimate(percent: int, hashes: int = HASHES, bits: int = BITS) -> float:
    """SIGMAS standard errors below the threshold."""
    chance, s = 2.0**-bits, percent / 100
    match = chance + (1 - chance) * s
    return s - SIGMAS * math.sqrt(match * (1 - match) / hashes) / (1 - chance)


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80) -> DataFrame:
    """(id, n_shingles, component_id, kept), one row per row.

    Documents whose sets have 100 * intersection >= percent * union are linked; component_id is the
    least id that links reach, kept is true where that is the row's own id. A document without words
    has no shingles and no links. Rows that share an id are one document and linked; a row with a null id
    is linked with nothing, has a null component_id and is kept. Equal sets are always linked. Columns other than the two named take no part.
    An empty table gives an empty result. A text is read whole; its set takes 8 bytes a word. df is read twice, for the sketches and for the full sets of candidates: give it
    as a table.
    """
    docs = saved(sketches(df, id_col, text_col), "sketches")
    # The tables below are smaller than the documents: no more files than those have partitions.
    parts = max(1, df.rdd.getNumPartitions())
    full = docs.where("set_key is not null and id is not null")
    nodes = saved(full.groupBy("set_key").agg(F.min("id").alias("node"), F.first("bands").alias("bands"), F.first("low").alias("low"), F.first("n_shingles").alias("n")), "nodes", parts)

    member = nodes.select("node", F.explode("bands").alias("key"))
    leaders = member.groupBy("key").agg(F.min(F.struct(F.xxhash64("key", "node").alias("h"), F.col("node").alias("leader"))).alias("x"), F.count("*").alias("size")).where("size > 1")
    member = saved(member.join(leaders.select("key", F.col("x.leader").alias("leader")), "key"), "buckets", parts)
    least, low = least_estimate(percent), nodes.select("node", "low", "n")

    def side(name: str) -> DataFrame:
        return low.select(F.col("node").alias(name), F.col("low").alias(f"low_{name}"), F.col("n").alias(f"n_{name}"))

    def likely(pairs: DataFrame) -> DataFrame:
        """Pairs a < b whose sizes and estimate allow the threshold."""
        both = pairs.join(side("a"), "a").join(side("b"), "b")
        sizes = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent
        return both.where(sizes & (estimate(F.col("low_a"), F.col("low_b")) >= least)).select("a", "b").distinct()

    # The full sets of all documents that share a bucket: one shuffle of texts, used twice.
    sets = saved(full_sets(df, id_col, text_col, member.select("node").distinct()), "sets")

    def confirmed(pairs: DataFrame) -> DataFrame:
        both = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a").join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b")
        both = both.select("a", "b", F.size(F.array_intersect("x", "y")).alias("common"), (F.size("x") + F.size("y")).alias("sum"))
        return both.where(F.col("common") * 100 >= (F.col("sum") - F.col("common")) * percent).select("a", "b").distinct()

    ordered = [F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")]
    first = saved(confirmed(likely(member.where("node <> leader").select(*ordered).distinct())), "links", parts)
    found = components(first, parts)

    # Buckets that still hold several components. A shingle that no other document in them has is common to no pair: the
    # rest of the smaller set bounds the intersection, exactly. The join counts the intersection itself, on 32-bit hashes of
    # the rest (a set's hashes that collide within it are added), so that only pairs about to be confirmed leave it.
    placed = member.select("key", "node").join(found, "node", "left").select("key", "node", F.coalesce("component", "node").alias("c"))
    most = placed.groupBy("key", "c").agg(F.count("*").alias("n")).groupBy("key").agg(F.max(F.struct("n", "c")).alias("x"), F.count("*").alias("parts")).where("parts > 1")
    placed = saved(placed.join(most.select("key", F.col("x.c").alias("main")), "key"), "placed", parts)
    inside = sets.join(placed.select("node").distinct(), "node", "left_semi")
    single = inside.select("node", F.explode("shingles").alias("s")).groupBy("s").agg(F.count("*").alias("k"), F.min("node").alias("node")).where("k = 1")
    own = single.groupBy("node").agg(F.collect_list("s").alias("own"))  # part of one document's set
    rest = F.when(F.col("own").isNull(), F.col("shingles")).otherwise(F.array_except("shingles", "own"))
    rest = inside.join(own, "node", "left").join(nodes.select("node", "low", "n", "bands"), "node").select("node", "low", "n", "bands", F.transform(rest, lambda s: F.hash(s)).alias("rest"))
    rest = rest.withColumn("same", F.size("rest") - F.size(F.array_distinct("rest")))
    placed = placed.join(saved(rest, "rest", parts), "node")
    outer = placed.where("c <> main").alias("p")
    every = placed.alias("q")

    def reach(common: Column) -> Column:
        return common * 100 >= (F.col("p.n") + F.col("q.n") - common) * percent

    meets = (F.col("p.key") == F.col("q.key")) & (F.col("p.c") != F.col("q.c")) & ((F.col("q.c") == F.col("q.main")) | (F.col("p.node") < F.col("q.node")))
    meets &= reach(F.least(F.size("p.rest"), F.size("q.rest")))
    meets &= estimate(F.col("p.low"), F.col("q.low")) >= least
    # A pair that shares several buckets is counted in the first of them alone.
    shared = F.array_position(F.zip_with("p.bands", "q.bands", lambda x, y: x == y), F.lit(True))
    meets &= F.get("p.bands", shared.cast("int") - 1) == F.col("p.key")
    meets &= reach(F.size(F.array_intersect("p.rest", "q.rest")) + F.least("p.same", "q.same"))
    more = outer.join(every, meets).select(F.least("p.node", "q.node").alias("a"), F.greatest("p.node", "q.node").alias("b")).distinct()
    second = saved(confirmed(more), "links", parts)
    if second.head(1):
        found = components(first.unionByName(second), parts)

    label = nodes.join(found, "node", "left").select("set_key", F.coalesce("component", "node").alias("c"))
    names = [F.col("id").alias(id_col), "n_shingles"]
    # Rows that share an id but not a set: one document.
    placed = docs.where("id is not null").join(label, "set_key", "left").select("id", "n_shingles", F.coalesce("c", "id").alias("c"))
    twice = placed.groupBy("id").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo <> hi")
    if twice.head(1):
        joined = components(placed.select(F.col("id").alias("a"), F.col("c").alias("b")), parts)
        placed = placed.join(joined, placed["c"] == joined["node"], "left").select("id", "n_shingles", F.coalesce("component", "c").alias("c"))
    out = placed.select(*names, F.col("c").alias("component_id"), (F.col("c") == F.col("id")).alias("kept"))
    alone = docs.where("id is null").select(*names, F.lit(None).cast("bigint").alias("component_id"), F.lit(True).alias("kept"))
    return out.unionByName(alone)


def deduplicated(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80) -> DataFrame:
    """df without the documents that aren't the least of their component; columns unchanged, whatever their names.

    Rows with a null id and rows without words are kept; rows that share an id are one document and stay or go together.
    An empty table gives an empty result.
    """
    gone = near_duplicates(df, id_col, text_col, percent).where("not kept").select(F.col(id_col).alias("__cl_gone_id")).distinct()
    return df.join(gone, df[id_col].cast("bigint") == gone["__cl_gone_id"], "left_anti")
