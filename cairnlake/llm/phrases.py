"""Phrase mining with depth-limited count tries.

A worker cuts texts into pieces and words and builds, for each language, the trie of the words that follow
each other: for every word of a piece the path of it and the next DEPTH - 1 words (fewer at the end of a piece), with a count where the path ends. A trie is
held as its paths in order: words are numbers in the order of their bytes, and a path is one long that holds
DEPTH numbers, so that sorted longs are the trie in depth-first order and the count of a node is the sum of a run. Once it has SHARD_TOKENS words
a shard is written, sorted, to the shared folder.

All shards are cut at the same paths into prefix ranges, chosen from evenly spaced paths of every shard so that no range
has much more than RANGE_PATHS; a task merges the sorted runs of a range and gives the
nodes that occur often enough. Only the first and last node of each depth may go on in a neighbouring range; they are added up afterwards.

Left parts of a phrase are the nodes above it, found by one walk through the nodes in order. Its right
parts are reached by suffix links: they are the nodes above it where paths are read from their ends, found
by the same walk over the nodes in that order. A walk reads ranges of bounded size side by side; what lies above the first node of a range is looked up by itself. So no
word, pair or language, however frequent, is gathered in a task.
"""

from __future__ import annotations

from array import array
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from typing import TYPE_CHECKING

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved, slices, text_of

if TYPE_CHECKING:
    import pyarrow as pa

#: Words of a phrase; a number of a word takes so many bits.
DEPTH, BITS = 3, 21
LEAST_COUNT, COVERED, TOP, SCALE = 10, 50, 2000, 1_000_000
#: Words, and bytes of pieces with new words, that a worker holds before it writes a shard (with a stretch more, below 2 ** BITS words); paths that a merging task reads, about.
SHARD_TOKENS, SHARD_LETTERS, RANGE_PATHS = 1_500_000, 32_000_000, 1_000_000
#: A shard tells one in so many of its paths; the driver looks at so many of them, about, to cut ranges.
MARK_EVERY, MOST_MARKS = 4096, 200_000
#: Bytes of a piece that are cut into words at once.
STRETCH = 1 << 20
#: A language's best phrases are first found in so many groups.
SALTS = 32
# Fixed values of the contract: these bytes end a piece.
STOPS = b".,;:!?\x0a\x0b\x0c\x0d"
FOLD = bytes.maketrans(STOPS + b"\t" + bytes(range(65, 91)), b"\n" * len(STOPS) + b" " + bytes(range(97, 123)))
PATH = [f"w{i + 1}" for i in range(DEPTH)]
MASK = (1 << BITS) - 1


class Shard:
    """Words of one language as numbers in the order they came; pieces are parted by -1."""

    def __init__(self, words: list[bytes] = ()) -> None:
        self.number: dict[bytes, int] = defaultdict()
        self.number.default_factory = self.number.__len__
        self.held = array("i", map(self.number.__getitem__, words))

    def tail(self) -> list[bytes]:
        """The last DEPTH - 1 words of a piece that goes on."""
        words, last = list(self.number), self.held[-(DEPTH - 1) :].tolist()
        return [words[i] for i in last[last.index(-1) + 1 if -1 in last else 0 :]]

    def paths(self, unfinished: int = 0) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """The words in order, the paths in order, and how often each path ends; none begins at the last `unfinished` words."""
        words = sorted(self.number)
        place = np.zeros(len(words) + 1, np.int64)  # the last is that of -1: no word
        place[[self.number[w] for w in words]] = np.arange(1, len(words) + 1)
        own = place[np.frombuffer(self.held, np.int32)]
        key, on = own.copy(), own > 0
        for k in range(1, DEPTH):
            after = np.append(own[k:], np.zeros(min(k, len(own)), np.int64))
            on = on & (after > 0)
            key = (key << BITS) | np.where(on, after, 0)
        begins = own > 0
        begins[len(own) - unfinished :] = False
        keys, counts = np.unique(key[begins], return_counts=True)
        return words, keys, counts


def stretches(piece: bytes) -> Iterator[tuple[bytes, bool]]:
    """A piece in turn, cut at spaces, and whether it goes on."""
    at = 0
    while at < len(piece):
        end = piece.find(b" ", at + STRETCH)
        end = len(piece) if end < 0 else end
        yield piece[at:end], end < len(piece)
        at = end


def parts_of(keys: np.ndarray) -> list[np.ndarray]:
    return [(keys >> (BITS * (DEPTH - 1 - k))) & MASK for k in range(DEPTH)]


def pack(words: list[bytes], keys: np.ndarray, counts: np.ndarray) -> bytes:
    """A sorted run of paths: sizes, words, first numbers as differences, other numbers and counts, compressed."""
    import pyarrow as pa

    text = b"\n".join(words)
    parts = parts_of(keys)
    parts[0] = np.diff(parts[0], prepend=0)
    wide = counts.astype("<u4") if counts.max(initial=0) < 1 << 32 else counts.astype("<u8")
    raw = np.array([len(words), len(text), len(keys), wide.itemsize], "<i8").tobytes() + text + b"".join(p.astype("<u4").tobytes() for p in parts) + wide.tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def unpack(data: bytes) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    import pyarrow as pa

    raw = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True)
    n_words, n_text, n, size = np.frombuffer(raw, "<i8", 4).tolist()
    words = raw[32 : 32 + n_text].split(b"\n") if n_words else []
    at, keys = 32 + n_text, np.zeros(n, np.int64)
    for k in range(DEPTH):
        part = np.frombuffer(raw, "<u4", n, at + 4 * n * k).astype(np.int64)
        keys = (keys << BITS) | (np.cumsum(part) if k == 0 else part)
    return words, keys, np.frombuffer(raw, f"<u{size}", n, at + 4 * n * DEPTH).astype(np.int64)


def path_of(words: list[bytes], key: int) -> list[str | None]:
    numbers = [(key >> (BITS * (DEPTH - 1 - k))) & MASK for k in range(DEPTH)]
    return [words[i - 1].decode() if i else None for i in numbers]


def shards(df: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, run, paths, tokens, marks) of every shard's trie: its sorted paths, their number, the number of words, and evenly spaced paths."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        open_shards: dict[str, Shard] = defaultdict(Shard)
        tokens = letters = 0

        def close(going_on: str | None = None) -> Iterator:
            tail = open_shards[going_on].tail() if going_on is not None else []
            for lang, shard in open_shards.items():
                words, keys, counts = shard.paths(len(tail) if lang == going_on else 0)
                if len(keys):
                    marks = [path_of(words, k) for k in keys[min(MARK_EVERY, len(keys)) // 2 :: MARK_EVERY].tolist()]
                    row = [[lang], [pack(words, keys, counts)], [len(keys)], [int(counts.sum())], [marks]]
                    kinds = (pa.string(), pa.binary(), pa.int64(), pa.int64(), pa.list_(pa.list_(pa.string())))
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(row, kinds, strict=True)], names=["lang", "run", "paths", "tokens", "marks"])
            open_shards.clear()
            if tail:
                open_shards[going_on] = Shard(tail)

        for batch in (x for whole in batches for x in slices(whole)):
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for piece in text.as_buffer().to_pybytes().translate(FOLD).split(b"\n"):
                    for part, more in ((piece, False),) if len(piece) <= STRETCH else stretches(piece):
                        if not (words := part.split()) and not more:
                            continue
                        shard = open_shards[lang]
                        known = len(shard.number)
                        shard.held.extend(map(shard.number.__getitem__, words))
                        tokens += len(words)
                        if len(shard.number) > known:
                            letters += len(part)
                        if not more:
                            shard.held.append(-1)
                        if tokens >= SHARD_TOKENS or letters >= SHARD_LETTERS:
                            yield from close(lang if more else None)
                            tokens = letters = 0
        yield from close()

    rows = df.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), text_of(text_col).alias("text"))
    return rows.mapInArrow(run, "lang string, run binary, paths bigint, tokens bigint, marks array<array<string>>")


def cuts_of(marks: list[tuple], ranges: int) -> list[tuple]:
    """At most ranges - 1 paths that cut sorted marks into equal runs."""
    marks = sorted(marks)
    return sorted({marks[i * len(marks) // ranges] for i in range(1, ranges)}) if marks else []


def first_at(words: list[bytes], path: tuple) -> int:
    """The least key that isn't below the path, a tuple of bytes that ends with b'' where it is shorter."""
    key = 0
    for k, word in enumerate(path):
        shift = BITS * (DEPTH - 1 - k)
        if not word:
            return key
        i = bisect_left(words, word)
        key |= (i + 1) << shift
        if i == len(words) or words[i] != word:
            return key
    return key


def cut(words: list[bytes], keys: np.ndarray, counts: np.ndarray, lang: bytes, cuts: list[tuple]) -> Iterator[tuple[int, bytes]]:
    """(range, sorted run) of a shard's paths, with the words of each run alone."""
    begin, end = bisect_left(cuts, (lang,)), bisect_left(cuts, (lang + b"\0",))
    at = [0, *np.searchsorted(keys, np.array([first_at(words, c[1:]) for c in cuts[begin:end]], np.int64)).tolist(), len(keys)]
    for i, (a, b) in enumerate(zip(at, at[1:], strict=False)):
        if a < b:
            parts = parts_of(keys[a:b])
            used = np.unique(np.concatenate([[0], *parts]))
            own = np.zeros(b - a, np.int64)
            for p in parts:
                own = (own << BITS) | np.searchsorted(used, p)
            yield begin + i, pack([words[u - 1] for u in used[1:].tolist()], own, counts[a:b])


def merge(runs: list[bytes]) -> tuple[list[bytes], list[np.ndarray], np.ndarray]:
    """Words, the numbers of all paths in order, and their counts, of sorted runs."""
    read = [unpack(r) for r in runs]
    words = sorted(set().union(*(w for w, _, _ in read)))
    number = {w: i for i, w in enumerate(words, 1)}
    columns: list[list] = [[] for _ in range(DEPTH)]
    for own, keys, _ in read:
        place = np.array([0, *map(number.__getitem__, own)], np.int64)
        for column, p in zip(columns, parts_of(keys), strict=True):
            column.append(place[p])
    parts, counts = [np.concatenate(c) for c in columns], np.concatenate([c for _, _, c in read])
    if len(words) < MASK:
        key = np.zeros(len(counts), np.int64)
        for p in parts:
            key = (key << BITS) | p
        order = np.argsort(key, kind="stable")  # merges the runs, as each is in order
    else:
        order = np.lexsort(parts[::-1])
    parts = [p[order] for p in parts]
    new = np.ones(len(order), bool)
    new[1:] = np.any([p[1:] != p[:-1] for p in parts], axis=0)
    at = np.flatnonzero(new)
    return words, [p[at] for p in parts], np.add.reduceat(counts[order], at) if len(at) else counts


def nodes_of(words: list[bytes], parts: list[np.ndarray], counts: np.ndarray, least: int) -> Iterator[tuple[list, int]]:
    """(path, count) of the nodes with the least count, of every depth; the first and last node of each depth too, as they may go on in another range."""
    for depth in range(1, DEPTH + 1):
        deep = parts[depth - 1] > 0
        own, n = [p[deep] for p in parts[:depth]], counts[deep]
        if not len(n):
            continue
        new = np.ones(len(n), bool)
        new[1:] = np.any([p[1:] != p[:-1] for p in own], axis=0)
        at = np.flatnonzero(new)
        total = np.add.reduceat(n, at)
        keep = total >= least
        keep[[0, -1]] = True
        for i in np.flatnonzero(keep).tolist():
            yield [words[p[at[i]] - 1].decode() for p in own] + [None] * (DEPTH - depth), int(total[i])


def nodes(tries: DataFrame, least: int = LEAST_COUNT) -> DataFrame:
    """(lang, w1, ..., n) of all phrases of at most DEPTH words that occur so often, from saved shards."""
    size, count = tries.agg(F.sum("paths"), F.count("*")).first()
    ranges = max(1, -(-(size or 0) // RANGE_PATHS))
    # Only how evenly ranges are filled depends on the marks that are looked at.
    share = min(1.0, MOST_MARKS / max(1, count + (size or 0) // MARK_EVERY))
    marks = tries.select("lang", F.explode("marks").alias("m")).where(F.pmod(F.xxhash64("lang", "m"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1).limit(2 * MOST_MARKS)
    cuts = cuts_of([(r["lang"].encode(), *((w or "").encode() for w in r["m"])) for r in marks.collect()], ranges) if ranges > 1 else []

    def divide(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for lang, run in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = list(cut(*unpack(run), lang.encode(), cuts))
                yield pa.RecordBatch.from_arrays([pa.array([r for r, _ in found], pa.int64()), pa.array([lang] * len(found), pa.string()), pa.array([x for _, x in found], pa.binary())], names=["range", "lang", "run"])

    def join(key: tuple, table: pa.Table) -> pa.Table:
        import pyarrow as pa

        words, parts, counts = merge(table["run"].to_pylist())
        rows = [(*path, n) for path, n in nodes_of(words, parts, counts, least)]
        columns = list(zip(*rows, strict=True)) or [[]] * (DEPTH + 1)
        arrays = [pa.array([key[1].as_py()] * len(rows), pa.string()), *(pa.array(c, pa.string()) for c in columns[:-1]), pa.array(columns[-1], pa.int64())]
        return pa.table(arrays, names=["lang", *PATH, "n"])

    divided = tries.select("lang", "run").mapInArrow(divide, "range bigint, lang string, run binary")
    schema = "lang string, " + ", ".join(f"{w} string" for w in PATH) + ", n bigint"
    found = divided.groupBy("range", "lang").applyInArrow(join, schema)
    return found.groupBy("lang", *PATH).agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def walked(rows: DataFrame, path: list[str], above: list[str]) -> DataFrame:
    """rows (lang, path columns, n) with a column for each depth below the greatest: the count of the node above at that depth, along path.

    rows hold every node above any of theirs. They are ranged by path and read in order: the last node of a depth that was
    passed is the one above. What a range's first node has above it lies in ranges before, and is looked up by one row for each range.
    """
    placed = saved(rows.repartitionByRange("lang", *path).withColumn("part", F.spark_partition_id()), "ranged")
    depth = sum((F.col(p).isNotNull().cast("int") for p in path), F.lit(0))
    so_far = Window.partitionBy("part").orderBy("lang", *path).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = lambda d: F.last(F.when(depth == d, F.col("n")), ignorenulls=True).over(so_far)
    seen = placed.select("*", *[last(d).alias(a) for d, a in enumerate(above, 1)])
    edge = saved(placed.groupBy("part").agg(F.min(F.struct("lang", *path)).alias("f")), "edges", 1)
    looked = edge
    for d, a in enumerate(above, 1):
        same = (F.col("f.lang") == F.col("lang")) & F.col(f"f.{path[d - 1]}").isNotNull()
        for i, p in enumerate(path):
            same = same & (F.col(f"f.{p}") == F.col(p) if i < d else F.col(p).isNull())
        # Edges have a row for each range, of which there are as many as Spark has partitions for a shuffle.
        found = placed.select("lang", *path, F.col("n").alias(f"edge_{a}")).join(F.broadcast(edge), same).select("part", f"edge_{a}")
        looked = looked.join(found, "part", "left")
    joined = seen.join(F.broadcast(saved(looked.drop("f"), "above", 1)), "part")
    return joined.select("lang", *path, *[c for c in rows.columns if c not in ("lang", *path)], *[F.coalesce(a, f"edge_{a}").alias(a) for a in above])


def phrases(df: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST_COUNT, covered: int = COVERED, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of each language's best phrases of two to DEPTH words.

    a, l and r count a phrase and the two parts of its weakest cut, n all words of the language; score is
    floor(1000000 * a * a / (l * r)), exact for counts below 10 ** 15. A phrase that occurs less than `least` times is none, and one
    that lies in a longer phrase with at least `covered` percent of its count is left out. Ties go by count, then by the phrase's bytes.

    A null language is `und`, a null text empty; repeated rows count each. Texts are cut piece by piece and long pieces in
    stretches, however long. Other columns take no part, whatever their names; an empty table gives an empty result.
    """
    tries = saved(shards(df, text_col, lang_col), "tries")
    totals = tries.groupBy("lang").agg(F.sum("tokens").alias("n"))
    return ranked(saved(nodes(tries, least), "nodes"), totals, covered, top)


def ranked(found: DataFrame, totals: DataFrame, covered: int = COVERED, top: int = TOP) -> DataFrame:
    """Each language's best phrases of all nodes (lang, w1, ..., n) that occur often enough; totals: (lang, n), all words."""
    lefts, rights = [f"l{k}" for k in range(1, DEPTH)], [f"r{k}" for k in range(1, DEPTH)]
    left = walked(found, PATH, lefts)
    # From its end: the last word first, absent words last.
    words = F.array_compact(F.array(*PATH))
    turned = F.reverse(words)
    ends = [f"e{k}" for k in range(1, DEPTH + 1)]
    both = walked(left.select("lang", *[F.get(turned, k).alias(e) for k, e in enumerate(ends)], "n", *lefts), ends, rights)
    words = F.reverse(F.array_compact(F.array(*ends)))
    rows = both.withColumn("words", words).where(F.size("words") > 1).select("lang", "words", F.col("n").alias("a"), *lefts, *rights)
    rows = saved(rows, "phrases")

    size, cuts = F.size("words"), []
    for k in range(1, DEPTH):  # the first k words, and the rest
        right: Column = F.coalesce(*[F.when(size - k == d, F.col(r)) for d, r in enumerate(rights, 1)])
        rows = rows.withColumn(f"rest{k}", right)
        exact = F.expr(f"({SCALE} * (cast(a as decimal(16,0)) * cast(a as decimal(16,0)))) div (cast({lefts[k - 1]} as decimal(16,0)) * cast(rest{k} as decimal(16,0)))")
        cuts.append(F.when(size > k, F.struct(exact.alias("score"), F.lit(k).alias("k"), F.col(lefts[k - 1]).alias("l"), F.col(f"rest{k}").alias("r"))))
    weakest = F.array_min(F.array(*cuts))
    # The greatest count of the longer phrases that a phrase lies in.
    inside = lambda n: F.transform(F.sequence(F.lit(1), size - n + 1), lambda i: F.slice("words", i, n))
    inner = [F.when(size > n, inside(n)) for n in range(2, DEPTH)]
    longer = rows.where(size > 2).select("lang", F.explode(F.flatten(F.array_compact(F.array(*inner)))).alias("words"), "a").groupBy("lang", "words").agg(F.max("a").alias("over"))
    scored = rows.join(longer, ["lang", "words"], "left").where(F.col("over").isNull() | (100 * F.col("over") < covered * F.col("a")))
    scored = scored.select("lang", F.array_join("words", " ").alias("phrase"), "a", weakest.alias("w")).select("lang", "phrase", "a", "w.l", "w.r", "w.score")
    order = [F.desc("score"), F.desc("a"), "phrase"]
    dealt = scored.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    few = dealt.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= top)
    best = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint")).where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
