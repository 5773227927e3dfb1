"""Token shards as wavelet matrices: one file gives access, counting and occurrence lookup.

A shard's tokens become ranks in its own sorted alphabet and are stored as bit planes,
highest bit first; after each plane the tokens are parted stably, zeros before
ones. Every 512 bits the number of ones so far is stored, which makes rank cheap; select
goes back up the planes by binary search over those counts.

File: "WMX1"; six little-endian 64-bit counts (tokens, symbols, planes, documents, part,
number in part); symbols as uint32; document ids as int64 and a byte each that is 1 for a null
id; document lengths as int64; then for each plane the number of zeros as int64, the bits in 64-bit
words padded to 512 bits, and the ones before each 512 bits as uint32.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator
from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh_path, saved, slices, text_of
from .tokens import default_vocabulary, encoder, for_task

MAGIC, BLOCK, END_ID = b"WMX1", 512, 2
#: A shard is closed once it holds so many tokens.
SHARD_TOKENS = 2_000_000


class WaveletMatrix:
    """tokens: a one-dimensional array of unsigned integers."""

    def __init__(self, n: int, symbols: np.ndarray, planes: list[tuple[int, np.ndarray, np.ndarray]]):
        self.n, self.symbols, self.planes = n, symbols, planes

    @classmethod
    def build(cls, tokens: np.ndarray) -> WaveletMatrix:
        symbols = np.flatnonzero(np.bincount(tokens)).astype("<u4")
        depth = max(1, int(len(symbols) - 1).bit_length())
        table = np.zeros(int(symbols[-1]) + 1 if len(symbols) else 1, np.uint16 if depth <= 16 else np.uint32)
        table[symbols] = np.arange(len(symbols))
        seq, planes = table[tokens], []
        for shift in range(depth - 1, -1, -1):
            ones = (seq & seq.dtype.type(1 << shift)).astype(bool)
            padded = np.zeros(-(-len(seq) // BLOCK) * BLOCK // 8, np.uint8)
            bits = np.packbits(ones, bitorder="little")
            padded[: len(bits)] = bits
            words = padded.view("<u8")
            per_block = np.bitwise_count(words).reshape(-1, BLOCK // 64).sum(1, dtype=np.int64)
            planes.append((len(seq) - int(np.count_nonzero(ones)), words, np.concatenate([[0], np.cumsum(per_block)]).astype("<u4")))
            seq = np.concatenate([np.compress(~ones, seq), np.compress(ones, seq)])
        return cls(len(tokens), symbols, planes)

    def _ones(self, level: int, at: np.ndarray) -> np.ndarray:
        """Ones before each position of a plane."""
        _, words, blocks = self.planes[level]
        at = np.asarray(at, np.int64)
        block, word = at // BLOCK, at // 64
        out = blocks[np.minimum(block, len(blocks) - 1)].astype(np.int64)
        for step in range(BLOCK // 64):  # whole words of the block that lie before the position
            w = block * (BLOCK // 64) + step
            use = w < word
            out += np.where(use, np.bitwise_count(words[np.minimum(w, len(words) - 1)]), 0) if len(words) else 0
        inside = (at % 64).astype(np.uint64)
        if len(words):
            mask = (np.uint64(1) << inside) - np.uint64(1)
            out += np.bitwise_count(words[np.minimum(word, len(words) - 1)] & mask)
        return out

    def access(self, at) -> np.ndarray:
        """The tokens at the given positions."""
        at = np.atleast_1d(np.asarray(at, np.int64))
        if len(at) and (at.min() < 0 or at.max() >= self.n):
            raise IndexError("position outside the shard")
        rank = np.zeros(len(at), np.int64)
        for level, (zeros, words, _) in enumerate(self.planes):
            bit = (words[at // 64] >> (at % 64).astype(np.uint64)) & np.uint64(1) == 1
            ones = self._ones(level, at)
            rank = rank * 2 + bit
            at = np.where(bit, zeros + ones, at - ones)
        return self.symbols[rank]

    def _code(self, token: int) -> int | None:
        i = int(np.searchsorted(self.symbols, token))
        return i if i < len(self.symbols) and self.symbols[i] == token else None

    def _span(self, token: int, start: int, stop: int) -> tuple[int, int]:
        code, depth = self._code(token), len(self.planes)
        if code is None:
            return 0, 0
        for level, (zeros, _, _) in enumerate(self.planes):
            a, b = (int(x) for x in self._ones(level, np.array([start, stop])))
            start, stop = (zeros + a, zeros + b) if code >> (depth - 1 - level) & 1 else (start - a, stop - b)
        return start, stop

    def count(self, token: int, start: int = 0, stop: int | None = None) -> int:
        """Occurrences of a token among positions start to stop (without stop)."""
        a, b = self._span(token, start, self.n if stop is None else stop)
        return max(0, b - a)

    def _select(self, level: int, ones: bool, number: int) -> int:
        """Position of the bit `ones` that has `number` such bits before it."""
        low, high = 0, self.n
        while high - low > 1:
            mid = (low + high) // 2
            before = int(self._ones(level, np.array([mid]))[0])
            low, high = (mid, high) if (before if ones else mid - before) <= number else (low, mid)
        return low

    def locate(self, token: int, number: int) -> int:
        """Position of the occurrence that has `number` others before it."""
        a, b = self._span(token, 0, self.n)
        if not 0 <= number < b - a:
            raise IndexError("the token has fewer occurrences")
        code, at = self._code(token), a + number
        for level in range(len(self.planes) - 1, -1, -1):
            one = bool(code >> (len(self.planes) - 1 - level) & 1)
            at = self._select(level, one, at - self.planes[level][0] if one else at)
        return at

    def decode(self) -> np.ndarray:
        """All tokens, from the lowest plane up."""
        rank = np.zeros(self.n, np.uint16 if len(self.planes) <= 16 else np.uint32)
        for shift, (zeros, words, _) in enumerate(reversed(self.planes)):
            ones = np.unpackbits(words.view(np.uint8), count=self.n, bitorder="little").view(bool)
            above = np.empty_like(rank)
            above[np.flatnonzero(~ones)] = rank[:zeros]
            above[np.flatnonzero(ones)] = rank[zeros:] | rank.dtype.type(1 << shift)
            rank = above
        return self.symbols[rank]


def to_bytes(matrix: WaveletMatrix, ids: list[int | None], lengths: list[int], part: int, number: int) -> bytes:
    out = [MAGIC, struct.pack("<6q", matrix.n, len(matrix.symbols), len(matrix.planes), len(ids), part, number), matrix.symbols.astype("<u4").tobytes()]
    out += [np.array([x or 0 for x in ids], "<i8").tobytes(), bytes(x is None for x in ids), np.array(lengths, "<i8").tobytes()]
    for zeros, words, blocks in matrix.planes:
        out += [struct.pack("<q", zeros), words.tobytes(), blocks.tobytes()]
    return b"".join(out)


def from_bytes(data: bytes) -> tuple[WaveletMatrix, list[int | None], np.ndarray, int, int]:
    """The matrix, the ids and lengths of its documents, the part and the number in it."""
    if data[:4] != MAGIC:
        raise ValueError("not a token shard")
    n, n_symbols, depth, docs, part, number = struct.unpack_from("<6q", data, 4)
    at = 52

    def take(kind: str, count: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(data, kind, count, at)
        at += out.nbytes
        return out

    symbols, ids, null, lengths = take("<u4", n_symbols), take("<i8", docs), take("u1", docs), take("<i8", docs)
    blocks, planes = -(-n // BLOCK), []
    for _ in range(depth):
        zeros = int(take("<i8", 1)[0])
        planes.append((zeros, take("<u8", blocks * BLOCK // 64).copy(), take("<u4", blocks + 1)))
    return WaveletMatrix(n, symbols, planes), [None if x else int(i) for i, x in zip(ids, null, strict=True)], lengths, part, number


def write_shards(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Encodes all texts in ascending id order into shard files under path; one row per shard.

    Returns (part, number, file, n_docs, n_tokens), a saved table; the files of a call have a folder of their own. path is a URI that all
    executors can write (file, hdfs, s3, gs). Each document ends with id 2; a null text is
    empty; null ids come first, and equal ids stand by the hash of their texts. A file is written
    under another name and renamed once whole, so that a task that runs twice does no harm. A document is never
    divided: a shard holds shard_tokens and the rest of its last document, and rows of equal id and text stand in one task.
    """
    vocabulary, folder = vocabulary or default_vocabulary(), f"shards-{uuid.uuid4().hex}"

    def run(batches: Iterator) -> Iterator:

        import pyarrow as pa
        from pyarrow import fs
        from pyspark import TaskContext

        store, root = fs.FileSystem.from_uri(f"{path}/{folder}")
        part, model, end = TaskContext.get().partitionId(), encoder(vocabulary), END_ID.to_bytes(4, "little")
        rows: list[tuple] = []
        ids: list[int | None] = []
        parts: list[bytes] = []
        held = 0

        def close() -> None:
            tokens = np.frombuffer(b"".join(parts), "<u4")
            name = f"shard-{part:06d}-{len(rows):05d}.wm"
            data = to_bytes(WaveletMatrix.build(tokens), ids, [len(x) // 4 for x in parts], part, len(rows))
            store.create_dir(root, recursive=True)
            with store.open_output_stream(side := f"{root}/.{name}.{uuid.uuid4().hex}") as f:
                f.write(data)
            store.move(side, f"{root}/{name}")
            rows.append((part, len(rows), f"{folder}/{name}", len(ids), len(tokens)))
            ids.clear()
            parts.clear()

        with for_task():
            for batch in (x for whole in batches for x in slices(whole)):
                for i, found in zip(batch.column(0).to_pylist(), model.many(batch.column(1)), strict=True):
                    ids.append(i)
                    parts.append(found.tobytes() + end)
                    held += len(parts[-1]) // 4
                    if held >= shard_tokens:
                        close()
                        held = 0
            if ids:
                close()
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows, strict=True)], names=["part", "number", "file", "n_docs", "n_tokens"])

    rows = df.select(F.col(id_col).cast("bigint").alias("id"), text_of(text_col).alias("text")).withColumn("tie", F.xxhash64("text"))
    rows = rows.repartitionByRange("id", "tie").sortWithinPartitions("id", "tie").select("id", "text")
    return saved(rows.mapInArrow(run, "part bigint, number bigint, file string, n_docs bigint, n_tokens bigint"), "token-shards")


def read_documents(shards: DataFrame, path: str, id_col: str = "doc_id") -> DataFrame:
    """One row per document from the shard files: (id, start, n_tokens, ids_crc32)."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for data in batch.column(0):
                matrix, ids, lengths, part, number = from_bytes(data.as_buffer().to_pybytes())
                tokens = memoryview(matrix.decode().astype("<u4")).cast("B")
                ends = np.cumsum(lengths)
                sums = [crc32(tokens[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
                same = lambda x: pa.array([x] * len(ids), pa.int64())
                yield pa.RecordBatch.from_arrays([same(part), same(number), pa.array(ids, pa.int64()), pa.array(ends - lengths, pa.int64()), pa.array(lengths, pa.int64()), pa.array(sums, pa.int64())], names=["part", "number", "id", "at", "n_tokens", "ids_crc32"])

    spark = shards.sparkSession
    first = shards.select("file").first()
    if not first:
        return spark.createDataFrame([], f"`{id_col}` bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
    files = spark.read.format("binaryFile").load(f"{path}/{first['file'].split('/')[0]}/shard-*.wm").select("content")
    docs = files.mapInArrow(run, "part bigint, number bigint, id bigint, at bigint, n_tokens bigint, ids_crc32 bigint")
    # Where each shard begins: sums within a part, then over the parts, of which there is a row each.
    within = Window.partitionBy("part").orderBy("number")
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("n")).withColumn("earlier", F.sum("n").over(Window.orderBy("part")) - F.col("n"))
    begins = shards.withColumn("inside", F.sum("n_tokens").over(within) - F.col("n_tokens")).join(parts, "part").select("part", "number", (F.col("inside") + F.col("earlier")).alias("begin"))
    return docs.join(begins, ["part", "number"]).select(F.col("id").alias(id_col), (F.col("begin") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def token_shards(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, path: str | None = None) -> DataFrame:
    """Writes the shards (to a fresh shared folder unless path is given) and reads every document back from them.

    An empty table writes no file and gives an empty result; other columns take no part,
    whatever their names.
    """
    path = path or fresh_path(df.sparkSession, "wavelet")
    if "://" not in path:
        path = path.replace("file:/", "file:///", 1) if path.startswith("file:/") else "file://" + path
    return read_documents(write_shards(df, path, id_col, text_col, vocabulary), path, id_col)
