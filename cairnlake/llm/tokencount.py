"""Token counts by heap-and-linked-list byte-pair merging.

The symbols of a piece are its bytes, held in a linked list. A heap gives the
adjacent pair of lowest rank, leftmost first; popping it joins the pair and offers
the two new neighbours. The count is the number of bytes minus the merges made; no
token identifier is ever looked up or emitted.

A long piece of n bytes takes some 25 n bytes of memory: links, symbols and places are plain arrays there.
"""

from __future__ import annotations

import heapq
from array import array
from collections.abc import Iterator
from functools import cached_property, lru_cache
from typing import TYPE_CHECKING

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, text_of
from .tokens import Words, by_length, byte_level, byte_names, default_vocabulary, for_task

if TYPE_CHECKING:
    import pyarrow as pa

# Fixed value: the splitting pattern of byte-level BPE vocabularies of this kind.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Pieces of so many bytes are held in arrays; remembered counts may take so much memory in a worker.
LONG, MEMO_BYTES = 4096, 90_000_000


def merge_table(ranks: dict[tuple[bytes, bytes], int]) -> dict[tuple[int, int], tuple[int, int]]:
    """(rank, symbol made) of each pair of symbols. Symbols are numbers of this table alone; the first 256 are the bytes."""
    number = {bytes([b]): b for b in range(256)}
    out: dict[tuple[int, int], tuple[int, int]] = {}
    for (left, right), rank in ranks.items():
        a, b, both = (number.setdefault(x, len(number)) for x in (left, right, left + right))
        out[a, b] = rank, both
    return out


class Counter:
    """count(text): tokens of a whole text under a byte-level BPE vocabulary file."""

    def __init__(self, path: str):
        import regex

        spec = byte_level(path)
        bytes_of = {c: bytes([b]) for b, c in enumerate(byte_names())}
        plain = lambda s: b"".join(map(bytes_of.__getitem__, s))
        pairs = (x.split(" ") if isinstance(x, str) else x for x in spec["model"]["merges"])
        self.ranks = {(plain(left), plain(right)): rank for rank, (left, right) in enumerate(pairs)}
        self.added = tuple(x["content"] for x in spec["added_tokens"])
        self.at_added = regex.compile("|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) or r"(?!)")
        self.pieces = regex.compile(SPLIT).finditer
        self.words = Words(lambda x: self.of_piece(x.encode()), self.of_part, self.added, MEMO_BYTES)

    @cached_property
    def merges(self) -> dict[tuple[int, int], tuple[int, int]]:
        return merge_table(self.ranks)

    def of_piece(self, data: bytes) -> int:
        n = len(data)
        if n >= LONG:
            return self.of_long(data)
        rank = self.ranks.get
        symbol: list[bytes | None] = [data[i : i + 1] for i in range(n)]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, 2) for i in range(n - 1) if (r := rank((symbol[i], symbol[i + 1]))) is not None]
        heapq.heapify(heap)
        merges = 0
        while heap:
            _, i, size = heapq.heappop(heap)
            left = symbol[i]
            if left is None or (j := after[i]) >= n or len(left) + len(symbol[j]) != size:
                continue  # one of the two has been merged since
            both = symbol[i] = left + symbol[j]
            symbol[j] = None
            merges += 1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := rank((both, symbol[k]))) is not None:
                    heapq.heappush(heap, (r, i, size + len(symbol[k])))
            if (h := before[i]) >= 0 and (r := rank((symbol[h], both))) is not None:
                heapq.heappush(heap, (r, h, len(symbol[h]) + size))
        return n - merges

    def of_long(self, data: bytes) -> int:
        """The same for a long piece, in plain arrays: the heap has ranks alone, and each rank the places of its pairs."""
        n, find = len(data), self.merges.get
        symbol, after, before = array("i", np.frombuffer(data, np.uint8).astype(np.int32).tobytes()), array("i", range(1, n + 1)), array("i", range(-1, n - 1))
        places: dict[int, array] = {}
        heap: list[int] = []

        def offer(i: int, j: int) -> None:
            if (m := find((symbol[i], symbol[j]))) is not None:
                if (there := places.get(m[0])) is None:
                    places[m[0]] = array("i", (i,))
                    heapq.heappush(heap, m[0])
                else:
                    there.append(i)

        for i in range(n - 1):
            offer(i, i + 1)
        merges = 0
        while heap:
            rank = heapq.heappop(heap)
            there = np.sort(np.frombuffer(places.pop(rank), np.int32))
            for at, i in enumerate(there):
                # A place may be old: one of the two symbols has been joined since.
                if symbol[i] < 0 or (j := after[i]) >= n or (m := find((symbol[i], symbol[j]))) is None or m[0] != rank:
                    continue
                symbol[i], symbol[j] = m[1], -1
                merges += 1
                after[i] = k = after[j]
                if k < n:
                    before[k] = i
                    offer(i, k)
                if (h := before[i]) >= 0:
                    offer(h, i)
                if heap and heap[0] < rank:  # not in a vocabulary that was learnt: its longer symbols come later
                    places[rank] = array("i", there[at + 1 :].tobytes())
                    heapq.heappush(heap, rank)
                    break
        return n - merges

    def of_part(self, text: str) -> int:
        """Tokens of a text without added tokens."""
        return sum(self.of_piece(x[0].encode()) for x in self.pieces(text))

    def many(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text of an Arrow array of strings without nulls. A long plain text is counted in stretches."""
        import pyarrow as pa

        out = [np.zeros(0, np.int64)]
        for some, long in by_length(texts):
            if not long:
                out.append(self._of(some))
            elif (parts := self.words.stretches(text := some[0].as_py())) is None:
                out.append(np.array([self.of_text(text)]))
            else:
                out.append(np.array([sum(int(self._of(pa.array([x]), plain=True)[0]) for x in parts)]))
        return np.concatenate(out)

    def _of(self, texts: pa.Array, plain: bool = False) -> np.ndarray:
        out = np.zeros(len(texts), np.int64)
        for row, odd, offsets, which, values in self.words.cut(texts, plain):
            sums = np.concatenate([[0], np.cumsum(np.array(values, np.int64)[which])])
            n = len(offsets) - 1
            out[row : row + n] = sums[offsets[1:]] - sums[offsets[:-1]]
            for i in np.flatnonzero(np.array(odd.to_pylist(), bool)):
                out[row + i] = self.of_text(texts[row + int(i)].as_py())
        return out

    def of_text(self, text: str) -> int:
        """Tokens of any text, added tokens counted as one each."""
        parts = self.at_added.split(text)
        return len(parts) - 1 + sum(map(self.of_part, parts))


@lru_cache(maxsize=1)
def counter(path: str) -> Counter:
    return Counter(path)


def token_counts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, limit: int = 1024) -> DataFrame:
    """Tokens of each whole text: (id, n_bytes, n_tokens, over_limit), one row per input row.

    A text is counted whole, however long: plain ones in stretches, an unbroken piece in
    memory of some 25 times its size. A null text counts as empty (0 bytes, 0 tokens); a null id stays null; repeated
    rows are counted each. Other columns take no part, whatever their names. An empty
    table gives an empty result. vocabulary is the path of a byte-level BPE file that
    every executor can open.
    """
    path = vocabulary or default_vocabulary()
    kind = df.schema[id_col].dataType

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc

        model = counter(path)
        with for_task():
            for batch in (x for whole in batches for x in slices(whole)):
                counts = model.many(batch.column(1))
                sizes = pc.binary_length(batch.column(1)).cast(pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0), sizes, pa.array(counts), pa.array(counts > limit)], names=[id_col, "n_bytes", "n_tokens", "over_limit"])

    rows = df.select(F.col(id_col), text_of(text_col).alias("text"))
    return rows.mapInArrow(run, f"`{id_col}` {kind.simpleString()}, n_bytes bigint, n_tokens bigint, over_limit boolean")
