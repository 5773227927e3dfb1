"""Compression of vectors by codebooks of their parts, the nearest entries found as in a vector approximation file.

A vector is cut into parts; each part becomes the index of its nearest codebook entry. The entries of a
codebook are the file: their coordinates are quantised into 2 ** BITS cells for each dimension. A part that is to be assigned is a query:
a table of its least and greatest squared distance to each cell of each dimension, summed over the entries' cells, bounds its
distance from every entry. Only entries whose lower bound doesn't pass the least upper bound are candidates, and their
distances are taken in whole numbers.

Codebooks are refined in rounds: each task sends sums and counts of its parts by entry, which Spark adds up, so a round
moves a bounded number of rows for each task and the driver holds only the codebooks.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from decimal import Decimal
from typing import TYPE_CHECKING

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved

if TYPE_CHECKING:
    import pyarrow as pa

PARTS, ENTRIES, ROUNDS, SCALE, BITS = 4, 256, 4, 1024, 3
#: Up to this size of components, bounds and distances are exact in doubles and longs; others are held as Python's numbers.
SAFE = 1 << 20
#: Parts that are bounded at once; rows that go to Python at once are Arrow's batches.
BLOCK = 2048
#: Up to so many labels (some 50 bytes each) go to every executor; more are joined by shuffle, dealt over SALTS tasks each.
BROADCAST_LABELS, SALTS = 200_000, 64
LONG = (1 << 63) - 1


def edges_of(dims: int, parts: int) -> list[int]:
    """Where the parts begin and end: equal parts where dims can be so divided, else as equal as can be."""
    return [p * dims // parts for p in range(parts + 1)]


def matrix(vectors: pa.Array) -> np.ndarray:
    """An Arrow array of lists of equal length, without nulls, as rows of doubles."""
    return vectors.flatten().to_numpy().reshape(len(vectors), -1)


def whole(v: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of rows of doubles: longs up to SAFE, else Python's numbers."""
    with np.errstate(over="ignore"):
        y = np.floor(v * scale)
    if np.abs(y).max(initial=0) <= SAFE:
        return y.astype(np.int64)
    exact = lambda x: math.floor(x * scale) if math.isfinite(x * scale) else int(x) * scale
    return np.array([[exact(x) for x in row] for row in v.tolist()], object).reshape(v.shape)


class Approximation:
    """The vector approximation file of one codebook."""

    def __init__(self, entries: np.ndarray, bits: int = BITS):
        self.entries, self.cells, self.dims = entries, 1 << bits, entries.shape[1]
        self.safe = entries.dtype != object and np.abs(entries).max(initial=0) <= SAFE
        if self.safe:
            # Cells of about equal numbers of entries; a cell spans from its least to its greatest coordinate.
            order = np.argsort(entries, axis=0, kind="stable")
            cell = np.empty(entries.shape, np.int64)
            np.put_along_axis(cell, order, (np.arange(len(entries)) * self.cells // len(entries))[:, None], 0)
            self.low, self.high = (np.zeros((self.dims, self.cells)) for _ in range(2))
            for c in range(self.cells):
                here = cell == c
                if here.any():
                    self.low[:, c] = np.where(here, entries, SAFE).min(0)
                    self.high[:, c] = np.where(here, entries, -SAFE).max(0)
            # For each entry the cells that it lies in, as a row of zeros and ones: sums over its cells are a product.
            self.marks = np.zeros((self.dims * self.cells, len(entries)))
            self.marks[(np.arange(self.dims) * self.cells + cell).ravel(), np.repeat(np.arange(len(entries)), self.dims)] = 1

    def bounds(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of squared distances, queries by entries; whole numbers below 2 ** 53, so sums are exact."""
        q = queries.astype(np.float64)[:, :, None]
        below, above = self.low - q, q - self.high
        least = np.maximum(np.maximum(below, above), 0)
        most = np.maximum(np.abs(below), np.abs(above))
        return (np.square(least).reshape(len(q), -1) @ self.marks), (np.square(most).reshape(len(q), -1) @ self.marks)

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry (ties to the lower) and the squared distance, of each row."""
        if not self.dims:
            return np.zeros(len(queries), np.int64), np.zeros(len(queries), np.int64)
        if not self.safe or queries.dtype == object or self.dims > 512:
            return self.plainly(queries)
        index, error = np.zeros(len(queries), np.int64), np.zeros(len(queries), np.int64)
        for at in range(0, len(queries), BLOCK):
            q = queries[at : at + BLOCK]
            lower, upper = self.bounds(q)
            row, entry = np.nonzero(lower <= upper.min(1)[:, None])
            distance = np.square(q[row] - self.entries[entry]).sum(1)
            first = np.searchsorted(row, np.arange(len(q)))
            best = np.minimum.reduceat(distance, first)
            hit = np.flatnonzero(distance == best[row])
            index[at : at + BLOCK] = entry[hit[np.searchsorted(row[hit], np.arange(len(q)))]]
            error[at : at + BLOCK] = best
        return index, error

    def plainly(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same by all distances, in whole numbers of any size."""
        entries, index, error = self.entries.astype(object), [], []
        for q in queries.astype(object):
            distances = np.square(entries - q).sum(1).tolist()
            error.append(min(distances))
            index.append(distances.index(error[-1]))
        return np.array(index, np.int64), np.array(error, object)


def valid(vector_col: str) -> Column:
    x = F.col(vector_col)
    return x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))


def decode(codebooks: list[np.ndarray], code: str) -> list[int]:
    """The components that a code stands for."""
    return [int(x) for book, i in zip(codebooks, bytes.fromhex(code), strict=True) for x in book[i]]


def digest(codebooks: list[np.ndarray]) -> str:
    """sha256 of all components in decimal, by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(str(x) for book in codebooks for x in book.ravel().tolist()).encode()).hexdigest()


def train(rows: DataFrame, dims: int, first: list, parts: int = PARTS, rounds: int = ROUNDS, scale: int = SCALE) -> list[np.ndarray]:
    """Codebooks after `rounds` rounds over all rows (column v), begun with the vectors in first."""
    edges = edges_of(dims, parts)
    start = whole(np.array(first, np.float64), scale)
    books = [start[:, a:b] for a, b in zip(edges, edges[1:], strict=False)]
    wide = not rows.where(F.exists("v", lambda x: F.abs(x) * scale > SAFE)).isEmpty()
    for _ in range(rounds):
        files = [Approximation(b) for b in books]

        def run(batches: Iterator, files: list = files) -> Iterator:
            import pyarrow as pa

            sums: dict[tuple[int, int], list] = {}
            for batch in batches:
                v = whole(matrix(batch.column(0)), scale)
                for p, file in enumerate(files):
                    own = v[:, edges[p] : edges[p + 1]]
                    index, _ = file.nearest(own)
                    order = np.argsort(index, kind="stable")
                    at = np.flatnonzero(np.diff(index[order], prepend=-1))
                    for i, n, s in zip(index[order][at].tolist(), np.diff(at, append=len(order)).tolist(), np.add.reduceat(own[order], at), strict=True):
                        held = sums.setdefault((p, i), [0, np.zeros(own.shape[1], object)])
                        held[0] += n
                        held[1] = held[1] + s.astype(object)
            if sums:
                # Digits, as a sum may pass 64 bits.
                yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in sums], pa.int32()), pa.array([k[1] for k in sums], pa.int32()), pa.array([n for n, _ in sums.values()], pa.int64()), pa.array([[str(x) for x in s] for _, s in sums.values()], pa.list_(pa.string()))], names=["part", "entry", "n", "sums"])

        told = rows.select("v").mapInArrow(run, "part int, entry int, n bigint, sums array<string>")
        books = [b.astype(object) if wide else b.copy() for b in books]
        for part, entry, n, sums in totals(told, wide):
            books[part][entry] = [int(s) // n for s in sums]
    return books


def totals(told: DataFrame, wide: bool) -> list[tuple[int, int, int, list]]:
    """(part, entry, count, sums) over all tasks: at most parts times entries rows. wide: sums may be beyond Spark's decimals; they are added as Python's numbers, by entry."""
    if wide:

        def run(key, pdf):
            import pandas as pd

            return pd.DataFrame([(*key, int(pdf["n"].sum()), [str(sum(map(int, xs))) for xs in zip(*pdf["sums"], strict=True)])], columns=["part", "entry", "n", "sums"])

        return [tuple(r) for r in told.groupBy("part", "entry").applyInPandas(run, told.schema).collect()]
    each = told.select("part", "entry", "n", F.posexplode_outer("sums").alias("at", "x")).groupBy("part", "entry", "at").agg(F.sum("n").alias("n"), F.sum(F.col("x").cast("decimal(27,0)")).alias("x"))
    found = each.groupBy("part", "entry").agg(F.first("n").alias("n"), F.array_sort(F.collect_list(F.struct("at", "x"))).alias("sums")).collect()
    return [(r["part"], r["entry"], r["n"], [s["x"] for s in r["sums"] if isinstance(s["x"], Decimal)]) for r in found]


def compress(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str | None = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, list[np.ndarray]]:
    """(id, code, error, label_error, codebooks_sha256) of every vector, and the codebooks.

    code has two hex digits for each part; error is the squared distance summed over the parts, label_error the
    error summed over all rows of the same label, nulls together. Vectors that are null or empty, or hold a null or non-finite component, are dropped; so are rows
    with a null id, and vectors of another length than the one of least id. Codebooks begin with
    the vectors of least id, equal ids in the order of their vectors; with fewer vectors than entries there are as many entries as vectors. Repeated rows count each.
    Other columns take no part, whatever their names. An empty table gives an empty result and no codebooks.
    Distances are exact for every finite vector; an error beyond 64 bits is given as the greatest long.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits for each part: 1 to 256 entries")
    label = F.col(label_col) if label_col else F.lit(None).cast("string")
    rows = df.where(F.col(id_col).isNotNull() & valid(vector_col) & (F.size(vector_col) > 0)).select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"), label.alias("label"))
    first = rows.select("id", "v").orderBy("id", "v").limit(1).collect()
    if not first:
        return rows.select(F.col("id").alias(id_col), F.lit("").alias("code"), F.lit(0).cast("bigint").alias("error"), F.lit(0).cast("bigint").alias("label_error"), F.lit("").alias("codebooks_sha256")), []
    dims = len(first[0]["v"])
    rows = rows.where(F.size("v") == dims)
    start = [r["v"] for r in rows.select("id", "v").orderBy("id", "v").limit(entries).collect()]
    books = train(rows, dims, start, parts, rounds, scale)
    files, edges, kinds = [Approximation(b) for b in books], edges_of(dims, parts), {c: rows.schema[c].dataType.simpleString() for c in ("id", "label")}

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            v = whole(matrix(batch.column(1)), scale)
            found = [file.nearest(v[:, a:b]) for file, a, b in zip(files, edges, edges[1:], strict=False)]
            codes = ["".join(f"{i:02x}" for i in row) for row in zip(*(i.tolist() for i, _ in found), strict=True)]
            errors = [min(sum(row), LONG) for row in zip(*(e.tolist() for _, e in found), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(codes, pa.string()), pa.array(errors, pa.int64())], names=["id", "label", "code", "error"])

    coded = saved(rows.select("id", "v", "label").mapInArrow(run, f"id {kinds['id']}, label {kinds['label']}, code string, error bigint"), "codes")
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LONG).cast("decimal(38,0)")).cast("bigint")
    by_label = saved(coded.groupBy("label").agg(total.alias("label_error")), "labels")
    if by_label.count() <= BROADCAST_LABELS:
        summed = coded.join(F.broadcast(by_label.withColumnRenamed("label", "of")), F.col("label").eqNullSafe(F.col("of")))
    else:
        salted = coded.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)))
        dealt = by_label.select(F.col("label").alias("of"), "label_error", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))).alias("of_salt"))
        summed = salted.join(dealt, F.col("label").eqNullSafe(F.col("of")) & (F.col("salt") == F.col("of_salt")))
    return summed.select(F.col("id").alias(id_col), "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256")), books
