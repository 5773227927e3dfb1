import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cairnlake.llm import queries, vafile


def brute(rows, entries=256, rounds=4, parts=4, scale=1024):
    """Codes and codebooks by all distances, in Python's whole numbers."""
    fine = [(i, v, g) for i, v, g in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    fine.sort(key=lambda r: (r[0], r[1]))
    fine = [r for r in fine if len(r[1]) == len(fine[0][1])]
    if not fine:
        return [], []
    whole = [[math.floor(x * scale) for x in v] for _, v, _ in fine]
    d = len(whole[0])
    edges = [p * d // parts for p in range(parts + 1)]
    cut = [[v[a:b] for v in whole] for a, b in zip(edges, edges[1:], strict=False)]
    books = [[list(x) for x in c[:entries]] for c in cut]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for own, book in zip(cut, books, strict=True):
            sums = {}
            for x in own:
                sums.setdefault(nearest(x, book)[1], []).append(x)
            for i, xs in sums.items():
                book[i] = [sum(c) // len(xs) for c in zip(*xs, strict=True)]
    found = [[nearest(own[i], book) for own, book in zip(cut, books, strict=True)] for i in range(len(fine))]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    errors = [min(sum(e for e, _ in f), vafile.LONG) for f in found]
    by_label = {}
    for (_, _, g), e in zip(fine, errors, strict=True):
        by_label[g] = min(by_label.get(g, 0) + e, vafile.LONG)
    return sorted((i, "".join(f"{k:02x}" for _, k in f), e, by_label[g], digest) for (i, _, g), f, e in zip(fine, found, errors, strict=True)), books


def got(df, **options):
    out, books = vafile.compress(df, **options)
    return sorted(map(tuple, out.collect())), books


SCHEMA = "vec_id bigint, embedding array<double>, label string"


@pytest.mark.parametrize("spread", [3, 400])
def test_equals_all_distances(spark, spread):
    """Few different values: many ties; entries that repeat; rows of every odd kind."""
    rng = np.random.default_rng(spread)
    rows = [(i, (rng.integers(-spread, spread + 1, 10) / 256).tolist(), None if i % 3 else f"g{i % 2}") for i in range(300)]
    rows += [(300, None, "g0"), (301, [], "g0"), (302, [1.0, None] * 5, "g0"), (303, [float("nan")] * 10, "g0"), (304, [math.inf] * 10, "g0"), (None, [1.0] * 10, "g0"), (305, [1.0] * 7, "g0"), (5, rows[5][1], "g1"), (5, rows[6][1], None)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("code", F.lit("clash")).withColumn("v", F.lit(1)).repartition(3)
    want, books = brute(rows, entries=20)
    found, made = got(df, entries=20)
    assert found == want and [b.tolist() for b in made] == books
    i, code = found[0][:2]
    assert vafile.decode(made, code) == [x for b, k in zip(books, bytes.fromhex(code), strict=True) for x in b[k]] and i == 0


def test_vectors_of_any_size(spark):
    """Beyond exact doubles and longs."""
    rng = np.random.default_rng(3)
    rows = [(i, (rng.standard_normal(8) * 10.0 ** (i % 40 * 7)).tolist(), "a") for i in range(60)]
    assert got(spark.createDataFrame(rows, SCHEMA), entries=5)[0] == brute(rows, entries=5)[0]


def test_few_rows_and_none(spark):
    df = spark.createDataFrame([(7, [0.5, -0.5], None), (9, [0.25, 1.0], "x")], SCHEMA)
    assert got(df)[0] == brute([tuple(r) for r in df.collect()])[0]  # fewer parts have room than there are
    out, books = vafile.compress(df.limit(0))
    assert books == [] and out.count() == 0 and out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


def test_many_labels_are_joined_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(vafile, "BROADCAST_LABELS", 1)
    rows = [(i, [float(i % 7), 1.0, -i / 9, 2.0], f"g{i % 4}" if i % 5 else None) for i in range(80)]
    assert got(spark.createDataFrame(rows, SCHEMA), entries=4)[0] == brute(rows, entries=4)[0]


def test_bounds_hold(sf_dir):
    """Lower and upper bounds enclose every distance, and leave few candidates."""
    import pyarrow.parquet as pq

    v = np.array(pq.read_table(f"{sf_dir}/embeddings.parquet")["embedding"].to_pylist())
    x = vafile.whole(v[:, :16], 1024)
    file = vafile.Approximation(x[:256])
    lower, upper = file.bounds(x)
    distance = np.square(x[:, None] - file.entries[None]).sum(2)
    assert (lower <= distance).all() and (distance <= upper).all()
    assert (lower <= upper.min(1)[:, None]).mean() < 0.5
    index, error = file.nearest(x)
    assert (index == distance.argmin(1)).all() and (error == distance.min(1)).all()


def test_query_of_equal_rows(spark, sf_dir):
    rows = [tuple(r) for r in queries.op12_vafile(spark, sf_dir).collect()]
    assert len({r[4] for r in rows}) == 1 and all(len(r[1]) == 8 for r in rows)
