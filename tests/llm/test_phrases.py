import re
from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from cairnlake.llm import phrases

SCHEMA = "text string, lang string"


def brute(rows, least=10, covered=50, top=2000):
    found, total = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(w)
            for k in (1, 2, 3):
                found.setdefault(lang, Counter()).update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in found.items():
        kept = []
        for g, a in f.items():
            if len(g) < 2 or a < least:
                continue
            if len(g) == 2 and any(100 * n >= covered * a for h, n in f.items() if len(h) == 3 and n >= least and g in (h[:2], h[1:])):
                continue
            score, k = min((int(Fraction(1_000_000 * a * a, f[g[:k]] * f[g[k:]]) // 1), k) for k in range(1, len(g)))
            kept.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        out += [(lang, r, p.decode(), -a, x, y, total[lang], -s) for r, (s, a, p, x, y) in enumerate(sorted(kept)[:top], 1)]
    return sorted(out)


def got(spark, rows, parts=3, **options):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("n", F.lit("clash")).withColumn("w1", F.lit(1)).repartition(parts)
    return sorted(map(tuple, phrases.phrases(df, **options).collect()))


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    return [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text", "lang").collect()]


ODD = [(None, "en"), ("", None), (" .,;", "x"), ("a b. a b, A\tB\x0bc d", None), ("\x01 \x00 é É É", "en"), ("a\x00 a \x01a", "")]


def test_equals_counting(spark, texts):
    rows = texts + ODD * 12
    assert got(spark, rows) == brute(rows)


def test_small_shards_and_ranges(spark, texts, monkeypatch):
    """Many shards, many ranges and pieces that go on in the next shard give the same."""
    monkeypatch.setattr(phrases, "SHARD_TOKENS", 500)
    monkeypatch.setattr(phrases, "RANGE_PATHS", 700)
    monkeypatch.setattr(phrases, "MARK_EVERY", 50)
    monkeypatch.setattr(phrases, "STRETCH", 40)
    rows = texts[:60] + ODD * 12 + [("long " + "one two three four five " * 2000, "en"), ("w" * 5000 + " " + "z " * 300, None)]
    assert got(spark, rows, least=5) == brute(rows, least=5)


def test_top_and_ties(spark):
    """Ties by count and bytes; at most `top` of a language; products beyond 64 bits in the score's formula."""
    rows = [(". ".join(f"p{i:02d}é q{i:02d}" for i in range(40)), "en")] * 10 + [("Z z, z Z, z z", "de")] * 10
    assert got(spark, rows, top=7) == brute(rows, top=7)
    assert got(spark, []) == [] and got(spark, [(None, None)]) == []


def test_score_of_great_counts(spark):
    """Counts of 10 ** 14: 1000000 * a * a passes 64 bits."""
    a, x, y = 123_456_789_012_345, 223_456_789_012_345, 523_456_789_012_345
    nodes = [("en", "a", None, None, x), ("en", "b", None, None, y), ("en", "a", "b", None, a)]
    df = spark.createDataFrame(nodes, "lang string, w1 string, w2 string, w3 string, n bigint")
    row = phrases.ranked(df, spark.createDataFrame([("en", x + y)], "lang string, n bigint")).first()
    assert row["score"] == 1_000_000 * a * a // (x * y) and (row["l"], row["r"]) == (x, y)


def test_run_round_trip():
    import numpy as np

    shard = phrases.Shard()
    shard.held.extend([shard.number[w] for w in b"b a b a c".split()] + [-1])
    words, keys, counts = shard.paths()
    again = phrases.unpack(phrases.pack(words, keys, counts))
    assert again[0] == words == [b"a", b"b", b"c"] and (again[1] == keys).all() and (again[2] == counts).all()
    assert [phrases.path_of(words, k) for k in keys.tolist()] == [["a", "b", "a"], ["a", "c", None], ["b", "a", "b"], ["b", "a", "c"], ["c", None, None]]
    pieces = list(phrases.cut(words, keys, counts, b"en", [(b"en", b"a", b"c", b""), (b"en", b"bb", b"", b"")]))
    assert [r for r, _ in pieces] == [0, 1, 2]
    merged, parts, n = phrases.merge([x for _, x in pieces])
    assert merged == words and np.array_equal(np.array(parts).T, np.array(phrases.parts_of(keys)).T) and n.sum() == 5
