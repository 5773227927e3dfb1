import math
from collections import Counter
from zlib import crc32

import pytest
import regex
from pyspark.sql import functions as F

from cairnlake.llm import langid, queries


def brute_model(rows, pairs=langid.PAIRS, cells=langid.CELLS):
    """The shares of words and n-grams of each language, by plain counting."""
    words, grams = {}, {}
    for text, lang in rows:
        if lang is not None:
            words.setdefault(lang, Counter()).update(regex.findall(r"\p{L}[\p{L}\p{M}]*", (text or "").lower()))
    words = {k: v for k, v in words.items() if v}
    most = max(langid.ORDERS, min(pairs, cells // len(words)) // (2 * len(words)))
    for lang, own in words.items():
        for w, n in own.items():
            for order in range(1, langid.ORDERS + 1):
                padded = w if order == 1 else f" {w} "
                for i in range(len(padded) - order + 1):
                    grams.setdefault((lang, order), Counter())[padded[i : i + order]] += n

    def shares(counts, least):
        total = sum(counts.values())
        return {k: math.log(n / total) for k, n in counts.items() if n / total >= least}

    order = sorted(words, key=lambda x: (-sum(words[x].values()), x))
    lists = {(g, 0): shares(words[g], 1 / most) for g in order} | {(g, o): shares(c, langid.ORDERS / most) for (g, o), c in grams.items()}
    floor = [math.log(1 / most) - langid.PENALTY] + [math.log(langid.ORDERS / most) - langid.PENALTY] * langid.ORDERS
    return order, lists, floor


def brute_guess(model, text):
    langs, lists, floor = model
    total, some = dict.fromkeys(langs, 0.0), False
    for w in regex.findall(r"\p{L}[\p{L}\p{M}]*", (text or "").lower()):
        some = True
        told = [w] if any(w in lists[g, 0] for g in langs) else []
        order = 0
        while not told and order < langid.ORDERS:
            padded = w if order == langid.ORDERS - 1 else f" {w} "
            n = langid.ORDERS - order
            told = [x for i in range(len(padded) - n + 1) if any((x := padded[i : i + n]) in lists.get((g, n), {}) for g in langs)]
            order += 1
        at = 0 if not order else langid.ORDERS - order + 1
        for g in langs:
            if told:
                total[g] += sum(lists.get((g, at), {}).get(x, floor[at]) for x in told) / len(told)
    if not some:
        return "und", 0.0
    best = max(langs, key=lambda g: (total[g], -langs.index(g)))
    return best, 1 / sum(math.exp(max(-700, total[g] - total[best])) for g in langs)


@pytest.mark.parametrize("pairs", [langid.PAIRS, 600])
def test_query_equals_plain_counting(spark, sf_dir, monkeypatch, pairs):
    """pairs 600: most words are unknown, so that n-grams decide."""
    monkeypatch.setattr(langid, "PAIRS", pairs)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang").collect()
    held = {r["doc_id"]: crc32(str(r["doc_id"]).encode()) % 4 == 2 for r in docs}
    model = brute_model([(r["text"], r["lang"]) for r in docs if not held[r["doc_id"]]], pairs)
    got = {r["doc_id"]: r for r in queries.op11_langid(spark, sf_dir).collect()}
    assert set(got) == set(held) and all(got[i]["held_out"] == h for i, h in held.items())
    for r in docs:
        name, score = brute_guess(model, r["text"])
        assert got[r["doc_id"]]["lang_pred"] == name and got[r["doc_id"]]["score"] == pytest.approx(score, abs=1e-4)


def test_held_out_accuracy(spark, sf_dir):
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang").collect()}
    held = [r for r in queries.op11_langid(spark, sf_dir).collect() if r["held_out"]]
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.98 * len(held) > 0


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(langid, "STRETCH", 50)
    monkeypatch.setattr(langid, "TALLY", 20)
    monkeypatch.setattr(langid, "MEMO_BYTES", 2_000)
    rows = [(i, f"the cat number{'x' * i} sat, on the mat!", "en") for i in range(20)] + [(20 + i, f"die katze nummer{'y' * i} saß auf der Matte", "de") for i in range(20)]
    rows += [(100, None, "en"), (101, "", "de"), (102, "12 34 ½ -- ②", "de"), (103, "unseen catlike", None), (104, "ЖЖЖ", None), (None, "the cat", None), (105, "saß " * 3000 + "the", None), (105, "the", None), (106, "x" * 5000, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").withColumn("score", F.lit("clash")).withColumn("item", F.lit(1))
    model = langid.train(df)
    plain = brute_model([(t, g) for _, t, g in rows])
    assert model["langs"] == plain[0] == ["en", "de"] or set(model["langs"]) == {"en", "de"}
    got = langid.predict(df, model).collect()
    assert len(got) == len(rows) and got[0].asDict().keys() == {"doc_id", "lang_pred", "score"}
    by_id = {}
    for r in got:
        by_id.setdefault(r["doc_id"], []).append(r["lang_pred"])
    assert by_id[100] == by_id[101] == by_id[102] == ["und"] and by_id[103] == by_id[None] == ["en"] and sorted(by_id[105]) == ["de", "en"]
    assert by_id[104] == [model["langs"][0]]  # tells nothing
    assert all(r["lang_pred"] == brute_guess(plain, t)[0] for r, (_, t, _) in zip(sorted(got, key=lambda r: (r["doc_id"] is None, r["doc_id"])), sorted(rows, key=lambda r: (r[0] is None, r[0])), strict=True) if r["doc_id"] not in (105,))
    nothing = langid.train(df.limit(0))
    assert langid.predict(df.limit(0), model).count() == 0
    assert {(r["lang_pred"], r["score"]) for r in langid.predict(df, nothing).collect()} == {("und", 0.0)}


def test_too_many_languages(spark, monkeypatch):
    monkeypatch.setattr(langid, "LANGUAGES", 3)
    with pytest.raises(ValueError, match="more than 3"):
        langid.train(spark.createDataFrame([("word", str(i)) for i in range(4)], "text string, lang string"))
