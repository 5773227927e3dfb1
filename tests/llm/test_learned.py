import itertools
import random
from zlib import crc32

import numpy as np
import pytest

from cairnlake.llm import quality, toxicity
from cairnlake.llm.queries import op2_toxicity, op9_quality

SF = "/root/testdata/sf0.01"


def held_out(spark, query, label, parts, held):
    labels = {r["doc_id"]: r[label] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = query(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r["held_out"] == (crc32(str(r["doc_id"]).encode()) % parts == held) and 0 <= r["score"] <= 1 for r in rows)
    return [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]


def test_toxicity_on_held_out(spark):
    pairs = held_out(spark, op2_toxicity, "toxic", 3, 1)
    assert sum(a == b for a, b in pairs) / len(pairs) > 0.93


def test_quality_on_held_out(spark):
    pairs = held_out(spark, op9_quality, "quality", 5, 0)
    assert sum(a == b for a, b in pairs) / len(pairs) > 0.95


def test_noisy_or_and_sentences(spark):
    model = toxicity.fit(["fine words here. you are scum. all good"] * 5 + ["fine words here. all good"] * 20, [1] * 5 + [0] * 20)
    df = spark.createDataFrame([(1, "all good. you scum! fine"), (2, "all good"), (3, None), (4, "")], "doc_id bigint, text string")
    rows = {r["doc_id"]: r for r in toxicity.score(df, model).collect()}
    assert rows[1]["score"] > 0.7 > 0.3 > rows[2]["score"] and "scum" in rows[1]["worst_sentence"]
    assert rows[3]["score"] == rows[4]["score"] < 0.3 and rows[3]["worst_sentence"] is None
    s = toxicity.Scorer(model)
    p = 1 / (1 + np.exp(-np.array(s.sentence_logits("all good. you scum! fine"))))
    assert abs(s.score("all good. you scum! fine") - (1 - np.prod(1 - p))) < 1e-9
    assert [r["doc_id"] for r in toxicity.keep_below(df, model).orderBy("doc_id").collect()] == [2, 3, 4]
    assert toxicity.score(df.limit(0), model).count() == 0


@pytest.mark.parametrize("module", [toxicity, quality])
def test_training_without_usable_labels(spark, module):
    docs = spark.createDataFrame([(1, "a"), (None, "b")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(None, 1, 1), (1, None, None), (1, 7, 7), (9, 1, 1)], "doc_id bigint, toxic int, quality int")
    model = module.train(docs, labels)
    assert module.score(docs, model).count() == 2


def test_forward_backward_by_enumeration():
    rng = np.random.default_rng(4)
    lengths = [1, 4, 3]
    e, t = rng.normal(size=(3, 4, 2)), rng.normal(size=(2, 2))
    mask = np.arange(4) < np.array(lengths)[:, None]
    p, moves, logz = quality.marginals(e, t, mask)
    for d, n in enumerate(lengths):
        paths = list(itertools.product((0, 1), repeat=n))
        w = np.array([np.exp(sum(e[d, i, s] for i, s in enumerate(x)) + sum(t[a, b] for a, b in itertools.pairwise(x))) for x in paths])
        assert abs(np.log(w.sum()) - logz[d]) < 1e-9
        for i in range(n):
            assert abs(sum(w[j] for j, x in enumerate(paths) if x[i]) / w.sum() - p[d, i, 1]) < 1e-9
        want = np.zeros((2, 2))
        for j, x in enumerate(paths):
            for a, b in itertools.pairwise(x):
                want[a, b] += w[j] / w.sum()
        assert np.allclose(moves[d], want)


def test_odds_equal_forward_backward(spark, sf_dir):
    texts = [r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60).collect()]
    model = quality.fit(texts, [i % 2 for i in range(len(texts))], steps=20)
    s = quality.Scorer(model)
    for text in [*texts[:20], "", "a\n\nb"]:
        x, lengths = quality.observed(text)
        e = ((x - s.mean) / s.spread) @ s.w
        p, _, _ = quality.marginals(e[None], s.t, np.ones((1, len(e)), bool))
        assert np.allclose(p[0, :, 1], s.lines(text)[0], atol=1e-6)
        assert abs(s.score(text) - (p[0, :, 1] @ lengths) / lengths.sum()) < 1e-6


def test_quality_rows(spark):
    df = spark.createDataFrame([(1, None), (1, ""), (None, "good line\n*** ### ***")], "doc_id bigint, text string")
    model = quality.fit(["A good line.\nAnother good line."] * 6 + ["*** ### ***\n%%% $$$"] * 6, [1] * 6 + [0] * 6)
    rows = quality.score(df, model).collect()
    assert sorted(r["n_lines"] for r in rows) == [1, 1, 2] and all(0 <= r["score"] <= 1 for r in rows)
    assert quality.score(df.limit(0), model).count() == 0


def test_lines_of_any_number_and_length(monkeypatch):
    rng = random.Random(2)
    texts = ["\n".join(rng.choice(["A good line of words.", "*** ### ***", "", "WORD word word!! http://x 12|3"]) for _ in range(n)) for n in (1, 3, 200)] + ["", "\n", "é" * 50, "a" * 3000, "tail\n"]
    model = quality.fit(texts, [1, 0, 1, 0, 1, 0, 1, 0], steps=10)
    s = quality.Scorer(model)
    whole = [s.many(*quality.of_text(t))[0] for t in texts]
    data = [t.encode() for t in texts]
    offsets = np.cumsum([0, *map(len, data)]).astype(np.int32)
    many = lambda: s.many(np.frombuffer(b"".join(data), np.uint8), offsets)
    assert np.allclose(many(), whole)  # a text's score doesn't depend on those beside it
    monkeypatch.setattr(quality, "WINDOW_BYTES", 64)
    monkeypatch.setattr(quality, "AT_ONCE", 7)
    assert np.allclose(many(), whole)
    monkeypatch.setattr(quality, "LINE_BYTES", 1000)
    assert [n for _, _, n in many()] == [1, 3, 200, 1, 2, 1, 3, 2]


def test_line_counts():
    f = quality.observed("Ab cd cd, EF!! 12|\n\n http://a http .")[0]
    assert f[0, 2] * 100 == 5 and f[1, 3] == 1 and f[2, 2] * 100 == 3
    assert np.allclose(f[0, 8:13] * 5, [1, 1, 1, 5, 0]) and f[2, 13] == 1 and f[0, 14] == 1 and np.isclose(f[2, 16] * 3, 2)


@pytest.mark.parametrize("module", [toxicity, quality])
def test_scores_beside_any_column(spark, module):
    df = spark.createDataFrame([(1, "You scum. *** ###", "x", 2.0), (1, None, "y", None)], "doc_id bigint, text string, label string, score double")
    model = module.fit(["You scum.", "fine words here"] * 5, [1, 0] * 5)
    assert module.score(df, model).count() == 2 and module.score(df.limit(0), model).count() == 0
    assert toxicity.keep_below(df, toxicity.fit([], [])).columns == df.columns


def test_filter_keeps_rows_as_they_are(spark):
    model = toxicity.fit(["fine words here. you are scum. all good"] * 5 + ["fine words here. all good"] * 20, [1] * 5 + [0] * 20)
    df = spark.createDataFrame([(1, "all good. you scum!", 1), (2, "all good", 2), (2, "all good", 2), (None, None, 3), (4, "", None)], "doc_id bigint, text string, score bigint")
    assert sorted(map(tuple, toxicity.keep_below(df, model).collect()), key=str) == sorted([(2, "all good", 2), (2, "all good", 2), (None, None, 3), (4, "", None)], key=str)
    assert toxicity.keep_below(df.limit(0), model).count() == 0


def test_sample_is_bounded_by_its_texts(spark):
    docs = spark.createDataFrame([(i, "x" * 100) for i in range(50)] + [(99, "y" * 10_000)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, 1) for i in [*range(50), 99]], "doc_id bigint, toxic int")
    found = toxicity.sample_of(docs, labels, "doc_id", "text", "toxic", 30, 1_000, lambda texts, _: {"n": len(texts), "most": max(map(len, texts))})
    assert found.first()["model"] == '{"n": 10, "most": 100}'
