"""Toxicity by multiple-instance learning.

A document is a bag of sentences. Each sentence gets a probability from a logistic model over
its words and their stems (first letters); the document's probability is the noisy-or of its
sentences: 1 - prod(1 - p). Only document labels are used in training, by the gradient of
the noisy-or likelihood; the sentence scores then show where the offence lies.
"""

from __future__ import annotations

import json
import math
import re
from collections import Counter as Tally
from collections.abc import Callable, Iterator


import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, text_of
from .tokens import Memo

#: The model is fitted on at most so many labelled documents, those of least hash, and at most so many bytes of their texts; a text that would go beyond is left out.
SAMPLE_DOCS, SAMPLE_BYTES = 8_000, 48_000_000
#: The model looks at the stems and words that tell the labels apart best.
FEATURES = 2_000
STEMS = (4, 5, 6, 7)
SENTENCE_END = re.compile(r"[.!?\n]+(?:\s|$)|\n").finditer
EDGE = "\"'.,;:!?()[]{}<>|*&%$#@_-"


def features_of(word: str) -> list[str]:
    """The word itself and its stems, where it is longer."""
    w = word.strip(EDGE)
    return [w + "$", *(w[:n] for n in STEMS if len(w) >= n)] if w else []


def each_sentence(text: str) -> Iterator[str]:
    """Sentences with words in them; a text without any has one empty sentence. One at a time, however long the text."""
    at, none = 0, True
    for end in SENTENCE_END(text):
        if (s := text[at : end.start()]) and not s.isspace():
            none = False
            yield s
        at = end.end()
    if (s := text[at:]) and not s.isspace():
        yield s
    elif none:
        yield ""


def sentences_of(text: str) -> list[str]:
    return list(each_sentence(text))


def fit(texts: list[str], labels: list[int], steps: int = 500, rate: float = 0.1, penalty: float = 5e-6) -> dict:
    """Weights of the sentence model from document labels."""
    y = np.array(labels, np.float64)
    if not len(y):
        return {"bias": -5.0, "weights": {}}
    seen, known = [Tally(), Tally()], Memo(features_of)
    for text, label in zip(texts, labels, strict=True):
        seen[label].update(set().union(*map(known.__getitem__, set(text.lower().split()))))
    n1, n0 = max(1, int(y.sum())), max(1, int(len(y) - y.sum()))
    tells = {f: (a := seen[1][f], b := seen[0][f], abs(a / n1 - b / n0) ** 2 / ((a + b) / (n1 + n0) + 1 / len(y)))[2] for f in seen[0].keys() | seen[1].keys() if seen[0][f] + seen[1][f] >= 3}
    chosen = {f: i for i, f in enumerate(sorted(tells, key=lambda f: (-tells[f], f))[:FEATURES])}
    del seen, tells, known
    told = Memo(lambda w: [chosen[f] for f in features_of(w) if f in chosen])
    doc, row, col = [], [], []
    for d, text in enumerate(texts):
        for s in sentences_of(text):
            here = [i for w in s.lower().split() for i in told[w]]
            row += [len(doc)] * len(here)
            col += here
            doc.append(d)
    doc, row, col = np.array(doc), np.array(row, np.int64), np.array(col, np.int64)
    w, bias, m, v = np.zeros(len(chosen)), -4.0, np.zeros(len(chosen) + 1), np.zeros(len(chosen) + 1)
    for step in range(1, steps + 1):
        z = bias + np.bincount(row, w[col], len(doc)) if len(row) else np.full(len(doc), bias)
        none = np.maximum(np.bincount(doc, np.logaddexp(0, z), len(y)), 1e-12)  # -log(1 - p) of each document
        p = -np.expm1(-none)
        pull = np.where(y == 1, -np.exp(-none) / p, 1.0) / len(y)
        dz = pull[doc] / (1 + np.exp(-z))
        grad = np.append(np.bincount(col, dz[row], len(chosen)) if len(row) else np.zeros(len(chosen)), dz.sum())
        grad[:-1] += penalty * w
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        w, bias = w - move[:-1], bias - move[-1]
    return {"bias": float(bias), "weights": {f: round(float(w[i]), 5) for f, i in chosen.items() if abs(w[i]) > 1e-3}}


class Scorer:
    def __init__(self, model: dict):
        weight = model["weights"].get
        self.bias = model["bias"]
        self.words = Memo(lambda w: sum(weight(f, 0.0) for f in features_of(w)), 20_000_000)

    def logit(self, sentence: str) -> float:
        return self.bias + sum(map(self.words.__getitem__, sentence.lower().split()))

    def sentence_logits(self, text: str) -> list[float]:
        return [self.logit(s) for s in sentences_of(text)]

    def judge(self, text: str) -> tuple[float, float, str | None]:
        """The noisy-or over the sentences, the greatest sentence logit, and its first sentence if that is over the bias."""
        none, best, where = 0.0, -math.inf, None
        for s in each_sentence(text):
            z = self.logit(s)
            none += z if z > 30 else math.log1p(math.exp(z)) if z > -30 else 0.0
            if z > best:
                best, where = z, s
        return -math.expm1(-none), best, where if best > self.bias else None

    def score(self, text: str) -> float:
        """Noisy-or over the sentences."""
        return self.judge(text)[0]


def train(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE_DOCS) -> dict:
    """Fits the model in one task, on at most `sample` labelled documents.

    Rows with a null id or label, or a label other than 0 and 1, are not used; a null text is
    empty; of rows that share an id one is used. Without labelled rows the model gives every text the same low score.
    """
    found = sample_of(df, labels, id_col, text_col, label_col, sample, SAMPLE_BYTES, fit).first()
    return json.loads(found["model"]) if found else fit([], [])


def sample_of(df: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, sample: int, most: int, fit: Callable[[list[str], list[int]], dict], weight: Callable[[str], int] = len) -> DataFrame:
    """(model) by fit, as JSON, of the labelled documents of least hash: at most `sample`, weighing at most `most` in all, read in that order by one task."""
    known = labels.where(F.col(label_col).isin(0, 1)).select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).dropDuplicates(["id"])
    order = F.xxhash64(F.col("id").cast("string"))
    chosen = known.join(df.select(F.col(id_col).alias("id")), "id", "left_semi").orderBy(order, "id").limit(sample)
    rows = df.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).join(F.broadcast(chosen), "id").select("id", "label", "text")

    def run(batches: Iterator) -> Iterator:
        texts, out, held, last = [], [], 0, None
        for batch in (x for whole in batches for x in slices(whole)):
            for i, label, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if i != last and held + (size := weight(text)) <= most:
                    texts.append(text)
                    out.append(label)
                    held += size
                last = i
        if texts:
            yield pa.RecordBatch.from_arrays([pa.array([json.dumps(fit(texts, out))])], names=["model"])

    return rows.repartition(1).sortWithinPartitions(order, "id", "text").mapInArrow(run, "model string")


def score(df: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, worst_sentence, worst_score), one row per row; worst_sentence is the text of the sentence likeliest to offend.

    A null or empty text is one empty sentence, its score the model's floor. Texts are read sentence by
    sentence, however long. Ties between sentences go to the first. Repeated rows are scored each;
    an empty table gives an empty result; other columns take no part, whatever their names.
    """
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        scorer = Scorer(model)
        for batch in (x for whole in batches for x in slices(whole)):
            scores, z, where = zip(*map(scorer.judge, batch.column(1).to_pylist()), strict=True)
            worst = pa.array([1 / (1 + math.exp(-max(x, -700))) for x in z], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()), pa.array(where, pa.string()), worst], names=[id_col, "score", "worst_sentence", "worst_score"])

    return df.select(F.col(id_col), text_of(text_col).alias("__cl_text")).mapInArrow(run, f"`{id_col}` {kind}, score double, worst_sentence string, worst_score double")


def keep_below(df: DataFrame, model: dict, least: float = 0.7, text_col: str = "text") -> DataFrame:
    """The rows of df whose text scores below `least`, columns unchanged.

    A null text scores as an empty one. Each row is judged by its text alone, repeated ones too; an empty
    table gives an empty result. Only the text goes to Python, so other columns take no part, whatever their names.
    """

    def below(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(model)
        for batch in texts:
            rows = pa.RecordBatch.from_arrays([batch], names=["text"])
            kept = [scorer.score(t) < least for part in slices(rows) for t in part.column(0).to_pylist()]
            yield pa.array(kept, pa.bool_())

    return df.where(F.arrow_udf(below, "boolean")(text_of(text_col)))
