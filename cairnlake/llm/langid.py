"""Language identification by words first, with backoff to character n-grams.

Training counts every word of the labelled texts by language, and the character n-grams (of 1 to ORDERS
characters, a space at both ends of a word) of the same words. A word that some language knows scores by the logarithm of its share in each
language; one that none knows scores by its n-grams of the greatest length of which any is known, on
average; a word without any known n-gram tells nothing. The language with the greatest sum wins.

The model is bounded by shares: what has a share of less than 1 / m in its language is left out, so that a language
has at most m words and at most m / ORDERS n-grams of a length, whatever the corpus. Nothing is ranked, and no group is gathered.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import TYPE_CHECKING

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved, slices, text_of

if TYPE_CHECKING:
    import pyarrow as pa

#: Longest n-gram. The model's words and n-grams over all languages, and numbers in its table, are at most so many.
ORDERS, PAIRS, CELLS = 5, 400_000, 16_000_000
#: More languages than this are an error.
LANGUAGES = 2_000
#: What a language scores below the least logarithm of its lists for a word or n-gram that isn't in them.
PENALTY = 2.0
#: Different words that a worker counts before it hands the counts on; bytes of words that it remembers; characters read at once.
TALLY, MEMO_BYTES, STRETCH = 200_000, 80_000_000, 1 << 20
#: Signs that are taken for spaces before a text is cut at white space; other signs are met run by run.
SIGNS = '.,;:!?|()"'
WORD, GAP = r"\p{L}[\p{L}\p{M}]*", r"[^\p{L}\p{M}]"
UNKNOWN = "und"


def stretches(text: str, most: int = STRETCH) -> Iterator[str]:
    """The text in lower case, its signs as spaces, in turn, cut only where no word is."""
    import regex

    gap, at = regex.compile(GAP), 0
    while at < len(text):
        end = at + most
        if end < len(text):
            found = gap.search(text, end)
            end = found.start() if found else len(text)
        part = text[at:end].lower()
        for sign in SIGNS:
            part = part.replace(sign, " ")
        yield part
        at = end


def grams(word: str) -> list[str]:
    """The n-grams of a word with a space at both ends; of one character, those of the word alone."""
    w = f" {word} "
    return [*word, *(w[i : i + n] for n in range(2, ORDERS + 1) for i in range(len(w) - n + 1))]


def _partial_counts(counts: dict[str, Counter]) -> pa.RecordBatch:
    import pyarrow as pa

    langs, items, n = [], [], []
    for lang, own in counts.items():
        langs += [lang] * len(own)
        items += own.keys()
        n += own.values()
    return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(items, pa.string()), pa.array(n, pa.int64())], names=["lang", "item", "n"])


def words_in(counts: dict[str, Counter]) -> dict[str, Counter]:
    """The words in counted runs of characters without white space."""
    import regex

    words, out = regex.compile(WORD).findall, {}
    for lang, own in counts.items():
        seen = out[lang] = Counter()
        for token, n in own.items():
            if token.isalpha():
                seen[token] += n
            else:
                for w in words(token):
                    seen[w] += n
    return out


def word_counts(df: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, item, n) of every word of every text with a language; workers hand on partial counts."""

    def run(batches: Iterator) -> Iterator:
        seen, size = {}, 0
        for batch in (x for whole in batches for x in slices(whole)):
            for lang, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for part in stretches(text):
                    own = seen.setdefault(lang, Counter())
                    size -= len(own)
                    own.update(part.split())
                    size += len(own)
                    if size > TALLY:
                        yield _partial_counts(words_in(seen))
                        seen, size = {}, 0
        if size:
            yield _partial_counts(words_in(seen))

    rows = df.where(F.col(lang_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), text_of(text_col).alias("text"))
    return rows.mapInArrow(run, "lang string, item string, n bigint").groupBy("lang", "item").agg(F.sum("n").alias("n"))


def gram_counts(words: DataFrame) -> DataFrame:
    """(lang, item, n) of the character n-grams of counted words."""

    def run(batches: Iterator) -> Iterator:
        seen, size = {}, 0
        for batch in batches:
            for lang, word, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = seen.setdefault(lang, Counter())
                size -= len(own)
                if n == 1:
                    own.update(grams(word))
                else:
                    for g in grams(word):
                        own[g] += n
                size += len(own)
                if size > TALLY:
                    yield _partial_counts(seen)
                    seen, size = {}, 0
        if size:
            yield _partial_counts(seen)

    return words.select("lang", "item", "n").mapInArrow(run, "lang string, item string, n bigint").groupBy("lang", "item").agg(F.sum("n").alias("n"))


def train(df: DataFrame, text_col: str = "text", lang_col: str = "lang") -> dict:
    """The model: languages, items (words, and n-grams marked by their order) and their logarithms by language.

    Every row with a language counts, repeated ones too; a null text is empty. Languages without a word are
    not learned. Without any row the model knows no language.
    """
    words = saved(word_counts(df, text_col, lang_col), "words")
    kinds = saved(words.select("lang", F.lit(0).alias("order"), "item", "n").unionByName(gram_counts(words).select("lang", F.length("item").alias("order"), "item", "n")), "items")
    totals = kinds.groupBy("lang", "order").agg(F.sum("n").alias("total"))
    found = totals.where("order = 0").limit(LANGUAGES + 1).collect()
    if len(found) > LANGUAGES:
        raise ValueError(f"{lang_col} has more than {LANGUAGES} values")
    if not found:
        return {"langs": [], "items": [], "cells": np.zeros((0, 0), np.float32)}
    langs = [r["lang"] for r in sorted(found, key=lambda r: (-r["total"], r["lang"]))]
    most = max(ORDERS, min(PAIRS, CELLS // len(langs)) // (2 * len(langs)))
    share = F.col("n") / F.col("total")
    least = F.when(F.col("order") == 0, 1 / most).otherwise(ORDERS / most)
    # A row for each language and order; shares of an order sum to 1, so what is collected is bounded.
    kept = kinds.join(F.broadcast(totals), ["lang", "order"]).where(share >= least).select("lang", "order", "item", F.log(share).alias("log")).toArrow()
    at: dict[tuple[int, str], int] = {}
    rows = [at.setdefault(x, len(at)) for x in zip(kept["order"].to_pylist(), kept["item"].to_pylist(), strict=True)]
    floor = np.log([1 / most] + [ORDERS / most] * ORDERS) - PENALTY
    cells = np.repeat(floor[[order for order, _ in at]][:, None], len(langs), 1).astype(np.float32)
    number = {x: i for i, x in enumerate(langs)}
    cells[rows, [number[x] for x in kept["lang"].to_pylist()]] = kept["log"].to_numpy()
    return {"langs": langs, "items": list(at), "cells": cells}


class Guesser:
    """guess(text) by a model.

    A run of characters without white space is a row of a table: the sum over its words. Rows that are not in the model are worked out together for
    a stretch of text and remembered until they take up their memory. Row 0 is that of runs without a letter, row 1 of those that tell nothing.
    """

    def __init__(self, model: dict):
        import regex

        self.langs, self.words = model["langs"], regex.compile(WORD).findall
        self.grams: list[dict[str, int]] = [{} for _ in range(ORDERS + 1)]
        for row, (order, item) in enumerate(model["items"], 2):
            self.grams[order][item] = row
        self.cells = np.zeros((len(model["items"]) + 2, len(self.langs)))
        self.cells[2:] = model["cells"]
        self.forget()

    def forget(self) -> None:
        self.rows, self.held, self.used = dict(self.grams[0]), 0, len(self.cells)
        self.table = self.cells

    def evidence(self, token: str) -> tuple[list[int], list[float]] | None:
        """Rows and weights of a run: of each known word, or of the longest known n-grams of a word; None without a letter."""
        rows, weights, some, known = [], [], False, self.grams[0].get
        for word in (token,) if token.isalpha() else self.words(token):
            some = True
            if (row := known(word)) is not None:
                rows.append(row)
                weights.append(1.0)
                continue
            w = f" {word} "
            for order in range(ORDERS, 0, -1):
                get = self.grams[order].get
                found = [row for i in range(len(w) - order + 1) if (row := get(w[i : i + order])) is not None]
                if found:
                    rows += found
                    weights += [1 / len(found)] * len(found)
                    break
        return (rows, weights) if some else None

    def learn(self, tokens: set[str]) -> None:
        rows, weights, starts, named = [], [], [], []
        for token in tokens:
            self.held += 160 + len(token) + 8 * len(self.langs)
            if (told := self.evidence(token)) is None:
                self.rows[token] = 0
            elif not told[0]:
                self.rows[token] = 1
            else:
                starts.append(len(rows))
                named.append(token)
                rows += told[0]
                weights += told[1]
        if named:
            new = np.add.reduceat(self.cells[rows] * np.array(weights)[:, None], starts)
            if self.used + len(new) > len(self.table):
                self.table = np.concatenate([self.table[: self.used], np.zeros((self.used + 2 * len(new), len(self.langs)))])
            self.table[self.used : self.used + len(new)] = new
            self.rows.update(zip(named, range(self.used, self.used + len(new)), strict=True))
            self.used += len(new)

    def guess(self, text: str) -> tuple[str, float]:
        total, some = np.zeros(len(self.langs)), False
        for part in stretches(text):
            if self.held > MEMO_BYTES:
                self.forget()
            tokens = part.split()
            if missing := set(tokens).difference(self.rows):
                self.learn(missing)
            rows = np.array([self.rows[t] for t in tokens], np.int64)
            some = some or bool(rows.any())
            total += self.table[rows].sum(0)
        if not some or not self.langs:
            return UNKNOWN, 0.0
        best = int(total.argmax())
        return self.langs[best], float(1 / np.exp(total - total[best]).sum())


def predict(df: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score), one row per row; score is the language's share of the likelihood over all languages.

    A text that is null, or has no letter, is `und` with score 0, and so is every text where no language was learned.
    Ties, and texts whose words tell nothing, go to the language with more words in training, then to the lesser name. Whole texts are read, in
    stretches, however long. Repeated rows are predicted each; an empty table gives an empty result; other columns take no part, whatever their names.
    """
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        guesser = Guesser(model)
        for batch in (x for whole in batches for x in slices(whole)):
            names, scores = zip(*map(guesser.guess, batch.column(1).to_pylist()), strict=True)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=[id_col, "lang_pred", "score"])

    return df.select(F.col(id_col), text_of(text_col).alias("__cl_text")).mapInArrow(run, f"`{id_col}` {kind}, lang_pred string, score double")
