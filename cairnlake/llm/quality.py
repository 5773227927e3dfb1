"""Document quality by a linear-chain conditional random field over lines.

Every line is good or bad. Its emission scores come from counts within the line and within its two
neighbours; a transition matrix ties a line to the next. Training maximises the
likelihood of line labels taken from the document's label. A document's quality is the
mean of its lines' forward-backward marginals of "good", weighted by line length.

Lines are counted with NumPy on the bytes of many texts at once, window by window; of a line only its
emission, length and forward message stay (some 30 bytes), so that a text of millions of lines is
scored whole. A line over LINE_BYTES bytes is read as several.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, text_of
from .toxicity import sample_of

#: The model is fitted on at most so many labelled documents, those of least hash, and on all their lines, in chains of at most so many.
SAMPLE_DOCS, CHAIN_LINES = 8_000, 48
#: At most so many bytes of sample texts, each line counting as so many more; a text that would go beyond is left out.
SAMPLE_BYTES, BYTES_A_LINE = 64_000_000, 200
#: A longer line is several lines; so many bytes of lines are counted at once.
LINE_BYTES = WINDOW_BYTES = 1 << 19
#: Messages that are held as Python numbers at once.
AT_ONCE = 100_000


def _among(of: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(of)] = True
    return out


UPPER, LOWER, DIGIT = _among(bytes(range(65, 91))), _among(bytes(range(97, 123))), _among(b"0123456789")
WHITE, MARK, STOP = _among(bytes([*range(9, 14), *range(28, 33)])), _among(b"#$%&*|!@^~=+<>{}[]\\/_"), _among(b".!?")
OTHER = ~(UPPER | LOWER | _among(b" " + bytes(range(128, 256))))
FEATURES = 17


def bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first) of the lines of texts that lie one after another in data: where each line begins and ends, and the first line of each text (and their number, last)."""
    low, n = int(offsets[0]), len(offsets) - 1
    breaks = np.flatnonzero(data[low : int(offsets[-1])] == 10).astype(np.int32) + np.int32(low)
    of_break = np.searchsorted(offsets, breaks, "right").astype(np.int32) - 1  # the text of each line break
    per = np.bincount(of_break, minlength=n) + 1
    first = np.concatenate([[0], np.cumsum(per)])
    starts, ends = np.empty(first[-1], np.int32), np.empty(first[-1], np.int32)
    after = np.arange(len(breaks)) + of_break + 1  # line that follows each break
    starts[first[:-1]], starts[after] = offsets[:-1], breaks + 1
    ends[first[1:] - 1], ends[after - 1] = offsets[1:], breaks
    pieces = np.maximum(1, -(-(ends - starts) // LINE_BYTES))
    if (pieces > 1).any():
        first = np.concatenate([[0], np.cumsum(pieces)])[first]
        step = np.arange(first[-1]) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        starts, ends = (np.repeat(starts, pieces) + step * LINE_BYTES).astype(np.int32), np.repeat(ends, pieces)
        ends = np.minimum(ends, starts + LINE_BYTES)
    return starts, ends, first


def features_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A row for each of some lines in a row: shape, marks, case and repetition, each of bounded size."""
    lines, d = len(starts), data[starts[0] : ends[-1]]
    s, e = starts - starts[0], ends - starts[0]
    begin = np.zeros(len(d) + 1, bool)
    begin[s] = True

    def each(mask: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(d) + 1, np.int32)
        np.cumsum(mask, out=sums[1:])
        return sums[e] - sums[s]

    word = ~WHITE[d]
    opens = word.copy()
    opens[1:] &= ~word[:-1] | begin[1:-1]
    n, at = each(opens), np.flatnonzero(opens)
    of_word = np.repeat(np.arange(lines), n)
    zero = np.zeros(lines)
    upper = distinct = same = zero
    if len(at):
        place = np.arange(len(d)) - at[np.maximum(np.cumsum(opens) - 1, 0)]
        place[~word] = 0
        powers = np.cumprod(np.full(int(place.max()) + 1, 0x9E3779B97F4A7C15, np.uint64))
        h = np.add.reduceat(np.where(word, (d.astype(np.uint64) + np.uint64(1)) * powers[place], np.uint64(0)), at)
        shout = (np.add.reduceat(UPPER[d], at, dtype=np.int32) > 0) & (np.add.reduceat(LOWER[d], at, dtype=np.int32) == 0)
        upper = np.bincount(of_word, shout, lines)
        same = np.bincount(of_word[1:], (h[1:] == h[:-1]) & (of_word[1:] == of_word[:-1]), lines)
        order = np.lexsort((h, of_word))
        h, of_word = h[order], of_word[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (of_word[1:] != of_word[:-1])
        distinct = np.bincount(of_word, new, lines)
    bang = d == 33
    bang[1:] &= bang[:-1] & ~begin[1:-1]
    bang[:1] = False
    links = np.flatnonzero((d[:-3] == 104) & (d[1:-2] == 116) & (d[2:-1] == 116) & (d[3:] == 112)) if len(d) > 3 else np.zeros(0, int)
    of_link = np.searchsorted(s, links, "right") - 1
    link = np.bincount(of_link[links + 4 <= e[of_link]], minlength=lines)
    size, full = e - s, e > s
    k, b = np.maximum(n, 1), np.maximum(size, 1)
    head, tail = np.zeros(lines, bool), np.zeros(lines, bool)
    head[full], tail[full] = UPPER[d[s[full]]], STOP[d[e[full] - 1]]
    return np.column_stack([
        np.ones(lines), np.minimum(size, 2000) / 500, np.minimum(n, 400) / 100, n == 0, n < 4,
        np.minimum(size / k, 30) / 10, each(OTHER[d]) / b, each(MARK[d]) / b, each(d == 124) / k, each(bang) / k,
        upper / k, distinct / k, same / k, tail, head, each(DIGIT[d]) / b, link / k,
    ]).astype(np.float64)


def windows(starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of lines that are counted at once."""
    load, i = ends.astype(np.int64) + 8 * np.arange(len(ends)), 0
    while i < len(ends):
        j = max(i + 1, int(np.searchsorted(load, int(starts[i]) + 8 * i + WINDOW_BYTES, "right")))
        yield i, j
        i = j


def of_text(text: str) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(text.encode(), np.uint8)
    return data, np.array([0, len(data)], np.int32)


def observed(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Features of each line beside those of the lines before and after it, and the lines' lengths (1 at least)."""
    data, offsets = of_text(text)
    starts, ends, _ = bounds(data, offsets)
    f = np.vstack([features_of(data, starts[i:j], ends[i:j]) for i, j in windows(starts, ends)])
    none = np.zeros((1, f.shape[1]))
    return np.hstack([f, np.vstack([none, f[:-1]]), np.vstack([f[1:], none])]), np.maximum(ends - starts, 1).astype(np.float64)


def marginals(emission: np.ndarray, move: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward over padded chains: P(state) of each line, expected moves of each chain, log of the partition sum.

    emission: chains x lines x 2; mask: chains x lines, true where a line is, lines first.
    """
    docs, lines, _ = emission.shape
    top = emission.max(2, keepdims=True)
    e, t = np.exp(emission - top), np.exp(move)
    a, scale = np.zeros_like(e), np.ones((docs, lines))
    for i in range(lines):
        x = e[:, 0] if i == 0 else (a[:, i - 1] @ t) * e[:, i]
        x = np.where(mask[:, i, None], x, a[:, i - 1] if i else 1.0)
        scale[:, i] = np.where(mask[:, i], x.sum(1), 1.0)
        a[:, i] = x / x.sum(1, keepdims=True)
    b = np.ones_like(e)
    moves = np.zeros((docs, 2, 2))
    for i in range(lines - 2, -1, -1):
        on = mask[:, i + 1]
        next_ = e[:, i + 1] * b[:, i + 1] / scale[:, i + 1, None]
        pair = a[:, i, :, None] * t * next_[:, None, :]
        moves += np.where(on[:, None, None], pair, 0.0)
        b[:, i] = np.where(on[:, None], next_ @ t.T, 1.0)
    p = a * b
    p /= p.sum(2, keepdims=True)
    return p, moves, (np.log(scale) + np.where(mask, top[:, :, 0], 0.0)).sum(1)


def fit(texts: list[str], labels: list[int], steps: int = 150, rate: float = 0.1, penalty: float = 1e-4) -> dict:
    """Weights (features x 2), transition matrix, and the features' means and spreads."""
    width = observed("")[0].shape[1]
    if not texts:
        return {"weights": np.zeros((width, 2)).tolist(), "move": np.zeros((2, 2)).tolist(), "mean": [0.0] * width, "spread": [1.0] * width}
    found = [observed(t)[0].astype(np.float32) for t in texts]
    lines = np.array([len(x) for x in found])
    mean = sum(x.sum(0, dtype=np.float64) for x in found) / lines.sum()
    spread = np.sqrt(sum(np.square(x - mean).sum(0) for x in found) / lines.sum())
    constant = spread < 1e-6
    mean[constant], spread[constant] = 0.0, 1.0
    # A text of many lines is several chains, none of its lines left out.
    chains = [(d, i, min(i + CHAIN_LINES, int(n))) for d, n in enumerate(lines) for i in range(0, int(n), CHAIN_LINES)]
    chains.sort(key=lambda c: c[2] - c[1])
    steps_of = np.bincount([d for d, _, _ in chains], [j - i - 1 for _, i, j in chains])  # moves within a document's chains
    batches = []
    for at in range(0, len(chains), 500):
        part = chains[at : at + 500]
        x, mask = np.zeros((len(part), part[-1][2] - part[-1][1], width), np.float32), np.zeros((len(part), part[-1][2] - part[-1][1]), bool)
        for row, (d, i, j) in enumerate(part):
            x[row, : j - i] = (found[d][i:j] - mean) / spread
            mask[row, : j - i] = True
        docs = np.array([d for d, _, _ in part])
        batches.append((x, mask, np.array(labels)[docs], lines[docs], steps_of[docs]))
    del found
    w, t = np.zeros((width, 2)), np.zeros((2, 2))
    m, v = np.zeros(width * 2 + 4), np.zeros(width * 2 + 4)
    for step in range(1, steps + 1):
        gw, gt = penalty * w, penalty * t
        for x, mask, y, all_lines, all_moves in batches:
            p, moves, _ = marginals(x @ w, t, mask)
            gold = np.zeros((len(y), 2))
            gold[np.arange(len(y)), y] = 1.0
            # Each document weighs the same, however many lines it has.
            share = (mask / all_lines[:, None])[:, :, None] / len(texts)
            gw = gw + np.tensordot(x, (p - gold[:, None, :]) * share, ((0, 1), (0, 1)))
            n = np.maximum(mask.sum(1) - 1, 0)
            true = np.zeros((len(y), 2, 2))
            true[np.arange(len(y)), y, y] = n
            gt = gt + ((moves - true) / np.maximum(all_moves, 1)[:, None, None]).sum(0) / len(texts)
        grad = np.append(gw.ravel(), gt.ravel())
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        change = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        w, t = w - change[:-4].reshape(w.shape), t - change[-4:].reshape(2, 2)
    return {"weights": w.tolist(), "move": t.tolist(), "mean": mean.tolist(), "spread": spread.tolist()}


class Scorer:
    def __init__(self, model: dict):
        self.w, self.t, self.mean, self.spread = (np.array(model[x]) for x in ("weights", "move", "mean", "spread"))
        # Only the difference between the two states counts.
        self.pull = ((self.w[:, 1] - self.w[:, 0]) / self.spread).reshape(3, FEATURES)
        self.base = -float(self.mean @ self.pull.ravel())

    def emissions(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Log odds of good for each line from what is seen, the lines' lengths, and the first line of each text."""
        starts, ends, first = bounds(data, offsets)
        n = len(starts)
        z, opens = np.full(n + 2, self.base), np.zeros(n + 1, bool)  # z has a place before the first line and one after the last
        opens[first] = True
        for i, j in windows(starts, ends):
            own, to_next, to_last = features_of(data, starts[i:j], ends[i:j]).dot(self.pull.T).T
            z[i + 1 : j + 1] += own
            z[i + 2 : j + 2] += np.where(opens[i + 1 : j + 1], 0.0, to_next)
            z[i:j] += np.where(opens[i:j], 0.0, to_last)
        return z[1:-1], np.maximum(ends - starts, 1), first

    def good(self, z: np.ndarray) -> np.ndarray:
        """P(good) of each line of a text by forward and backward messages. Odds of good to bad are all that two states need."""
        t00, t01, t10, t11 = np.exp(self.t - self.t.max()).ravel().tolist()
        odds = lambda part: np.exp(np.clip(part, -50, 50)).tolist()
        both, r = np.empty(len(z)), None
        for at in range(0, len(z), AT_ONCE):
            ahead = []
            for o in odds(z[at : at + AT_ONCE]):
                r = o if r is None else o * (t01 + r * t11) / (t00 + r * t10)
                r = min(max(r, 1e-60), 1e60)
                ahead.append(r)
            both[at : at + AT_ONCE] = ahead
        back = 1.0
        for at in reversed(range(0, len(z), AT_ONCE)):
            behind = []
            for o in reversed(odds(z[at : at + AT_ONCE])):
                behind.append(back)
                q = o * back
                back = min(max((t10 + t11 * q) / (t00 + t01 * q), 1e-60), 1e60)
            both[at : at + AT_ONCE] *= behind[::-1]
        return both / (1 + both)

    def many(self, data: np.ndarray, offsets: np.ndarray) -> list[tuple[float, int, int]]:
        """(quality, lines likelier good than bad, lines) of each text."""
        z, lengths, first = self.emissions(data, offsets)
        out = []
        for i, j in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            p, n = self.good(z[i:j]), lengths[i:j]
            out.append((min(1.0, float(p @ n / n.sum(dtype=np.int64))), int(np.count_nonzero(p > 0.5)), j - i))
        return out

    def lines(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """P(good) of each line, and the lines' lengths."""
        z, lengths, _ = self.emissions(*of_text(text))
        return self.good(z), lengths

    def score(self, text: str) -> float:
        return self.many(*of_text(text))[0][0]


def train(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE_DOCS) -> dict:
    """Fits the model in one task, on at most `sample` labelled documents of SAMPLE_BYTES in all.

    Rows with a null id or label, or a label other than 0 and 1, are not used; a null text is
    empty; of rows that share an id one is used. Without labelled rows every line is as likely good as bad.
    """
    found = sample_of(df, labels, id_col, text_col, label_col, sample, SAMPLE_BYTES, fit, lambda t: len(t) + BYTES_A_LINE * t.count("\n")).first()
    return json.loads(found["model"]) if found else fit([], [])


def score(df: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, good_lines, n_lines), one row per row; good_lines counts lines likelier good than bad.

    A null or empty text is one empty line. A text is scored whole, however long; it takes its own size and some
    40 bytes a line. Repeated rows are scored each; an empty table gives an empty result; other columns
    take no part, whatever their names.
    """
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        scorer = Scorer(model)
        for batch in (x for whole in batches for x in slices(whole)):
            texts = batch.column(1).cast(pa.string())
            _, offsets, data = texts.buffers()
            offsets = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1]
            scores, good, n = zip(*scorer.many(np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8), offsets), strict=True)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()), pa.array(good, pa.int64()), pa.array(n, pa.int64())], names=[id_col, "score", "good_lines", "n_lines"])

    return df.select(F.col(id_col), text_of(text_col).alias("__cl_text")).mapInArrow(run, f"`{id_col}` {kind}, score double, good_lines bigint, n_lines bigint")
