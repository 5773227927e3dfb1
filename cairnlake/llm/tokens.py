"""Token ids of whole texts, by the tokenizers library, each different piece of a batch once.

A byte-level BPE never joins symbols across the pieces that its splitting pattern
makes. Where single spaces and newlines are the only white space of a text, each of them
starts a piece, so the ids of the text are those of its words put together. Such texts are cut there
with Arrow, a batch's different words go to the library (or come from the memory of the worker), and
NumPy puts the ids together. Any other text goes to the library whole.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import lru_cache
from typing import TYPE_CHECKING, Any

import numpy as np

if TYPE_CHECKING:
    import pyarrow as pa

#: Memory that remembered words may take in a worker (by an estimate of each entry), bytes of text that are cut at once, and words whose ids are put together at once.
MEMO_BYTES, CHUNK_BYTES, GATHER_WORDS = 30_000_000, 3_000_000, 200_000
#: What an entry takes besides the bytes of its word and value.
ENTRY_BYTES = 160
CUT = "\x00"
#: White space other than single spaces and newlines between words, and the sign that cuts.
NOT_PLAIN = r"^[ \n]|[ \n]$|[ \n][ \n]|[\x00\t\x0b\x0c\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: Latin letters or none and then marks or none, after a space or not: a piece each.
SIMPLE = re.compile(r"( ?[A-Za-zÀ-ÖØ-öø-ɏ]+)?([.,;:!?|*&%$#)]*)").fullmatch

GAP = re.compile("[ \n]").search


def byte_names() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: itself if printable in Latin-1, else 256 and up in order."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class Memo(dict):
    """Values of words by a function. Once full it keeps what it has, frequent words mostly, and starts anew after many misses."""

    def __init__(self, value: Callable[[str], Any], most: int | None = None):
        super().__init__()
        self.value, self.most, self.held, self.misses = value, MEMO_BYTES if most is None else most, 0, 0

    def __missing__(self, word: str) -> Any:
        out = self.value(word)
        if self.held < self.most:
            if len(word) <= 64:
                self[word] = out
                self.held += ENTRY_BYTES + len(word) + (len(out) if isinstance(out, (bytes, list)) else 0)
        else:
            self.misses += 1
            if self.misses > self.most // 20:
                self.forget()
        return out

    def forget(self) -> None:
        self.clear()
        self.held = self.misses = 0


class Words:
    """Cuts plain texts into words and gives their values: piece() of a single piece, value() of any text; values can be added."""

    def __init__(self, piece: Callable[[str], Any], value: Callable[[str], Any], never: tuple[str, ...] = (), most: int | None = None):
        self.memo, self.value, self.never = Memo(piece, most), value, never

    def of(self, words: list[str]) -> list:
        out, memo = [], self.memo
        for w in words:
            if (v := memo.get(w)) is None:
                m = SIMPLE(w)
                if m is None:
                    v = self.value(w)
                elif m[1] and m[2]:
                    v = memo[m[1]] + memo[m[2]]
                else:
                    v = memo[w]
            out.append(v)
        return out

    def not_plain(self, texts: pa.Array) -> pa.Array:
        """Whether a text must go to the library whole."""
        import pyarrow.compute as pc

        odd = pc.or_(pc.match_substring_regex(texts, NOT_PLAIN), pc.equal(texts, ""))
        for x in self.never:
            odd = pc.or_(odd, pc.match_substring(texts, x))
        return odd

    def stretches(self, text: str) -> list[str] | None:
        """A long plain text in stretches that begin with its white space, so that their words are those of the text; None if it isn't plain."""
        import pyarrow as pa

        if self.not_plain(pa.array([text]))[0].as_py():
            return None
        out, start = [], 0
        while start < len(text):
            found = GAP(text, start + CHUNK_BYTES // 4)
            end = found.start() if found else len(text)
            out.append(text[start:end])
            start = end
        return out

    def cut(self, texts: pa.Array, plain: bool = False) -> Iterator[tuple[int, pa.Array, np.ndarray, np.ndarray, list]]:
        """For chunks of texts: the first row, which rows are plain, where their words begin and end, each word's number, the different words' values.

        Rows that aren't plain have no words. plain: all are known to be plain.
        """
        import pyarrow as pa
        import pyarrow.compute as pc

        sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False)) if len(texts) else np.zeros(0)
        row = 0
        while row < len(texts):
            end = max(row + 1, int(np.searchsorted(sizes, (sizes[row - 1] if row else 0) + CHUNK_BYTES)))
            part = texts.slice(row, end - row)
            odd = self.not_plain(part) if not plain else pa.array([False] * len(part))
            marked = pc.replace_substring(pc.replace_substring(pc.if_else(odd, "", part), " ", CUT + " "), "\n", CUT + "\n" + CUT)
            lists = pc.split_pattern(marked, CUT)
            words = lists.flatten().dictionary_encode()
            if isinstance(words, pa.ChunkedArray):
                words = words.combine_chunks()
            yield row, odd, np.asarray(lists.offsets), np.asarray(words.indices), self.of(words.dictionary.to_pylist())
            row = end


def byte_level(path: str) -> dict:
    """The contents of a vocabulary file; ValueError where texts are not cut as byte-level BPE cuts them, as counts and ids by words would be wrong then."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, cut = spec["model"], spec.get("pre_tokenizer") or {}
    odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges") if model.get(k)]
    if spec.get("normalizer"):
        odd.append("normalizer")
    if cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex", True):
        odd.append("pre_tokenizer")
    if model.get("type", "BPE") != "BPE":
        odd.append("model")
    if odd:
        raise ValueError(f"{path} is not a plain byte-level BPE vocabulary: {', '.join(odd)}")
    return spec


class Encoder:
    """Token ids as unsigned 32-bit integers."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        byte_level(path)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        encode = self.tokenizer.encode
        self.raw = raw = lambda text: np.array(encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        added = tuple(x.content for x in self.tokenizer.get_added_tokens_decoder().values())
        of_piece, names = self.tokenizer.model.tokenize, dict(enumerate(byte_names()))

        def piece(text: str) -> bytes:
            # A lone piece needs no splitting: the library's model takes it at once, in its names of bytes.
            text = text.replace(" ", names[32]) if text.isascii() else text.encode().decode("latin-1").translate(names)
            return array("I", [x.id for x in of_piece(text)]).tobytes()

        self.words = Words(piece, raw, added)

    def many(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text, in order; texts is an Arrow array of strings without nulls. A long plain text is cut and put together in stretches."""
        import pyarrow as pa

        for some, long in by_length(texts):
            if not long:
                yield from self._of(some)
            elif (parts := self.words.stretches(text := some[0].as_py())) is None:
                yield np.frombuffer(self.raw(text), "<u4")
            else:
                yield np.concatenate([ids for x in parts for ids in self._of(pa.array([x]), plain=True)])

    def _of(self, texts: pa.Array, plain: bool = False) -> Iterator[np.ndarray]:
        for row, odd, offsets, which, values in self.words.cut(texts, plain):
            lengths = np.fromiter(map(len, values), np.int32, len(values)) // 4
            flat, starts = np.frombuffer(b"".join(values), "<u4"), np.cumsum(lengths, dtype=np.int32) - lengths
            others, n, i = odd.to_pylist(), len(offsets) - 1, 0
            while i < n:
                j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + GATHER_WORDS)) - 1)
                words = which[offsets[i] : offsets[j]]
                each = lengths[words]
                ends = np.cumsum(each, dtype=np.int32)
                ids = flat[np.repeat(starts[words] - (ends - each), each) + np.arange(int(ends[-1]) if len(ends) else 0, dtype=np.int32)]
                at = np.concatenate([[0], ends])[offsets[i : j + 1] - offsets[i]].tolist()
                for k in range(i, j):
                    yield np.frombuffer(self.raw(texts[row + k].as_py()), "<u4") if others[k] else ids[at[k - i] : at[k - i + 1]]
                i = j


def by_length(texts: pa.Array) -> Iterator[tuple[pa.Array, bool]]:
    """Runs of texts of at most CHUNK_BYTES each, and each longer text alone (true), in order."""
    import pyarrow.compute as pc

    at = 0
    for i in np.flatnonzero(pc.binary_length(texts).to_numpy(zero_copy_only=False) > CHUNK_BYTES).tolist() if len(texts) else []:
        if i > at:
            yield texts.slice(at, i - at), False
        yield texts.slice(i, 1), True
        at = i + 1
    if at < len(texts):
        yield texts.slice(at), False


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """One encoder for each worker process."""
    return Encoder(path)


@contextmanager
def for_task() -> Iterator[None]:
    """At the end of a task Arrow's unused memory is given back: a worker process outlives its tasks. Words stay remembered, in a bounded memory."""
    import pyarrow as pa

    try:
        yield
    finally:
        pa.default_memory_pool().release_unused()


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
