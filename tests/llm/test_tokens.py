import random
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from cairnlake.llm import common, packing, tokencount, tokens, wavelet
from cairnlake.llm.tokens import Encoder, default_vocabulary

ODD = ["", " ", "a", "  two  spaces ", "tab\tnew\n\nline\r\n", "<|endoftext|>", "x<|endoftext|> y<|endoftext|>", "don't we'll 12² ½ ªº", "é" * 50, "漢字 かな 😀　x", "\x1c\x85\xa0", "a" * 3000, "word " * 500, "trailing ", " leading", "a_b c-d (e) [f]", "12345 67", "I'm 'quoted' it's"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(default_vocabulary())


def texts(spark, sf_dir):
    return [r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]


def noise(n, seed):
    rng = random.Random(seed)
    letters = "ab \x00's\n\t,.!é²_1  'll<"
    return ["".join(rng.choice(letters) if rng.random() < 0.9 else chr(rng.randrange(1, 0xD7FF)) for _ in range(rng.randrange(60))) for _ in range(n)]


def test_encoder_equals_library(spark, sf_dir, library, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(tokens, "GATHER_WORDS", 700)
    monkeypatch.setattr(tokens, "CHUNK_BYTES", 50_000)
    every = [*ODD, *noise(2000, 1), *texts(spark, sf_dir)]
    for text, ids in zip(every, Encoder(default_vocabulary()).many(pa.array(every)), strict=True):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, repr(text[:80])
    assert list(Encoder(default_vocabulary()).many(pa.array([], pa.string()))) == []


def test_counts_equal_library(spark, sf_dir, library):
    import pyarrow as pa

    every = [*ODD, *noise(2000, 2), *texts(spark, sf_dir)]
    for text, n in zip(every, tokencount.Counter(default_vocabulary()).many(pa.array(every)), strict=True):
        assert n == len(library.encode(text, add_special_tokens=False).ids), repr(text[:80])


def rows_of(spark, values):
    return spark.createDataFrame(values, "doc_id bigint, text string")


def test_token_counts_rows(spark, library):
    df = rows_of(spark, [(1, "a b"), (None, None), (1, "a b"), (2, "<|endoftext|>"), (3, "x " * 2000)]).withColumn("n_tokens", F.lit("clash")).withColumn("text_", F.lit(0))
    got = sorted(map(tuple, tokencount.token_counts(df).collect()), key=str)
    want = [(1, 3, 2, False)] * 2 + [(2, 13, 1, False), (3, 4000, len(library.encode("x " * 2000).ids), True), (None, 0, 0, False)]
    assert got == sorted(want, key=str)
    assert tokencount.token_counts(df.limit(0)).count() == 0


def test_merging_is_by_rank_and_leftmost():
    c = tokencount.Counter.__new__(tokencount.Counter)
    c.ranks = {(b"a", b"a"): 0, (b"aa", b"a"): 1}
    assert [c.of_piece(b"a" * n) for n in range(1, 8)] == [1, 1, 1, 2, 2, 3, 3]


def test_wavelet_matrix():
    rng = np.random.default_rng(3)
    for tokens in (rng.integers(0, 50257, 5000), np.zeros(700, int), np.array([5]), np.arange(513), np.repeat([7, 60000], 600)):
        m = wavelet.WaveletMatrix.build(tokens.astype(np.uint32))
        back, ids, lengths, part, number = wavelet.from_bytes(wavelet.to_bytes(m, [1, None], [3, len(tokens) - 3], 4, 9))
        assert ids == [1, None] and lengths.tolist() == [3, len(tokens) - 3] and (part, number) == (4, 9)
        assert back.decode().tolist() == tokens.tolist()
        at = rng.integers(0, len(tokens), 200)
        assert back.access(at).tolist() == tokens[at].tolist()
        for token in {int(tokens[0]), int(tokens[-1])}:
            where = np.flatnonzero(tokens == token)
            assert back.count(token) == len(where)
            assert back.count(token, 1, len(tokens) // 2) == ((where >= 1) & (where < len(tokens) // 2)).sum()
            assert [back.locate(token, i) for i in (0, len(where) // 2, len(where) - 1)] == [where[0], where[len(where) // 2], where[-1]]
        assert back.count(55555) == 0
        with pytest.raises(IndexError):
            back.locate(int(tokens[0]), len(tokens) + 1)


def shards_by_hand(values, library):
    start, out = 0, []
    for i, text in values:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((i, start, len(ids), crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_token_shards(spark, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    values = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    got = sorted(map(tuple, wavelet.token_shards(docs.withColumn("start", F.lit("clash"))).collect()))
    assert got == shards_by_hand(values, library)


def test_token_shards_edges(spark, library, tmp_path):
    df = rows_of(spark, [(None, "n"), (3, None), (1, "a"), (2, ""), (1, "a"), (0, "long " * 3000)])
    shards = wavelet.write_shards(df, f"file://{tmp_path}/w", shard_tokens=50)
    assert shards.count() > 1 and shards.agg(F.sum("n_docs")).first()[0] == 6
    got = sorted(map(tuple, wavelet.read_documents(shards, f"file://{tmp_path}/w").collect()), key=lambda r: r[1])
    assert got == shards_by_hand([(None, "n"), (0, "long " * 3000), (1, "a"), (1, "a"), (2, ""), (3, None)], library)
    assert wavelet.token_shards(df.limit(0)).count() == 0


def check_packing(rows, values, library):
    """Each id lies in one piece, sequences are gapless and hold at most 2048; returns the share of padding."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert set(by_doc) == {i for i, _ in values}
    for i, text in values:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for p in sorted(by_doc[i], key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(ids)
            assert p["ids_crc32"] == crc32(ids[at : at + p["length"]].tobytes())
            at += p["length"]
        assert at == len(ids)
    room = 0
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p["offset"]):
            assert p["offset"] == at and p["length"] > 0
            at += p["length"]
        assert at <= 2048
        room += 0 if at & (at - 1) == 0 else 2048 - at
    return room / (2048 * len(by_sequence))


def test_packing(spark, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    values = [(r["doc_id"], r["text"]) for r in docs.collect()]
    rows = packing.pack(docs.repartition(5).withColumn("offset", F.lit("clash"))).collect()
    assert check_packing(rows, values, library) < 0.02


def test_packing_edges(spark, library):
    values = [(1, None), (2, ""), (3, "a " * 2047), (4, "b " * 4096), (None, "n")]
    assert check_packing(packing.pack(rows_of(spark, values)).collect(), values, library) < 0.5
    assert packing.pack(rows_of(spark, values).limit(0)).count() == 0
    assert packing.pack(rows_of(spark, [(1, "a"), (1, "a")])).count() == 2


def test_cuts():
    for n in range(1, 5000):
        found = packing.cuts(n, 2048)
        assert [a for a, _, _ in found] == np.cumsum([0, *(s for _, s, _ in found)])[:-1].tolist() and sum(s for _, s, _ in found) == n
        assert all(k * s <= 2048 < (k + 1) * s for _, s, k in found if s * 32 < 2048 or 2048 % s == 0)


def test_long_pieces_and_stretches(library, monkeypatch):
    import pyarrow as pa

    rng = random.Random(5)
    monkeypatch.setattr(tokens, "CHUNK_BYTES", 400)
    monkeypatch.setattr(tokencount, "LONG", 20)
    every = ["".join(rng.choice("abcdeé_1") for _ in range(900)), "x" * 5000, " ".join(f"w{rng.randrange(999)}" for _ in range(900)), "\n".join("ab, cd." for _ in range(300)), "two  spaces " * 90, "short", "", "<|endoftext|> and " * 60]
    want = [library.encode(t, add_special_tokens=False).ids for t in every]
    assert [x.tolist() for x in Encoder(default_vocabulary()).many(pa.array(every))] == want
    assert tokencount.Counter(default_vocabulary()).many(pa.array(every)).tolist() == list(map(len, want))


def test_memory_of_words_is_bounded():
    memo = tokens.Memo(lambda w: [len(w)], 10_000)
    assert all(memo[f"w{i}"] == [len(f"w{i}")] for i in range(3000)) and len(memo) < 70


def test_slices():
    import pyarrow as pa

    texts = ["a" * n for n in (5, 0, 7, 30, 1, 1)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(texts)], names=["i", "t"])
    found = [x.column(1).to_pylist() for x in common.slices(batch, most=12)]
    assert found == [texts[:3], texts[3:4], texts[4:]] and list(common.slices(batch.slice(0, 0))) == []


def test_other_vocabularies_are_refused():
    import public_tokenizers

    from cairnlake.llm.tokencount import Counter

    for make in (Encoder, Counter):
        with pytest.raises(ValueError, match="normalizer"):
            make(public_tokenizers.path("word_bpe_49k.json"))
