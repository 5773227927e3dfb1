"""The pipeline against a plain version of each stage, and the queries of the package against their SQL."""

from pathlib import Path
from zlib import crc32

import numpy as np
import pytest
from helpers import canonical
from test_search import brute_components, brute_overlaps

import corpus_pipeline
from cairnlake.llm import linededup, queries, toxicity
from cairnlake.llm.common import shared_folder


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, duck, sf_dir, name):
    df = queries.queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    rows = [tuple(r) for r in df.select(*columns).collect()]
    quoted = ", ".join(f'"{c}"' for c in columns)
    assert canonical(rows) == canonical(duck.execute(f"SELECT {quoted} FROM ({queries.oracle_sql()[name]})").fetchall())


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line dedup", "near-dedup", "decontamination", "packing"]
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        seen[name] = ([r.asDict() for r in docs.collect()], [r.asDict() for r in out.collect()])
        docs = spark.createDataFrame([tuple(r.values()) for r in seen[name][1]], docs.schema)

    before, after = seen["toxicity"]
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scorer = toxicity.Scorer(toxicity.train(spark.read.parquet(f"{sf_dir}/documents.parquet"), labels))
    assert {r["doc_id"] for r in after} == {r["doc_id"] for r in before if scorer.score(r["text"]) < 0.7}

    before, after = seen["line dedup"]
    texts, total = {}, {}
    for r in before:
        total[r["source"]] = total.get(r["source"], 0) + 1
        for line in {x.strip(" ") for x in r["text"].split("\n")} - {""}:
            texts.setdefault((r["source"], line), set()).add(r["text"])
    bad = {k for k, t in texts.items() if len(t) >= linededup.MIN_PAGES and len(t) / total[k[0]] > linededup.RATIO}
    want = {r["doc_id"]: "\n".join(x for x in r["text"].split("\n") if (r["source"], x.strip(" ")) not in bad) for r in before}
    assert {r["doc_id"]: r["text"] for r in after} == want and all(r["n_chars"] == len(r["text"]) for r in after if want[r["doc_id"]] != "")

    before, after = seen["near-dedup"]
    assert sorted(r["doc_id"] for r in after) == [r[0] for r in brute_components([(r["doc_id"], r["text"]) for r in before], 80) if r[3]]

    before, after = seen["decontamination"]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    leaked = {i for i, *_ in brute_overlaps([(r["doc_id"], r["text"]) for r in before], items)}
    assert 0 < len(leaked) < len(before) and {r["doc_id"] for r in after} == {r["doc_id"] for r in before} - leaked


def tables(spark):
    return {p.name for p in Path(shared_folder(spark).removeprefix("file:"), "cairnlake").glob("*")}


def test_run_keeps_what_is_not_its_own(spark, sf_dir):
    """A result that was made before still reads its saved tables afterwards; of the pipeline's own tables only its result is left."""
    held = linededup.drop_boilerplate(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    rows, before = held.count(), tables(spark)
    out = corpus_pipeline.run(spark, sf_dir)
    assert out.columns[0] == "doc_id" and out.count() > 0 and held.count() == rows
    assert len(tables(spark) - before) == 1 and before <= tables(spark)


def test_whole_pipeline_on_odd_rows(spark, tmp_path):
    """Null and empty texts, null and repeated ids, and an empty table go through every stage; what is packed is what a plain version of packing asks for."""
    from tokenizers import Tokenizer

    from cairnlake.llm.tokens import default_vocabulary

    word = lambda *k: "w" + "x".join(map(str, k))
    text = lambda k: "\n".join(" ".join(word(k, n, i) for i in range(15)) for n in range(4))
    item = " ".join(word("item", i) for i in range(30))
    rows = [(i, text(i), "en", f"s{i % 2}", 0) for i in range(20)]
    rows += [(100, text(3), "en", "s0", 0), (101, "lead " + item + " tail", "en", "s1", 0), (102, None, None, None, None), (103, "", "en", None, 0), (None, text(200), None, "s0", 0), (104, text(201), "en", "s1", 0), (104, text(201), "en", "s1", 0)]
    for name, data, schema in (("documents", rows, "doc_id bigint, text string, lang string, source string, n_chars bigint"), ("labels", [(0, 1, 0), (1, 1, 0)], "doc_id bigint, quality int, toxic int"), ("benchmark", [(1, item), (2, None)], "item_id bigint, text string")):
        spark.createDataFrame(data, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
        spark.createDataFrame([], schema).write.parquet(str(tmp_path / f"none/{name}.parquet"))
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    library = Tokenizer.from_file(default_vocabulary())
    ids = lambda t: np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
    want = {i: ids(t) for i, t, *_ in rows if i not in (100, 101)}
    assert {r["doc_id"] for r in found} == set(want)
    for i, own in want.items():
        pieces = sorted((r["start"], r["length"], r["ids_crc32"]) for r in found if r["doc_id"] == i)
        assert all(crc == crc32(own[at : at + n].tobytes()) for at, n, crc in pieces)
        times = 2 if i == 104 else 1  # both rows of a repeated one
        assert sum(n for _, n, _ in pieces) == times * len(own) and sorted({at for at, _, _ in pieces}) == [0, *np.cumsum([n for _, n, _ in pieces[::times]])[:-1].tolist()]
    by_sequence = {}
    for r in found:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in by_sequence.values():
        assert [at for at, _ in sorted(pieces)] == [0, *np.cumsum([n for _, n in sorted(pieces)])[:-1].tolist()] and sum(n for _, n in pieces) <= 2048
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0
