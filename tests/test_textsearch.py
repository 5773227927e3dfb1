import math
import re

import pytest
from pyspark.sql import functions as F

from cairnlake.operators.textsearch import TextIndex, postings

TEXTS = {1: "The cat sat on the mat.", 2: "cats and THE dogs", 3: None, 4: "", 5: "été cat-cat x1 the cat sat", 6: "on the mat the cat the cat sat on the mat", 7: "concatenate"}


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    df = spark.createDataFrame([*TEXTS.items(), (None, "the cat")], "id int, body string")
    return TextIndex.build(df, "id", "body", str(tmp_path_factory.mktemp("text")))


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def fits(w, q):
    return w.startswith(q[:-1]) if q.endswith("*") else w == q


@pytest.mark.parametrize("query", ["the", "the cat", "cat*", "THE cat* sat", "cat cat* cat", "é*", "x1 été", "nothing the", "", "*", "mat on"])
def test_search(index, query):
    asked = list(dict.fromkeys(q for q in query.lower().split() if q.strip("*")))
    has = {i: [sum(fits(w, q) for w in words(t)) for q in asked] for i, t in TEXTS.items()}
    want = {}
    for i, counts in has.items():
        if asked and all(counts):
            score = sum(n * math.log(1 + len(TEXTS) / sum(1 for c in has.values() if c[k])) for k, n in enumerate(counts))
            want[i] = (sum(counts), pytest.approx(score))
    assert {r["key"]: (r["matches"], r["score"]) for r in index.search(query).collect()} == want


@pytest.mark.parametrize("query", ["the cat", "the cat sat", "cat cat", "on the mat", "th* c* s*", "mat cat", ""])
def test_phrase(index, query):
    asked, want = query.split(), {}
    for i, t in TEXTS.items():
        w = words(t)
        if n := sum(all(fits(x, q) for x, q in zip(w[k : k + len(asked)], asked, strict=True)) for k in range(len(w) - len(asked) + 1) if asked):
            want[i] = n
    assert {r["key"]: r["matches"] for r in index.phrase(query).collect()} == want


def test_words_reach_the_scan(index):
    plan = index.search("the cat*")._jdf.queryExecution().executedPlan().toString()
    assert "StringStartsWith(term,cat)" in plan and "EqualTo(term,the)" in plan


def test_postings_stay_in_their_tasks(spark, tmp_path):
    """Texts are dealt out once, and each file of the index is sorted by word."""
    df = spark.createDataFrame([(i, f"b{i % 7} a{i} the b{i % 7} c") for i in range(300)], "id long, body string")
    made = postings(df, "id", "body")
    assert "Exchange" not in made._jdf.queryExecution().executedPlan().toString()
    assert {tuple(r) for r in made.where("key = 9").select("term", "n", F.concat_ws(" ", F.col("places").cast("array<string>"))).collect()} == {("a9", 1, "1"), ("b2", 2, "0 3"), ("c", 1, "4"), ("the", 1, "2")}
    TextIndex.build(df, "id", "body", str(tmp_path))
    files = {}
    for r in spark.read.parquet(f"{tmp_path}/postings").select(F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("at"), "term", "key").collect():
        files.setdefault(r["file"], []).append((r["at"], (r["term"], r["key"])))
    assert len(files) > 1 and all([x for _, x in sorted(rows)] == sorted(x for _, x in rows) for rows in files.values())
    assert len({f for f, rows in files.items() if any(t == "the" for _, (t, _) in rows)}) == len(files)  # a frequent word is in the segments of its texts, not in one task


def test_a_phrase_is_found_by_one_shuffle(index):
    plan = index.phrase("the cat sat")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Expand" not in plan
