import itertools
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from cairnlake.llm import decontaminate, linededup, neardup, topk
from cairnlake.llm.components import components


# Top-k


def brute_top_k(vectors, every=50, k=5):
    fine = {i: np.floor(256 * np.array(v, np.float64)).astype(int) for i, v in vectors if i is not None and v and all(x is not None and np.isfinite(x) for x in v)}
    out = []
    for q in fine:
        if q % every == 0:
            found = sorted((-int(fine[q] @ fine[c]), c) for c in fine if c != q and len(fine[c]) == len(fine[q]))[:k]
            out += [(q, r, c, -s) for r, (s, c) in enumerate(found, 1)]
    return sorted(out)


def test_top_k(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    want = brute_top_k([(r["vec_id"], r["embedding"]) for r in df.collect()])
    assert sorted(map(tuple, topk.top_k(df.withColumn("rank", F.lit("clash"))).collect())) == want


def test_top_k_ties_and_gaps(spark, monkeypatch):
    rng = np.random.default_rng(1)
    rows = [(i, rng.integers(-2, 3, 40).astype(float).tolist()) for i in range(300)]
    rows += [(300, None), (301, []), (302, [1.0, None] * 20), (303, [float("nan")] * 40), (304, [float("inf")] * 40), (None, [1.0] * 40), (350, [1.0] * 7), (351, [2.0] * 7), (400, [0.0] * 40), (1, rows[1][1])]
    monkeypatch.setattr(topk, "CANDIDATES", 50)
    monkeypatch.setattr(topk, "QUERIES", 2)
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    assert sorted(map(tuple, topk.top_k(df).collect())) == brute_top_k(rows)
    assert topk.top_k(df.limit(0)).count() == 0
    assert topk.top_k(df.where("vec_id = 50")).count() == 0


# Near-duplicates


def brute_components(rows, percent):
    sets = {}
    for i, text in rows:
        w = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[i] = {tuple(w[j : j + 5]) for j in range(len(w) - 4)} or ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        common, both = len(sets[a] & sets[b]), len(sets[a] | sets[b])
        if common and 100 * common >= percent * both:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    return sorted((i, len(s), find(i), find(i) == i) for i, s in sets.items())


def got(spark, rows, percent):
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("kept", F.lit("clash")).withColumn("node", F.lit(1))
    return sorted(map(tuple, neardup.near_duplicates(df, percent=percent).collect()))


@pytest.mark.parametrize("percent", [80, 85])
def test_near_duplicates_of_documents(spark, sf_dir, percent):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert got(spark, rows, percent) == brute_components(rows, percent)


def test_copies_of_many_strengths(spark):
    """One text edited from hardly to heavily: many pairs lie near the threshold, and links form chains."""
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in rng.integers(0, 4000, 150)]
    rows = []
    for i in range(160):
        words = list(base if i % 3 or not rows else rows[int(rng.integers(len(rows)))][1].split())
        for _ in range(int(rng.integers(0, 12))):
            words[int(rng.integers(len(words)))] = f"x{rng.integers(10**6)}"
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, " ".join(base)) for i in range(40)]
    for percent in (80, 85):
        assert got(spark, rows, percent) == brute_components(rows, percent)


def test_near_duplicate_edges(spark):
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "A b"), (5, "a B"), (6, "a b c"), (7, "É x"), (8, "é x"), (9, "one two three four five"), (10, "ONE\x0btwo three\nfour five")]
    assert got(spark, rows, 85) == brute_components(rows, 85)
    assert got(spark, [], 85) == []
    df = spark.createDataFrame([(None, "a b"), (None, "a b"), (3, "a b"), (3, "c d"), (1, "c d"), (3, "a b")], "doc_id bigint, text string")
    assert sorted(map(tuple, neardup.near_duplicates(df).collect()), key=str) == sorted([(None, 1, None, True)] * 2 + [(3, 1, 1, False)] * 3 + [(1, 1, 1, True)], key=str)
    assert sorted(r["doc_id"] is None for r in neardup.deduplicated(df).collect()) == [False, True, True]


def test_estimate_is_near_the_truth(spark):
    rng = np.random.default_rng(2)
    sketcher, rows = neardup.Sketcher(), []
    for _ in range(40):
        a = rng.integers(0, 2**63, 400).astype(np.uint64)
        b = a.copy()
        n = int(rng.integers(0, 300))
        b[:n] = rng.integers(0, 2**63, n).astype(np.uint64)
        rows.append((sketcher.sketch(a)[1].tolist(), sketcher.sketch(b)[1].tolist(), (400 - n) / (400 + n)))
    df = spark.createDataFrame(rows, "a array<bigint>, b array<bigint>, s double")
    error = [r[0] for r in df.select(F.abs(neardup.estimate(F.col("a"), F.col("b")) - F.col("s"))).collect()]
    assert max(error) < 0.25 and np.mean(error) < 0.06


def test_components(spark):
    rng = np.random.default_rng(0)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 400, (260, 2))] + [(i, i + 1) for i in range(1000, 1100)] + [(5000, 5000 + i) for i in range(1, 60)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    df = spark.createDataFrame([*links, (7, None), (None, 7)], "a bigint, b bigint")
    found = {r["node"]: r["component"] for r in components(df).collect()}
    want = {x: find(x) for x in parent}
    assert {x: found.get(x, x) for x in want} == want
    assert components(df.limit(0)).count() == 0


# Lines


def test_line_dedup_edges(spark):
    rows = [(i, "s" if i < 50 else None, f"head\nbody {i}\n\n head \nfoot") for i in range(100)] + [(200, "t", None), (201, "t", ""), (202, "u", "head\nfoot"), (203, "s", "foot")]
    df = spark.createDataFrame(rows, "doc_id bigint, source string, text string").withColumn("line", F.lit(1)).withColumn("host", F.lit(2))
    out = {r["doc_id"]: r for r in linededup.drop_boilerplate(df).collect()}
    assert len(out) == len(rows) and set(df.columns) < set(next(iter(out.values())).asDict())
    assert out[0]["text"] == "body 0\n" and out[0]["__cl_dropped"] == 3 and out[60]["text"] == "body 60\n"
    assert out[200]["text"] is None and out[201]["text"] == "" and out[203]["text"] == ""
    assert out[202]["text"] == "head\nfoot" and out[202]["__cl_dropped"] == 0
    assert linededup.drop_boilerplate(df.limit(0)).count() == 0


def test_line_dedup_of_a_long_text(spark):
    """4,000 lines in one text, and one line of 3 MB. Lines of a text are told apart pair by pair, so 400,000 did not end in minutes; see README."""
    rows = [(i, "s", f"head\nown {i}") for i in range(10)] + [(10, "s", "head\n" + "\n".join(f"x{i}" for i in range(4_000)) + "\nhead"), (11, "s", "y" * 3_000_000 + "\nhead")]
    out = {r["doc_id"]: r for r in linededup.drop_boilerplate(spark.createDataFrame(rows, "doc_id bigint, source string, text string")).collect()}
    assert out[10]["text"] == rows[10][2][5:-5] and out[10]["__cl_dropped"] == 2 and out[11]["text"] == "y" * 3_000_000


def test_line_dedup_shuffled_equals_broadcast(spark, sf_dir, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    few = sorted(map(str, linededup.drop_boilerplate(docs).collect()))
    monkeypatch.setattr(linededup, "BROADCAST_LINES", -1)
    assert sorted(map(str, linededup.drop_boilerplate(docs).collect())) == few


def test_equal_texts_count_once(spark):
    line = lambda *k: " ".join("w" + "x".join(map(str, (*k, i))) for i in range(12))
    menu = [line("menu", n) for n in range(12)]  # longer than the page's own text
    rows = [f"{line('own', i)}\nLes.\n{line('more', i)}" if i % 4 == 0 else line("own", i) for i in range(120)]
    rows += ["\n".join([*menu, line("under", i)]) for i in range(60)]
    rows += ["\n".join(line("copy", n) for n in range(10))] * 320
    df = spark.createDataFrame([(i, "s", t) for i, t in enumerate(rows)], "doc_id bigint, source string, text string")
    out = {r["doc_id"]: r["text"].split("\n") for r in linededup.drop_boilerplate(df).collect()}
    assert not any("Les." in x for x in out.values())
    assert all(out[i] == [line("under", i - 120)] for i in range(120, 180))
    assert all(out[i] == rows[i].split("\n") for i in range(180, 500))


@pytest.mark.parametrize(("pages", "common"), [(300, 20), (300, 50), (1000, 30), (1000, 40)])
def test_pages_made_from_a_template(spark, pages, common):
    """Catalogue pages: a footer, words of their own, and a line that differs from page to page by a number alone."""
    rng = random.Random(common)
    shared = " ".join(f"c{i}" for i in range(common))
    own = ["\n".join([" ".join(f"o{rng.randrange(10**9)}" for _ in range(80)), f"{shared} {i}", "All rights reserved"]) for i in range(pages)]
    df = spark.createDataFrame([(i, "shop", t) for i, t in enumerate(own)], "doc_id bigint, source string, text string")
    out = {r["doc_id"]: r["text"] for r in linededup.drop_boilerplate(df).collect()}
    assert all(out[i] == t.removesuffix("\nAll rights reserved") for i, t in enumerate(own))


def test_url_host(spark):
    df = spark.createDataFrame([("HTTP://U:p@Ex.COM:80/a",), ("x",), (None,)], "u string")
    assert [r[0] for r in df.select(linededup.url_host(F.col("u"))).collect()] == ["ex.com", "", None]


# Decontamination


def test_overlaps(spark, monkeypatch):
    item = [f"k{i}" for i in range(40)]
    near = [("z" if i in (3, 12, 20, 33) else w) for i, w in enumerate(item)]
    rows = [(1, "pre " + " ".join(item).upper() + "! post"), (2, "x " + " , ".join(near)), (3, " ".join(item[:8])), (4, " ".join(reversed(item))), (5, None), (6, ""), (None, " ".join(item[5:34])), (7, "one two three four five six"), (8, " ".join(item) + " " + " ".join(item)), (8, "other words")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("item_id", F.lit("clash")).withColumn("seed", F.lit(0)).withColumn("words", F.lit(0))
    bench = spark.createDataFrame([(1, " ".join(item)), (2, "two three four five six"), (3, "two three"), (4, None), (5, "")], "item_id bigint, text string")
    want = [(1, 1, 40, 24, 24, 1), (2, 1, 40, 22, 24, 1), (7, 2, 5, 5, 5, 1), (7, 3, 2, 2, 2, 1), (8, 1, 40, 24, 24, 0), (None, 1, 40, 24, 24, -5)]
    for bound in (10**6, -1):
        monkeypatch.setattr(decontaminate, "BROADCAST_SEEDS", bound)
        found = [(r["doc_id"], r["item_id"], r["item_words"], r["matched"], r["window"], r["start"]) for r in decontaminate.overlaps(docs, bench).collect()]
        assert sorted(found, key=str) == sorted(want, key=str)
    assert sorted(str(r["doc_id"]) for r in decontaminate.clean(docs, bench).collect()) == ["3", "4", "5", "6"]
    assert decontaminate.overlaps(docs.limit(0), bench).count() == decontaminate.overlaps(docs, bench.limit(0)).count() == 0


def test_any_window_of_a_diagonal(spark):
    rng = random.Random(3)
    items = [[f"k{n}x{i}" for i in range(40)] for n in range(300)]
    texts = [[f"z{n}x{i}" if i in changed else w for i, w in enumerate(item)] for n, item in enumerate(items) for changed in [set(rng.sample(range(40), 8))]]

    def best(text, item):
        same = [a == b for a, b in zip(text, item, strict=True)]
        return max(sum(same[i : i + decontaminate.WINDOW]) for i in range(len(same) - decontaminate.WINDOW + 1)), max(len(x) for x in "".join(".x"[s] for s in same).split("."))

    want = {n: best(t, item) for n, (t, item) in enumerate(zip(texts, items, strict=True))}
    docs = spark.createDataFrame([(n, "pre " * (n % 3) + " ".join(t)) for n, t in enumerate(texts)], "doc_id bigint, text string")
    bench = spark.createDataFrame([(n, " ".join(x)) for n, x in enumerate(items)], "item_id bigint, text string")
    found = {r["doc_id"]: r["matched"] for r in decontaminate.overlaps(docs, bench).collect()}
    assert found == {n: m for n, (m, run) in want.items() if m >= decontaminate.SHARE * decontaminate.WINDOW or run >= decontaminate.RUN}


def test_masks_lose_no_overlap():
    """For every item length and every choice of changed words that the share allows, some mask reads none of them."""
    d = decontaminate
    for n in range(1, d.WINDOW + 1):
        changed = n - math.ceil(d.SHARE * n)
        masks = d.FAMILIES[max(x for x in d.FAMILIES if x <= n)]
        places = [sum(1 << (at + i) for i in m) for m in masks for at in range(n - max(m))]
        for c in itertools.combinations(range(n), changed):
            bits = sum(1 << i for i in c)
            assert any(not bits & p for p in places), (n, c)


def brute_overlaps(docs, items):
    d, out = decontaminate, []
    words = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    for i, text in docs:
        w = words(text)
        for j, t in items:
            item, found = words(t), []
            for start in range(1 - len(item), len(w)):
                same = [0 <= start + k < len(w) and w[start + k] == x for k, x in enumerate(item)]
                size = min(len(same), d.WINDOW)
                best = max(sum(same[k : k + size]) for k in range(len(same) - size + 1))
                run = max(len(x) for x in "".join(".x"[y] for y in same).split("."))
                if best >= d.SHARE * size - 1e-9 or run >= d.RUN:
                    found.append((-best, -run, start, size, len(item)))
            if found:
                best, run, start, size, n = min(found)
                out.append((i, j, n, -best, size, -run, start))
    return sorted(out)


@pytest.mark.parametrize("bound", [10**6, -1])
def test_overlaps_of_every_length(spark, monkeypatch, bound):
    rng = random.Random(7)
    items = [(n * 10 + k, " ".join(f"i{n}k{k}w{rng.randrange(3 * n)}" for _ in range(n))) for n in [*range(1, 27), 40] for k in range(3)]
    docs = []
    for n, (_, text) in enumerate(items):
        for change in (0, 1, 2, 3, 4, 5, 8):
            w = text.split()
            for at in rng.sample(range(len(w)), min(change, len(w))):
                w[at] = f"z{n}"
            cut = w[rng.randrange(3) :] if change > 4 else w
            docs.append((len(docs), " ".join(["pre"] * rng.randrange(3) + cut + ["post"] * rng.randrange(3))))
    docs.append((len(docs), " ".join(items[-1][1].split()[11:24])))  # 13 of 40 words
    docs.append((len(docs), " ".join(items[-1][1].split()[11:23])))  # 12
    monkeypatch.setattr(decontaminate, "BROADCAST_SEEDS", bound)
    found = decontaminate.overlaps(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"))
    assert sorted(map(tuple, found.collect())) == brute_overlaps(docs, items)


def test_top_k_of_any_size(spark):
    rng = np.random.default_rng(8)
    whole = lambda x: topk.whole(x, 256)
    for size in (1e30, 1e22, 3e10, 1.7e308):
        rows = [(i, (np.sign(v) * size if size > 1e300 else v * size).tolist()) for i, v in enumerate(rng.normal(size=(60, 5)))]
        rows += [(60, [1e10, 1.0, 0.0, 0.0, 0.0]), (61, [1e10, 0.0, 0.0, 0.0, 0.0]), (62, rows[3][1]), (63, [-x for x in rows[3][1]])]
        want = []
        for q, v in rows:
            if q % 50 == 0:
                scores = sorted((-sum(whole(x) * whole(y) for x, y in zip(v, c, strict=True)), i) for i, c in rows if i != q)[:5]
                want += [(q, r, i, max(-(2**63), min(2**63 - 1, -s)), not -(2**63) <= -s < 2**63) for r, (s, i) in enumerate(scores, 1)]
        found = topk.top_k(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), beyond=True)
        assert sorted(map(tuple, found.collect())) == sorted(want)


def test_recall_of_links(spark):
    """Every link that full sets give is found at sf0.01."""
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    assert got(spark, rows, 85) == brute_components(rows, 85)


def test_line_dedup_takes_any_name(spark):
    rows = [(i, "s", f"head\nbody {i}", "a", "b", 7) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id bigint, source string, text string, __cl_lines string, site string, dropped bigint")
    out = linededup.drop_boilerplate(df)
    assert out.columns == ["doc_id", "source", "text", "site", "dropped", "__cl_lines", "__cl_dropped"]
    assert {(r["text"], r["site"], r["dropped"], r["__cl_lines"], r["__cl_dropped"]) for r in out.collect()} == {(f"body {i}", "b", 7, 2, 1) for i in range(30)}


def test_hits_carry_the_words_beside_an_item(spark, monkeypatch):
    """Texts are matched once however many items share them; Spark keeps a document's hits at once, so they go on with an item's words alone, and seeds that are dealt over tasks are never broadcast."""
    rng = random.Random(11)
    texts = [" ".join(f"w{n}x{rng.randrange(9)}" for _ in range(30)) for n in range(4)]
    bench = spark.createDataFrame([(i * 10 + n, t) for i in range(3) for n, t in enumerate(texts)] + [(0, "one two three four five six"), (None, texts[1])], "item_id bigint, text string")
    docs = spark.createDataFrame([(1, " ".join(texts * 3)), (2, "no " + texts[2]), (3, "one two three four five six"), (None, texts[1])], "doc_id bigint, text string")
    found = []
    for bound in (10**6, -1):
        monkeypatch.setattr(decontaminate, "BROADCAST_SEEDS", bound)
        best, named = decontaminate.matched_texts(docs, bench, "doc_id", "text", "item_id", "text")
        assert best.count() == 4 + 1 + 1 + 1 and named.count() == 3 * 4 + 2
        plan = [x for x in best._jdf.queryExecution().executedPlan().toString().splitlines() if "Join" in x or "Project" in x]
        join = next(i for i, x in enumerate(plan) if "Join [seed#" in x)
        assert "slice(words#" in plan[join - 1] if bound > 0 else "SortMergeJoin" in plan[join]
        found.append(sorted(map(tuple, decontaminate.overlaps(docs, bench).collect()), key=str))
        assert [r["doc_id"] for r in decontaminate.clean(docs, bench).collect()] == []
    assert found[0] == found[1] and len(found[0]) == 4 * 3 + 1 + 3 + 1 + 4 + 0 and (3, 0, 6, 6, 6, 6, 0) in found[0]


def test_clean_knows_how_few_leak(spark, sf_dir):
    """Documents are not dealt by id to meet the ids of leaks."""
    docs, bench = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    plan = decontaminate.clean(docs, bench)._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan and "hashpartitioning" not in plan
