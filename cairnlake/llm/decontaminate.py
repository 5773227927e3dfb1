"""Benchmark decontamination by spaced-seed hashing, with DataFrame functions alone.

Texts become lower-case words of letters and digits. A mask reads some positions of a short
stretch of words and skips the others, so that a changed word under a skipped position does no harm. The
hashes of all benchmark items under the masks of their length are joined with those at every
position of every document. At each hit the two texts are laid side by side and compared word by
word along the whole item. They overlap where, in the best window of WINDOW words of the item (all of a
shorter item), SHARE of the words agree, or where RUN words in a row agree.

No overlap is lost: for every item length, and every choice of the changed words that the share allows, some
mask of the length has a place that reads none of them (tested over all choices). Items of one to
four words allow no change and are matched whole.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved

WINDOW, SHARE, RUN = 24, 0.8, 13
#: The masks (positions read) for items from so many words on, up to the next entry.
FAMILIES = {
    1: ((0,),), 2: ((0, 1),), 3: ((0, 1, 2),), 4: ((0, 1, 2, 3),),
    5: ((0, 1, 3), (0, 3, 4)),
    6: ((0, 2, 3, 4), (0, 1, 2, 5)),
    7: ((0, 1, 3, 4),),
    8: ((0, 1, 3, 4, 5), (0, 1, 3, 4, 7)),
    9: ((0, 1, 2, 4, 5, 6), (0, 1, 3, 4, 7, 8)),
    10: ((0, 1, 3, 4, 5), (0, 1, 2, 6, 8), (0, 2, 3, 4, 5)),
    12: ((0, 1, 3, 5, 6, 7), (0, 1, 2, 5, 8, 9), (0, 1, 3, 4, 5, 7)),
    15: ((0, 1, 2, 3, 5, 6), (0, 1, 3, 4, 5, 6), (0, 1, 2, 4, 9, 10)),
}
#: Up to so many seeds (some 50 bytes each in memory) and bytes of items go to every executor; more are joined by shuffle.
BROADCAST_SEEDS, BROADCAST_BYTES = 1_000_000, 64_000_000
#: In a shuffle a seed is dealt over so many tasks, so that a common phrase isn't one task.
SALTS = 16
#: Bits of one of Spark's bitmaps, and of the whole map of seeds at most (64 MB).
MAP_BITS, LARGEST_MAP = 32_768, 1 << 29
LONGEST_RUN = (1 << 24) - 1


def words_of(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def family_of(size: Column) -> Column:
    """The key in FAMILIES of an item of so many words."""
    out = F.lit(None).cast("int")
    for least in FAMILIES:
        out = F.when(size >= least, least).otherwise(out)
    return out


def masks_of(families: list[int]) -> dict[int, tuple[int, ...]]:
    """The masks of some families by their number among all."""
    number = count()
    return {n: m for least, masks in FAMILIES.items() for m in masks for n in [next(number)] if least in families}


def positions(df: DataFrame, masks: dict[int, tuple[int, ...]]) -> DataFrame:
    """df (with words) once for each position and mask that fits there: the position `at`, the number `mask`, the `seed`."""
    hashed = df.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    every = hashed.withColumn("at", F.explode(F.sequence(F.lit(0), F.size("hashes") - 1)))
    at, size = F.col("at"), F.size("hashes")
    seeds = [F.when(at + (max(m) + 1) <= size, F.struct(F.lit(n).alias("mask"), F.xxhash64(F.lit(n), *[F.get("hashes", at + i) for i in m]).alias("seed"))) for n, m in masks.items()]
    return every.withColumn("x", F.explode(F.array(*seeds))).where("x is not null").select("*", "x.mask", "x.seed").drop("hashes", "x")


def agreement(words: Column, start: Column, item: Column, size: Column) -> Column:
    """(best, longest) if the item begins at word start, which may be negative: the most words that agree in a window of size words of the item, and the most that agree in a row."""
    same = lambda k: F.when(F.get(words, start + k) == F.get(item, k), 1).otherwise(0)

    def step(state: Column, k: Column) -> Column:
        # Before the window is full its sum is a part of the first window's, so it can only be too small.
        now = same(k)
        here = state["here"] + now - F.when(k >= size, same(k - size)).otherwise(0)
        run = (state["run"] + 1) * now
        return F.struct(here.alias("here"), F.greatest(state["best"], here).alias("best"), run.alias("run"), F.greatest(state["longest"], run).alias("longest"))

    none = F.struct(*[F.lit(0).alias(x) for x in ("here", "best", "run", "longest")])
    return F.aggregate(F.sequence(F.lit(0), F.size(item) - 1), none, step, lambda s: F.struct(s["best"], s["longest"]))


def follows(words: Column, start: Column, item: Column, j: Column, mask: Column) -> Column:
    """Whether the same mask has a hit one word before j on the same diagonal."""
    shapes = F.array(*[F.array(*map(F.lit, m)) for m in masks_of(list(FAMILIES)).values()])
    # A function over the positions: written out for all masks, the code that Spark makes of it would be too long to be compiled.
    return F.coalesce(F.forall(F.get(shapes, mask), lambda i: F.get(words, start + j + (i - 1)) == F.get(item, j + (i - 1))), F.lit(False))


def beside(words: Column, start: Column, size: Column) -> Column:
    """The words that lie beside an item of size words which begins at word start; those before the first are lacking."""
    return F.slice(words, F.greatest(start, F.lit(0)) + 1, size + F.least(start, F.lit(0)))


def matched_texts(docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str, item_col: str, item_text_col: str) -> tuple[DataFrame, DataFrame]:
    """(id, no, code, window, item_words), a row for each document and different text of the benchmark that overlap, and (item, no), the items of each text.

    Texts are matched once however many items share them. Of a document only the words that lie beside an item go on with a hit, so that
    what a task holds doesn't grow with a text's length times its hits.
    """
    given = benchmark.select(F.col(item_col).alias("item"), words_of(F.col(item_text_col).cast("string")).alias("words")).where(F.size("words") > 0).withColumn("no", F.xxhash64("words"))
    # As many files as the benchmark has partitions: a shuffle would scatter a small table over all of its own.
    parts = max(1, benchmark.rdd.getNumPartitions())
    named = saved(given.select("item", "no").distinct().coalesce(parts), "item-ids")
    items = saved(given.select("no", "words").distinct().withColumn("family", family_of(F.size("words"))).coalesce(parts), "items")
    used = sorted(r[0] for r in items.select("family").distinct().collect())  # at most one row for each entry of FAMILIES
    masks, seeds = masks_of(used), None
    for family in used:
        of_family = positions(items.where(F.col("family") == family), masks_of([family])).select("no", F.col("at").alias("j"), F.size("words").alias("n"), "mask", "seed")
        seeds = of_family if seeds is None else seeds.unionByName(of_family)
    if seeds is None:
        seeds = items.select("no", F.lit(0).alias("j"), F.lit(0).alias("n"), F.lit(0).alias("mask"), F.lit(0).cast("bigint").alias("seed"))
        masks = masks_of([1])
    seeds = saved(seeds.coalesce(parts), "seeds")
    held, many = items.agg(F.coalesce(F.sum(F.size("words") * 24 + F.length(F.array_join("words", ""))), F.lit(0))).first()[0], seeds.count()
    rows = docs.select(F.col(id_col).alias("id"), words_of(F.col(text_col).cast("string")).alias("words")).where(F.size("words") > 0)
    item = items.select("no", F.col("words").alias("item_words"))
    start, lead = (F.col("at") - F.col("j")).alias("start"), F.least(F.col("start"), F.lit(0))
    if many <= BROADCAST_SEEDS and held <= BROADCAST_BYTES:
        # The words ride along to the join, which goes on with those beside the item: Spark keeps all hits of a document at once.
        hits = positions(rows, masks).join(F.broadcast(seeds.drop("mask")), "seed").select("id", "no", start, "j", "mask", beside(F.col("words"), F.col("at") - F.col("j"), F.col("n")).alias("beside"))
        hits = hits.join(F.broadcast(item), "no")
        # All hits of a diagonal give one comparison; of hits in a row the first is enough.
        hits = hits.where(~follows(F.col("beside"), lead, F.col("item_words"), F.col("j"), F.col("mask")))
    else:
        rows = rows.withColumn("row", F.xxhash64("id", "words"))
        dealt = seeds.drop("mask").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        light = likely(positions(rows.select("row", "words"), masks).select("row", "at", "seed"), seeds, many)
        light = light.withColumn("salt", F.pmod("row", F.lit(SALTS)).cast("int"))
        # Spark takes the dealt seeds for as small as their file, and so would broadcast them; words of documents are joined last, to rows that are sorted without them.
        light = light.join(dealt.hint("merge"), ["seed", "salt"]).select("row", "no", start).distinct()
        hits = light.join(item, "no").join(rows.hint("merge"), "row")
        hits = hits.select("id", "no", "start", "item_words", beside(F.col("words"), F.col("start"), F.size("item_words")).alias("beside"))
    size = F.size("item_words")
    hits = hits.withColumn("window", F.least(size, F.lit(WINDOW)))
    # Exploded, or Spark would move the comparison into the join's condition and the slice into each step of the comparison.
    hits = hits.withColumn("found", F.explode(F.array(agreement(F.col("beside"), lead, F.col("item_words"), F.col("window")))))
    hits = hits.select("id", "no", size.alias("item_words"), F.col("found.best").alias("matched"), F.least("found.longest", F.lit(LONGEST_RUN)).alias("run"), "window", "start")
    hits = hits.where((F.col("matched") >= F.ceil(F.lit(SHARE) * F.col("window"))) | (F.col("run") >= RUN))
    # The most matches, then the longest run and the least start in one long, so that the aggregate's buffer is plain numbers.
    code = F.shiftleft(F.col("matched").cast("bigint"), 57) + F.shiftleft(F.col("run").cast("bigint"), 33) + ((1 << 32) - F.col("start").cast("bigint"))
    best = hits.groupBy("id", "no").agg(F.max(code).alias("code"), F.max("window").alias("window"), F.max("item_words").alias("item_words"))
    return best, named


def likely(light: DataFrame, seeds: DataFrame, many: int) -> DataFrame:
    """The rows whose seed may be among the benchmark's: all that are, and of others one in some 16 or fewer up to LARGEST_MAP / 16 seeds.

    A map of bits by the seeds' hashes goes to every executor, so that only what is likely to meet a seed is shuffled.
    """
    bits = 1 << max(20, min((16 * many).bit_length(), LARGEST_MAP.bit_length() - 1))
    place = lambda: F.pmod(F.col("seed"), F.lit(bits))
    bucket, at = lambda: F.shiftright(place(), 15), lambda: place().bitwiseAND(F.lit(MAP_BITS - 1))
    marked = seeds.select(bucket().alias("bucket"), at().alias("bit")).groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("marks"))
    # 64-bit words, the first byte highest.
    words = F.transform(F.sequence(F.lit(0), F.lit(MAP_BITS // 64 - 1)), lambda i: F.conv(F.hex(F.substring("marks", i * 8 + 1, F.lit(8))), 16, -10).cast("bigint"))
    marked = saved(marked.select("bucket", words.alias("marks")), "seed-map")
    bit = at()
    turn = ((F.lit(7) - F.shiftright(bit, 3).bitwiseAND(F.lit(7))) * 8 + bit.bitwiseAND(F.lit(7))).cast("int")
    word = F.get("marks", F.shiftright(bit, 6).cast("int"))
    held = light.withColumn("bucket", bucket()).join(F.broadcast(marked), "bucket")
    return held.where(word.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("bigint"), turn)) != 0).select(*light.columns)


def overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(id, item_id, item_words, matched, window, run, start): one row for each document and item that overlap.

    matched is the largest number of agreeing words in a window (of `window` words), run the most agreeing
    words in a row, start the word of the document at which the item would begin: of the place with most matched, then
    the longest run, then the least start. Null and empty texts overlap with nothing; an item of a
    few words overlaps with every document that holds them. Rows that share an id give one row; a null
    id stays null. A null item id is an item of its own. An item that repeats under several ids is found under each.
    An empty table on either side gives an empty result; other columns take no part, whatever their names. A text of any
    length is one row of its words; a run of more than LONGEST_RUN words is given as that.
    """
    best, named = matched_texts(docs, benchmark, id_col, text_col, item_col, item_text_col)
    best = best.join(named, "no").drop("no")
    if named.count() > named.select("item").distinct().count():  # items of several texts
        best = best.groupBy("id", "item").agg(*(F.max(x).alias(x) for x in ("code", "window", "item_words")))
    run, start = F.shiftright("code", 33).bitwiseAND(F.lit(LONGEST_RUN)), F.lit(1 << 32) - F.col("code").bitwiseAND(F.lit((1 << 33) - 1))
    long = lambda x: F.col(x).cast("bigint").alias(x)
    return best.select(F.col("id").alias(id_col), F.col("item").alias("item_id"), long("item_words"), F.shiftright("code", 57).alias("matched"), long("window"), run.alias("run"), start.alias("start"))


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The documents that overlap with no benchmark item, columns unchanged.

    Rows that share an id, or have a null id, go together if one of them overlaps. Rows with a null or empty text
    of their own id stay. An empty table gives an empty result, an empty benchmark all rows; columns may have any names.
    """
    found, _ = matched_texts(docs, benchmark, id_col, text_col, item_col, item_text_col)
    # Saved, so that its size is known and documents aren't shuffled to meet a few ids.
    bad = saved(found.select(F.col("id").alias("__cl_bad_id")).distinct(), "leaks")
    return docs.join(bad, docs[id_col].eqNullSafe(bad["__cl_bad_id"]), "left_anti")
