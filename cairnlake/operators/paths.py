"""Search in graphs of any depth: least distances, shortest paths, and all paths between sources and targets.

A search goes in steps. Each step joins what was reached last with the edges, and its result is saved as a table, so that
the plan of a step doesn't hold the steps before it and a lost executor costs no more than a step. Only what is new goes on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import Tables, partitions_for, tables

#: A search without a depth ends when nothing new is reached, and fails beyond so many steps.
STEPS = 1000
#: A step looks for what was reached before in so many tables at most; then they are made one.
TOGETHER = 8


def _edges(edges: DataFrame) -> DataFrame:
    """Different edges (src, dst) without nulls."""
    return edges.select("src", "dst").where("src is not null and dst is not null").distinct()


def _to_targets(own: Tables, edges: DataFrame, targets: DataFrame | None, depth: int) -> DataFrame | None:
    """(node, left): nodes from which a target can be reached, and the least steps to the nearest one; None without targets."""
    if targets is None:
        return None
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    return distances(back, targets.select(F.lit(0).alias("source"), F.col("target").alias("node")), depth, own, start=True).groupBy("node").agg(F.min("distance").alias("left"))


def distances(edges: DataFrame, sources: DataFrame, depth: int | None = None, own: Tables | None = None, start: bool = False) -> DataFrame:
    """(source, node, distance, before) of all nodes within `depth` steps of a source (no depth: all that can be reached), at their least distance.

    edges: (src, dst), repeats and nulls left out; sources: (source), each of which is at distance 0 of itself. before is the least of the nodes
    by which a node is reached at its distance (null at 0), so that following it back gives one shortest path. Circles end, as a
    node goes on only from its least distance.
    """
    spark = edges.sparkSession
    if own is None:
        with tables(spark) as made:
            return distances(edges, sources, depth, made, start)
    n, by = partitions_for(edges), ("source", "node")
    kept = own.save_by(_edges(edges), "edges", "src", n=n)
    first = sources.select("source", "node") if start else sources.select("source", F.col("source").alias("node"))
    empty = F.lit(None).cast(edges.schema["src"].dataType)
    front = own.save_by(first.where("node is not null").distinct().select("source", "node", F.lit(0).alias("distance"), empty.alias("before")), "reached", *by, n=n)
    reached, at = [front], 0
    while depth is None or at < depth:
        at += 1
        if at > STEPS:
            raise RuntimeError(f"the search did not end in {STEPS} steps")
        step = front.select("source", F.col("node").alias("src")).join(kept, "src").select("source", F.col("dst").alias("node"), "src")
        step, older = step.repartition(n, *by).groupBy(*by).agg(F.min("src").alias("before")), front
        for seen in reached:  # each in buckets of the same number, so that what was reached before stays where it is
            step = step.join(seen.select(*by), [*by], "left_anti")
        front = own.save_by(step.select("source", "node", F.lit(at).alias("distance"), "before"), "reached", *by, n=n, dealt=True)
        if front.isEmpty():
            own.let_go(front)
            break
        if not any(t is older for t in reached):
            own.let_go(older)
        reached.append(front)
        if len(reached) == TOGETHER:
            all_of = own.save_by(_together(reached), "reached", *by, n=n)
            own.let_go(*reached[:-1])  # the last is where the next step begins
            reached = [all_of]
    own.let_go(kept)
    return _together(reached)


def _together(parts: list[DataFrame]) -> DataFrame:
    out, *rest = parts
    for p in rest:
        out = out.unionByName(p)
    return out


def paths(edges: DataFrame, sources: DataFrame, depth: int) -> DataFrame:
    """(source, node, distance) of nodes within `depth` steps, each at its least distance; edges: src, dst; sources: source."""
    return distances(edges, sources, depth).select("source", "node", "distance")


def shortest_paths(edges: DataFrame, pairs: DataFrame, depth: int | None = None) -> DataFrame:
    """(source, target, distance, path) of each pair that is connected: the nodes of one shortest path, from source to target.

    pairs: (source, target). Among shortest paths it is that whose node before the target is least, then the one before that, and so on. A source
    that is its own target has the path of itself.
    """
    with tables(edges.sparkSession) as own:
        asked = own.save(pairs.select("source", "target").where("source is not null and target is not null").distinct(), "pairs")
        inner = Tables(own.spark)
        found = own.save_by(distances(edges, asked.select("source").distinct(), depth, inner), "distances", "source", "node", n=partitions_for(edges))
        inner.drop()
        walk = asked.join(found.withColumnRenamed("node", "target"), ["source", "target"]).select("source", "target", "distance", F.array("target").alias("path"), F.col("before").alias("at"))
        done, walk = [], own.save(walk, "walk")
        while not walk.isEmpty():
            done.append(walk.where("at is null").drop("at"))
            back = walk.where("at is not null").join(found.select("source", F.col("node").alias("at"), "before"), ["source", "at"])
            walk = own.save(back.select("source", "target", "distance", F.concat(F.array("at"), "path").alias("path"), F.col("before").alias("at")), "walk")
        own.let_go(found, asked)
        if not done:
            return walk.drop("at")
        own.let_go(walk)
        return _together(done)


def all_paths(edges: DataFrame, sources: DataFrame, targets: DataFrame | None = None, depth: int = 10, pairs: DataFrame | None = None, per_target: int | None = None) -> DataFrame:
    """(source, target, path, length): every path of 1 to `depth` edges that visits no node twice (but that it may end where it began), from each source to each target.

    Without targets every node is one. pairs: (source, target) instead, of which each pair is searched alone. per_target: at most so many
    paths for a source and target, the shortest and of equal length those of least nodes in order: a search that has them goes no further for that pair. Only nodes
    from which a target can be reached in the steps that are left are visited. edges and nulls as in distances().
    """
    if pairs is not None:
        pairs = pairs.select("source", "target").where("source is not null and target is not null").distinct()
        sources, targets = pairs.select("source").distinct(), pairs.select("target").distinct()
    with tables(edges.sparkSession) as own:
        kept = own.save_by(_edges(edges), "edges", "src")
        inner = Tables(own.spark)
        left = _to_targets(inner, kept, targets, depth)
        if left is not None:
            left = own.save_by(left, "left", "node")
            inner.drop()
        walk = own.save(sources.select("source").where("source is not null").distinct().select("source", F.col("source").alias("node"), F.array("source").alias("path")), "walk")
        done: list[DataFrame] = []
        for at in range(1, depth + 1):
            step = walk.select("source", "path", F.col("node").alias("src")).join(kept, "src").withColumnRenamed("dst", "node")
            # A circle back to the source may end a path; it doesn't go on.
            step = step.where(((F.col("node") == F.col("source")) | ~F.array_contains("path", F.col("node"))) & ((F.size("path") == 1) | (F.col("path")[0] != F.element_at("path", -1))))
            if left is not None:  # a node from which no step is left to the nearest target is one
                step = step.join(left.where(F.col("left") <= depth - at).select("node", (F.col("left") == 0).alias("ends")), "node")
            else:
                step = step.withColumn("ends", F.lit(True))
            walk_on = own.save(step.select("source", "node", F.concat("path", F.array("node")).alias("path"), "ends"), "walk")
            own.let_go(walk)
            walk = walk_on
            if walk.isEmpty():
                break
            ended = walk.where("ends").select("source", F.col("node").alias("target"), "path", F.lit(at).alias("length"))
            if pairs is not None:
                ended = ended.join(pairs, ["source", "target"], "left_semi")
            if per_target is not None:
                ended = _first_paths(own, done, ended, per_target)
                walk = _unserved(own, walk, done + [ended], targets, pairs, per_target) if targets is not None else walk
            else:
                ended = own.save(ended, "ended")
            done.append(ended)
        if not done:  # walk is empty, and is read for its schema
            done.append(walk.select("source", F.col("node").alias("target"), "path", F.lit(0).alias("length")))
        else:
            own.let_go(walk)
        own.let_go(kept, *([left] if left is not None else []))
        return _together(done)


def _first_paths(own: Tables, done: list[DataFrame], ended: DataFrame, per_target: int) -> DataFrame:
    """Of the paths that end now those that a pair still wants."""
    rank = F.row_number().over(Window.partitionBy("source", "target").orderBy("path"))
    if done:
        had = _together(done).groupBy("source", "target").agg(F.count("*").alias("had"))
        ended = ended.join(had, ["source", "target"], "left")
    else:
        ended = ended.withColumn("had", F.lit(0))
    return own.save(ended.withColumn("rank", rank).where(F.col("rank") + F.coalesce("had", F.lit(0)) <= per_target).select("source", "target", "path", "length"), "ended")


def _unserved(own: Tables, walk: DataFrame, done: list[DataFrame], targets: DataFrame, pairs: DataFrame | None, per_target: int) -> DataFrame:
    """Walks of sources that still want paths to a target."""
    full = _together(done).groupBy("source", "target").agg(F.count("*").alias("n")).where(F.col("n") >= per_target)
    if pairs is not None:
        open_pairs = pairs.join(full, ["source", "target"], "left_anti")
        return walk.join(open_pairs.select("source").distinct(), "source", "left_semi")
    served = full.groupBy("source").agg(F.count("*").alias("served")).where(F.col("served") >= targets.select("target").distinct().count())
    return walk.join(served, "source", "left_anti")


def path_edges(found: DataFrame) -> DataFrame:
    """(source, target, path_id, edge, start, end): a row for each edge of each path, numbered from 0; path_id numbers a pair's paths by length and nodes."""
    order = F.row_number().over(Window.partitionBy("source", "target").orderBy("length", "path")) - 1
    each = found.withColumn("path_id", order).select("source", "target", "path_id", "path", F.posexplode(F.slice("path", F.lit(1), F.size("path") - 1)).alias("edge", "start"))
    return each.select("source", "target", "path_id", "edge", "start", F.get("path", F.col("edge") + 1).alias("end"))
