"""Tables that a result needs on its way, in the folder that the driver and all executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Where it isn't set on one machine a temporary folder is made, which goes when Python ends; on a cluster that is an error."""
    sc = spark.sparkContext
    place = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not place:
        current = sc._jsc.sc().getCheckpointDir()
        if current.isDefined():
            return current.get().rstrip("/")
        if sc.master.split("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        place = "file://" + tempfile.mkdtemp(prefix="cairnlake-")
        atexit.register(shutil.rmtree, place[7:], ignore_errors=True)
        sc.setCheckpointDir(place)
    return place.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/cairnlake/{name}-{uuid.uuid4().hex}"


def delete(spark: SparkSession, path: str) -> None:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def partitions_for(*frames: DataFrame, each: int = 4 << 20) -> int:
    """How many partitions what is read for these frames should be dealt into: one for every `each` bytes of their files, as many as cores at least.

    Partitions that are asked for by number are not put together again, so that what a task holds stays the same as tables grow.
    """
    spark = frames[0].sparkSession
    size = 0
    for name in {x for f in frames for x in f.inputFiles()}:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
        size += path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(path).getLen()
    return max(spark.sparkContext.defaultParallelism, -(-size // each))


@contextmanager
def shuffles_let_go(spark: SparkSession) -> Iterator[None]:
    """Within it a query's shuffle files go when it has been written, not when the driver happens to collect its garbage: for steps that are saved and read again. The session's own setting is there again at the end."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


class Tables:
    """Tables of one computation: saved by name, let go one by one, or all together by drop()."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths, self.names = spark, {}, {}

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """df as a Parquet table: its lineage ends here."""
        path = fresh_path(self.spark, name)
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = (path, out)
        return out

    def save_by(self, df: DataFrame, name: str, *key: str, n: int | None = None, dealt: bool = False) -> DataFrame:
        """df in n buckets of key, or as many as its files ask for: joins on the key deal out their other side alone, however often. dealt: it was dealt into n parts by the key."""
        path, n = fresh_path(self.spark, name), n or partitions_for(df)
        table = f"cairnlake_{path.rsplit('-', 1)[1]}"
        (df if dealt else df.repartition(n, *key)).write.bucketBy(n, *key).format("parquet").option("path", path).saveAsTable(table)
        out = self.spark.table(table)
        self.paths[id(out)], self.names[id(out)] = (path, out), table
        return out

    def let_go(self, *tables: DataFrame) -> None:
        for t in tables:
            if id(t) in self.names:
                self.spark.sql(f"DROP TABLE IF EXISTS {self.names.pop(id(t))}")
            if id(t) in self.paths:
                delete(self.spark, self.paths.pop(id(t))[0])

    def drop(self) -> None:
        self.let_go(*[t for _, t in list(self.paths.values())])


@contextmanager
def tables(spark: SparkSession) -> Iterator[Tables]:
    """Tables that are dropped where the block fails; where it ends well, those that were not let go stay for its result."""
    own = Tables(spark)
    try:
        yield own
    except BaseException:
        own.drop()
        raise
