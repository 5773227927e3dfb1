"""Tables of a directory by name, with the item filter put into the cube."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from ..sources.tables import raw_schemas
from .compose import COMPOSED, TOP_N, organisations

CUBE = "group_items"


def read_by_name(spark: SparkSession, *paths: str) -> DataFrame:
    """Parquet files of one table whose columns differ, united by name: what a file lacks is null there. Types must agree."""
    return spark.read.option("mergeSchema", "true").parquet(*paths)


class Catalog:
    """tables(name) -> DataFrame: a given DataFrame, else Parquet in the folder, else composed on the fly.

    A filter given by where() restricts the cube alone; questions that read other tables only
    are not affected. A raw table that isn't there is empty. A table that isn't stored is composed anew by each question
    that reads it: registry.build() stores what many questions share.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None, given: dict[str, DataFrame] | None = None, where: Column | None = None):
        self.spark, self.folder, self.where = spark, folder, where
        self.known: dict[str, DataFrame] = dict(given or {})

    def _stored(self, name: str) -> DataFrame | None:
        if self.folder is None:
            return None
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}.parquet")
        links = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        found = next((p for p in (path, links) if fs.exists(p) and self._whole(fs, p)), None)
        return self.spark.read.parquet(found.toString()) if found is not None else None

    def _whole(self, fs, path) -> bool:
        """Whether a table was written to its end: not where a write broke off and left its working folder, or nothing."""
        if not fs.getFileStatus(path).isDirectory():
            return True
        names = {f.getPath().getName() for f in fs.listStatus(path)}
        return "_SUCCESS" in names or ("_temporary" not in names and any(n[0] not in "._" for n in names))

    def _base(self, name: str) -> DataFrame:
        if name not in self.known:
            df = self._stored(name)
            if df is None and name == "orgs":
                df = organisations(self)
            elif df is None and name in COMPOSED:
                df = COMPOSED[name][0](self)
            elif df is None:
                schemas = raw_schemas()
                if name not in schemas:
                    raise KeyError(f"no table {name}")
                df = self.spark.createDataFrame([], schemas[name])
            self.known[name] = df
        return self.known[name]

    def __call__(self, name: str) -> DataFrame:
        df = self._base(name)
        return df.where(self.where) if name == CUBE and self.where is not None else df

    def filtered(self, where: Column | None) -> Catalog:
        return Catalog(self.spark, self.folder, self.known, where)

    def names(self) -> list[str]:
        """Tables that can be had, by name: those given, stored in the folder, or composed from raw tables."""
        found = {*self.known, *raw_schemas(), *COMPOSED, "orgs"}
        if self.folder is not None:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
            fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
            found |= {f.getPath().getName().removesuffix(".parquet") for f in (fs.listStatus(path) if fs.exists(path) else [])}
        return sorted(n for n in found if n[0] not in "._")

    def list_tables(self) -> list[dict]:
        """Each table's name, number of columns, and whether it is stored."""
        return [{"table": n, "columns": len(self(n).columns), "stored": self._stored(n) is not None} for n in self.names()]

    def register(self, *names: str) -> None:
        """Temporary views for SQL."""
        for name in names:
            self(name).createOrReplaceTempView(name)

    def describe(self, name: str, rows: int = 5) -> dict:
        """Columns with their types, and a few rows."""
        df = self(name)
        return {"table": name, "columns": [(f.name, f.dataType.simpleString()) for f in df.schema], "sample": [r.asDict() for r in df.limit(rows).collect()]}

    def sql(self, query: str, rows: int = 50) -> tuple[list[dict], bool]:
        """Rows of a SQL query over the registered views, at most `rows`, and whether there are more."""
        found = self.spark.sql(query).limit(rows + 1).collect()
        return [r.asDict() for r in found[:rows]], len(found) > rows


__all__ = ["CUBE", "TOP_N", "Catalog", "read_by_name"]
