"""Digests of files of any size: tasks read them in steps, so that a file is never held."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

STEP = 4 << 20


def digests(files: DataFrame, *algorithms: str) -> DataFrame:
    """files (path, ...) with a column of hex digits for each algorithm of hashlib. Paths are of any file system that pyarrow.fs opens."""
    kinds = {f.name: f.dataType.simpleString() for f in files.schema}

    def run(batches: Iterator) -> Iterator:
        import hashlib

        import pyarrow as pa

        from .archives import file_system

        for batch in batches:
            found: list[list[str]] = [[] for _ in algorithms]
            for path in batch.column("path").to_pylist():
                system, inner = file_system(path)
                sums = [hashlib.new(a) for a in algorithms]
                with system.open_input_file(inner) as f:
                    while data := f.read(STEP):
                        for s in sums:
                            s.update(data)
                for own, s in zip(found, sums, strict=True):
                    own.append(s.hexdigest())
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(x, pa.string()) for x in found]], names=[*batch.schema.names, *algorithms])

    return files.mapInArrow(run, ", ".join(f"`{n}` {k}" for n, k in (kinds | dict.fromkeys(algorithms, "string")).items()))


def listed(spark: SparkSession, path: str, pattern: str | None = None, recursive: bool = False) -> DataFrame:
    """(path, length) of the files of a folder (with those below it if recursive), of a pattern, or of one file, empty ones too; a task for each. pattern: of their names."""
    import fnmatch

    from .archives import file_system, list_files

    folder = file_system(path)[1].rstrip("/")
    direct = lambda p: recursive or "*" in path or "?" in path or file_system(p)[1] in (folder, f"{folder}/{p.rsplit('/', 1)[1]}")
    found = [f for f in list_files(path) if direct(f[0]) and (pattern is None or fnmatch.fnmatch(f[0].rsplit("/", 1)[1], pattern))]
    return spark.createDataFrame(found, "path string, length bigint").repartition("path")
