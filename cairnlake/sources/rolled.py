"""Text files of bounded size: a data source that begins a new file once the next line would pass the bound, and repeats a header in each.

Tasks write under a folder of the job; the driver moves what the tasks that count have told it, and drops the rest. Where there was
nothing before, that is one renaming of a folder, so that a reader sees all files or none; a task that is run again leaves nothing behind.
"""

from __future__ import annotations

import gzip
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate
from typing import TYPE_CHECKING, Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from .archives import file_system
from .triples import statements

if TYPE_CHECKING:
    import pyarrow as pa

ROLL_BYTES = 1 << 30
SUCCESS = "_SUCCESS"


@dataclass
class Written(WriterCommitMessage):
    """Names of a task's files in the job's folder, and their bytes and lines."""

    names: list[str]
    bytes: list[int]
    lines: list[int]


class Roller:
    """Writes lines into files of at most `most` bytes, header and line ends included; a line that is longer has a file of its own."""

    def __init__(self, open_file: Any, header: bytes, most: int):
        self.open_file, self.header, self.most, self.out, self.told = open_file, header, most, None, Written([], [], [])

    def write(self, data: bytes, ends: list[int]) -> None:
        """Lines one after another in data, which end (with their line ends) at `ends`."""
        at = begin = 0
        for end in ends:
            if self.out is None or (self.told.bytes[-1] + end - begin > self.most and self.told.lines[-1]):
                if self.out is not None:
                    self.out.write(data[at:begin])
                at = begin
                self.roll()
            self.told.bytes[-1] += end - begin
            self.told.lines[-1] += 1
            begin = end
        if self.out is not None:
            self.out.write(data[at:])

    def roll(self) -> None:
        self.close()
        name, self.out = self.open_file(len(self.told.names))
        self.out.write(self.header)
        self.told.names.append(name)
        self.told.bytes.append(len(self.header))
        self.told.lines.append(0)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None


class RolledWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.path, self.most, self.overwrite = options["path"].rstrip("/"), int(options.get("roll_bytes", ROLL_BYTES)), overwrite
        self.header, self.suffix, self.zipped = options.get("header", "").encode(), options.get("suffix", ".txt"), options.get("compression", "none") == "gzip"
        self.job = uuid.uuid4().hex
        if len(self.header) >= self.most:
            raise ValueError("the header alone passes roll_bytes")

    def _folder(self) -> tuple[Any, str, str]:
        """File system, the place of the files, and the job's own place beside it."""
        system, inner = file_system(self.path)
        inner = inner.rstrip("/")
        parent, _, name = inner.rpartition("/")
        return system, inner, f"{parent}/.{name}-{self.job}"

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        from pyspark import TaskContext

        context = TaskContext.get()
        attempt = f"{context.partitionId():05d}-{context.taskAttemptId()}"
        system, _, own = self._folder()
        system.create_dir(own, recursive=True)

        def open_file(n: int) -> tuple[str, Any]:
            name = f"part-{attempt}-{n:04d}{self.suffix}" + (".gz" if self.zipped else "")
            raw = system.open_output_stream(f"{own}/{name}", compression=None)
            return name, _Gzipped(raw) if self.zipped else raw

        roller = Roller(open_file, self.header, self.most)
        try:
            for batch in batches:
                lines = [(x or "").encode() + b"\n" for x in batch.column(0).to_pylist()]
                roller.write(b"".join(lines), list(accumulate(map(len, lines))))
        finally:
            roller.close()
        return roller.told

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        from pyarrow import fs

        system, place, own = self._folder()
        kept = {n for m in messages if m for n in m.names}
        system.create_dir(own, recursive=True)
        for f in system.get_file_info(fs.FileSelector(own)):
            if f.base_name not in kept:  # of attempts that don't count
                system.delete_file(f.path)
        there = system.get_file_info(place).type != fs.FileType.NotFound
        if there and not self.overwrite:
            for n in sorted(kept):
                system.move(f"{own}/{n}", f"{place}/{n}")
            system.delete_dir(own)
        else:
            old = f"{own}-old"
            if there:
                system.move(place, old)
            system.move(own, place)
            if there:
                system.delete_dir(old)
        with system.open_output_stream(f"{place}/{SUCCESS}"):
            pass

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        from pyarrow import fs

        system, _, own = self._folder()
        if system.get_file_info(own).type != fs.FileType.NotFound:
            system.delete_dir(own)


class _Gzipped:
    def __init__(self, raw: Any):
        self.raw, self.out = raw, gzip.GzipFile(fileobj=raw, mode="wb", mtime=0)

    def write(self, data: bytes) -> None:
        self.out.write(data)

    def close(self) -> None:
        self.out.close()
        self.raw.close()


class RolledText(DataSource):
    """format("rolled_text") with path, roll_bytes, header, suffix and compression (none or gzip); one column of strings, whose nulls are empty lines."""

    @classmethod
    def name(cls) -> str:
        return "rolled_text"

    def schema(self) -> str:
        return "value string"

    def writer(self, schema: Any, overwrite: bool) -> RolledWriter:
        return RolledWriter(dict(self.options), overwrite)


def write_rolled(lines: DataFrame, path: str, roll_bytes: int = ROLL_BYTES, header: str = "", suffix: str = ".txt", compression: str = "none", mode: str = "append") -> None:
    """The lines (column value) as text files of at most roll_bytes each (before compression), each of which begins with the header.

    Every partition fills its files one after another, so all but its last are full but for one line. mode: append adds files, overwrite
    puts the new files in the place of the old ones.
    """
    spark = lines.sparkSession
    spark.dataSource.register(RolledText)
    lines.select(F.col("value").cast("string")).write.format("rolled_text").mode(mode).options(path=path, roll_bytes=str(roll_bytes), header=header, suffix=suffix, compression=compression).save()


def prefix_header(prefixes: dict[str, str]) -> str:
    return "".join(f"@prefix {p}: <{n}> .\n" for p, n in sorted(prefixes.items()))


def shortened(text: Column, iri: Column, prefixes: dict[str, str]) -> Column:
    """An IRI by its prefix where what follows is a plain name, else text."""
    out = text
    for p, n in sorted(prefixes.items(), key=lambda x: len(x[1])):  # the longest that fits comes first in the end
        local = F.substring(iri, F.lit(len(n) + 1), F.length(iri))
        out = F.when(iri.startswith(n) & local.rlike(r"^[A-Za-z_][A-Za-z0-9_]*\z"), F.concat(F.lit(p + ":"), local)).otherwise(out)
    return out


def write_turtle(triples: DataFrame, path: str, prefixes: dict[str, str] | None = None, roll_bytes: int = ROLL_BYTES, compression: str = "none", mode: str = "append") -> None:
    """Triples as Turtle files of bounded size, a statement to a line; each file declares the prefixes, which shorten the IRIs that they fit."""
    prefixes = prefixes or {}
    write_rolled(statements(triples, lambda text, iri: shortened(text, iri, prefixes)), path, roll_bytes, prefix_header(prefixes), ".ttl", compression, mode)
