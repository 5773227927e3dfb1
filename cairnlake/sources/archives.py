"""Dumps of Turtle and N-Triples files, plain, gzipped or in ZIP archives, as a data source of Spark.

Partitions are planned from the files' sizes and, for archives larger than a partition, from their directories: a partition is
some files, or a run of an archive's entries. Tasks read in chunks, so memory depends on neither the file nor
the entry. Paths are of any file system that pyarrow.fs opens (local, hdfs, s3, gs).
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from typing import TYPE_CHECKING, Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .triples import TRIPLES

if TYPE_CHECKING:
    import pyarrow as pa

#: Compressed bytes of a partition, bytes read at once, rows of a batch, and faults of an entry that are told one by one.
SPLIT, CHUNK, ROWS, FAULTS = 64 << 20, 1 << 20, 20_000, 100
NAMES = r"\.(ttl|nt|turtle)$"
#: Archives whose directories are read at a time while partitions are planned.
PLANNERS = 16
# Fixed value: how prefixes are declared in Turtle.
PREFIX = re.compile(r"^\s*(?:@prefix|prefix)\s+([\w.-]*):\s*<([^>]*)>", re.I)


def file_system(path: str) -> tuple[Any, str]:
    """The file system of a path and the path within it."""
    from pyarrow import fs

    if re.match(r"^[A-Za-z][A-Za-z0-9+.-]+:", path):
        return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
    return fs.LocalFileSystem(), path


def list_files(path: str) -> list[tuple[str, int]]:
    """(path, size) of the files of a file, a folder with all below it, or a pattern with * and ? (not across folders), in order; names that begin with . or _ are left out."""
    from pyarrow import fs

    system, inner = file_system(path)
    scheme = path[: len(path) - len(inner)] if path.endswith(inner) else ""
    fixed = re.split(r"[*?]", inner)[0]
    matches = re.compile("".join({"*": "[^/]*", "?": "[^/]"}.get(c, re.escape(c)) for c in inner)).fullmatch
    folder = inner if fixed == inner else fixed.rsplit("/", 1)[0] or "/"
    info = system.get_file_info(folder)
    if info.type == fs.FileType.File:
        found = [info]
    elif info.type == fs.FileType.Directory:
        found = system.get_file_info(fs.FileSelector(folder, recursive=True))
    else:
        raise FileNotFoundError(path)
    hidden = lambda p: any(x[0] in "._" for x in p[len(folder) :].split("/") if x)
    files = [(scheme + f.path, f.size) for f in found if f.type == fs.FileType.File and not hidden(f.path) and (fixed == inner or matches(f.path))]
    return sorted(files)


@dataclass
class Piece(InputPartition):
    """Files with the run of their entries (None: all there are)."""

    files: list[tuple[str, tuple[int, int] | None]]


def is_zip(path: str) -> bool:
    return path.lower().endswith(".zip")


def entry_runs(path: str, names: str, split: int) -> list[tuple[int, int]]:
    """Runs of the archive's entries whose compressed bytes come to about `split`; none if its directory can't be read, which the reader then tells."""
    import zipfile

    system, inner = file_system(path)
    try:
        with system.open_input_file(inner) as f, zipfile.ZipFile(f) as z:
            sizes = [e.compress_size for e in z.infolist() if re.search(names, e.filename, re.I)]
    except (zipfile.BadZipFile, OSError, ValueError):
        return []
    runs, begin, held = [], 0, 0
    for i, size in enumerate(sizes, 1):
        held += size
        if held >= split or i == len(sizes):
            runs.append((begin, i))
            begin, held = i, 0
    return runs


def plan(path: str, names: str, split: int) -> list[Piece]:
    """Partitions of about `split` bytes; a file that isn't an archive is never cut."""
    from concurrent.futures import ThreadPoolExecutor

    files = [(p, size) for part in path.split(",") for p, size in list_files(part.strip()) if is_zip(p) or re.search(names, re.sub(r"\.gz$", "", p), re.I)]
    large = [p for p, size in files if is_zip(p) and size > split]
    with ThreadPoolExecutor(PLANNERS) as pool:
        runs = dict(zip(large, pool.map(lambda p: entry_runs(p, names, split), large), strict=True))
    out, held, size_held = [], [], 0
    for p, size in files:
        if runs.get(p):
            out += [Piece([(p, run)]) for run in runs[p]]
            continue
        held.append((p, None))
        size_held += size
        if size_held >= split:
            out.append(Piece(held))
            held, size_held = [], 0
    return out + ([Piece(held)] if held else [])


@contextmanager
def opened(path: str) -> Iterator[Any]:
    """A file's bytes as a file object; all members of a gzip file."""
    import gzip

    system, inner = file_system(path)
    with system.open_input_file(inner) as f:
        if f.read(2) == b"\x1f\x8b":
            f.seek(0)
            with gzip.GzipFile(fileobj=f) as g:
                yield g
        else:
            f.seek(0)
            yield f


def texts(piece: Piece, names: str) -> Iterator[tuple[str, str | None, Callable[[], Any] | Exception]]:
    """(file, entry, how to open it as a context of a file object); an error instead where an archive can't be read."""
    import zipfile

    for path, run in piece.files:
        if not is_zip(path):
            yield path, None, lambda path=path: opened(path)
            continue
        system, inner = file_system(path)
        try:
            with system.open_input_file(inner) as f, zipfile.ZipFile(f) as z:
                entries = [e for e in z.infolist() if re.search(names, e.filename, re.I)]
                for e in entries[slice(*run)] if run else entries:
                    yield path, e.filename, lambda z=z, e=e: z.open(e)
        except (zipfile.BadZipFile, OSError, ValueError) as e:
            yield path, None, e


def characters(f: Any) -> Iterator[str]:
    import codecs

    decode = codecs.getincrementaldecoder("utf-8-sig")().decode
    while data := f.read(CHUNK):
        yield decode(data)
    yield decode(b"", True)


def triples_of(file: str, entry: str | None, opening: Callable[[], Any], damaged: str) -> Iterator[tuple]:
    """(s, p, o, kind, lang, datatype, file, entry, problem) of one text."""
    import zipfile

    from .turtle import Reader

    mark = f"f{zlib.crc32(file.encode()):08x}" + (f"e{zlib.crc32(entry.encode()):08x}" if entry else "")

    def read(problems: list[str] | None) -> Iterator[tuple]:
        with opening() as f:
            yield from Reader(characters(f), mark).triples(problems)

    broken = (ValueError, OSError, EOFError, RuntimeError, NotImplementedError, zlib.error, zipfile.BadZipFile)
    problems: list[str] = []
    try:
        if damaged == "entry":
            # Read once to see whether all of it can be read, and again for its triples: nothing is held.
            for _ in read(None):
                pass
        for t in read(problems if damaged == "statement" else None):
            yield (*t, file, entry, None)
    except broken as e:
        if damaged == "strict":
            raise ValueError(f"{file}{'/' + entry if entry else ''}: {e}") from e
        problems.append(f"{type(e).__name__}: {e}" if not isinstance(e, ValueError) else str(e))
    told = problems[:FAULTS] + ([f"and {len(problems) - FAULTS} more"] if len(problems) > FAULTS else [])
    for problem in told:
        yield (None,) * 6 + (file, entry, problem)


class DumpReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.names = options["path"], options.get("names", NAMES)
        self.damaged, self.what, self.split = options.get("damaged", "strict"), options.get("what", "triples"), int(options.get("split", SPLIT))
        if self.damaged not in ("strict", "entry", "statement"):
            raise ValueError(f"damaged is strict, entry or statement, not {self.damaged}")

    def partitions(self) -> list[InputPartition]:
        return plan(self.path, self.names, self.split)

    def rows(self, piece: Piece) -> Iterator[tuple]:
        for file, entry, opening in texts(piece, self.names):
            if isinstance(opening, Exception):
                if self.damaged == "strict":
                    raise ValueError(f"{file}: {opening}") from opening
                if self.what == "triples":
                    yield (None,) * 6 + (file, entry, f"{type(opening).__name__}: {opening}")
            elif self.what == "triples":
                yield from triples_of(file, entry, opening, self.damaged)
            else:
                seen = set()
                with opening() as f:
                    for line in lines_of(characters(f)):
                        if (m := PREFIX.match(line)) and m.groups() not in seen:
                            seen.add(m.groups())
                            yield (*m.groups(), file, entry)

    def read(self, piece: Piece) -> Iterator[pa.RecordBatch]:
        import pyarrow as pa

        names = [f.split()[0] for f in (TRIPLES_OF if self.what == "triples" else PREFIXES_OF).split(", ")]
        rows: list[tuple] = []
        for row in self.rows(piece):
            rows.append(row)
            if len(rows) == ROWS:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in zip(*rows, strict=True)], names=names)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in zip(*rows, strict=True)], names=names)


def lines_of(chunks: Iterator[str]) -> Iterator[str]:
    """Lines of a text that comes in chunks; of a line longer than a chunk its first."""
    rest, whole = "", True
    for chunk in chunks:
        *lines, last = (rest + chunk).split("\n")
        if lines and not whole:
            lines, whole = lines[1:], True
        yield from lines
        rest = last
        if len(rest) > CHUNK:
            if whole:
                yield rest
            rest, whole = "", False
    if whole:
        yield rest


TRIPLES_OF = f"{TRIPLES}, file string, entry string, problem string"
PREFIXES_OF = "prefix string, namespace string, file string, entry string"


class Dump(DataSource):
    """format("rdf_dump") with path, damaged, names, split, and what: "triples" or "prefixes"."""

    @classmethod
    def name(cls) -> str:
        return "rdf_dump"

    def schema(self) -> str:
        return PREFIXES_OF if self.options.get("what") == "prefixes" else TRIPLES_OF

    def reader(self, schema: Any) -> DumpReader:
        return DumpReader(dict(self.options))


def _load(spark: SparkSession, path: str, **options: str) -> DataFrame:
    spark.dataSource.register(Dump)
    return spark.read.format("rdf_dump").options(path=path, **options).load()


def read_dump(spark: SparkSession, path: str, damaged: str = "strict", names: str = NAMES, split: int = SPLIT) -> DataFrame:
    """Triples of all files of a dump, with (file, entry, problem) of each; entry is null outside archives.

    path: a file, a folder or a pattern, or several with commas between them. names: a pattern of the files (without .gz) and entries that
    are read. What can't be read (faulty statements, damaged entries, archives without a directory, text that isn't UTF-8) is by `damaged`
    an error ("strict"), or told in a row with nothing but file, entry and problem: either nothing else
    is given of that entry ("entry"), or its faulty statements are left out ("statement"; what comes before the damage is given where bytes are damaged).
    Blank nodes are told apart by file and entry. Empty files give no rows.
    """
    return _load(spark, path, damaged=damaged, names=names, split=str(split))


def dump_prefixes(spark: SparkSession, path: str, names: str = NAMES, split: int = SPLIT) -> DataFrame:
    """(prefix, namespace, n): the declarations of a dump's texts and in how many texts each stands."""
    from pyspark.sql import functions as F

    return _load(spark, path, what="prefixes", damaged="statement", names=names, split=str(split)).groupBy("prefix", "namespace").agg(F.count("*").alias("n"))
