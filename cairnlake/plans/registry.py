"""Which tables there are, what they depend on, and writing them in order."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from ..sources.sinks import delete_table, write_table
from ..sources.tables import LINKS, VALUES
from .catalog import Catalog
from .compose import COMPOSED, SORTED

RAW = (*VALUES, "values_edm_WebResource", "values_svcs_Service", "values_publishing_tier", *LINKS)
EXPLORER = ("explorer_edm_entities", "explorer_concepts", "explorer_agents", "explorer_places", "explorer_timespans", "explorer_facet_top_n", "map_cho_mimetypes", "map_rights", "group_items", "values_foaf_Organization", "values_edm_Agent", "values_edm_Place", "values_skos_Concept", "values_edm_TimeSpan", "values_ore_Proxy", "links_ore_Proxy")
SETS = {"raw": RAW, "maps": tuple(n for n in COMPOSED if n.startswith("map_")), "group": ("group_items",), "explorer": EXPLORER, "pipeline": (*RAW, *COMPOSED)}


@dataclass(frozen=True)
class Table:
    name: str
    depends_on: tuple[str, ...] = ()
    make: Callable[[Catalog], DataFrame] | None = None
    sorted_by: tuple[str, ...] = ()


@dataclass
class Outcome:
    written: list[str] = field(default_factory=list)
    skipped: list[str] = field(default_factory=list)
    failed: dict[str, str] = field(default_factory=dict)
    dropped: list[str] = field(default_factory=list)


def registry() -> dict[str, Table]:
    out = {n: Table(n) for n in RAW}
    return out | {n: Table(n, deps, make, SORTED.get(n, ())) for n, (make, deps) in COMPOSED.items()}


def closure(tables: dict[str, Table], names: Iterable[str]) -> list[str]:
    """The names and all that they need, each after what it needs; a circle or an unknown name is an error."""
    order: list[str] = []
    state: dict[str, int] = {}

    def visit(name: str, path: tuple[str, ...]) -> None:
        if name not in tables:
            raise KeyError(f"no table {name}")
        if state.get(name) == 1:
            raise ValueError("tables depend on each other: " + " -> ".join((*path[path.index(name):], name)))
        if name not in state:
            state[name] = 1
            for d in tables[name].depends_on:
                visit(d, (*path, name))
            state[name] = 2
            order.append(name)

    for name in names:
        visit(name, ())
    return order


def select(names: Iterable[str] = (), sets: Iterable[str] = (), everything: bool = False) -> list[str]:
    chosen = [*names, *(n for s in sets for n in SETS[s]), *(SETS["pipeline"] if everything else ())]
    return list(dict.fromkeys(chosen))


def build(catalog: Catalog, folder: str, names: Iterable[str], tables: dict[str, Table] | None = None, overwrite: bool = False, drop_helpers: bool = False) -> Outcome:
    """Writes tables and what they need to folder.

    A build that was broken off goes on where it stopped, as what is there stays. drop_helpers: tables that this call wrote
    only because others needed them are deleted at the end.

    A table that is there is left alone, unless overwrite is set and it was named itself. A table that fails, or needs one
    that failed, is noted and the rest goes on. Later tables read what earlier ones wrote.
    """
    tables, names, out = tables or registry(), list(names), Outcome()
    stored = Catalog(catalog.spark, folder)
    for name in closure(tables, names):
        t = tables[name]
        if stored._stored(name) is not None and not (overwrite and name in names):
            out.skipped.append(name)
        elif missing := [d for d in t.depends_on if d in out.failed]:
            out.failed[name] = f"needs {', '.join(missing)}"
            continue
        else:
            try:
                df = t.make(catalog) if t.make else catalog(name)
                write_table(df, folder, name, t.sorted_by)
                out.written.append(name)
            except Exception as e:  # one table must not keep the others back
                out.failed[name] = f"{type(e).__name__}: {e}"
                continue
        catalog.known[name] = stored(name)
    if drop_helpers:
        for name in [n for n in out.written if n not in names]:
            delete_table(catalog.spark, folder, name)
            catalog.known.pop(name)
            out.dropped.append(name)
    return out
