"""Every query of the library against its SQL, on the smallest tables."""

import pytest
from helpers import canonical

from cairnlake.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    rows = [tuple(r) for r in df.select(*columns).collect()]
    if name not in ORACLE:
        assert len(set(columns)) == len(columns)
        return
    quoted = ", ".join(f'"{c}"' for c in columns)
    found = duck.execute(f"SELECT {quoted} FROM ({ORACLE[name]})").fetchall()
    assert canonical(rows) == canonical(found)


def test_entry_has_no_hidden_names(spark):
    import __spark_entry__ as entry

    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0


def test_approximate_count_is_near(spark, duck, sf_dir):
    exact = dict(duck.execute("SELECT o_orderstatus, count(DISTINCT o_custkey) FROM orders GROUP BY 1").fetchall())
    found = {r["o_orderstatus"]: r["customers"] for r in QUERIES["approx_distinct"](spark, sf_dir).collect()}
    assert found.keys() == exact.keys() and all(abs(found[k] - n) <= max(2, 0.15 * n) for k, n in exact.items())
