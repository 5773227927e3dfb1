"""What a task holds doesn't grow with the tables: steps are dealt into parts by the size of what they read."""

import re

import pytest
from helpers import canonical

from cairnlake.plans import compose
from cairnlake.roles import catalog
from cairnlake.sources.scratch import partitions_for


def plan_of(df):
    return df._jdf.queryExecution().toString()


@pytest.fixture()
def dealt(monkeypatch):
    monkeypatch.setattr(compose, "partitions_for", lambda *frames: 37)


def by_number(df):
    """The keys by which the plan deals rows into 37 parts."""
    return re.findall(r"Exchange hashpartitioning\(([a-z_]+)#[^)]*, 37\), REPARTITION_BY_NUM", plan_of(df).split("== Physical Plan ==")[1])


def test_partitions_grow_with_files(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(50_000).repartition(3).write.parquet(path)
    size = sum(p.stat().st_size for p in (tmp_path / "t").glob("*.parquet"))
    df = spark.read.parquet(path)
    assert partitions_for(df, df.where("id > 5"), each=1000) == -(-size // 1000) > 50
    assert partitions_for(df) == partitions_for(spark.range(3)) == spark.sparkContext.defaultParallelism


def test_map_cho_entities_is_dealt_by_size(spark, sf_dir, dealt):
    assert set(by_number(catalog(spark, sf_dir)("map_cho_entities"))) == {"k_iri_entity", "k_iri", "k_iri_cho"}


def test_explorer_entities_are_dealt_by_size(spark, sf_dir, dealt):
    assert by_number(catalog(spark, sf_dir)("explorer_edm_entities")).count("k_iri_entity") == 3  # the edges' two joins and the labels


def test_facets_make_edges_once(spark, sf_dir, dealt):
    found = plan_of(catalog(spark, sf_dir)("explorer_facet_top_n")).split("== Physical Plan ==")[1]
    assert len(re.findall(r"37\), REPARTITION_BY_NUM", found)) == 6


def test_cube_has_the_rows_of_its_parts(spark, sf_dir, dealt):
    t = catalog(spark, sf_dir)
    made = compose.whole_cube(t)
    assert plan_of(made).split("== Physical Plan ==")[1].count("SortMergeJoin") < 7  # it had one more for each of ten parts
    assert canonical(made.collect()) == canonical(compose.cube_of(compose.cube_parts(t)).collect())
