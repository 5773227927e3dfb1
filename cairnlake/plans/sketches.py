"""Mergeable sketches of the item cube: different values and quantiles for any set of groups, without its rows.

For each combination of the group columns a row holds, beside exact counts, an HLL sketch for each column whose different values are asked for, and a KLL sketch
for each number whose quantiles are. Sketches are merged under any filter on the group columns: what is read doesn't grow with the items.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GROUPS = ("v_edm_country", "v_edm_provider", "v_edm_type")
DISTINCT, NUMBERS = ("v_edm_dataProvider", "v_edm_datasetName"), ("x_web_resource_count", "x_title_languages")
#: Precision: an HLL sketch of 2 ** HLL registers errs by about 1.04 / sqrt(2 ** HLL) (one standard deviation), a KLL sketch of size KLL by about 1.3 % in rank at 200.
HLL, KLL = 12, 200


@dataclass(frozen=True)
class Sketches:
    """table has a row for each group; what was sketched, by name."""

    table: DataFrame
    groups: tuple[str, ...]
    distinct: tuple[str, ...]
    numbers: tuple[str, ...]

    @classmethod
    def of(cls, df: DataFrame, groups: tuple[str, ...] = GROUPS, distinct: tuple[str, ...] = DISTINCT, numbers: tuple[str, ...] = NUMBERS) -> Sketches:
        """Sketches of a table. Nulls are no values; a group column that is null is a group. Values to be told apart are taken as text, numbers as longs."""
        text = lambda c: F.col(c).cast("string")
        aggs = [F.count("*").alias("rows"), *[F.hll_sketch_agg(text(c), HLL).alias(f"hll_{c}") for c in distinct], *[F.kll_sketch_agg_bigint(F.col(c).cast("bigint"), KLL).alias(f"kll_{c}") for c in numbers]]
        return cls(df.groupBy(*groups).agg(*aggs), groups, distinct, numbers)

    @classmethod
    def read(cls, table: DataFrame, groups: tuple[str, ...] = GROUPS) -> Sketches:
        """Sketches from a table that was stored."""
        names = lambda p: tuple(c.removeprefix(p) for c in table.columns if c.startswith(p))
        return cls(table, groups, names("hll_"), names("kll_"))

    def merged(self, by: tuple[str, ...] = (), where: Column | None = None) -> DataFrame:
        """Sketches of coarser groups under a filter on the group columns."""
        rows = self.table if where is None else self.table.where(where)
        aggs = [F.sum("rows").alias("rows"), *[F.hll_union_agg(f"hll_{c}").alias(f"hll_{c}") for c in self.distinct], *[F.kll_merge_agg_bigint(f"kll_{c}").alias(f"kll_{c}") for c in self.numbers]]
        return rows.groupBy(*by).agg(*aggs)

    def estimates(self, by: tuple[str, ...] = (), where: Column | None = None, quantiles: tuple[float, ...] = (0.5, 0.9, 0.99)) -> DataFrame:
        """(by, rows, n_<column> for different values, q_<number> with its quantiles): rows exact, the rest within the sketches' errors; quantiles of nothing are null."""
        asked = F.array(*[F.lit(float(q)) for q in quantiles])
        out = [F.hll_sketch_estimate(f"hll_{c}").alias(f"n_{c}") for c in self.distinct]
        some = lambda c: F.when(F.kll_sketch_get_n_bigint(f"kll_{c}") > 0, F.kll_sketch_get_quantile_bigint(f"kll_{c}", asked))
        return self.merged(by, where).select(*by, "rows", *out, *[some(c).alias(f"q_{c}") for c in self.numbers])
