"""Matrix statistics: moments of several fields and of each pair of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docquarry.functions.predicates import all_of


def matrix_stats(df: DataFrame, fields: Sequence[str], where=None) -> DataFrame:
    """One row per ordered field pair, from a single aggregation.

    Rows that lack any of the fields are left out.  Variance and covariance are
    sample values, skewness is the population value and kurtosis is not reduced
    by 3.
    """
    rows = df if where is None else df.where(where)
    rows = rows.select(*[F.col(f).cast("double").alias(f"x{i}") for i, f in enumerate(fields)])
    span = range(len(fields))
    rows = rows.where(all_of([F.col(f"x{i}").isNotNull() for i in span]))
    measures = [F.count(F.lit(1)).alias("count")]
    for i in span:
        x = f"x{i}"
        measures += [F.avg(x).alias(f"mean{i}"), F.var_samp(x).alias(f"var{i}"),
                     F.skewness(x).alias(f"skew{i}"), (F.kurtosis(x) + 3).alias(f"kurt{i}")]
        measures += [m for j in span if i < j for m in (
            F.covar_samp(x, f"x{j}").alias(f"cov{i}_{j}"),
            F.corr(x, f"x{j}").alias(f"corr{i}_{j}"))]
    totals = rows.agg(*measures)

    def pair(i: int, j: int):
        low, high = sorted((i, j))
        same = i == j
        return F.struct(
            F.lit(fields[i]).alias("field"), F.col("count"), F.col(f"mean{i}").alias("mean"),
            F.col(f"var{i}").alias("variance"), F.col(f"skew{i}").alias("skewness"),
            F.col(f"kurt{i}").alias("kurtosis"), F.lit(fields[j]).alias("other"),
            F.col(f"var{i}" if same else f"cov{low}_{high}").alias("covariance"),
            (F.lit(1.0) if same else F.col(f"corr{low}_{high}")).alias("correlation"))

    pairs = F.array(*[pair(i, j) for i in span for j in span])
    return totals.select(F.explode(pairs).alias("p")).select("p.*")
