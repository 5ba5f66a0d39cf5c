"""Aggregate expressions and ordered statistics."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def moments(z: str) -> dict[str, Column]:
    """Sample deviation, population skewness and kurtosis, and the interpolated 90 % quantile.

    Skewness and kurtosis are null without variance.
    """
    spread = F.var_pop(z) > 0
    return {
        "zsd": F.stddev_samp(z),
        "zskew": F.when(spread, F.skewness(z)),
        "zkurt": F.when(spread, F.kurtosis(z) + 3),
        "zq90": F.percentile(z, F.lit(0.9)),
    }


def ranked(rows: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """rows with what gini_of() needs of each value: its place in the group, and it less the least negative one.

    Values are ranked by windows over the same keys, so one shuffle serves all of them
    and a group isn't gathered in an array.
    """
    by = Window.partitionBy(*keys)
    for v in values:
        rows = rows.withColumn(f"_{v}", F.col(v).cast("double") - F.least(F.min(F.col(v).cast("double")).over(by), F.lit(0.0)))
        rows = rows.withColumn(f"_{v}_place", F.when(F.col(v).isNotNull(), F.row_number().over(by.orderBy(F.col(v).asc_nulls_last()))).cast("double"))
    return rows


def gini_of(value: str) -> Column:
    """Gini coefficient of a group of ranked() rows, corrected by n / (n - 1).

    Nulls don't count; fewer than two values give null; a total of zero gives 0.
    """
    v, place = F.col(f"_{value}"), F.col(f"_{value}_place")
    n, total = F.count(v).cast("double"), F.sum(v)
    raw = 2 * F.sum(place * v) / (n * total) - (n + 1) / n
    return F.when(F.count(v) < 2, None).when(total == 0, 0.0).otherwise(raw * n / (n - 1))


def gini(rows: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """(keys, name): Gini coefficient of the values of a group."""
    return ranked(rows, keys, [value]).groupBy(*keys).agg(gini_of(value).alias(name))


def entropy_share(counts: DataFrame, keys: list[str], count: str, levels: int, name: str) -> DataFrame:
    """(keys, name): Shannon entropy of counts over the logarithm of the number of levels; null for one level."""
    n = F.col(count).cast("double")
    total = F.sum(n)
    # -sum(p ln p) = ln T - sum(n ln n) / T
    entropy = F.ln(total) - F.sum(n * F.ln(n)) / total
    value = entropy / math.log(levels) if levels > 1 else F.lit(None).cast("double")
    return counts.groupBy(*keys).agg(value.alias(name))


def arg_max(rows: DataFrame, keys: list[str], by: str, ties: list[str], columns: dict[str, str]) -> DataFrame:
    """The row of greatest `by` of each group, of the least ties; columns are renamed.

    One aggregation: a struct with the greatest value and negated ties is compared.
    """
    order = F.struct(F.col(by), *(-F.col(t) for t in ties))
    payload = F.struct(*(F.col(c).alias(n) for c, n in columns.items()))
    return rows.groupBy(*keys).agg(F.max_by(payload, order).alias("_top")).select(*keys, "_top.*")


def slope(y: Column, x: Column) -> Column:
    """Least-squares slope; null for fewer than two rows."""
    return F.when(F.count(y) >= 2, F.regr_slope(y, x))
