"""Ranks and medians of groups of any size, without a task that holds a whole group.

Ranks: equal values of a group are counted together; the counted values are range-partitioned by (group,
value), so that a large group takes many partitions and small ones share one. Running counts inside a
partition, plus the counts of the partitions before (one row for each group and partition), give every
value's place; rows find theirs by an equi-join on group and value.

Medians: one pass takes count and quantile sketch of every group (mergeable, of bounded size). A sketch
of accuracy A is exact for groups of fewer than A / 2 values: it drops none and knows each one's
place. For larger groups it brackets the median to a few values in forty thousand; a second pass counts what
lies below the bracket, and ranks only counted values inside it. A bracket that missed its place
(a sketch erred by more than it should) is seen by these counts, and opened.

Defined results: null values have no rank and count for nothing; NaN is larger than every number;
group keys may be null. Groups without a value have no median row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strataloom.operators.lineage import cut
from strataloom.operators.lookups import bounded

#: Accuracy of sketches: groups of up to half as many values need one pass, and a sketch takes about a MB.
ACCURACY = 40_000
#: Brackets up to this number are broadcast.
MAX_BRACKETS = 100_000


def _joined(a: DataFrame, b: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on keys that may be null; the keys of a stay."""
    other = b.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = F.lit(True)
    for k in keys:
        on = on & a[k].eqNullSafe(other[f"_r_{k}"])
    out = a.join(other, on, how)
    return out if how == "left_anti" else out.drop(*[f"_r_{k}" for k in keys])


def dealt_values(rows: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """Counted values (keys, value, _n) with the range partition (_part) that holds them."""
    counted = rows.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    return cut(counted.repartitionByRange(*keys, value).withColumn("_part", F.spark_partition_id()))


def places(dealt: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """keys, value, _n rows of this value, _before smaller ones, _k all of the group."""
    per = dealt.groupBy(*keys, "_part").agg(F.sum("_n").alias("_m"))
    group = W.partitionBy(*keys)
    lower = F.sum("_m").over(group.orderBy("_part").rowsBetween(W.unboundedPreceding, -1))
    per = per.select(*keys, "_part", F.coalesce(lower, F.lit(0)).alias("_low"), F.sum("_m").over(group).alias("_k"))
    inside = W.partitionBy(*keys, "_part").orderBy(value).rowsBetween(W.unboundedPreceding, W.currentRow)
    running = dealt.withColumn("_in", F.sum("_n").over(inside) - F.col("_n"))
    met = _joined(running, per, [*keys, "_part"])
    return met.select(*keys, value, "_n", (F.col("_low") + F.col("_in")).alias("_before"), "_k")


def average_rank(rows: DataFrame, keys: list[str], value: str = "value", name: str = "average_rank", size: str | None = None) -> DataFrame:
    """rows with the rank of their value in its group, ties averaged (and the group's number of values)."""
    found = places(dealt_values(rows, keys, value), keys, value)
    more = [F.col("_k").alias(size)] if size else []
    ranks = found.select(*keys, value, (F.col("_before") + (F.col("_n") + 1) / 2).alias(name), *more)
    return _joined(rows, ranks, [*keys, value], "left")


def between_brackets(rows: DataFrame, brackets: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """keys, i, x: the value at the (fractional) place ``at`` of the group's values, interpolated.

    brackets: keys, i, at (from 0), and lo, hi, between which that place's neighbours lie for certain. Rows
    below are counted, with partial aggregation; only counted values inside are ranked.
    """
    met = _joined(rows.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_v")), bounded(brackets, MAX_BRACKETS), keys).where(F.col("_v") <= F.col("hi"))
    counted = met.groupBy(*keys, "i", "at", F.when(F.col("_v") >= F.col("lo"), F.col("_v")).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    w = W.partitionBy(*keys, "i").orderBy(F.col("_v").asc_nulls_first())
    ranked = counted.withColumn("_last", F.sum("_n").over(w) - 1).withColumn("_first", F.col("_last") - F.col("_n") + 1).where(F.col("_v").isNotNull())
    has = lambda place: (F.col("_first") <= place) & (F.col("_last") >= place)
    below = F.floor("at")
    ends = ranked.groupBy(*keys, "i", "at").agg(F.max(F.when(has(below), F.col("_v"))).alias("_x"), F.max(F.when(has(F.ceil("at")), F.col("_v"))).alias("_y"))
    return ends.select(*keys, "i", (F.col("_x") + (F.col("_y") - F.col("_x")) * (F.col("at") - below)).alias("x"))


def selected(rows: DataFrame, brackets: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """between_brackets, with the brackets that do not hold their place opened to all values."""
    found = cut(between_brackets(rows, brackets, keys, value).where(F.col("x").isNotNull()))
    lost = _joined(brackets, found.select(*keys, "i"), [*keys, "i"], "left_anti").withColumns({"lo": F.lit(float("-inf")), "hi": F.lit(float("nan"))})
    return found if lost.isEmpty() else found.unionByName(between_brackets(rows, lost, keys, value))


def quantile(rows: DataFrame, keys: list[str], q: float, value: str = "value", name: str = "quantile") -> DataFrame:
    """keys and the exact quantile of each group, interpolated between its neighbours."""
    reach, have = 2.0 / ACCURACY, rows.where(F.col(value).isNotNull())
    found = cut(have.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.percentile_approx(F.col(value).cast("double"), [max(0.0, q - reach), min(1.0, q + reach)], ACCURACY).alias("_e")))
    few = F.col("n") < ACCURACY // 2
    lo, hi = (F.when(few, F.lit(end)).otherwise(F.get("_e", F.lit(i))) for i, end in enumerate((float("-inf"), float("nan"))))
    brackets = found.select(*keys, F.lit(0).alias("i"), ((F.col("n") - 1) * q).alias("at"), lo.alias("lo"), hi.alias("hi"))
    return selected(have, brackets, keys, value).drop("i").withColumnRenamed("x", name)


def medians(rows: DataFrame, keys: list[str], *more: Column, value: str = "value", name: str = "median") -> DataFrame:
    """keys, n, the exact median, and further aggregates (of rows with a value) of each group."""
    reach = 2.0 / ACCURACY
    points = [max(0.0, 0.5 - reach), 0.5, 0.5 + 1e-9, min(1.0, 0.5 + reach)]
    v = F.col(value).cast("double")
    have = rows.where(F.col(value).isNotNull())
    found = cut(have.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.percentile_approx(v, points, ACCURACY).alias("_e"), *more))
    e = [F.get("_e", F.lit(i)) for i in range(4)]
    large = found.where(F.col("n") >= ACCURACY // 2).select(*keys, F.lit(0).alias("i"), ((F.col("n") - 1) / 2).alias("at"), e[0].alias("lo"), e[3].alias("hi"))
    small = F.when(F.col("n") < ACCURACY // 2, (e[1] + e[2]) / 2)
    if large.isEmpty():
        return found.withColumn(name, small).drop("_e")
    exact = selected(have, large, keys, value).drop("i").withColumnRenamed("x", "_x")
    return _joined(found, exact, keys, "left").withColumn(name, F.coalesce(small, F.col("_x"))).drop("_e", "_x")
