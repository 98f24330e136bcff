"""Exact quantiles, histograms and box-plot statistics without large groups.

Spark's `percentile` keeps every distinct value of a group in one buffer.  Here the
place of each quantile is narrowed down by rounds of histograms with partial counts:
the first has a cell for each sign and power of two, later ones cut the cell that holds
the wanted rank into equally wide cells, between the smallest and the largest value found
in it. Five rounds reach any double within a power of two; usually a few are enough. No
values are ever ordered, only the bounded cells of a histogram.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.fixed_values import HISTOGRAM_BINS
from tributary.operators.skew import skew_join
from tributary.staging import stage

#: Cells of one round, for each group and rank.
_CELLS = 1 << 14
#: Rows are written apart as soon as this share of them is all that is still looked at.
_FEW = 1 / 8


def _interpolated(low: Column, high: Column, share: Column) -> Column:
    rising = low + (high - low) * share
    falling = high - (high - low) * (F.lit(1.0) - share)
    return F.when(share == 0, low).when(share < 0.5, rising).otherwise(falling)


def _power_cell(value: Column) -> Column:
    """A number for the sign and power of two of a value, rising with it."""
    power = F.floor(F.least(F.greatest(F.log2(F.abs(value)), F.lit(-1100.0)), F.lit(1100.0))) + 1101
    return F.when(value == 0, F.lit(0)).when(value > 0, power).otherwise(-power).cast("int")


def _width_cell(value: Column, low: Column, high: Column) -> Column:
    return F.least(F.floor((value - low) / (high - low) * _CELLS), F.lit(_CELLS - 1)).cast("int")


_FOUND = "struct<below: bigint, n: bigint, low: double, high: double, done: boolean>"


def _cell_of_rank(cells: str, rank: Column) -> Column:
    """The cell that holds the value of a rank counted from 0, and how many values lie below it."""
    return F.aggregate(
        F.array_sort(cells),
        F.expr(f"cast(struct(0L, 0L, null, null, false) as {_FOUND})"),
        lambda s, c: F.when(s["done"], s).otherwise(F.struct(
            F.when(s["below"] + c["n"] > rank, s["below"]).otherwise(s["below"] + c["n"]).alias("below"),
            c["n"].alias("n"), c["low"].alias("low"), c["high"].alias("high"), (s["below"] + c["n"] > rank).alias("done"),
        ).cast(_FOUND)),
    )


def _cells(rows: DataFrame, *by: str) -> DataFrame:
    """Counted cells with their smallest and largest value, collected for all columns but the last: `_cell`."""
    counted = rows.groupBy(*by, "_cell").agg(
        F.count("*").alias("n"), F.min("_value").alias("low"), F.max("_value").alias("high"))
    return counted.groupBy(*by).agg(F.collect_list(F.struct("_cell", "n", "low", "high")).alias("_cells"))


def _meet(rows: DataFrame, lookup: DataFrame, keys: list[str], column: str) -> DataFrame:
    """Rows with the one value of `column` that the lookup has for their group."""
    if keys:
        return skew_join(rows, lookup, keys)
    return rows.withColumn(column, lookup.select(column).scalar())


def exact_quantiles(
    df: DataFrame,
    value: str,
    probabilities: list[float],
    groups: tuple[str, ...] = (),
) -> DataFrame:
    """Linearly interpolated quantiles q0, q1, … and the row count n per group.

    Null values and, where groups are given, null groups are left out.  The rounds run
    when this is called; what they find is written.
    """
    keys = list(groups)
    rows = df.select(*keys, F.col(value).cast("double").alias("_value")).dropna()
    first = _cells(rows.withColumn("_cell", _power_cell(F.col("_value"))), *keys)
    total = F.aggregate("_cells", F.lit(0).cast("long"), lambda s, c: s + c["n"])
    first = first.withColumn("n", total).where("n > 0")
    wanted = []  # the two neighbours of each quantile
    for p in probabilities:
        rank = F.floor(F.lit(p) * (F.col("n") - 1))
        wanted += [rank, F.least(rank + 1, F.col("n") - 1)]
    ranks = first.select(*keys, "n", "_cells", F.posexplode(F.array(*wanted)).alias("target", "rank"))
    found = stage(ranks.select(*keys, "target", "n", "rank", _cell_of_rank("_cells", F.col("rank")).alias("found")).select(
        *keys, "target", F.col("n").alias("_all"), "rank", "found.below", "found.n", "found.low", "found.high"), "quantile-ranks")
    settled = []
    size = None
    while True:
        settled.append(found.where("low = high"))
        unsettled = found.where("low < high")
        left = unsettled.agg(F.sum("n")).first()[0]
        if left is None:
            break
        size = size or found.agg(F.sum("_all") / (2 * len(probabilities))).first()[0]
        targets = unsettled.groupBy(*keys).agg(F.collect_list(F.struct("target", "low", "high")).alias("_targets"))
        met = _meet(rows, stage(targets, "quantile-targets"), keys, "_targets")
        inside = F.exists("_targets", lambda t: F.col("_value").between(t["low"], t["high"]))
        if left <= size * _FEW:
            rows, size = stage(met.where(inside).select(*keys, "_value"), "quantile-rows"), left
            met = _meet(rows, stage(targets, "quantile-targets"), keys, "_targets")
        cells = (
            met.select(*keys, "_value", F.inline("_targets"))
            .where(F.col("_value").between(F.col("low"), F.col("high")))
            .withColumn("_cell", _width_cell(F.col("_value"), F.col("low"), F.col("high")))
        )
        narrowed = skew_join(unsettled, _cells(cells, *keys, "target"), [*keys, "target"])
        inner = _cell_of_rank("_cells", F.col("rank") - F.col("below"))
        found = stage(narrowed.withColumn("found", inner).select(
            *keys, "target", "_all", "rank", (F.col("below") + F.col("found.below")).alias("below"),
            "found.n", "found.low", "found.high"), "quantile-ranks")

    every = reduce(DataFrame.unionByName, settled)
    at = [F.max(F.when(F.col("target") == t, F.col("low"))).alias(f"_v{t}") for t in range(2 * len(probabilities))]
    values = every.groupBy(*keys, F.col("_all").alias("n")).agg(*at)

    def quantile(index: int, p: float) -> Column:
        position = F.lit(p) * (F.col("n") - 1)
        return _interpolated(F.col(f"_v{2 * index}"), F.col(f"_v{2 * index + 1}"), position - F.floor(position))

    return values.select(*keys, "n", *[quantile(i, p).alias(f"q{i}") for i, p in enumerate(probabilities)])


def box_statistics(df: DataFrame, value: str, group: str, reach: float = 1.5) -> DataFrame:
    """Quartiles and whiskers per group.

    A whisker ends at the furthest value within `reach` quartile distances of
    the box, at the box itself if there is none.
    """
    rows = df.select(group, F.col(value).cast("double").alias(value)).dropna()
    quartiles = exact_quantiles(rows, value, [0.25, 0.5, 0.75], (group,))
    span = (F.col("q2") - F.col("q0")) * reach
    fences = quartiles.withColumns({"_low": F.col("q0") - span, "_high": F.col("q2") + span})
    measured = skew_join(rows, stage(fences, "fences"), [group])
    within = F.col(value).between(F.col("_low"), F.col("_high"))
    return (
        measured.groupBy(group, "n", "q0", "q1", "q2")
        .agg(
            F.min(F.when(within, F.col(value))).alias("_lowest"),
            F.max(F.when(within, F.col(value))).alias("_highest"),
            F.count_if(~within).alias("outliers"),
        )
        .select(
            group, "n",
            F.least(F.coalesce("_lowest", "q0"), "q0").alias("whisker_low"),
            F.col("q0").alias("q1"),
            F.col("q1").alias("median"),
            F.col("q2").alias("q3"),
            F.greatest(F.coalesce("_highest", "q2"), "q2").alias("whisker_high"),
            "outliers",
        )
    )


def box_outliers(df: DataFrame, value: str, group: str, boxes: DataFrame) -> DataFrame:
    """The rows beyond the whiskers of `box_statistics`."""
    rows = df.select(group, F.col(value).cast("double").alias(value)).dropna()
    ends = boxes.select(group, "whisker_low", "whisker_high")
    beyond = ~F.col(value).between(F.col("whisker_low"), F.col("whisker_high"))
    return skew_join(rows, ends, [group]).where(beyond).select(group, value)


def histogram(df: DataFrame, value: str, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Counts of equally wide bins from the smallest to the largest value.

    Every bin has a row; the last one includes its upper edge.  A single value
    gets a range of one around it.
    """
    rows = df.select(F.col(value).cast("double").alias("_value")).dropna()
    low = F.coalesce(F.min("_value"), F.lit(0.0))
    high = F.coalesce(F.max("_value"), F.lit(1.0))
    margin = F.when(low == high, 0.5).otherwise(0.0)
    limits = rows.agg(F.struct((low - margin).alias("low"), (high + margin).alias("high"))).scalar()
    width = (F.col("_limits.high") - F.col("_limits.low")) / bins

    def edge(number):
        inner = F.col("_limits.low") + number * width
        return F.when(number == bins, F.col("_limits.high")).otherwise(inner)

    share = (F.col("_value") - F.col("_limits.low")) / (F.col("_limits.high") - F.col("_limits.low"))
    guess = F.col("_guess")
    # the quotient may land one bin beside the edges it is compared with
    corrected = (
        guess
        - (F.col("_value") < edge(guess)).cast("int")
        + ((F.col("_value") >= edge(guess + 1)) & (guess < bins - 1)).cast("int")
    )
    counts = (
        rows.withColumn("_limits", limits)
        .withColumn("_guess", F.least(F.floor(share * bins), F.lit(bins - 1)))
        .groupBy((corrected + 1).cast("int").alias("bin")).count()
    )
    every = df.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    return (
        every.withColumn("_limits", limits)
        .join(F.broadcast(counts), "bin", "left")  # at most `bins` rows
        .select(
            "bin",
            edge(F.col("bin") - 1).alias("bin_low"),
            edge(F.col("bin")).alias("bin_high"),
            F.coalesce("count", F.lit(0)).alias("count"),
        )
    )
