"""Population stability, densities and alerts on predictions and features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tallyhouse.functions.labels import default_flag
from tallyhouse.functions.schema import SNAPSHOT
from tallyhouse.operators.periods import matured
from tallyhouse.operators.ranks import deciles, unpivot

# Thresholds and the floor of an empty bin.
PSI_LIMIT, AUC_LIMIT, SHARE_FLOOR = 0.25, 0.65, 1e-6


def bin_of(value: Column, edges: Column) -> Column:
    """Number of the right-closed bin, the lowest edge counting to bin 1; null outside the edges."""
    below = F.size(F.filter(edges, lambda e: e < value))
    return (
        F.when(value == F.element_at(edges, 1), 1)
        .when((value > F.element_at(edges, 1)) & (value <= F.element_at(edges, -1)), below))


def _binned_pairs(df: DataFrame, value: str, by: Sequence[str], buckets: int) -> DataFrame:
    """One row per snapshot: rows per bin in it (``actual``) and in the month before (``expected``).

    Bins are the deciles of the month before. A count per distinct value serves twice, as the actual
    side of its own snapshot and as the expected side of the next one, so all pairs share one job.
    """
    keys = [*by, SNAPSHOT]
    number = F.col(value).try_cast("double")
    clean = df.select(*keys, number.alias("value")).where(number.isNotNull() & ~F.isnan(number))
    counts = clean.groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("n"))
    edges = (
        deciles(counts, "value", keys, buckets, weight="n")
        .select(*by, F.add_months(SNAPSHOT, 1).alias(SNAPSHOT), F.array_sort(F.array_distinct("edges")).alias("edges")))
    none, n, month = F.lit(0).cast("long"), F.col("n"), F.col(SNAPSHOT)
    roles = F.array(
        F.struct(month.alias("of"), n.alias("actual"), none.alias("expected")),
        F.struct(F.add_months(month, 1).alias("of"), none.alias("actual"), n.alias("expected")))
    both = (
        counts.select(*by, "value", F.explode(roles).alias("role"))
        .select(*by, F.col("role.of").alias(SNAPSHOT), "value", "role.actual", "role.expected"))
    binned = (
        both.join(edges, keys, "left").withColumn("bin", bin_of(F.col("value"), F.col("edges")))
        .groupBy(*keys, "bin").agg(
            F.sum("actual").alias("actual"), F.sum("expected").alias("expected"),
            F.max(F.size("edges") - 1).alias("bins")))
    inside = F.col("bin").isNotNull()

    def of_bin(side: str) -> Column:  # at most ``buckets`` entries
        return F.map_from_entries(F.collect_list(F.when(inside, F.struct("bin", side)))).alias(f"{side}_of")

    def total(side: str) -> Column:
        return F.coalesce(F.sum(F.when(inside, F.col(side))), none).alias(f"all_{side}")

    return (
        binned.groupBy(*keys).agg(
            F.max("bins").alias("bins"), F.sum("actual").alias("rows"),
            total("actual"), total("expected"), of_bin("actual"), of_bin("expected"))
        .where("rows > 0"))


def _share(side: str, bin: Column) -> Column:
    n = F.coalesce(F.try_element_at(f"{side}_of", bin), F.lit(0))
    return F.greatest(n.cast("double") / F.col(f"all_{side}").cast("double"), F.lit(SHARE_FLOOR))


def _comparable() -> Column:
    """Both months have values in the bins, and there are two bins at least."""
    return (F.col("all_actual") > 0) & (F.col("all_expected") > 0) & (F.col("bins") >= 2)


def bin_shares(df: DataFrame, value: str, by: Sequence[str] = (), buckets: int = 10) -> DataFrame:
    """Per snapshot and bin: share of the snapshot's rows and share of the rows one month before.

    Text is read as a number; what is none drops out, and so do values outside the edges. An empty bin
    counts ``SHARE_FLOOR``. Snapshots without a comparable month before carry no bins.
    """
    bins = F.explode(F.sequence(F.lit(1), F.col("bins"))).alias("bin")
    return (
        _binned_pairs(df, value, by, buckets).where(_comparable()).select("*", bins)
        .select(
            *by, SNAPSHOT, "bin", _share("actual", F.col("bin")).alias("actual"),
            _share("expected", F.col("bin")).alias("expected")))


def psi(df: DataFrame, value: str, by: Sequence[str] = (), buckets: int = 10) -> DataFrame:
    """Population stability index of each snapshot against the month before.

    Snapshots without a month before, or whose month before has too few distinct values to form bins,
    have a null index, and ``psi_status`` says why.
    """
    def add(total: Column, bin: Column) -> Column:  # in bin order, so that the last digit is fixed too
        a, e = _share("actual", bin), _share("expected", bin)
        return total + (a - e) * F.ln(a / e)

    index = F.when(_comparable(), F.aggregate(F.sequence(F.lit(1), F.col("bins")), F.lit(0.0), add))
    status = (
        F.when(F.col("bins").isNull(), "no previous snapshot").when(F.col("bins") < 2, "too few distinct values")
        .when(~_comparable(), "no value within the bins").otherwise("ok"))
    return _binned_pairs(df, value, by, buckets).select(
        *by, SNAPSHOT, index.alias("psi"), status.alias("psi_status"))


def drift_status(index: Column) -> Column:
    return F.when(index > PSI_LIMIT, "major shift").when(index.isNotNull(), "within range")


def performance_status(area: Column) -> Column:
    return (
        F.when(area < AUC_LIMIT, "retraining needed").when(area.isNotNull(), "performance ok")
        .otherwise("labels not available"))


def histogram(df: DataFrame, cols: Sequence[str], by: Sequence[str], bins: int = 500) -> DataFrame:
    """Rows per group, feature and bin of equal width; the range of a feature is shared by all groups."""
    long = unpivot(df, cols, by).where(F.col("value").isNotNull() & ~F.isnan("value"))
    extent = df.agg(*[
        F.struct(F.min(F.col(c).cast("double")).alias("low"), F.max(F.col(c).cast("double")).alias("high")).alias(c)
        for c in cols])
    ranges = extent.unpivot([], list(cols), "feature", "extent").select("feature", "extent.low", "extent.high")
    width = (F.col("high") - F.col("low")) / bins
    at = F.least(F.floor(F.try_divide(F.col("value") - F.col("low"), width)), F.lit(bins - 1))
    return (
        long.join(F.broadcast(ranges), "feature")  # one row per feature
        .select(*by, "feature", F.coalesce(at, F.lit(0)).cast("int").alias("bin"), "low", width.alias("width"))
        .groupBy(*by, "feature", "bin", "low", "width").agg(F.count(F.lit(1)).alias("n")))


def density(
    df: DataFrame, cols: Sequence[str], by: Sequence[str], points: int = 100, bins: int = 500,
) -> DataFrame:
    """Gaussian kernel density of each feature per group, on ``points`` grid points.

    The kernel runs over the histogram, at most ``bins`` weighted bin centres per group. Bandwidth is
    n^(-1/5) times the sample deviation, and the grid reaches three bandwidths past the outer centres.
    """
    hist = histogram(df, cols, by, bins).withColumn(
        "centre", F.col("low") + (F.col("bin") + 0.5) * F.col("width"))
    keys = [*by, "feature"]
    groups = hist.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("centre", "n"))).alias("bars"))
    add = lambda f: F.aggregate("bars", F.lit(0.0), lambda t, b: t + f(b))
    sized = groups.withColumn("rows", add(lambda b: b["n"])).withColumn(
        "mean", add(lambda b: b["n"] * b["centre"]) / F.col("rows"))
    spread = F.sqrt(F.try_divide(
        add(lambda b: b["n"] * F.pow(b["centre"] - F.col("mean"), 2)), F.col("rows") - 1))
    banded = sized.withColumn("h", spread * F.pow("rows", F.lit(-0.2))).where(F.col("h") > 0)
    start = F.element_at("bars", 1)["centre"] - 3 * F.col("h")
    stop = F.element_at("bars", -1)["centre"] + 3 * F.col("h")
    grid = banded.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1)))).withColumn(
        "x", start + (stop - start) * F.col("point") / (points - 1))
    kernel = add(lambda b: b["n"] * F.exp(-F.pow((F.col("x") - b["centre"]) / F.col("h"), 2) / 2))
    scale = F.col("rows") * F.col("h") * F.sqrt(2 * F.pi())
    return grid.select(*keys, "point", "x", (kernel / scale).alias("density"))


def metric_trend(metrics: DataFrame) -> DataFrame:
    """Metrics in the order of their snapshots."""
    return metrics.orderBy(SNAPSHOT)


def bad_rate_curve(loans: DataFrame, days: int, before: str | None = None) -> DataFrame:
    """Share of rows at ``days`` or more past due, by month on book."""
    rows = loans if before is None else matured(loans, before)
    return (
        rows.groupBy("mob").agg(
            F.count(F.lit(1)).alias("n"), F.avg(default_flag(F.col("dpd"), days)).alias("bad_rate"))
        .orderBy("mob"))
