"""Point-in-time joins on (customer, snapshot) and the lagged pivot."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tallyhouse.functions.schema import KEY, SNAPSHOT


def duplicate_keys(df: DataFrame, key: Sequence[str] = tuple(KEY)) -> DataFrame:
    """Keys with more than one row, and how many they have."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def assert_unique(df: DataFrame, key: Sequence[str] = tuple(KEY)) -> DataFrame:
    """The frame itself; raises if a key repeats. Run where a table enters the store."""
    repeated = duplicate_keys(df, key).take(1)
    if repeated:
        raise ValueError(f"key {', '.join(key)} repeats, for example {repeated[0].asDict()}")
    return df


def outer_join(sources: Sequence[DataFrame], key: Sequence[str] = tuple(KEY)) -> DataFrame:
    """Full outer join of any number of sources with one row per key, in one exchange.

    The sources are put one below the other and each key is gathered by one aggregate that is combined map-side. Chained full
    outer joins would shuffle what they have joined again for each further source, and Spark cannot split a hot key of them;
    here such a key leaves each task as one row. A key that a source repeats is found in the same pass and is an error. Rows
    with a null in the key meet no others, as in a join. Columns beside the key have to differ between the sources.
    """
    names = [c for s in sources for c in s.columns if c not in key]
    if len(names) != len(set(names)):
        raise ValueError(f"columns {sorted({c for c in names if names.count(c) > 1})} are in more than one source")
    tagged = [s.withColumn("_source", F.lit(i)) for i, s in enumerate(sources)]
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    no_key = reduce(lambda a, b: a | b, [F.col(f"`{k}`").isNull() for k in key])
    alone = F.when(no_key, F.monotonically_increasing_id())  # null for all others, which it does not keep apart
    counts = [F.count_if(F.col("_source") == i).alias(f"_n{i}") for i in range(len(sources))]
    gathered = every.withColumn("_alone", alone).groupBy(*[f"`{k}`" for k in key], "_alone").agg(
        *counts, *[F.first(f"`{c}`", ignorenulls=True).alias(c) for c in names])
    most = F.greatest(*[F.col(f"_n{i}") for i in range(len(sources))]) if len(sources) > 1 else F.col("_n0")
    message = F.concat(F.lit(f"key {', '.join(key)} repeats in a source: "), F.concat_ws(", ", *[F.col(f"`{k}`").cast("string") for k in key]))
    first = F.when(most > 1, F.raise_error(message)).otherwise(F.col(f"`{key[0]}`")).alias(key[0])
    return gathered.select(first, *[F.col(f"`{c}`") for c in [*key[1:], *names]])


def join_sources(clicks: DataFrame, attributes: DataFrame, financials: DataFrame) -> DataFrame:
    """Full outer join of the three sources, each with one row per key."""
    return outer_join([clicks, attributes, financials])


def feature_set(engagement: DataFrame, risk: DataFrame) -> DataFrame:
    """Full outer join of the two gold feature tables, for training."""
    return outer_join([engagement, risk])


def scoring_set(risk: DataFrame, engagement: DataFrame) -> DataFrame:
    """Risk features with engagement where there is any, for scoring."""
    return risk.join(engagement, KEY, "left")


def training_rows(labels: DataFrame, features: DataFrame) -> DataFrame:
    """Labels with the features of the same customer and snapshot."""
    return labels.join(features, KEY, "left")


def label_predictions(labels: DataFrame, predictions: DataFrame) -> DataFrame:
    """Labels with the predictions for the same customer and snapshot; unscored labels drop out."""
    return labels.join(predictions, KEY, "left").where(F.col("model_predictions").isNotNull())


def months_between_firsts(later: Column, earlier: Column) -> Column:
    """Whole months between two first-of-month dates."""
    return F.months_between(later, earlier).cast("int")


def lagged(df: DataFrame, as_of: Column, months: int = 6) -> DataFrame:
    """Rows of the ``months`` snapshots before ``as_of`` in one range filter, with ``months_ago``."""
    in_range = (F.col(SNAPSHOT) >= F.add_months(as_of, -months)) & (F.col(SNAPSHOT) < as_of)
    return df.where(in_range).withColumn("months_ago", months_between_firsts(as_of, F.col(SNAPSHOT)))


def lagged_pivot(
    df: DataFrame, value: str, prefix: str, months: int = 6, low: str | None = None, high: str | None = None,
) -> DataFrame:
    """Per customer and snapshot, the value of each of the ``months`` snapshots before it.

    All snapshots at once: a row serves the ``months`` snapshots after its own, so one aggregate with
    map-side combining is the only shuffle. ``low`` and ``high`` bound the snapshots that are built; of a table
    by snapshot only those that they look back on are read, so a rerun of one month reads ``months`` partitions. Columns are ``<prefix>_1m``, ``<prefix>_2m`` and so on; every one exists. Copies give the largest.
    """
    if low is not None:
        df = df.where(F.col(SNAPSHOT) >= F.add_months(F.lit(low).cast("date"), -months))
    if high is not None:
        df = df.where(F.col(SNAPSHOT) < F.lit(high).cast("date"))
    lag = F.explode(F.sequence(F.lit(1), F.lit(months))).alias("lag")
    spread = (
        df.select("Customer_ID", F.col(SNAPSHOT).alias("seen"), value, lag)
        .select("Customer_ID", F.expr("add_months(seen, lag)").alias(SNAPSHOT), value, "lag"))
    if low is not None:
        spread = spread.where(F.col(SNAPSHOT) >= F.lit(low).cast("date"))
    if high is not None:
        spread = spread.where(F.col(SNAPSHOT) <= F.lit(high).cast("date"))
    return spread.groupBy("Customer_ID", SNAPSHOT).agg(
        *[F.max(F.when(F.col("lag") == k, F.col(value))).alias(f"{prefix}_{k}m") for k in range(1, months + 1)])
