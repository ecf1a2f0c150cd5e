"""Splits, gradient-boosted trees, randomised search, scoring and the performance ceiling.

``fit_boosted_trees`` fits Spark's boosted trees on all rows. A search fits hundreds of models of all rows, side by side: few
rows are sent to the tasks, which take a fit each (see ``boosting``), many stay in them (see ``spread``). Models of both kinds are compiled to column expressions for scoring (see ``trees``).
"""

from __future__ import annotations

import itertools
import random
from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tallyhouse.functions.schema import SNAPSHOT
from tallyhouse.operators.boosting import DEFAULTS, Fit, Sample, run_fits
from tallyhouse.operators.periods import max_snapshot, training_periods
from tallyhouse.operators.ranks import auc, gini, running_totals
from tallyhouse.operators.spread import Spread, run_spread, spread
from tallyhouse.operators.trees import Model, of_pipeline, with_probability
from tallyhouse.session import cut_lineage, drop_staged

# Seeds, split ratio and the two search grids.
SPLIT_SEED, SEARCH_SEED, TRAIN_RATIO = 88, 42, 0.8
SEARCH_DRAWS, SEARCH_FOLDS = 100, 3
GRID_SMALL: dict[str, list] = {
    "n_estimators": [25, 50],
    "max_depth": [2, 3],
    "learning_rate": [0.01, 0.1],
    "subsample": [0.6, 0.8],
    "colsample_bytree": [0.6, 0.8],
    "gamma": [0, 0.1],
    "min_child_weight": [1, 3, 5],
    "reg_alpha": [0, 0.1, 1],
    "reg_lambda": [1, 1.5, 2],
}
GRID_LARGE: dict[str, list] = {
    "n_estimators": [25, 50, 100],
    "max_depth": [2, 3, 5, 7],
    "learning_rate": [0.01, 0.1],
    "subsample": [0.6, 0.8, 1],
    "colsample_bytree": [0.6, 0.8, 1],
    "gamma": [0, 0.1],
    "min_child_weight": [1, 3, 5],
    "reg_alpha": [0, 0.1, 1],
    "reg_lambda": [1, 1.5, 2, 3],
}

MOST_ROWS = 50_000  # labelled rows that are sent to the tasks for their fits; more are fitted where they are
PLACES = 1 << 48


def split_place(key: Sequence[str], seed: int = SPLIT_SEED) -> Column:
    """48 bits of the hashed key as a number: the same on any cluster. A null part counts as an empty text."""
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in key]
    digits = F.substring(F.md5(F.concat_ws("|", *parts, F.lit(str(seed)))), 1, 12)
    return F.conv(digits, 16, 10).cast("long")


def train_test_split(
    df: DataFrame, key: Sequence[str], ratio: float = TRAIN_RATIO, seed: int = SPLIT_SEED, label: str | None = "label",
    by: Sequence[str] = (),
) -> DataFrame:
    """Adds ``split``: train or test, stratified by the label, and within each group of ``by`` on its own.

    Of each label the rows with the smallest places are train, ``ratio`` of them rounded to whole rows; rows
    with equal keys go together. Without a label, rows below a place are train, about ``ratio`` of all.
    """
    if not 0 <= ratio <= 1:
        raise ValueError("the ratio must be between 0 and 1")
    placed = df.withColumn("split_place", split_place(key, seed))
    if label is None:
        train = F.col("split_place") < F.lit(ratio * PLACES)
        return placed.withColumn("split", F.when(train, "train").otherwise("test")).drop("split_place")
    groups = [*by, label]
    ranked = running_totals(placed, "split_place", {"rows": F.lit(1)}, groups)
    taken = ranked.where(F.col("before_rows") < F.round(F.lit(ratio) * F.col("all_rows"))).select(
        *[F.col(g).alias(f"taken_{g}") for g in groups], F.col("split_place").alias("taken_place"))
    same = F.col("split_place") == F.col("taken_place")
    for g in groups:
        same &= F.col(g).eqNullSafe(F.col(f"taken_{g}"))
    split = F.when(F.col("taken_place").isNotNull(), "train").otherwise("test")
    return placed.join(taken, same, "left").select(*[F.col(f"`{c}`") for c in df.columns], split.alias("split"))


def oot_split(
    df: DataFrame, key: Sequence[str], ratio: float = TRAIN_RATIO, seed: int = SPLIT_SEED, label: str | None = "label",
) -> DataFrame:
    """As above, with the rows of the last snapshot as the out-of-time part."""
    last = max_snapshot(df).select(F.col(SNAPSHOT).alias("last"))
    dated = df.crossJoin(F.broadcast(last))  # exactly one row
    late = dated.where(F.col(SNAPSHOT) == F.col("last")).drop("last")
    early = dated.where(F.col(SNAPSHOT) < F.col("last")).drop("last")
    return train_test_split(early, key, ratio, seed, label).unionByName(late.withColumn("split", F.lit("oot")))


def period_split(df: DataFrame, train_date: str, key: Sequence[str], label: str | None = "label", **periods) -> DataFrame:
    """Split by the periods before a training date; rows outside both periods drop out."""
    at = training_periods(F.lit(train_date).cast("date"), **periods)
    early = df.where(F.col(SNAPSHOT).between(at["train_test_start_date"], at["train_test_end_date"]))
    late = df.where(F.col(SNAPSHOT).between(at["oot_start_date"], at["oot_end_date"]))
    return train_test_split(early, key, label=label).unionByName(late.withColumn("split", F.lit("oot")))


def split_stats(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows and share of bad labels per split."""
    return df.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg(label), 2).alias("bad_share"))


def boosted_trees(features: Sequence[str], label: str = "label", **params) -> Pipeline:
    """Impute, assemble, scale, boost. A missing feature takes the median of the rows the model was fitted
    on, so that no row is lost when scoring."""
    known = [f"{f}_known" for f in features]
    imputed = Imputer(inputCols=list(features), outputCols=known, strategy="median")
    assembled = VectorAssembler(inputCols=known, outputCol="raw_features")
    scaled = StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True)
    trees = GBTClassifier(labelCol=label, featuresCol="features", seed=SPLIT_SEED, **params)
    return Pipeline(stages=[imputed, assembled, scaled, trees])


def fit_boosted_trees(train: DataFrame, features: Sequence[str], label: str = "label", **params) -> PipelineModel:
    """Fit one model. Each stage reads the rows again, so only the needed columns are kept meanwhile."""
    kept = train.select(*features, label).persist()
    try:
        return boosted_trees(features, label, **params).fit(kept)
    finally:
        kept.unpersist()


def draw_params(grid: Mapping[str, Sequence], draws: int, seed: int = SEARCH_SEED) -> list[dict]:
    """Distinct random combinations of a grid; all of them if there are no more than ``draws``."""
    every = [dict(zip(grid, values)) for values in itertools.product(*grid.values())]
    return random.Random(seed).sample(every, min(draws, len(every)))


def bounded_rows(rows: DataFrame, key: Sequence[str], most: int = MOST_ROWS) -> DataFrame:
    """At most ``most`` rows: all of them, or those with the smallest hashed keys, about ``most``. No fit is made on them.

    A key with more rows than that is cut by the limit; which of its rows stay is then not fixed.
    """
    n = rows.count()
    if n <= most:
        return rows
    share = max(0.0, most - 4 * most**0.5) / n
    return rows.where(split_place(key, SEARCH_SEED) < F.lit(share * PLACES)).limit(most)


def _samples(
    rows: DataFrame, features: Sequence[str], key: Sequence[str], label: str, folds: int, most: int, part: str | None = None,
) -> dict[object, Sample] | Spread:
    """All labelled rows per value of ``part``, each with its fold, which is hashed from the key.

    Up to ``most`` rows are brought together, to be sent to the tasks; more stay in the tasks. None are left out.
    """
    rows = rows.where(F.col(label).isNotNull())
    fold = F.pmod(F.xxhash64(*key), F.lit(folds)).cast("int") if folds else F.lit(0)
    kept = rows.select(
        (F.col(part) if part else F.lit(0)).alias("part"), split_place(key, SEARCH_SEED).alias("place"),
        F.col(label).cast("int").alias("label"), fold.alias("fold"),
        F.array(*[F.col(f).cast("double") for f in features]).alias("x"))
    if rows.count() > most:
        return spread(kept)
    found: dict[object, list] = {}
    for r in sorted(kept.collect(), key=lambda r: (r.place, r.label, [-np.inf if v is None else v for v in r.x])):  # `most` rows at most
        found.setdefault(r.part, []).append(r)
    return {
        k: Sample(
            np.array([[np.nan if v is None else v for v in r.x] for r in rs], float).reshape(len(rs), len(features)),
            np.array([r.label for r in rs]), np.array([r.fold for r in rs]))
        for k, rs in found.items()}


def _run(
    spark: SparkSession, samples: Mapping[object, Sample] | Spread, fits: Sequence[Fit], features: Sequence[str], seed: int,
) -> tuple[list[list[float]], list[Model | None]]:
    """Fits whose parts are numbered in the order of the samples."""
    return run_spread(samples, fits, features, seed) if isinstance(samples, Spread) else run_fits(spark, list(samples.values()), fits, features, seed)


def _done(samples: Mapping[object, Sample] | Spread) -> None:
    if isinstance(samples, Spread):
        drop_staged(samples.rows)


def _candidates(draws: Sequence[Mapping]) -> dict[tuple, tuple[dict, list[int]]]:
    """Draws by what they share: all but their number of trees; with the draws' indices."""
    groups: dict[tuple, tuple[dict, list[int]]] = {}
    for i, params in enumerate(draws):
        rest = {k: v for k, v in params.items() if k != "n_estimators"}
        groups.setdefault(tuple(sorted(rest.items())), (rest, []))[1].append(i)
    return groups


def _trees_of(params: Mapping) -> int:
    return (DEFAULTS | dict(params))["n_estimators"]


def search_samples(
    spark: SparkSession, samples: Mapping[object, Sample] | Spread, features: Sequence[str], grid: Mapping[str, Sequence] = GRID_LARGE,
    draws: int = SEARCH_DRAWS, folds: int = SEARCH_FOLDS, seed: int = SPLIT_SEED,
) -> dict[object, tuple[Model, dict, float, list[float]]]:
    """Per sample the model of the best draw on all its rows, its parameters, its mean AUC over the folds, and that of every draw.

    Two jobs for all samples: one of the folds' fits, one of the best draws' final fits. Samples whose labels are all alike have
    no entry. Of equally good draws the first one wins.
    """
    drawn = draw_params(grid, draws)
    groups = list(_candidates(drawn).values())
    keys = samples.parts if isinstance(samples, Spread) else list(samples)
    fits, asked = [], []
    for p, f, (rest, members) in itertools.product(range(len(keys)), range(folds), groups):
        stages = tuple(sorted({_trees_of(drawn[i]) for i in members}))
        fits.append(Fit(p, f, rest | {"n_estimators": stages[-1]}, stages))
        asked.append(members)
    areas, _ = _run(spark, samples, fits, features, seed)
    sums = np.zeros((len(keys), len(drawn), 2))
    for fit, members, found in zip(fits, asked, areas):
        at = dict(zip(fit.stages, found))
        for i in members:
            value = at[_trees_of(drawn[i])]
            if not np.isnan(value):  # a fold of one class says nothing
                sums[fit.part, i] += value, 1
    means = np.divide(sums[..., 0], sums[..., 1], out=np.full(sums.shape[:2], np.nan), where=sums[..., 1] > 0)
    best = [int(np.nan_to_num(m, nan=-1.0).argmax()) for m in means]
    last = [Fit(p, -1, drawn[b], ()) for p, b in enumerate(best)]
    _, models = _run(spark, samples, last, features, seed)
    _done(samples)
    return {k: (models[p], drawn[best[p]], float(means[p, best[p]]), means[p].tolist()) for p, k in enumerate(keys) if models[p]}


def random_search(
    train: DataFrame, features: Sequence[str], key: Sequence[str], label: str = "label",
    grid: Mapping[str, Sequence] = GRID_LARGE, draws: int = SEARCH_DRAWS, folds: int = SEARCH_FOLDS, most_rows: int = MOST_ROWS,
) -> tuple[Model, dict, float]:
    """Best model by cross-validated AUC of the scores, its parameters and its mean AUC, on all rows.

    Folds are hashed from the key, so a rerun sees the same folds. See ``boosting`` for what the fits share, and ``spread`` for
    the fits of more than ``most_rows`` rows.
    """
    samples = _samples(train, features, key, label, folds, most_rows)
    found = search_samples(train.sparkSession, samples, features, grid, draws, folds)
    if not found:
        raise ValueError("the training rows need both labels")
    return found[0][:3]


def search_table(
    train: DataFrame, features: Sequence[str], key: Sequence[str], label: str = "label",
    grid: Mapping[str, Sequence] = GRID_LARGE, draws: int = SEARCH_DRAWS, folds: int = SEARCH_FOLDS, most_rows: int = MOST_ROWS,
) -> DataFrame:
    """Every draw of the search on all rows: its number, its parameters and its mean AUC over the folds (null if no fold has both labels)."""
    samples = _samples(train, features, key, label, folds, most_rows)
    found = search_samples(train.sparkSession, samples, features, grid, draws, folds)
    means = found[0][3] if found else [None] * draws
    drawn = [{k: float(v) for k, v in params.items()} for params in draw_params(grid, draws)]
    rows = [(i, *p.values(), None if m is None or np.isnan(m) else m) for i, (p, m) in enumerate(zip(drawn, means))]
    return train.sparkSession.createDataFrame(rows, f"draw int, {', '.join(f'{k} double' for k in grid)}, auc_cv double")


def fit_trees(
    train: DataFrame, features: Sequence[str], key: Sequence[str], label: str = "label", most_rows: int = MOST_ROWS, **params,
) -> Model:
    """One model with the given parameters, the others by default, on all rows; see ``_samples`` for ``most_rows``."""
    samples = _samples(train, features, key, label, 0, most_rows)
    model = _run(train.sparkSession, samples, [Fit(0, -1, params, ())] if samples else [], features, SPLIT_SEED)[1]
    _done(samples)
    if not model or not model[0]:
        raise ValueError("the training rows need both labels")
    return model[0]


def compiled(model: Model | PipelineModel, rows: DataFrame) -> Model:
    """The trees of either kind of model."""
    return of_pipeline(model, rows) if isinstance(model, PipelineModel) else model


def score(features: DataFrame, model: Model | PipelineModel, model_name: str) -> DataFrame:
    """Probability of the bad label per customer and snapshot, tagged with the model, by column expressions."""
    return with_probability(features, compiled(model, features), "model_predictions").select(
        "Customer_ID", SNAPSHOT, F.lit(model_name).alias("model_name"), "model_predictions")


def split_auc(model: Model | PipelineModel, rows: DataFrame, label: str = "label") -> DataFrame:
    """AUC and Gini of a model on each split of the rows."""
    scored = with_probability(rows, compiled(model, rows), "model_predictions").select("split", label, "model_predictions")
    scored = cut_lineage(scored, "scored-rows")  # the area reads the scores several times
    return auc(scored, label, "model_predictions", ["split"]).withColumn("gini", gini(F.col("auc")))


PARTS = ("train", "test", "oot")


def train_model(
    rows: DataFrame, features: Sequence[str], key: Sequence[str], label: str = "label", snapshot: str | None = None, **search,
) -> tuple[Model, DataFrame]:
    """Fit on the train split by random search; returns the model and its one-row record, dated by the last snapshot of the
    rows unless ``snapshot`` says otherwise.

    ``rows`` carry ``split`` and are read a few times: stage them if they are costly.
    """
    snapshot = snapshot or str(rows.agg(F.max(SNAPSHOT)).first()[0])
    model, params, cv_auc = random_search(rows.where(F.col("split") == "train"), features, key, label, **search)
    areas = {r["split"]: r for r in split_auc(model, rows, label).collect()}  # three rows at most
    stats = {r["split"]: r for r in split_stats(rows, label).collect()}
    record: dict[str, object] = {
        "snapshot_date": snapshot, "model_version": "credit_model_" + snapshot.replace("-", "_"),
        "hp_params": {k: str(v) for k, v in params.items()}, "auc_cv": cv_auc}
    for part in PARTS:
        at, stat = areas.get(part), stats.get(part)
        record |= {
            f"auc_{part}": at and at["auc"], f"gini_{part}": at and at["gini"],
            f"n_{part}": stat["n"] if stat else 0, f"bad_share_{part}": stat and stat["bad_share"]}
    parts = ", ".join(f"auc_{p} double, gini_{p} double, n_{p} long, bad_share_{p} double" for p in PARTS)
    schema = f"snapshot_date string, model_version string, hp_params map<string,string>, auc_cv double, {parts}"
    row = rows.sparkSession.createDataFrame([record], schema)
    return model, row.withColumn(SNAPSHOT, F.col(SNAPSHOT).cast("date"))


AS_OF = "as_of"


def rows_as_of(rows: DataFrame, key: Sequence[str], label: str = "label") -> DataFrame:
    """Each row once for its own snapshot and every later one, as ``as_of``, with its ``split`` there.

    The snapshots are those of the rows. At its own snapshot a row is out of time, at a later one train or test.
    """
    known = rows.select(F.col(SNAPSHOT).alias(AS_OF)).distinct()
    last = known.agg(F.max(AS_OF).alias("last"))
    dated = rows.crossJoin(F.broadcast(last)).withColumn(  # exactly one row
        AS_OF, F.explode(F.sequence(SNAPSHOT, "last", F.expr("INTERVAL 1 MONTH")))).drop("last")
    dated = dated.join(known, AS_OF)
    early, late = F.col(SNAPSHOT) < F.col(AS_OF), F.col(SNAPSHOT) == F.col(AS_OF)
    return train_test_split(dated.where(early), key, label=label, by=[AS_OF]).unionByName(
        dated.where(late).withColumn("split", F.lit("oot")))


def score_as_of(rows: DataFrame, models: Mapping[object, Model], features: Sequence[str], name: str = "probability") -> DataFrame:
    """Adds the probability by the model of each row's ``as_of``; null where there is none. The models are sent to the tasks:
    their size is bounded by the search's parameters."""
    models, features = dict(models), list(features)
    schema = T.StructType([*rows.schema.fields, T.StructField(name, T.DoubleType())])
    wide = rows.withColumn("_x", F.array(*[F.col(f).cast("double") for f in features]))

    def run(batches):
        for batch in batches:
            at = batch[AS_OF].to_pylist()
            x = batch["_x"].flatten().to_numpy(zero_copy_only=False).reshape(len(at), len(features)).astype(float)
            out = np.full(len(at), np.nan)
            for day in set(at) & set(models):
                own = np.array([d == day for d in at])
                out[own] = models[day].walk(x[own])
            columns = [batch[c] for c in batch.schema.names if c != "_x"]
            fields = [batch.schema.field(c) for c in batch.schema.names if c != "_x"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(out, from_pandas=True)], schema=pa.schema([*fields, pa.field(name, pa.float64())]))

    return wide.mapInArrow(run, schema)


def performance_ceiling(
    rows: DataFrame, features: Sequence[str], key: Sequence[str], label: str = "label", grid: Mapping[str, Sequence] = GRID_LARGE,
    draws: int = SEARCH_DRAWS, folds: int = SEARCH_FOLDS, most_rows: int = MOST_ROWS,
) -> DataFrame:
    """Search anew at every snapshot of the rows on the history up to it: the best AUC there is to be had, month by month.

    All months' fits are dealt over the cluster as one job, each on all rows of its month's history (see ``_samples`` for
    ``most_rows``, which is over all months together). A month without both labels before it has null areas.
    """
    needed = dict.fromkeys([*key, SNAPSHOT, label, *features])
    dated = cut_lineage(rows_as_of(cut_lineage(rows.select(*needed), "training-rows"), key, label), "rows-as-of")
    samples = _samples(dated.where(F.col("split") == "train"), features, key, label, folds, most_rows, AS_OF)
    found = search_samples(rows.sparkSession, samples, features, grid, draws, folds)
    scored = cut_lineage(score_as_of(dated, {k: v[0] for k, v in found.items()}, features, "_p").select(AS_OF, "split", label, "_p"), "scored-rows")
    areas = auc(scored, label, "_p", [AS_OF, "split"])
    wide = areas.groupBy(AS_OF).agg(*[F.max(F.when(F.col("split") == p, F.col("auc"))).alias(f"auc_{p}") for p in PARTS])
    months = dated.select(F.col(AS_OF).alias(SNAPSHOT)).distinct()
    return months.join(wide.withColumnRenamed(AS_OF, SNAPSHOT), SNAPSHOT, "left").orderBy(SNAPSHOT)
