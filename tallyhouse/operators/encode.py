"""Category encoders, and a standard scaler.

An index takes any number of categories. Where categories become columns, their vocabulary is bounded by
``MOST_LABELS``, above which fitting is an error. A vocabulary is fitted once and passed on, so that all snapshots share the same columns.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyhouse.functions.cleaning import column_label
from tallyhouse.session import cut_lineage

MOST_LABELS = 1_000


def category_counts(df: DataFrame, col: str) -> DataFrame:
    """Rows per category, most frequent first, ties by name; null is no category."""
    return (
        df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), col))


def elements(df: DataFrame, col: str) -> DataFrame:
    """Distinct elements of an array column."""
    return df.select(F.explode(col).alias("element")).distinct()


def _bounded(labels: DataFrame, most: int) -> list[str]:
    """First column of a small frame; more than ``most`` rows are an error, not a cut."""
    found = [row[0] for row in labels.limit(most + 1).collect()]
    if len(found) > most:
        raise ValueError(f"more than {most} categories: encode this column another way")
    return found


def vocabulary(df: DataFrame, col: str, most: int = MOST_LABELS) -> list[str]:
    """Categories by descending frequency, ties by name."""
    return _bounded(category_counts(df, col).select(col), most)


def vocabularies(df: DataFrame, cols: Sequence[str], array_cols: Sequence[str] = (), most: int = MOST_LABELS) -> dict[str, list[str]]:
    """Vocabularies of several columns by one aggregate: categories by descending frequency and name, elements by name."""
    labels = [f"array(struct('{c}' AS of, CAST(`{c}` AS STRING) AS label))" for c in cols]
    labels += [f"transform(coalesce(`{c}`, array()), e -> struct('{c}' AS of, CAST(e AS STRING) AS label))" for c in array_cols]
    found: dict[str, list] = {c: [] for c in (*cols, *array_cols)}
    if not found:
        return {}
    counts = df.select(F.expr(f"explode(concat({', '.join(labels)}))").alias("pair")).select("pair.*").where("label IS NOT NULL").groupBy("of", "label").agg(F.count(F.lit(1)).alias("n"))
    rows = counts.limit(len(found) * most + 1).collect()
    for r in rows:
        found[r["of"]].append(r)
    if len(rows) > len(found) * most or max(map(len, found.values())) > most:
        raise ValueError(f"more than {most} categories: encode this column another way")
    return {c: [r["label"] for r in sorted(rs, key=lambda r: (0 if c in array_cols else -r["n"], r["label"]))] for c, rs in found.items()}


def element_vocabulary(df: DataFrame, col: str, most: int = MOST_LABELS) -> list[str]:
    """Distinct elements of an array column by name."""
    return _bounded(elements(df, col).orderBy("element"), most)


CELL_LABELS = 1 << 20  # categories that one task ranks, about


def label_index(df: DataFrame, col: str, cell_labels: int = CELL_LABELS) -> DataFrame:
    """Every category of a column with its index by descending frequency, ties by name: ``col``, ``label_index``.

    Categories are dealt into ranges of (frequency, name) of about ``cell_labels`` each and written with their range; the index
    is the size of the ranges before plus the place within the range. So no task ranks all categories of one frequency, and
    the driver holds none. It runs as this is called.
    """
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    counts = cut_lineage(counts, "label-counts")
    cells = max(1, -(-counts.count() // cell_labels))
    dealt = counts.repartitionByRange(cells, F.desc("n"), F.col(col)) if cells > 1 else counts.coalesce(1)
    dealt = cut_lineage(dealt.withColumn("cell", F.spark_partition_id()), "label-cells")  # the ranges are drawn once
    sizes = dealt.groupBy("cell").agg(F.count(F.lit(1)).alias("size"))  # a row a range
    before = F.coalesce(F.sum("size").over(Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    place = F.row_number().over(Window.partitionBy("cell").orderBy(F.desc("n"), col)) - 1
    sizes = F.broadcast(sizes.withColumn("before", before))
    return dealt.withColumn("place", place).join(sizes, "cell").select(
        col, (F.col("before") + F.col("place")).cast("int").alias("label_index"))


def index_strings(df: DataFrame, col: str, name: str, fitted: DataFrame | None = None) -> DataFrame:
    """Adds the index of each category under ``name``; unseen and null values share the next index.

    ``fitted`` is a ``label_index`` of the training rows, by default of ``df`` itself, of any number of categories.
    """
    fitted = label_index(df, col) if fitted is None else fitted
    size = fitted.agg(F.count(F.lit(1)).cast("int").alias("labels"))
    joined = df.join(fitted, col, "left").crossJoin(F.broadcast(size))  # exactly one row
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], F.coalesce("label_index", "labels").alias(name))


def one_hot(c: Column, name: str, vocab: Sequence[str]) -> dict[str, Column]:
    """One 0/1 column per category but the first, named after the category it flags."""
    return {f"{name}_{column_label(v)}": F.coalesce((c == v).cast("int"), F.lit(0)) for v in vocab[1:]}


def multi_hot(c: Column, vocab: Sequence[str], left_out: Sequence[str] = ("not specified",)) -> dict[str, Column]:
    """One 0/1 column per element of an array column."""
    return {column_label(v): F.array_contains(c, v).cast("int") for v in vocab if v not in left_out}


def encode_categories(
    df: DataFrame, vocabs: Mapping[str, Sequence[str]], array_vocabs: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Replace category and array columns by their 0/1 columns, all in one projection."""
    flags: dict[str, Column] = {}
    for col, vocab in vocabs.items():
        flags |= one_hot(F.col(col), col, vocab)
    for col, vocab in (array_vocabs or {}).items():
        flags |= multi_hot(F.col(col), vocab)
    return df.withColumns(flags).drop(*vocabs, *(array_vocabs or {}))


def scaler(train: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Mean and population deviation of each column in one row, ``mean_<c>`` and ``std_<c>``."""
    return train.agg(*[f for c in cols for f in (
        F.avg(c).alias(f"mean_{c}"), F.stddev_pop(c).alias(f"std_{c}"))])


def scale(df: DataFrame, fitted: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Columns centred and divided by the fitted deviation (by 1 where that is 0)."""
    joined = df.crossJoin(F.broadcast(fitted))  # exactly one row
    return joined.select(*[
        F.try_divide(
            F.col(c) - F.col(f"mean_{c}"),
            F.when(F.col(f"std_{c}") == 0, 1.0).otherwise(F.col(f"std_{c}"))).alias(c)
        if c in cols else F.col(f"`{c}`") for c in df.columns])
