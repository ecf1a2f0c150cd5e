"""Fills along the history of a key, medians, constants and null counts.

The history of a key is first put together to one row per snapshot, with map-side combining, so a key that
holds a third of all rows costs each task one row per snapshot. The windows run over those short histories,
and what they found is joined back to the rows by key and snapshot, an equi-join that adaptive execution
splits where a key is hot. There is one path for all sizes.

Rows of one key and snapshot are peers: a gap takes a peer's value first, the largest one (the smallest
one when filling backward), so that no result hangs on the order in which rows arrive.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DateType, DecimalType, FractionalType

from tallyhouse.functions.schema import numeric_columns
from tallyhouse.operators.ranks import MOST_TARGETS, lower_medians

FORWARD, BACKWARD, BOTH, LATEST, EARLIEST = "forward", "backward", "both", "latest", "earliest"


def _name(c: str) -> str:
    return f"`{c}`"


def _along(kind: str, low: str, high: str, by: Sequence[str], order: str) -> str:
    """SQL of the value seen from a snapshot of a key's history; ``low`` and ``high`` bound it among peers.

    Looking ahead runs over the descending order, so every frame only grows.
    """
    key, at = ", ".join(map(_name, by)), _name(order)
    upward, downward = (f"PARTITION BY {key} ORDER BY {at} {way} ROWS UNBOUNDED PRECEDING" for way in ("ASC", "DESC"))
    forms = {
        FORWARD: f"last_value({high}) IGNORE NULLS OVER ({upward})",
        BACKWARD: f"last_value({low}) IGNORE NULLS OVER ({downward})",
        LATEST: f"first_value({high}) IGNORE NULLS OVER ({downward})",
        EARLIEST: f"first_value({low}) IGNORE NULLS OVER (PARTITION BY {key} ORDER BY {at} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)",
    }
    return f"coalesce({forms[FORWARD]}, {forms[BACKWARD]})" if kind == BOTH else forms[kind]


def fill_history(df: DataFrame, fills: Mapping[str, str], by: Sequence[str], order: str) -> DataFrame:
    """Fill gaps of several columns along the history of each key, in one pass.

    ``fills`` maps a column to its direction: ``forward`` (latest value up to the row), ``backward``
    (next value from the row on; sees the future), ``both`` (forward, then backward), ``latest`` (the
    newest value of the key, if it is not older than the row) or ``earliest`` (the oldest value of the
    key, which also replaces values that are present). ``df`` is read twice; stage it if it is costly.
    """
    unknown = set(fills.values()) - {FORWARD, BACKWARD, BOTH, LATEST, EARLIEST}
    if unknown:
        raise ValueError(f"unknown fill {', '.join(sorted(unknown))}")
    if not isinstance(df.schema[order].dataType, DateType):
        raise ValueError(f"{order} must be a date: the history of a key is kept short by it")
    known = _history(df, fills, by, order)
    same = " AND ".join(f"{_name(k)} <=> {_name('known_' + k)}" for k in [*by, order])

    def filled(c: str) -> str:
        value = _name(c)
        if c not in fills:
            return value
        return f"{f'known.{value}' if fills[c] == EARLIEST else f'coalesce({value}, known.{value})'} AS {value}"

    return df.join(known, F.expr(same), "left").selectExpr(*map(filled, df.columns))


def _history(rows: DataFrame, fills: Mapping[str, str], by: Sequence[str], order: str) -> DataFrame:
    """Filled history of the given rows, one row per (key, snapshot), as ``known_<key>`` and a struct."""
    sides = {FORWARD: "high", LATEST: "high", BACKWARD: "low", EARLIEST: "low", BOTH: "low high"}
    bounds = [f(_name(c)).alias(f"{side}_{c}") for c, kind in fills.items() for side, f in (("low", F.min), ("high", F.max)) if side in sides[kind]]
    seen = ", ".join(
        f"{_along(kind, _name('low_' + c), _name('high_' + c), by, order)} AS {_name(c)}"
        for c, kind in fills.items())
    return rows.groupBy(*by, order).agg(*bounds).selectExpr(
        *[f"{_name(k)} AS {_name('known_' + k)}" for k in [*by, order]], f"struct({seen}) AS known")


def ffill(df: DataFrame, cols: Sequence[str], by: Sequence[str], order: str) -> DataFrame:
    """Forward fill per key in snapshot order."""
    return fill_history(df, {c: FORWARD for c in cols}, by, order)


def last_known(rows: DataFrame, cols: Sequence[str], by: Sequence[str], order: str, state: DataFrame | None = None) -> DataFrame:
    """State of a forward fill: per key the last known value of each column, as a struct of its snapshot and the value.

    ``state`` is the one before ``rows`` came; together they give the one after, by one aggregate that is combined map-side,
    so that neither a long history nor a hot key is read or held again.
    """
    at = F.col(_name(order))
    seen = rows.select(*map(_name, by), *[
        F.when(F.col(_name(c)).isNotNull(), F.struct(at.alias("at"), F.col(_name(c)).alias("value"))).alias(c) for c in cols])
    every = seen if state is None else state.select(*seen.columns).unionByName(seen)
    return every.groupBy(*map(_name, by)).agg(*[F.max(_name(c)).alias(c) for c in cols])


def ffill_from(state: DataFrame, rows: DataFrame, cols: Sequence[str], by: Sequence[str], order: str) -> DataFrame:
    """``ffill`` of new snapshots that reads them and the state before them only, not the history.

    The rows are later than what the state has seen. A key without a state starts with its own rows. The join of rows with their
    key's state is a left one without a hint, which adaptive execution splits where a key is hot.
    """
    own = ffill(rows, cols, by, order)
    before = state.select(*[F.col(_name(k)).alias(f"known_{k}") for k in by], F.struct(*map(_name, cols)).alias("known"))
    same = " AND ".join(f"{_name(k)} <=> {_name('known_' + k)}" for k in by)
    filled = [f"coalesce({_name(c)}, known.{_name(c)}.value) AS {_name(c)}" if c in cols else _name(c) for c in rows.columns]
    return own.join(before, F.expr(same), "left").selectExpr(*filled)


def ffill_bfill(
    df: DataFrame, cols: Sequence[str], by: Sequence[str], order: str, backward: bool = True,
) -> DataFrame:
    """Forward fill, then backward fill. ``backward=False`` keeps later snapshots out of earlier rows."""
    return fill_history(df, {c: BOTH if backward else FORWARD for c in cols}, by, order)


def fill_latest(
    df: DataFrame, col: str, by: Sequence[str], order: str, default: str = "Unknown",
) -> DataFrame:
    """Gaps take the key's newest value that is not older than the row, else ``default``."""
    return fill_history(df, {col: LATEST}, by, order).na.fill({col: default})


def fill_from_group(df: DataFrame, col: str, by: Sequence[str], order: str) -> DataFrame:
    """Every row takes the key's oldest known value; keys without any take the median over all rows."""
    return fill_median(fill_history(df, {col: EARLIEST}, by, order), [col])


def latest_per_key(df: DataFrame, by: Sequence[str], order: str) -> DataFrame:
    """The newest row of each key, by a partial aggregate instead of a sort; ties by the largest row."""
    rest = [c for c in df.columns if c not in (*by, order)]
    newest = df.groupBy(*by).agg(F.max(F.struct(order, *rest)).alias("newest"))
    return newest.select(*[F.col(c) if c in by else F.col("newest")[c].alias(c) for c in df.columns])


def _medians(df: DataFrame, cols: Sequence[str], by: Sequence[str]) -> tuple[DataFrame, int]:
    """Medians, one row per group, and a bound on their number."""
    found = lower_medians(df, cols, by)
    return found.values.groupBy(*by).agg(*[
        F.max(F.when(F.col("feature") == c, F.col("value"))).cast(df.schema[c].dataType).alias(f"median_{c}")
        for c in cols]), found.targets


def medians(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Exact medians (the lower one of two middle values) named ``median_<column>``, one row per group.

    ``df`` is read as this is called, and once more as the result is; stage it if it is costly.
    """
    return _medians(df, cols, by)[0]


def approximate_medians(
    df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), accuracy: int = 10_000,
) -> DataFrame:
    """As ``medians``, by sketches: cheaper, with a rank error of up to 1/``accuracy`` of the rows of a group.

    No table of this package uses it; where a group has more than ``accuracy`` rows its results differ from run to run.
    """
    return df.groupBy(*by).agg(
        *[F.percentile_approx(c, 0.5, accuracy).alias(f"median_{c}") for c in cols])


def fill_median(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Gaps take the exact median of the column, over all rows or within ``by``, in the column's own type.

    ``df`` is read three times, twice of them as this is called; stage it if it is costly.
    """
    middle, groups = _medians(df, cols, by)
    if by:
        middle = middle.select(
            *[F.col(k).alias(f"at_{k}") for k in by], *[f"median_{c}" for c in cols])
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"at_{k}")) for k in by])
        joined = df.join(F.broadcast(middle) if groups <= MOST_TARGETS else middle, same, "left")
    else:
        joined = df.crossJoin(F.broadcast(middle))  # exactly one row
    return joined.select(*[
        F.coalesce(F.col(c), F.col(f"median_{c}")).alias(c) if c in cols else F.col(f"`{c}`")
        for c in df.columns])


def fill_const(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Gaps take a constant per column."""
    return df.na.fill(dict(values))


def fill_zero(df: DataFrame) -> DataFrame:
    """Every null number of the frame becomes 0."""
    return df.na.fill(0, subset=numeric_columns(df))


def null_counts(df: DataFrame) -> DataFrame:
    """One row with the number of nulls per column."""
    return df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])


def complete_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Rows without any null or NaN.

    Written out per column, so that the optimizer can push the tests below a join and make a left join inner.
    """
    wanted = [f for f in df.schema.fields if cols is None or f.name in cols]
    tests = [F.col(f"`{f.name}`").isNotNull() for f in wanted]
    tests += [~F.isnan(f"`{f.name}`") for f in wanted if isinstance(f.dataType, FractionalType)
              and not isinstance(f.dataType, DecimalType)]
    return df.where(reduce(lambda a, b: a & b, tests)) if tests else df
