"""Exact order statistics of groups of any size."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quantpanel.functions.storage import materialise
from quantpanel.operators.ranks import WINDOW_ROWS, largest_group, rank_in_group


def group_median(
    df: DataFrame, keys: list[str], value: str, name: str = "median", window_rows: int = WINDOW_ROWS
) -> DataFrame:
    """Exact median per key, nulls skipped.

    The built-in median keeps all distinct values of a group in one task, so it is used only
    for groups of checked size; larger ones take the middle ranks of a distributed sort.
    """
    rows = df.select(*keys, value).filter(F.col(value).isNotNull())
    size = largest_group(rows, keys)
    if size <= window_rows:
        return rows.groupBy(*keys).agg(F.median(value).alias(name))
    # Equal values need no tie-break: any of them is the right one.
    ranked = rank_in_group(
        rows.withColumn("_tie", F.monotonically_increasing_id()),
        keys, [F.col(value), "_tie"], "_r", group_rows=size, window_rows=window_rows,
    )
    counts = rows.groupBy(*keys).agg(F.count("*").alias("_n"))
    middle = ranked.join(counts, keys).filter(
        (F.col("_r") >= F.floor((F.col("_n") - 1) / 2)) & (F.col("_r") <= F.floor(F.col("_n") / 2))
    )
    return middle.groupBy(*keys).agg(F.avg(value).alias(name))


@dataclass(frozen=True)
class ColumnSummary:
    """Count, mean and population deviation of a column's values, and their exact median."""

    count: int
    mean: float
    std: float
    median: float


def column_summaries(
    df: DataFrame, columns: list[str], accuracy: int = 10_000, window_rows: int = WINDOW_ROWS
) -> dict[str, ColumnSummary]:
    """Exact medians by selection, with the moments of the first scan; nulls and NaN are skipped.

    A scan with approximate quantiles brackets the middle ranks of every column. The next one counts the
    values below each bracket and keeps only those inside, of which the middle one is selected; a bracket
    of more than `window_rows` distinct values is narrowed again. Rows are never turned into one
    row per column. A column without values has zeros.
    """
    values = {c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in columns}
    low, high = dict.fromkeys(columns, -math.inf), dict.fromkeys(columns, math.inf)
    below, inside, medians, moments = {}, {}, {}, {}
    open_columns, whole = list(columns), set()
    while open_columns:
        row = df.agg(*_bracket_columns(open_columns, values, low, high, below, inside, accuracy)).first()
        for c in open_columns:
            if c not in moments:
                moments[c] = row[f"n_{c}"], row[f"m_{c}"] or 0.0, row[f"s_{c}"] or 0.0
            if row[f"q_{c}"] is not None and c not in whole:
                low[c], high[c] = row[f"q_{c}"]
        open_columns = [c for c in open_columns if moments[c][0] > 0]
        if not open_columns:
            break
        kept = materialise(_inside(df.select(*(values[c].alias(c) for c in open_columns)), open_columns, low, high))
        sums = kept.groupBy("column").agg(
            F.sum(F.when(F.col("value").isNull(), F.col("n"))).alias("below"),
            F.sum(F.when(F.col("value").isNotNull(), F.col("n"))).alias("inside"),
            F.count("value").alias("distinct"),
        )
        sized = {open_columns[r["column"]]: r for r in sums.collect()}  # one row per column
        ready = {}
        for c in open_columns:
            n = moments[c][0]
            below[c], inside[c] = sized[c]["below"] or 0, sized[c]["inside"] or 0
            middle = (n - 1) // 2, n // 2
            if below[c] > middle[0] or below[c] + inside[c] <= middle[1]:
                # outside of what the sketch promises: take all values
                low[c], high[c], below[c], inside[c] = -math.inf, math.inf, 0, n
                whole.add(c)
            elif sized[c]["distinct"] <= window_rows or c in whole:
                ready[c] = [k - below[c] for k in middle]
        medians |= _selected(kept, open_columns, ready)
        open_columns = [c for c in open_columns if c not in ready]
    return {c: ColumnSummary(*moments[c], medians.get(c, 0.0)) for c in columns}


def _bracket_columns(names, values, low, high, below, inside, accuracy):
    """Moments of the columns and approximate quantiles around their middle ranks."""
    slack = 2 / accuracy
    for c in names:
        x, share = values[c], 0.5
        if c in inside:
            n = below[c] + inside[c]
            share = min(max((n / 2 - below[c]) / max(inside[c], 1), 0.0), 1.0)
            x = F.when((x >= low[c]) & (x <= high[c]), x)
        yield F.percentile_approx(x, [max(share - slack, 0.0), min(share + slack, 1.0)], accuracy).alias(f"q_{c}")
        yield F.count(x).alias(f"n_{c}")
        yield F.avg(x).alias(f"m_{c}")
        yield F.stddev_pop(x).alias(f"s_{c}")


def _inside(rows: DataFrame, names: list[str], low: dict, high: dict) -> DataFrame:
    """``column, value, n``: values of each bracket with their counts; a null value counts those below it."""
    bounds = [(low[c], high[c]) for c in names]

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        smaller = [0] * len(bounds)
        for batch in batches:
            for i, (least, most) in enumerate(bounds):
                x = batch.column(i).drop_null().to_numpy(zero_copy_only=False)
                smaller[i] += int((x < least).sum())
                found, counts = np.unique(x[(x >= least) & (x <= most)], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([i] * len(found), "int32"), pa.array(found, "float64"), pa.array(counts, "int64")], ["column", "value", "n"])
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(bounds)), "int32"), pa.nulls(len(bounds), "float64"), pa.array(smaller, "int64")], ["column", "value", "n"]
        )

    found = rows.mapInArrow(keep, "column int, value double, n long")
    return found.groupBy("column", "value").agg(F.sum("n").alias("n"))


def _selected(kept: DataFrame, names: list[str], ranks: dict[str, list[int]]) -> dict[str, float]:
    """The mean of the values at two ranks within the bracket, per column."""
    if not ranks:
        return {}
    wanted = F.create_map(*(F.lit(x) for c, at in ranks.items() for x in (names.index(c), at)))
    upto = F.sum("n").over(Window.partitionBy("column").orderBy("value"))
    at = F.col("at")
    middle = (
        kept.where(F.col("value").isNotNull() & F.col("column").isin([names.index(c) for c in ranks]))
        .select("column", "value", "n", upto.alias("upto"), F.try_element_at(wanted, "column").alias("at"))
        .withColumn("hits", F.size(F.filter(at, lambda k: (k < F.col("upto")) & (k >= F.col("upto") - F.col("n")))))
        .where("hits > 0")
        .groupBy("column")
        .agg((F.sum(F.col("value") * F.col("hits")) / F.sum("hits")).alias("median"))
    )
    return {names[r["column"]]: r["median"] for r in middle.collect()}


def column_medians(df: DataFrame, columns: list[str], **kwargs) -> dict[str, float]:
    """Exact median of each column; 0 where a column has no values. See `column_summaries`."""
    return {c: s.median for c, s in column_summaries(df, columns, **kwargs).items()}
