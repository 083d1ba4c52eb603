"""Statistics of trailing windows of many rows, computed next to the sorted rows.

A sliding frame of Spark reads its whole window again for every row and every statistic. Here the
sorted rows pass through Arrow batches and each statistic is a few array operations per batch. A batch
is given the last rows of the one before it, so memory does not depend on the length of a ticker.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, StructType

from quantpanel.functions.columns import by_ticker

Wanted = tuple[str, int, str] | tuple[str, int, str, str]  # kind, rows, column (two for `cov`)


def rolled_name(kind: str, rows: int, *columns: str) -> str:
    return "_".join(["", kind, str(rows), *columns])


def rolled(kind: str, rows: int, *columns: str) -> Column:
    """The column that `rolling` adds for a statistic."""
    return F.col(rolled_name(kind, rows, *columns))


def _steps(x: np.ndarray, rows: int) -> Iterator[np.ndarray]:
    """The first, second, ... value of every window."""
    n = len(x) - rows + 1
    return (x[k : k + n] for k in range(rows))


def _deviations(x: np.ndarray, rows: int) -> Iterator[np.ndarray]:
    """Deviations from the window's mean; exactly 0 where the window holds one value only."""
    first = x[: len(x) - rows + 1]
    mean = sum(step - first for step in _steps(x, rows)) / rows
    return (step - first - mean for step in _steps(x, rows))


def _mean(rows: int, x: np.ndarray) -> np.ndarray:
    return sum(_steps(x, rows)) / rows


def _max(rows: int, x: np.ndarray) -> np.ndarray:
    out = x[: len(x) - rows + 1].copy()
    for step in _steps(x, rows):
        np.maximum(out, step, out=out)
    return out


def _var(rows: int, x: np.ndarray) -> np.ndarray:
    return sum(d * d for d in _deviations(x, rows)) / (rows - 1)


def _std(rows: int, x: np.ndarray) -> np.ndarray:
    return np.sqrt(_var(rows, x))


def _cov(rows: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return sum(a * b for a, b in zip(_deviations(x, rows), _deviations(y, rows))) / (rows - 1)


KINDS = {"mean": _mean, "max": _max, "var": _var, "std": _std, "cov": _cov}


def rolling(panel: DataFrame, wanted: list[Wanted]) -> DataFrame:
    """Add a double column per statistic (sample moments), named by `rolled_name`.

    A statistic covers the ticker's last `rows` rows up to the row itself; it is null unless all their
    values are known. Rows of a ticker are ordered by date.
    """
    inputs = sorted({c for _, _, *columns in wanted for c in columns})
    longest = max(rows for _, rows, *_ in wanted)
    names = [rolled_name(*w) for w in wanted]
    target = StructType(list(panel.schema.fields))
    for name in names:
        target = target.add(name, DoubleType())
    schema = to_arrow_schema(target)
    kept = panel.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values = {c: np.zeros(longest - 1) for c in inputs}
        known = {c: np.zeros(longest - 1, bool) for c in inputs}
        for batch in batches:
            if batch.num_rows == 0:
                continue
            number = batch.column("_number").to_numpy()
            for c in inputs:
                column = batch.column(c).cast("float64")
                values[c] = np.concatenate([values[c], column.fill_null(0.0).to_numpy(zero_copy_only=False)])
                known[c] = np.concatenate([known[c], column.is_valid().to_numpy(zero_copy_only=False)])
            counts = {c: np.concatenate([[0], np.cumsum(known[c])]) for c in inputs}
            out = []
            with np.errstate(all="ignore"):
                for kind, rows, *columns in wanted:
                    skip = longest - rows  # values before the first row's window
                    result = KINDS[kind](rows, *(values[c][skip:] for c in columns))
                    full = number >= rows
                    for c in columns:
                        full &= (counts[c][rows:] - counts[c][:-rows])[skip:] == rows
                    out.append(pa.array(result, mask=~full))
            arrays = [batch.column(c) for c in kept] + out
            yield pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(arrays, schema)], schema=schema)
            for c in inputs:
                values[c], known[c] = (x[c][len(x[c]) - longest + 1 :] for x in (values, known))

    # The window sorts each ticker's rows in one partition; the second sort is already met by it.
    numbered = panel.withColumn("_number", F.row_number().over(by_ticker()))
    return numbered.sortWithinPartitions("ticker", "date").mapInArrow(run, target)
