"""Train / validation / test intervals with purge gaps, static and walk-forward.

Interval arithmetic runs on the trading calendar (one row per day), rows of a panel are then
tagged through an equality join on the date.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quantpanel.config import TRADING_DAYS_PER_YEAR, SplitConfig
from quantpanel.operators.grid import day_table

FOLD_PATTERN = r"^(walkforward_\d+)_(.*)$"


def _interval(name: Column, start: Column, end: Column, purge: int) -> Column:
    last = F.col("n") - 1
    return F.struct(
        name.alias("split_name"),
        start.alias("start_idx"),
        end.alias("end_idx"),
        F.least(end + purge, last).alias("purge_end_idx"),
    )


def _with_dates(intervals: DataFrame, calendar: DataFrame) -> DataFrame:
    days = calendar.select("day_idx", "date")
    out = intervals
    for index, name in (
        ("start_idx", "start_date"), ("end_idx", "end_date"), ("purge_end_idx", "purge_end")
    ):
        out = out.join(days.select(F.col("day_idx").alias(index), F.col("date").alias(name)), index)
    return out.select(
        "split_name", "start_date", "end_date", F.col("end_date").alias("purge_start"), "purge_end"
    )


def static_splits(
    calendar: DataFrame, cfg: SplitConfig = SplitConfig(), drop_inverted: bool = True
) -> DataFrame:
    """Intervals by calendar position; splits that the purge pushes off the end are left out.

    A purge longer than the validation part inverts it (start after end); such a split is
    dropped unless asked for.
    """
    n = F.col("n").cast("double")
    base = calendar.agg(F.count("*").cast("int").alias("n"))
    base = base.withColumn("te", F.floor(n * cfg.train_frac).cast("int") - 1)
    base = base.withColumn(
        "ve", F.least(F.col("te") + F.floor(n * cfg.val_frac).cast("int"), F.col("n") - 1)
    )
    base = base.withColumn("vs", F.col("te") + cfg.purge_days + 1)
    base = base.withColumn("ts", F.col("ve") + cfg.purge_days + 1)
    val_ok = F.col("vs") < F.col("n")
    test_ok = val_ok & (F.col("ts") < F.col("n"))
    last = F.col("n") - 1
    parts = F.array(
        _interval(F.lit("train"), F.lit(0), F.col("te"), cfg.purge_days),
        F.when(val_ok, _interval(F.lit("val"), F.col("vs"), F.col("ve"), cfg.purge_days)),
        F.when(test_ok, _interval(F.lit("test"), F.col("ts"), last, cfg.purge_days)),
    )
    rows = base.select(F.explode(F.array_compact(parts)).alias("s")).select("s.*")
    if drop_inverted:
        rows = rows.filter(F.col("start_idx") <= F.col("end_idx"))
    return _with_dates(rows, calendar)


def inverted_splits(calendar: DataFrame, cfg: SplitConfig = SplitConfig()) -> DataFrame:
    """The splits that `static_splits` drops because the purge inverts them."""
    rows = static_splits(calendar, cfg, drop_inverted=False)
    return rows.filter(F.col("start_date") > F.col("end_date"))


def walkforward_splits(calendar: DataFrame, cfg: SplitConfig = SplitConfig()) -> DataFrame:
    """Folds that step forward by the test length."""
    year = TRADING_DAYS_PER_YEAR
    train, val = cfg.walkforward_train_years * year, cfg.walkforward_val_years * year
    test, purge = cfg.walkforward_test_years * year, cfg.purge_days
    total = train + purge + val + purge + test
    base = calendar.agg(F.count("*").cast("int").alias("n")).filter(F.col("n") >= total)
    folds = base.select(
        "n", F.posexplode(F.sequence(F.lit(0), F.col("n") - total, F.lit(test))).alias("k", "o")
    )
    fold = F.concat(F.lit("walkforward_"), F.lpad(F.col("k").cast("string"), 2, "0"))
    starts = {"train": 0, "val": train + purge, "test": train + purge + val + purge}
    lengths = {"train": train, "val": val, "test": test}
    parts = F.array(
        *[
            _interval(
                F.concat(fold, F.lit("_" + name)),
                F.col("o") + start,
                F.col("o") + start + lengths[name] - 1,
                purge,
            )
            for name, start in starts.items()
        ]
    )
    rows = folds.select("n", F.explode(parts).alias("s")).select("s.*")
    return _with_dates(rows, calendar)


def split_interval(splits: DataFrame, name: str) -> tuple:
    row = splits.filter(F.col("split_name") == name).select("start_date", "end_date").first()
    if row is None:
        raise ValueError(f"split '{name}' not found")
    return row["start_date"], row["end_date"]


def split_days(splits: DataFrame) -> DataFrame:
    """(split_name, date) for every calendar day of every split: a date-level lookup."""
    days = F.sequence(F.col("start_date"), F.col("end_date"))
    valid = splits.filter(F.col("start_date") <= F.col("end_date"))
    return valid.select("split_name", F.explode(days).alias("date"))


def assign_split(rows: DataFrame, splits: DataFrame, date_col: str = "asof_date") -> DataFrame:
    """Rows tagged with the split that contains their date; others are left out."""
    lookup = split_days(splits).withColumnRenamed("date", date_col)
    return rows.join(day_table(lookup, date_col), date_col)


def with_fold(splits: DataFrame) -> DataFrame:
    """Fold id and split role parsed from walk-forward names."""
    return splits.filter(F.col("split_name").startswith("walkforward_")).select(
        "*",
        F.regexp_extract("split_name", FOLD_PATTERN, 1).alias("fold"),
        F.regexp_extract("split_name", FOLD_PATTERN, 2).alias("role"),
    )
