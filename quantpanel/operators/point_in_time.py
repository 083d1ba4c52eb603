"""Joins that only see what was known at a moment.

A key may own a large part of all facts, so no step orders all facts of a key in one task:
facts are reduced to one row per key and stretch of time (a day, or ten minutes for the as-of
join) with a combinable aggregate, and only those rows are ordered by key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quantpanel.operators.grid import calendar_of, day_table


def _order(ts: str, seq: str) -> Column:
    return F.struct(ts, seq)


def _bucket(df: DataFrame, ts: str) -> Column:
    """Number of the ten-minute stretch of a moment, increasing in time."""
    if df.schema[ts].dataType.typeName() == "timestamp_ntz":
        minutes = F.hour(ts) * 6 + F.floor(F.minute(ts) / 10)
        return (F.unix_date(F.to_date(ts)) * 144 + minutes).cast("long")
    return F.floor(F.unix_timestamp(ts) / 600).cast("long")


def asof_join(
    left: DataFrame, right: DataFrame, key: str, ts: str, values: list[str], seq: str
) -> DataFrame:
    """Each left row with the values of the latest right row of the key with ts <= left ts.

    Both sides have `key` and `ts`; `seq` orders right rows of the same moment. Left rows
    without an earlier fact keep nulls. Time is cut into ten-minute stretches: inside one the
    two sides are merged in time order, and what a stretch starts with comes from a table with
    one row per key and stretch.
    """
    packed = F.struct(*values)
    facts = right.select(key, ts, seq, packed.alias("_v"), _bucket(right, ts).alias("_slot"))
    lasts = facts.groupBy(key, "_slot").agg(F.max_by("_v", _order(ts, seq)).alias("_last"))
    asked = left.select(
        F.struct(*left.columns).alias("_l"), key, ts, _bucket(left, ts).alias("_slot")
    )
    before = Window.partitionBy(key).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    slots = asked.select(key, "_slot").distinct().join(lasts, [key, "_slot"], "full")
    carry = slots.select(
        key, "_slot", F.last("_last", ignorenulls=True).over(before).alias("_carry")
    )
    columns = [key, ts, "_slot"]
    merged = asked.select(
        *columns,
        "_l",
        F.lit(None).cast(facts.schema[seq].dataType).alias("_seq"),
        F.lit(None).cast(facts.schema["_v"].dataType).alias("_v"),
    ).unionByName(
        facts.select(
            *columns,
            F.lit(None).cast(asked.schema["_l"].dataType).alias("_l"),
            F.col(seq).alias("_seq"),
            "_v",
        )
    )
    # At the same moment facts come first, so that a left row sees them.
    inside = (
        Window.partitionBy(key, "_slot")
        .orderBy(ts, F.col("_l").isNotNull(), "_seq")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    seen = merged.withColumn("_seen", F.last("_v", ignorenulls=True).over(inside))
    out = seen.filter(F.col("_l").isNotNull()).join(carry, [key, "_slot"], "left")
    return out.withColumn("_v", F.coalesce("_seen", "_carry")).select("_l.*", "_v.*")


def known_by_cutoff(facts: DataFrame, calendar: DataFrame, ts: str) -> DataFrame:
    """Facts with the first calendar day on whose cutoff they are known (`date`, `day_idx`).

    `calendar`: (date, day_idx, n_days, cutoff) with at most one cutoff per day. A fact looks
    up the first cutoff on or after its own day by equality and moves on to the next one if it
    came too late. Facts before the first cutoff day, however old, look up that day; facts after
    the last cutoff and facts without a moment drop out.
    """
    ordered = Window.orderBy("cutoff")
    cuts = calendar.select(
        F.to_date("cutoff").alias("_cut_day"),
        "cutoff",
        "date",
        "day_idx",
        F.lead("date").over(ordered).alias("_next_date"),
        F.lag(F.to_date("cutoff")).over(ordered).alias("_prev_day"),
    )
    # Each cutoff answers for its own day and for the days since the cutoff before it.
    first = F.coalesce(F.date_add("_prev_day", 1), F.col("_cut_day"))
    lookup = cuts.withColumn("_fact_day", F.explode(F.sequence(first, F.col("_cut_day"))))
    earliest = calendar.agg(F.min(F.to_date("cutoff"))).scalar()
    # One row per calendar day, so the facts themselves are not moved.
    rows = (
        facts.filter(F.col(ts).isNotNull())
        .withColumn("_fact_day", F.greatest(F.to_date(ts), earliest))
        .join(F.broadcast(lookup), "_fact_day")
    )
    late = F.col(ts) > F.col("cutoff")
    return (
        rows.withColumn("_idx", F.when(late, F.col("day_idx") + 1).otherwise(F.col("day_idx")))
        .withColumn("date", F.when(late, F.col("_next_date")).otherwise(F.col("date")))
        .filter(F.col("date").isNotNull())
        .drop("_fact_day", "_cut_day", "cutoff", "_next_date", "_prev_day", "day_idx")
        .withColumnRenamed("_idx", "day_idx")
    )


def point_in_time(
    facts: DataFrame, calendar: DataFrame, key: str, ts: str, values: list[str], seq: str
) -> DataFrame:
    """(key, date, values): the latest fact known at each day's cutoff, from the first on."""
    known = known_by_cutoff(facts, calendar, ts)
    daily = known.groupBy(key, "day_idx").agg(
        F.max_by(F.struct(*values), _order(ts, seq)).alias("_v")
    )
    filled = _carry_forward(daily, calendar, key)
    days = calendar.select("day_idx", "date")
    return filled.join(day_table(days, "day_idx"), "day_idx").select(key, "date", "_v.*")


def _carry_forward(daily: DataFrame, calendar: DataFrame, key: str) -> DataFrame:
    """Repeat each (key, day) row until the day before the key's next one."""
    window = Window.partitionBy(key).orderBy("day_idx")
    last = calendar.agg(F.max("day_idx")).scalar()
    until = F.coalesce(F.lead("day_idx").over(window) - 1, last)
    rows = daily.withColumn("_until", until)
    own = [c for c in daily.columns if c != "day_idx"]
    return rows.select(
        *own,
        F.col("day_idx").alias("_own_day"),
        F.explode(F.sequence("day_idx", "_until")).alias("day_idx"),
    )


def known_vintages(
    series: DataFrame, calendar: DataFrame, key: str, value: str = "value"
) -> DataFrame:
    """(key, date, observed, vintage_date, value): what each cutoff knew of a revised series.

    `series`: (key, date, release_ts, vintage_date, value). At a cutoff the latest observation
    date released so far counts, in its latest vintage released so far.
    """
    facts = series.withColumnRenamed("date", "observed")
    known = known_by_cutoff(facts, calendar, "release_ts")
    newest = F.max(F.struct("observed", "vintage_date", "release_ts", value)).alias("_v")
    daily = known.groupBy(key, "day_idx").agg(newest)
    so_far = Window.partitionBy(key).orderBy("day_idx").rowsBetween(Window.unboundedPreceding, 0)
    latest = daily.select(key, "day_idx", F.max("_v").over(so_far).alias("_v"))
    filled = _carry_forward(latest, calendar, key)
    days = calendar.select("day_idx", F.col("date"))
    return filled.join(day_table(days, "day_idx"), "day_idx").select(
        key, "date", "_v.observed", "_v.vintage_date", f"_v.{value}"
    )


def filing_features(
    filings: DataFrame, calendar: DataFrame, key: str, ts: str, forms: dict[str, str], days: int = 365
) -> DataFrame:
    """Days since the last filing of each form and number of filings in the last year.

    `forms` maps an output suffix to the form name. A filing counts from the first cutoff on
    which it was known.
    """
    known = known_by_cutoff(filings, calendar, ts).withColumn("_filed", F.to_date(ts))
    latest = [
        F.max(F.when(F.col("form") == form, F.col("_filed"))).alias(f"_last_{name}")
        for name, form in forms.items()
    ]
    daily = known.groupBy(key, "day_idx").agg(F.count("*").alias("_n"), *latest)
    days_of = day_table(calendar.select("day_idx", "date"), "day_idx")
    dense = _carry_forward(daily, calendar, key).join(days_of, "day_idx")
    so_far = Window.partitionBy(key).orderBy("day_idx").rowsBetween(Window.unboundedPreceding, 0)
    year = Window.partitionBy(key).orderBy(F.unix_date("date")).rangeBetween(-(days - 1), 0)
    fresh = F.when(F.col("day_idx") == F.col("_own_day"), F.col("_n")).otherwise(0)
    return dense.select(
        key,
        "date",
        *[
            F.datediff("date", F.max(f"_last_{n}").over(so_far)).alias(f"days_since_{n}")
            for n in forms
        ],
        F.sum(fresh).over(year).alias(f"filings_{days}d"),
    )


def resolve_dates(requested: DataFrame, panel: DataFrame) -> DataFrame:
    """(requested, date): the closest panel date on or before each requested day.

    Works on distinct days only, whatever the size of the two tables.
    """
    known = calendar_of(panel).select(F.col("date").alias("_day"), F.col("date"))
    asked = requested.select(F.col("requested").alias("_day")).distinct()
    days = asked.join(known, "_day", "full")
    so_far = Window.orderBy("_day").rowsBetween(Window.unboundedPreceding, 0)
    carried = days.select("_day", F.last("date", ignorenulls=True).over(so_far).alias("date"))
    return carried.join(asked, "_day", "left_semi").filter(F.col("date").isNotNull()).select(
        F.col("_day").alias("requested"), "date"
    )
