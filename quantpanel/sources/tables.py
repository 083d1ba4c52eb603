"""Table readers and writers, ingestion clean-up."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quantpanel.functions.columns import nan_to_null

PRICE_SCHEMA = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("ticker", T.StringType()),
        *[
            T.StructField(name, T.DoubleType())
            for name in ("open", "high", "low", "close", "adj_close", "volume")
        ],
    ]
)
PRICE_COLUMNS = ("open", "high", "low", "close", "adj_close", "volume")


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def table_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def read_optional(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame | None:
    """The table, or None where it does not exist (the step is then skipped)."""
    return read_table(spark, path, schema) if table_exists(spark, path) else None


def read_prices(
    spark: SparkSession, path: str, schema: T.StructType = PRICE_SCHEMA
) -> DataFrame:
    """Price file in CSV (with header) or parquet form, same columns either way.

    Columns are taken by name, in the order of `schema`; further ones are left out, and so are
    those of `schema` that the file does not have. CSV values that are no number or date
    become null.
    """
    if path.rstrip("/").endswith((".csv", ".csv.gz")):
        table = spark.read.option("header", True).csv(path)
    else:
        table = spark.read.parquet(path)
    names = {c.strip().lower(): c for c in table.columns}
    return table.select(
        *[F.col(f"`{names[f.name]}`").try_cast(f.dataType).alias(f.name) for f in schema if f.name in names]
    )


def write_table(df: DataFrame, path: str, date_col: str | None = None) -> None:
    """Overwrite a parquet table, partitioned by year of `date_col` if one is given.

    Rows are rebalanced over tasks of an even size, so that a date or year that holds a large
    part of all rows is written by several of them.
    """
    if date_col is None:
        df.write.mode("overwrite").parquet(path)
        return
    (
        df.withColumn("year", F.year(date_col))
        .hint("rebalance", "year")
        .write.mode("overwrite")
        .partitionBy("year")
        .parquet(path)
    )


def normalise_prices(raw: DataFrame) -> DataFrame:
    """Cast to the price types, NaN to null, drop rows without a close."""
    numbers = [
        nan_to_null(F.col(c).cast("double")).alias(c) for c in PRICE_COLUMNS if c in raw.columns
    ]
    others = [c for c in raw.columns if c not in PRICE_COLUMNS and c not in ("date", "ticker")]
    return raw.select(
        F.col("date").cast("date").alias("date"), F.col("ticker").cast("string"), *numbers, *others
    ).filter(F.col("close").isNotNull())


def with_dollar_volume(prices: DataFrame) -> DataFrame:
    return prices.withColumns(
        {"dollar_volume": F.col("close") * F.col("volume"), "source_ts": F.current_timestamp()}
    )


def deduplicate(rows: DataFrame, keys: list[str], sequence: str) -> DataFrame:
    """Keep the row with the highest `sequence` per key.

    An aggregate rather than a window: each task keeps one row per key before the shuffle,
    so a key repeated in a third of all rows costs no more than any other.
    """
    rest = [c for c in rows.columns if c not in keys]
    last = F.max_by(F.struct(*rest), F.col(sequence)).alias("_row")
    return rows.groupBy(*keys).agg(last).select(*keys, "_row.*").select(*rows.columns)


def ingest_metadata(prices: DataFrame) -> DataFrame:
    """One row: number of rows and tickers and the date range of a price table."""
    per_ticker = prices.groupBy("ticker").agg(
        F.count("*").alias("n"), F.min("date").alias("lo"), F.max("date").alias("hi")
    )
    return per_ticker.agg(
        F.sum("n").alias("n_rows"),
        F.count("*").alias("n_tickers"),
        F.min("lo").alias("first_date"),
        F.max("hi").alias("last_date"),
    )


def ticker_list(prices: DataFrame) -> DataFrame:
    """The tickers of a price table in order; a table, because the list grows with the data."""
    return prices.select("ticker").distinct().orderBy("ticker")


def wide_to_long(wide: DataFrame, separator: str = "|") -> DataFrame:
    """(date, `<ticker>|<field>` columns) to (date, ticker, one column per field)."""
    names = [c for c in wide.columns if c != "date"]
    fields = list(dict.fromkeys(n.split(separator)[1] for n in names))
    long = wide.unpivot("date", names, "_var", "_val").filter(F.col("_val").isNotNull())
    parts = F.split("_var", "[" + separator + "]")
    return (
        long.select("date", parts[0].alias("ticker"), parts[1].alias("_field"), "_val")
        .groupBy("date", "ticker")
        .pivot("_field", fields)
        .agg(F.first("_val"))
    )


def with_provenance(df: DataFrame, source: str, version: str) -> DataFrame:
    return df.withColumns(
        {
            "ingested_at": F.current_timestamp(),
            "source_name": F.lit(source),
            "source_version": F.lit(version),
        }
    )


# Types and keys of the stored form of each source besides prices.
SOURCE_TYPES = {
    "treasury": {"date": "date", "maturity": "string", "yield_pct": "double"},
    "factors": {"date": "date"},
    "macro": {
        "series_id": "string", "date": "date", "value": "double", "release_ts": "timestamp_ntz",
        "vintage_date": "date",
    },
    "filings": {
        "key": "string", "form": "string", "filing_date": "date", "accepted_ts": "timestamp_ntz",
        "accession_no": "string",
    },
}
SOURCE_KEYS = {
    "treasury": ["date", "maturity"],
    "factors": ["date"],
    "macro": ["series_id", "date", "vintage_date"],
    "filings": ["accession_no"],
}


def source_to_bronze(
    raw: DataFrame, kind: str, source: str, version: str, sequence: str, required: list[str] = ()
) -> DataFrame:
    """Raw rows of a source to the stored form: types, one row per key (the last), provenance.

    Columns named in `SOURCE_TYPES` are cast, values that don't fit become null; other numbers of
    a factor table are doubles, NaN is null. Rows without a key or a `required` value are left out.
    """
    types = SOURCE_TYPES[kind]
    keys = [k for k in SOURCE_KEYS[kind] if k in raw.columns]
    columns = []
    for name in raw.columns:
        column = F.col(f"`{name}`")
        if name in types:
            column = column.try_cast(types[name])
        elif kind == "factors" and name != sequence:
            column = column.try_cast("double")
        if types.get(name) == "double" or (kind == "factors" and name not in ("date", sequence)):
            column = nan_to_null(column)
        columns.append(column.alias(name))
    clean = raw.select(*columns).dropna(subset=[*keys, *required])
    return with_provenance(deduplicate(clean, keys, sequence), source, version)


def to_bronze(raw: DataFrame, source: str, version: str, sequence: str) -> DataFrame:
    """Raw prices to the stored form: types, dollar volume, one row per key, provenance."""
    clean = with_dollar_volume(normalise_prices(raw))
    return with_provenance(deduplicate(clean, ["date", "ticker"], sequence), source, version)
