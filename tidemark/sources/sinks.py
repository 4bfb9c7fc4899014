"""Partitioned tables by New York day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

ZONE = "America/New_York"


def with_day(df: DataFrame, ts: str = "timestamp", zone: str = ZONE) -> DataFrame:
    """df with `date`, the day of a UTC time in the zone."""
    return df.withColumn("date", F.to_date(F.from_utc_timestamp(F.col(ts).cast("timestamp"), zone)))


def trim_warmup(df: DataFrame, days: int) -> DataFrame:
    """Without the first `days` dates that occur. The dates alone are ranked, not the rows."""
    first = df.select("date").distinct().withColumn("__k", F.dense_rank().over(Window.orderBy("date"))).where(F.col("__k") <= days).select("date")
    return df.join(first, "date", "left_anti")


def write_days(df: DataFrame, path: str, ts: str = "timestamp", overwrite: bool = True, warmup_days: int = 0) -> None:
    """Write by day: days in df replace those at path, or with overwrite=False only days not there yet are added."""
    out = trim_warmup(with_day(df, ts), warmup_days) if warmup_days else with_day(df, ts)
    spark = df.sparkSession
    if not overwrite and exists(spark, path):
        out = out.join(spark.read.parquet(path).select("date").distinct(), "date", "left_anti")
    # a day's rows meet, but a large day is dealt to several tasks and files
    out.hint("rebalance", F.col("date")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(path)


def at(spark: SparkSession, path: str):
    """Hadoop's path and file system of a path."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    where, fs = at(spark, path)
    return fs.exists(where)


def put_text(spark: SparkSession, path: str, text: str, overwrite: bool = True) -> bool:
    """Write a small text; without overwrite only where there is none. Whether it was written."""
    where, fs = at(spark, path)
    if not overwrite and fs.exists(where):
        return False
    out = fs.create(where, True)
    out.write(bytearray(text.encode()))
    out.close()
    return True


def get_text(spark: SparkSession, path: str) -> str:
    """A small text, whole."""
    return spark.read.text(path, wholetext=True).first()[0]


def remove(spark: SparkSession, path: str) -> bool:
    where, fs = at(spark, path)
    return fs.delete(where, True)


def read_days(spark: SparkSession, path: str, since: str, until: str, columns: list[str] | None = None) -> DataFrame:
    """Days in [since, until) of a table written by write_days: partitions are pruned and columns read as asked."""
    rows = spark.read.parquet(path).where((F.col("date") >= F.lit(since).cast("date")) & (F.col("date") < F.lit(until).cast("date")))
    return rows.select(*[c for c in columns if c in rows.columns]) if columns else rows


def missing_days(have: DataFrame, since: str, until: str) -> DataFrame:
    """Dates of the calendar [since, until) that `have` (date) lacks."""
    days = have.sparkSession.range(1).select(F.explode(F.sequence(F.lit(since).cast("date"), F.date_sub(F.lit(until).cast("date"), 1))).alias("date"))
    return days.join(have.select("date").distinct(), "date", "left_anti")


def consecutive_days(days: DataFrame) -> DataFrame:
    """Runs of consecutive dates: first_day, last_day, n_days. Input is a calendar, a few thousand rows at most."""
    ranked = days.select("date").distinct().withColumn("g", F.date_sub("date", F.row_number().over(Window.orderBy("date"))))
    return ranked.groupBy("g").agg(F.min("date").alias("first_day"), F.max("date").alias("last_day"), F.count(F.lit(1)).alias("n_days")).drop("g")
