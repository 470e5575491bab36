"""Survival, accuracy, percentile and rejection reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import bar, percent

#: Right-closed bounds of the signed-cents histogram.
BOUNDS = (-250, -100, -25, 25, 100, 250)
BUCKETS = ("<=-250", "(-250,-100]", "(-100,-25]", "(-25,25]", "(25,100]", "(100,250]", ">250")


def bucket(x: Column) -> Column:
    out = F.when(x.isNull(), F.lit(None))
    for i, bound in enumerate(BOUNDS):
        out = out.when(x <= bound, F.lit(i))
    return out.otherwise(F.lit(len(BOUNDS))).cast("int")


def histogram(df: DataFrame, x: Column) -> DataFrame:
    """All seven buckets, empty ones with 0."""
    spark = df.sparkSession
    names = spark.createDataFrame(list(enumerate(BUCKETS)), "bucket int, name string")
    counts = df.select(bucket(x).alias("bucket")).where("bucket is not null").groupBy("bucket").agg(F.count("*").alias("n"))
    return F.broadcast(names).join(counts, "bucket", "left").select("bucket", "name", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def same_class(measured: Column, target: Column) -> Column:
    return (F.pmod(F.bround(measured), F.lit(12)) == F.pmod(target, F.lit(12))).cast("int")


def category_report(winners: DataFrame, failures: DataFrame, category: str, measured: str, target: str, cents: str) -> DataFrame:
    """Per category: winners, failures, survival, accuracies and exact percentiles of the absolute cents."""
    won = winners.groupBy(category).agg(
        F.count("*").alias("winners"), F.count(measured).alias("pitched"), F.avg(same_class(F.col(measured), F.col(target))).alias("class_accuracy"),
        F.avg((F.bround(measured) == F.col(target)).cast("int")).alias("exact_accuracy"), F.percentile(F.abs(F.col(cents)), 0.5).alias("median_cents"), F.percentile(F.abs(F.col(cents)), 0.9).alias("p90_cents"),
    )
    lost = failures.groupBy(category).agg(F.count("*").alias("failures"))
    out = won.join(lost, category, "full").fillna(0, ["winners", "failures", "pitched"])
    return out.withColumn("survival", F.coalesce(F.try_divide(F.col("winners"), F.col("winners") + F.col("failures")), F.lit(0.0)))


def overall(report: DataFrame) -> DataFrame:
    """Counts add up, accuracies are weighted by pitched winners, percentiles are those of the categories' own."""
    weighted = lambda c: F.try_divide(F.sum(F.col(c) * F.col("pitched")), F.sum(F.when(F.col(c).isNotNull(), F.col("pitched"))))
    out = report.agg(F.sum("winners").alias("winners"), F.sum("failures").alias("failures"), weighted("class_accuracy").alias("class_accuracy"), weighted("exact_accuracy").alias("exact_accuracy"), F.percentile("median_cents", 0.5).alias("median_of_medians"), F.percentile("p90_cents", 0.9).alias("p90_of_p90s"))
    return out.withColumn("survival", F.coalesce(F.try_divide(F.col("winners"), F.col("winners") + F.col("failures")), F.lit(0.0)))


def report_lines(report: DataFrame, category: str) -> DataFrame:
    """A Markdown line for each category, in order of its name."""
    total = F.col("winners") + F.col("failures")
    return report.orderBy(category).select(F.concat_ws(" | ", F.col(category), F.col("winners").cast("string"), percent(F.col("survival")), percent(F.col("class_accuracy")), bar(F.col("winners"), total)).alias("line"))


def progress(verdicts: DataFrame, category: str, passed: str = "passed", reason: str = "reason") -> DataFrame:
    """Per category: winners, failures that were judged, and those still pending because their file could not be read.

    A category is done when none is pending, PENDING when nothing else is there, and partial in between.
    """
    unread = F.coalesce(F.contains(F.col(reason), F.lit("read_failed")), F.lit(False))
    out = verdicts.groupBy(category).agg(F.count_if(F.col(passed)).alias("winners"), F.count_if(~F.col(passed) & ~unread).alias("fresh"), F.count_if(~F.col(passed) & unread).alias("pending"))
    status = F.when(F.col("pending") == 0, "done").when(F.col("winners") + F.col("fresh") == 0, "PENDING").otherwise("partial")
    return out.withColumn("status", status)


def progress_total(progress: DataFrame) -> DataFrame:
    """One row: categories done and all, jobs judged and all, and their share in percent."""
    judged, all_ = F.sum(F.col("winners") + F.col("fresh")), F.sum(F.col("winners") + F.col("fresh") + F.col("pending"))
    return progress.agg(F.count_if(F.col("status") == "done").alias("done"), F.count("*").alias("categories"), F.coalesce(judged, F.lit(0)).alias("judged"), F.coalesce(all_, F.lit(0)).alias("jobs"), F.coalesce(F.bround(F.try_divide(100.0 * judged, all_), 1), F.lit(0.0)).alias("percent"))


def price_table(times: DataFrame, seconds: str, samples: int, hourly: tuple[float, ...] = (0.86, 1.19, 1.80)) -> DataFrame:
    mean = times.agg(F.avg(seconds).alias("mean_seconds"))
    return mean.select("mean_seconds", F.explode(F.array(*map(F.lit, hourly))).alias("hourly")).withColumn("price", F.col("mean_seconds") * samples / 3600 * F.col("hourly"))
