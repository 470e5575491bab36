"""A gate over a stream of verdicts: windowed rejection counts with late data bounded, and running winners."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.gates import best_of_group


def rejections(verdicts: DataFrame, ts: str, reason: str, window: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """Counts of reasons in tumbling windows; rows later than ``late`` are left out."""
    seen = verdicts.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late).where(F.col(reason).isNotNull())
    return seen.groupBy(F.window(ts, window), reason).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), reason, "n")


def keep_winners(verdicts: DataFrame, path: str, checkpoint: str, by: list[str], score: str, variant: str, passed: str):
    """Upserts the best row of each group into a Parquet table a batch; a restart repeats no batch."""

    def merge(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        old = f"{path}/epoch={epoch - 1}"
        fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(old)
        rows = batch
        if epoch and fs_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(fs_path):
            rows = rows.unionByName(spark.read.parquet(old))
        best_of_group(rows, by, score, variant, passed).write.mode("overwrite").parquet(f"{path}/epoch={epoch}")

    return verdicts.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
