"""From ordered prompt lines to jobs, units and batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.scalars import normalized, short_id
from ..scratch import kept


#: Where a text is split to lines, and what is taken off both ends of a line (all Unicode white space).
LINE_END = r"\r\n|[\n\x0B\x0C\r\x1C-\x1E\x85\u2028\u2029]"
BLANK = r"[\t-\r\x1C-\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]"


def prompt_lines(texts: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """Lines in order, from 1; blank lines and those that begin with # go but keep their number."""
    lines = texts.select(*keys, F.posexplode(F.split(F.col(text), LINE_END)).alias("at", "line"))
    return lines.select(*keys, (F.col("at") + 1).alias("line_no"), F.regexp_replace("line", f"^{BLANK}+|{BLANK}+$", "").alias("prompt")).where((F.length("prompt") > 0) & ~F.startswith("prompt", F.lit("#")))


def first_of_each(df: DataFrame, by: list[Column | str], order: list[Column | str]) -> DataFrame:
    """The first row of each group; Spark limits the groups before the shuffle as well as after it."""
    return df.withColumn("_n", F.row_number().over(W.partitionBy(*by).orderBy(*order))).where("_n = 1").drop("_n")


def ordered_dedup(lines: DataFrame, category: str, order: list[str], prompt: str = "prompt") -> DataFrame:
    """Of lines of a category that normalise alike, the first."""
    return first_of_each(lines, [category, normalized(F.col(prompt))], order)


def numbered(df: DataFrame, by: str, order: list[str], name: str) -> DataFrame:
    """A running number from 1 within ``by`` that one hot value of ``by`` does not put in one task.

    Rows are ranged by (by, order) over all partitions; a partition numbers its own rows and adds how many rows of the
    same value earlier partitions hold.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Written once: ranges are drawn from a sample, and both uses below must see the same ones.
    ranged = kept(df.repartitionByRange(n, by, *order).withColumn("_p", F.spark_partition_id()))
    local = ranged.withColumn("_k", F.row_number().over(W.partitionBy("_p", by).orderBy(*order)))
    sizes = ranged.groupBy(by, "_p").agg(F.count("*").alias("_s"))
    before = sizes.withColumn("_b", F.coalesce(F.sum("_s").over(W.partitionBy(by).orderBy("_p").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    met = local.join(before.select(F.col(by).alias("_by"), F.col("_p").alias("_q"), "_b"), F.col(by).eqNullSafe(F.col("_by")) & (F.col("_p") == F.col("_q")))
    return met.withColumn(name, (F.col("_k") + F.col("_b")).cast("long")).drop("_p", "_q", "_k", "_b", "_by")


def with_job_ids(lines: DataFrame, category: str, order: list[str], start: int, prompt: str = "prompt") -> DataFrame:
    """Seeds by place within the category, and ids by content and seed."""
    out = numbered(lines, category, order, "_place")
    out = out.withColumn("seed", F.col("_place") - 1 + start).drop("_place")
    return out.withColumn("id", F.concat(F.col(category), F.lit("-"), short_id(F.col(category), F.col(prompt), F.col("seed"))))


def limited(jobs: DataFrame, category: str, order: list[str], n: int) -> DataFrame:
    """The first n of each category."""
    return jobs.withColumn("_n", F.row_number().over(W.partitionBy(category).orderBy(*order))).where(F.col("_n") <= n).drop("_n")  # limited before the shuffle


def fan_out_targets(jobs: DataFrame, targets: str) -> DataFrame:
    return jobs.select("*", F.posexplode(targets).alias("target_pos", "target")).drop(targets)


def fan_out_variants(jobs: DataFrame, variants: str, offset: int = 0) -> DataFrame:
    """One unit for each variant, at least one; null counts as one."""
    n = F.greatest(F.lit(1), F.coalesce(F.col(variants), F.lit(1)))
    return jobs.withColumn("variant_index", F.explode(F.sequence(F.lit(offset), n.cast("int") - 1 + offset)))


def unit_name(id_: Column, variant: Column, many: Column) -> Column:
    """The id with two digits or more of the variant; numbers over 99 stay whole."""
    digits = variant.cast("string")
    return F.when(many, F.concat(id_, F.lit("_v"), F.when(variant < 10, F.concat(F.lit("0"), digits)).otherwise(digits))).otherwise(id_)


def drum_variant(stem: Column) -> Column:
    """(id, variant) of a file name's stem that ends with _v and two digits; the whole stem and -1 otherwise."""
    found = F.regexp_extract(stem, r"_v(\d{2})$", 1)
    return F.struct(F.when(found == "", stem).otherwise(F.substring(stem, F.lit(1), F.length(stem) - 4)).alias("id"), F.when(found == "", -1).otherwise(F.try_to_number(found, F.lit("99"))).cast("int").alias("variant"))


def pitched_variant(stem: Column) -> Column:
    """(id, variant) of a stem that ends with _v and digits, whatever their number; the whole stem and 0 otherwise."""
    found = F.regexp_extract(stem, r"_v(\d+)$", 1)
    return F.struct(F.when(found == "", stem).otherwise(F.substring(stem, F.lit(1), F.length(stem) - F.length(found) - 2)).alias("id"), F.coalesce(F.when(found != "", found).cast("long"), F.lit(0).cast("long")).alias("variant"))


def not_there(units: DataFrame, existing: DataFrame, on: list[str]) -> DataFrame:
    return units.join(existing, on, "left_anti")


def batches(units: DataFrame, bucket: list[str], order: list[str], size: int, start_seed: int = 2001) -> DataFrame:
    """Batches of one bucket each; batch numbers run over buckets in the order in which they first occur."""
    place = units.withColumn("_n", F.row_number().over(W.partitionBy(*bucket).orderBy(*order)))
    firsts = units.groupBy(*bucket).agg(F.min(F.struct(*order)).alias("_first"), F.ceil(F.count("*") / size).alias("_batches"))
    # One row a bucket: this window is over buckets, not over units.
    firsts = firsts.withColumn("_before", F.coalesce(F.sum("_batches").over(W.orderBy("_first").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    out = place.join(firsts.drop("_first", "_batches"), bucket)
    out = out.withColumn("batch", (F.col("_before") + F.floor((F.col("_n") - 1) / size)).cast("long")).withColumn("batch_position", F.pmod(F.col("_n") - 1, F.lit(size)).cast("int"))
    return out.withColumn("batch_seed", F.col("batch") + start_seed).drop("_n", "_before")
