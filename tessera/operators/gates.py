"""First-failure gates, best of N, and what was refused."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_failure(*checks: tuple[str, Column]) -> Column:
    """The name of the first check that fires, null if none does; a null check does not fire."""
    return F.coalesce(*(F.when(test, F.lit(name)) for name, test in checks))


def until_failed(metric: Column, *before: Column) -> Column:
    """A metric that is only known if none of the earlier checks fired."""
    fired = F.lit(False)
    for test in before:
        fired = fired | F.coalesce(test, F.lit(False))
    return F.when(~fired, metric)


def best_of_group(verdicts: DataFrame, by: list[str], score: str, variant: str, passed: str) -> DataFrame:
    """The passing row of the highest score, of equals the lowest variant: one pre-aggregated shuffle, no sort."""
    rest = [c for c in verdicts.columns if c not in by]
    best = F.max_by(F.struct(*rest), F.struct(F.col(score), -F.col(variant)))
    return verdicts.where(passed).groupBy(*by).agg(best.alias("_w")).select(*by, *(F.col("_w")[c].alias(c) for c in rest))


def failed_groups(verdicts: DataFrame, by: list[str], reason: str, passed: str) -> DataFrame:
    """Groups without a passing row: attempts and how often each reason occurred."""
    tally = verdicts.groupBy(*by, reason).agg(F.count("*").alias("n"), F.bool_or(passed).alias("ok"))
    return tally.groupBy(*by).agg(F.sum("n").alias("attempts"), F.bool_or("ok").alias("ok"), F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col(reason).isNotNull(), F.struct(reason, "n"))))).alias("rejection_reasons")).where("not ok").drop("ok")


def reason_tally(verdicts: DataFrame, reason: str, top: int | None = None) -> DataFrame:
    out = verdicts.where(F.col(reason).isNotNull()).groupBy(reason).agg(F.count("*").alias("n")).orderBy(F.desc("n"), reason)
    return out.limit(top) if top else out


def merged_tally(*tallies: DataFrame) -> DataFrame:
    """Sums of tallies (reason, n) from several places."""
    out = tallies[0]
    for t in tallies[1:]:
        out = out.unionByName(t)
    return out.groupBy("reason").agg(F.sum("n").alias("n"))


def needs_gating(groups: DataFrame, verdicts: DataFrame, by: list[str], passed: str, reason: str) -> DataFrame:
    """Groups without a winner or with any failed read."""
    seen = verdicts.groupBy(*by).agg(F.bool_or(passed).alias("ok"), F.bool_or(F.startswith(F.coalesce(F.col(reason), F.lit("")), F.lit("read_failed"))).alias("unread"))
    return groups.join(seen, by, "left").where(~F.coalesce("ok", F.lit(False)) | F.coalesce("unread", F.lit(False))).select(*groups.columns)
