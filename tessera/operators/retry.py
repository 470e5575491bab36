"""What survived, what failed, what to try again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import kept


def surviving_prompts(jobs: DataFrame, winners: DataFrame, category: str = "category") -> DataFrame:
    return jobs.join(winners, "id", "left_semi").select(category, "prompt").distinct()


def failed_rows(jobs: DataFrame, winners: DataFrame, category: str = "category") -> DataFrame:
    """Jobs of prompts of which no job has a winner: one surviving sibling saves a prompt."""
    return jobs.join(surviving_prompts(jobs, winners, category), [category, "prompt"], "left_anti")


def assess(jobs: DataFrame, winners: DataFrame, target: int, margin: int = 25, category: str = "category") -> DataFrame:
    """Per category: pool of prompts, survivors, failed jobs, whether it is short and how far to top up."""
    won = winners.select("id").distinct().withColumn("won", F.lit(True))
    prompts = jobs.join(won, "id", "left").groupBy(category, "prompt").agg(F.bool_or(F.coalesce("won", F.lit(False))).alias("survived"), F.count("*").alias("jobs"))
    out = prompts.groupBy(category).agg(F.count("*").alias("pool"), F.count_if("survived").alias("survivors"), F.sum(F.when(~F.col("survived"), F.col("jobs")).otherwise(0)).alias("failed_jobs"))
    return out.withColumns({"short": F.col("survivors") < target, "top_up_to": F.when(F.col("survivors") < target, F.col("pool") + target - F.col("survivors") + margin).otherwise(F.col("pool"))})


def new_rows(rows: DataFrame, seen: DataFrame) -> DataFrame:
    return rows.join(seen, "id", "left_anti")


def until_target(jobs: DataFrame, run: Callable[[DataFrame, int], DataFrame], author: Callable[[DataFrame, int], DataFrame], target: int, max_retries: int = 2, max_top_ups: int = 3, margin: int = 25, width: int = 64, keep: Callable[[DataFrame, str], DataFrame] = kept) -> tuple[DataFrame, DataFrame, list[dict]]:
    """Rounds until every category has ``target`` surviving prompts or no attempt is left.

    Without a target (0 or less) failed jobs are tried again up to ``max_retries`` times and nothing is authored. The
    log's last entry names the categories that are stuck short of the target.

    ``run(jobs, variant_offset)`` returns winners (id); ``author(short, round)`` returns new jobs for the rows of
    ``assess`` that are short. Failed jobs are tried again up to ``max_retries`` times between top-ups. State is a
    table a round, written by ``keep``; the driver holds a row for each category (their number is fixed).
    Returns (jobs, winners, log).
    """
    jobs, winners, log, state = keep(jobs, "jobs"), None, [], {}
    todo = jobs
    for round_ in range(max_retries + max_top_ups + 2):
        won = run(todo, round_ * width).select("id")
        winners = keep(won.distinct() if winners is None else winners.unionByName(won).distinct(), "winners")
        short = [r.asDict() for r in assess(jobs, winners, target, margin).where("short" if target > 0 else "failed_jobs > 0").collect()]
        log.append({"round": round_, "short": len(short), "stuck": []})
        if not short:
            break
        again, more = [], []
        for r in short:
            s = state.setdefault(r["category"], {"retries": 0, "top_ups": 0})
            if s["retries"] < max_retries and r["failed_jobs"]:
                s["retries"] += 1
                again.append(r["category"])
            elif target > 0 and s["top_ups"] < max_top_ups:
                s["top_ups"], s["retries"] = s["top_ups"] + 1, 0
                more.append(r["category"])
            else:
                log[-1]["stuck"].append(r["category"])
        log[-1]["stuck"].sort()
        if not again and not more:
            break
        todo = failed_rows(jobs, winners).where(F.col("category").isin(again)).select(*jobs.columns)
        if more:
            fresh = keep(new_rows(author(assess(jobs, winners, target, margin).where(F.col("category").isin(more)), round_), jobs.select("id")).select(*jobs.columns), "fresh")
            jobs, todo = keep(jobs.unionByName(fresh), "jobs"), todo.unionByName(fresh)
        todo = keep(todo, "todo")
    return jobs, winners, log
