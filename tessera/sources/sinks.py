"""Tables out to files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_json_rows(df: DataFrame, path: str, order: list[str] | None = None, partition: str | None = None) -> None:
    """JSON lines, in order if asked: ranges are ordered among each other and inside."""
    if order:
        df = df.repartitionByRange(*order).sortWithinPartitions(*order)
    writer = df.write.mode("overwrite").option("ignoreNullFields", "false")
    (writer.partitionBy(partition) if partition else writer).json(path)


def manifest(*fields: Column | str) -> Column:
    """One JSON document of the fields, nulls included."""
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def route(df: DataFrame, reason: str) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected)."""
    return df.where(F.col(reason).isNull()), df.where(F.col(reason).isNotNull())


def prompt_file(lines: DataFrame, category: str = "category", section: str = "section", place: str = "place", prompt: str = "prompt") -> DataFrame:
    """(category, text): a header, then each section under its name, in order. One category is a few hundred lines."""
    parts = lines.groupBy(category, section).agg(F.array_sort(F.collect_list(F.struct(place, prompt))).alias("l"), F.count("*").alias("n"))
    body = F.concat_ws("\n", F.concat(F.lit("# --- "), F.col(section), F.lit(" ---")), F.concat_ws("\n", F.col("l")[prompt]))
    whole = parts.groupBy(category).agg(F.array_sort(F.collect_list(F.struct(section, body.alias("t")))).alias("s"), F.sum("n").alias("n"))
    return whole.select(category, F.concat(F.lit("# "), F.col(category), F.lit(": "), F.col("n").cast("string"), F.lit(" prompts\n\n"), F.concat_ws("\n\n", F.col("s")["t"]), F.lit("\n")).alias("text"))


def replace_versioned(df: DataFrame, root: str, version: str) -> str:
    """Writes the table beside older ones; readers change over by path, so no reader sees half a table."""
    path = f"{root}/version={version}"
    df.write.mode("errorifexists").parquet(path)
    return path
