"""Key zones: roots on a grid, nearest sources, midpoint bounds, look-up of notes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

LOW, HIGH = 0, 127


def grid(sources: Column, span: int, step: int) -> Column:
    """Sorted distinct roots: the sources and every ``step`` from ``span`` below the lowest to ``span`` above the highest."""
    low, high = F.greatest(F.array_min(sources) - span, F.lit(LOW)), F.least(F.array_max(sources) + span, F.lit(HIGH))
    return F.array_sort(F.array_distinct(F.concat(sources, F.sequence(low, high, F.lit(step)))))


def nearest(sources: Column, root: Column) -> Column:
    """The nearest source; of two, the lower."""
    return F.array_min(F.transform(sources, lambda s: F.struct(F.abs(s - root).alias("d"), s.alias("s"))))["s"]


def zone_plan(instruments: DataFrame, id_: str, sources: str, span: int, step: int) -> DataFrame:
    """A row for each zone: root, source, shift and closed note bounds. Works row by row: no shuffle."""
    roots = F.col("_roots")
    with_roots = instruments.select(id_, F.col(sources).alias("_sources"), grid(F.col(sources), span, step).alias("_roots"))
    zones = with_roots.select(id_, "_sources", F.posexplode("_roots").alias("zone", "root"), roots)
    low = F.when(F.col("zone") == 0, F.lit(LOW)).otherwise((F.floor((F.get(roots, F.col("zone") - 1) + F.col("root")) / 2) + 1).cast("int"))
    high = F.when(F.col("zone") == F.size(roots) - 1, F.lit(HIGH)).otherwise(F.floor((F.col("root") + F.get(roots, F.col("zone") + 1)) / 2).cast("int"))
    out = zones.select(id_, "zone", "root", nearest(F.col("_sources"), F.col("root")).alias("source"), low.alias("min_midi"), high.alias("max_midi"))
    return out.withColumn("shift", F.col("root") - F.col("source"))


def zone_faults(zones: DataFrame, id_: str) -> DataFrame:
    """Zones that leave a gap, overlap, run backwards or miss an end; none in a sound plan."""
    w = W.partitionBy(id_).orderBy("root")
    seen = zones.withColumns({"_last": F.lag("max_midi").over(w), "_next": F.lead("root").over(w)})
    bad = F.when(F.col("min_midi") > F.col("max_midi"), "backwards").when(F.col("_last").isNull() & (F.col("min_midi") != LOW), "no start").when(F.col("min_midi") != F.col("_last") + 1, "gap or overlap").when(F.col("_next").isNull() & (F.col("max_midi") != HIGH), "no end")
    return seen.withColumn("fault", bad).where("fault is not null").drop("_last", "_next")


def notes_to_zones(notes: DataFrame, zones: DataFrame, id_: str, note: str) -> DataFrame:
    """Range join: every zone is spread over its at most 128 notes, so the join is on equal keys."""
    spread = zones.withColumn(note, F.explode(F.sequence("min_midi", "max_midi")))
    return notes.join(spread, [id_, note])


def overlapping(events: DataFrame, group: list[str], id_: str, begin: str, end: str, least: float, width: float, differ: Column | None = None) -> DataFrame:
    """Pairs (left, right), left first, of one group whose intervals overlap by more than ``least``.

    Intervals are spread over time slots of ``width`` and joined within a slot; a pair is taken in the first slot that
    both are in. ``differ`` is a further test on columns l and r.
    """
    slots = events.withColumn("_slot", F.explode(F.sequence(F.floor(F.col(begin) / width), F.floor(F.col(end) / width))))
    left, right = slots.alias("l"), slots.alias("r")
    on = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in group] + [F.col("l._slot") == F.col("r._slot")]
    lap = F.least(F.col(f"l.{end}"), F.col(f"r.{end}")) - F.greatest(F.col(f"l.{begin}"), F.col(f"r.{begin}"))
    first = F.floor(F.greatest(F.col(f"l.{begin}"), F.col(f"r.{begin}")) / width) == F.col("l._slot")
    met = left.join(right, on).where((F.col(f"l.{id_}") < F.col(f"r.{id_}")) & (lap > least) & first)
    if differ is not None:
        met = met.where(differ)
    return met.select(*(F.col(f"l.{c}").alias(c) for c in group), F.col(f"l.{id_}").alias("left"), F.col(f"r.{id_}").alias("right"), lap.alias("overlap"))
