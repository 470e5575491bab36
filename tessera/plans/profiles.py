"""Category tables, and the gates that read them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.gates import first_failure

DRUM_SCHEMA = "category string, kind string, centroid_lo double, centroid_hi double, max_onset_ms double, expect_decay boolean, single_hit boolean, min_duration double, variants int, duration double"
#: The drum profiles; the last row is for categories without one.
DRUMS = [
    ("kick", "sub", 20.0, 600.0, 90.0, True, True, 0.15, 6, 1.5),
    ("snare-standard", "percussive", 700.0, 6000.0, 70.0, True, True, 0.12, 6, 1.0),
    ("snare-rim", "percussive", 1000.0, 8000.0, 50.0, True, True, 0.05, 6, 0.75),
    ("hat-closed", "percussive", 4000.0, 16000.0, 40.0, True, True, 0.03, 5, 0.5),
    ("hat-open", "percussive", 3500.0, 15000.0, 60.0, True, False, 0.10, 5, 1.5),
    ("cymbal-ride", "cymbal", 3000.0, 14000.0, 120.0, True, False, 0.40, 5, 2.5),
    ("cymbal-crash", "cymbal", 3000.0, 14000.0, 120.0, True, False, 0.50, 5, 3.0),
    ("cymbal-splash", "cymbal", 3500.0, 15000.0, 100.0, True, False, 0.25, 5, 1.5),
    ("tamborine", "percussive", 4000.0, 13000.0, 90.0, True, False, 0.10, 5, 1.0),
    ("shaker", "percussive", 3000.0, 13000.0, 120.0, True, False, 0.08, 5, 0.75),
    ("tom-hi", "percussive", 200.0, 1500.0, 80.0, True, True, 0.12, 5, 1.0),
    ("tom-mid", "percussive", 150.0, 1100.0, 80.0, True, True, 0.15, 5, 1.25),
    ("tom-low", "percussive", 80.0, 800.0, 90.0, True, True, 0.18, 5, 1.5),
    ("hit", "percussive", 80.0, 6000.0, 120.0, True, True, 0.15, 5, 1.5),
    ("clap", "percussive", 1000.0, 7000.0, 90.0, True, True, 0.08, 6, 0.75),
    ("808", "sub", 20.0, 500.0, 110.0, True, True, 0.30, 6, 2.0),
    ("sub-drop", "sub", 20.0, 400.0, 0.0, True, False, 0.40, 4, 2.0),
    ("riser", "fx", 200.0, 16000.0, 0.0, False, False, 1.50, 4, 4.0),
    ("downlifter", "fx", 200.0, 16000.0, 0.0, False, False, 1.00, 4, 3.0),
    ("impact", "percussive", 50.0, 4000.0, 120.0, True, True, 0.20, 5, 2.0),
    ("sweep", "fx", 500.0, 16000.0, 0.0, False, False, 0.80, 4, 2.5),
    ("texture", "fx", 200.0, 14000.0, 0.0, False, False, 1.00, 4, 3.0),
    ("zap", "percussive", 1000.0, 14000.0, 40.0, True, True, 0.03, 5, 0.75),
    ("foley-perc", "percussive", 400.0, 9000.0, 90.0, True, True, 0.04, 5, 0.75),
    ("", "percussive", 80.0, 12000.0, 120.0, True, False, 0.05, 5, 2.0),
]
PITCHED_SCHEMA = "category string, targets array<int>, duration double, span int, step int, min_sustain double, open_ended boolean, floor_hz double, variants int"
#: The pitched categories with one source each.
PITCHED = [
    ("synths", [48], 5.0, 12, 3, 0.5, False, 60.0, 6),
    ("lead-supersaw", [60], 5.0, 12, 3, 0.4, False, 80.0, 6),
    ("lead-fm", [60], 5.0, 12, 3, 0.3, False, 80.0, 6),
    ("lead-acid", [48], 4.0, 12, 3, 0.3, False, 60.0, 6),
    ("pluck-synth", [60], 3.0, 12, 3, 0.1, False, 80.0, 6),
    ("plucks", [60], 3.0, 12, 3, 0.1, False, 80.0, 6),
    ("keys", [48], 5.0, 12, 3, 0.4, False, 80.0, 6),
    ("pianos", [60], 5.0, 12, 2, 0.4, False, 60.0, 6),
    ("organs", [48], 8.0, 12, 3, 0.75, True, 80.0, 8),
    ("basses", [40], 6.0, 12, 3, 0.5, False, 30.0, 8),
    ("808-bass", [36], 6.0, 12, 3, 0.5, False, 25.0, 8),
    ("reese-bass", [40], 6.0, 12, 3, 0.4, False, 35.0, 8),
    ("pads", [48], 12.0, 12, 2, 1.0, True, 80.0, 8),
    ("strings", [57], 8.0, 12, 2, 0.75, True, 60.0, 8),
    ("brass", [57], 6.0, 12, 3, 0.5, True, 80.0, 8),
    ("winds", [69], 5.0, 12, 2, 0.5, True, 100.0, 8),
    ("accordion", [54], 6.0, 12, 3, 0.6, True, 80.0, 8),
    ("bells", [72], 4.0, 12, 3, 0.3, False, 200.0, 6),
    ("mallets", [60], 3.0, 12, 3, 0.1, False, 200.0, 6),
    ("percussion", [60], 2.0, 12, 3, 0.08, False, 80.0, 6),
    ("timpani", [48], 4.0, 12, 3, 0.3, False, 35.0, 8),
    ("guitars", [52], 4.0, 12, 3, 0.2, False, 80.0, 6),
    ("banjos", [60], 3.0, 12, 3, 0.1, False, 90.0, 6),
    ("mandolin", [69], 3.0, 12, 3, 0.12, False, 130.0, 6),
    ("harp", [60], 4.0, 12, 3, 0.15, False, 60.0, 6),
    ("sitar", [60], 4.0, 12, 3, 0.2, False, 90.0, 6),
    ("vocals", [57], 5.0, 12, 2, 0.5, False, 100.0, 20),
    ("choir", [57], 10.0, 12, 2, 1.0, True, 90.0, 18),
]
#: Several sources for instruments of a wide range, and their span.
SEVERAL = {
    "basses": [28, 40, 52], "808-bass": [36, 48], "reese-bass": [40, 52], "pianos": [36, 48, 60, 72], "strings": [45, 57, 69], "brass": [45, 57, 69],
    "winds": [50, 62, 74], "guitars": [40, 52, 64], "harp": [48, 60, 72], "timpani": [41, 53], "lead-supersaw": [60, 72], "banjos": [60, 67],
}
SEVERAL_SPAN = 7


def drums(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(DRUMS, DRUM_SCHEMA)


def pitched(spark: SparkSession, several: bool = True) -> DataFrame:
    rows = [(c, SEVERAL[c], d, SEVERAL_SPAN, *rest) if several and c in SEVERAL else (c, t, d, span, *rest) for c, t, d, span, *rest in PITCHED]
    return spark.createDataFrame(rows, PITCHED_SCHEMA)


def with_profile(df: DataFrame, category: str = "category") -> DataFrame:
    """Each row's drum profile, or the default one. The table has 25 rows, so it is broadcast."""
    dim = F.broadcast(drums(df.sparkSession).withColumnRenamed("category", "_c"))
    names = [c for c in dim.columns if c != "_c"]
    default = dict(zip(names, DRUMS[-1][1:], strict=True))
    met = df.join(dim, F.col(category) == F.col("_c"), "left").drop("_c")
    return met.withColumns({n: F.coalesce(F.col(n), F.lit(default[n])) for n in names})


def with_config(df: DataFrame, category: str = "category", several: bool = True) -> DataFrame:
    """Each row's pitched configuration; a category without one is an error."""
    dim = F.broadcast(pitched(df.sparkSession, several).withColumnRenamed("category", "_c"))
    met = df.join(dim, F.col(category) == F.col("_c"), "left")
    return met.withColumn("targets", F.when(F.col("_c").isNull(), F.raise_error(F.concat(F.lit("no configuration for "), F.col(category))).cast("array<int>")).otherwise(F.col("targets"))).drop("_c")


def drum_reason(read_error: Column, prefilter: Column, duration: Column, onset_ms: Column, decay: Column, reattacks: Column, centroid: Column) -> Column:
    """The first check of a drum that fails, in order of cost; profile columns are read from the row. Effects have no
    onset and no band; a centroid that is null, infinite or not a number is in no band and out of none."""
    fx, known = F.col("kind") == "fx", centroid.isNotNull() & ~F.isnan(centroid) & (F.abs(centroid) < float("inf"))
    return F.coalesce(
        read_error, prefilter,
        first_failure(
            ("too_short", duration < F.col("min_duration")), ("slow_attack", ~fx & (F.col("max_onset_ms") > 0) & (onset_ms > F.col("max_onset_ms"))), ("sustained_no_decay", F.col("expect_decay") & (decay > 0.6)),
            ("multi_hit_loop", F.col("single_hit") & (reattacks >= 1)), ("off_band", known & ~fx & ((centroid < F.col("centroid_lo") / 3) | (centroid > F.col("centroid_hi") * 3))),
        ),
    )


def pitched_reason(read_error: Column, prefilter: Column, onset_ms: Column, body: Column, loudest: Column, sustain: Column, voiced: Column, confidence: Column, cents: Column, polyphonic: Column, tolerance: Column, effect: Column) -> Column:
    """The first check of a pitched sample that fails: prefilter, onset (null: none was found), sustain (``body`` are
    the seconds after the onset), pitch, polyphony. An ``effect`` has no pitch to check; a tolerance that no offset
    reaches leaves pitch measured but unjudged."""
    return F.coalesce(
        read_error, prefilter,
        first_failure(
            ("no_onset", onset_ms.isNull()), ("slow_onset", onset_ms > 300), ("short_body", body < 0.05), ("rms_zero", loudest <= 0), ("short_stab", sustain < F.col("min_sustain")),
            ("no_voiced_frames", ~effect & ~voiced), ("unconfident", ~effect & (confidence < 0.3)), ("wrong_pitch", ~effect & (F.abs(cents) > tolerance)), ("polyphonic", polyphonic),
        ),
    )


def pitched_candidate_score(confidence: Column, cents: Column, sustain: Column, effect: Column) -> Column:
    """Confidence squared, nearness in cents and the share of the wanted sustain; an effect counts as sure and in tune."""
    sure = F.greatest(F.when(effect, F.lit(1.0)).otherwise(confidence), F.lit(1e-6))
    near = F.exp(-F.abs(F.when(effect, F.lit(0.0)).otherwise(cents)) / 50)
    return F.bround(sure * sure * near * F.least(F.lit(1.0), sustain / F.greatest(F.col("min_sustain"), F.lit(1e-3))), 4)
