"""From prompts to winners with a pluggable generator; the default one is a deterministic synthesiser."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dsp
from ..operators.gates import best_of_group, failed_groups, first_failure
from ..operators.jobs import fan_out_targets, fan_out_variants, ordered_dedup, prompt_lines, with_job_ids
from ..sources import wav

RATE = 8000


#: Seconds of sustain that a synthesised sample must have.
LEAST_SUSTAIN = 0.05


def synthesise(target: float, seed: int, seconds: float) -> np.ndarray:
    """A tone with a decay and a little noise; every ninth seed is silent and every seventh clipped."""
    x = dsp.tone(target, seconds, RATE) * np.exp(-3 * np.arange(int(seconds * RATE)) / RATE)
    x += np.random.default_rng(seed).normal(0, 1e-3, len(x))
    return (x * (0.0 if seed % 9 == 0 else 20.0 if seed % 7 == 0 else 1.0)).astype(np.float32)


def generated(units: DataFrame, backend: Callable[[float, int, float], np.ndarray] = synthesise) -> DataFrame:
    """id, variant_index, target, content: one WAV a unit; a unit's seed depends on its id and variant alone."""

    def run(batches):
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("target", "unit_seed", "duration")), strict=True)
            blobs = [wav.encode(backend(t, s, d), RATE) for t, s, d in rows]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("variant_index"), batch.column("target"), pa.array(blobs, pa.binary())], ["id", "variant_index", "target", "content"])

    seeded = units.withColumn("unit_seed", F.pmod(F.xxhash64("id", "variant_index"), F.lit(1 << 31)))
    return seeded.select("id", "variant_index", F.col("target").cast("double").alias("target"), "unit_seed", F.col("duration").cast("double").alias("duration")).mapInArrow(run, "id string, variant_index int, target double, content binary")


def _kernel(x: np.ndarray, rate: int) -> dict:
    mono = x.mean(1)
    peak = float(np.abs(mono).max(initial=0))
    level = dsp.rms_envelope(mono)
    midi, strength = dsp.autocorrelation_midi(mono, rate) if peak > 1e-4 else (float("nan"), 0.0)
    return {
        "duration": len(mono) / rate, "peak": peak, "clipped": float((np.abs(mono) >= 0.999).mean()) if len(mono) else 0.0, "sustain": dsp.sustain_seconds(mono, rate),
        "decay": float(level[-max(1, int(len(level) * 0.15)) :].mean() / level.max()) if level.max(initial=0) > 0 else None, "midi": None if np.isnan(midi) else midi, "confidence": strength,
    }


def gated(wavs: DataFrame) -> DataFrame:
    """A verdict for each signal: metrics, the first failed check, whether it passed and its score."""
    met = wav.measured(wavs.withColumn("key", F.struct("id", "variant_index", "target")).select("key", "content"), _kernel, "duration double, peak double, clipped double, sustain double, decay double, midi double, confidence double", key="key")
    reason = F.coalesce("read_error", first_failure(("silent", F.col("peak") < 1e-4), ("clipped", F.col("clipped") > 0.01), ("rms_zero", F.col("decay").isNull()), ("short_stab", F.col("sustain") < LEAST_SUSTAIN), ("unconfident", F.col("confidence") < 0.3)))
    off = F.col("midi") - F.col("key.target")
    quality = F.least(F.lit(1.0), F.col("sustain") / LEAST_SUSTAIN)
    score = F.pow("confidence", F.lit(2)) * F.exp(-F.abs(100 * (off - 12 * F.bround(off / 12))) / 50) * quality
    return met.select("key.*", "midi", "confidence", "sustain", reason.alias("reason"), reason.isNull().alias("passed"), F.bround(score, 4).alias("score"))


def campaign(texts: DataFrame, targets: list[int], variants: int, seconds: float = 0.5, limit: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(winners, failures) of all prompts of (category, text): jobs, units, signals, verdicts, best of each job."""
    lines = ordered_dedup(prompt_lines(texts, ["category"]), "category", ["line_no"])
    jobs = with_job_ids(lines, "category", ["line_no"], 2001)
    if limit:
        jobs = jobs.where(F.col("seed") < 2001 + limit)
    jobs = fan_out_targets(jobs.withColumn("targets", F.array(*map(F.lit, targets))), "targets")
    jobs = jobs.withColumn("id", F.concat_ws("-", "id", "target")).withColumns({"variants": F.lit(variants), "duration": F.lit(seconds)})
    verdicts = gated(generated(fan_out_variants(jobs, "variants")))
    return best_of_group(verdicts, ["id"], "score", "variant_index", "passed"), failed_groups(verdicts, ["id"], "reason", "passed")
