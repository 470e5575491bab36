"""Scalar expressions over columns; all stay in generated code."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Pitch class names from C.
NOTES = ("C", "C#", "D", "D#", "E", "F", "F#", "G", "G#", "A", "A#", "B")


def normalized(text: Column) -> Column:
    """Lower case, runs of white space as one space, trimmed."""
    return F.trim(F.regexp_replace(F.lower(text), r"(?U)\s+", " "))


def token_set(text: Column) -> Column:
    """Distinct words of the normalised text; a comma parts words."""
    return F.array_distinct(F.filter(F.split(normalized(F.replace(text, F.lit(","), F.lit(" "))), " "), lambda w: w != ""))


def short_id(*parts: Column) -> Column:
    """First eight hex digits of the SHA-1 of the parts joined by colons."""
    return F.substring(F.sha1(F.concat_ws(":", *(p.cast("string") for p in parts)).cast("binary")), 1, 8)


def db_to_amplitude(db: Column) -> Column:
    return F.pow(F.lit(10.0), db / 20)


def amplitude_to_db(a: Column) -> Column:
    """20 log10; minus infinity at or under 0."""
    return F.when(a > 0, 20 * F.log10(a)).otherwise(F.lit(float("-inf")))


def midi_to_hz(midi: Column) -> Column:
    return 440 * F.pow(F.lit(2.0), (midi - 69) / 12)


def hz_to_midi(hz: Column) -> Column:
    """Null at or under 0."""
    return F.when(hz > 0, 69 + 12 * F.log2(hz / 440))


def cents(a: Column, b: Column) -> Column:
    return F.when((a > 0) & (b > 0), 1200 * F.log2(a / b))


def half_even(x: Column, digits: int = 0) -> Column:
    """Ties go to the even neighbour."""
    return F.bround(x, digits)


def floor_div(a: Column, b: int) -> Column:
    return F.floor(a / b).cast("int")


def note_name(midi: Column) -> Column:
    names = F.array(*map(F.lit, NOTES))
    return F.concat(F.get(names, F.pmod(midi, F.lit(12)).cast("int")), (F.floor(midi / 12) - 1).cast("string"))


def clipped(x: Column, low: float, high: float) -> Column:
    return F.greatest(F.least(x, F.lit(high)), F.lit(low))


def display_name(slug: Column) -> Column:
    return F.initcap(F.replace(slug, F.lit("-"), F.lit(" ")))


def replace_first(text: Column, old: str, new: str) -> Column:
    at = F.instr(text, old)
    return F.when(at > 0, F.concat(F.substring(text, F.lit(1), at - 1), F.lit(new), F.substring(text, at + len(old), F.length(text)))).otherwise(text)


def padded(number: Column, width: int = 3) -> Column:
    return F.lpad(number.cast("string"), width, "0")


def bar(count: Column, total: Column, width: int = 30) -> Column:
    return F.repeat(F.lit("#"), F.coalesce(F.bround(F.try_divide(width * count, total)), F.lit(0)).cast("int"))


def percent(x: Column) -> Column:
    return F.when(x.isNotNull(), F.format_string("%.1f%%", 100 * x)).otherwise("n/a")


def octave_reseat(pitch_class: Column, target: Column) -> Column:
    """The pitch of that class which is nearest to the target; of two, the lower."""
    base = target - F.pmod(target, F.lit(12)) + pitch_class
    return F.array_min(F.transform(F.array(base - 12, base, base + 12), lambda p: F.struct(F.abs(p - target).alias("d"), p.alias("p"))))["p"]


def band_nearness(centroid: Column, low: Column, high: Column) -> Column:
    """A bell over the logarithm of the centroid around the band's middle: 0 at 0 Hz, no number below, null for null."""
    bell = F.exp(-F.pow((F.ln(centroid) - F.ln(F.sqrt(low * high))) / 0.9, F.lit(2)))
    return F.when(centroid == 0, 0.0).when(centroid < 0, float("nan")).otherwise(bell)  # ln is null there in Spark


def drum_score(centroid: Column, low: Column, high: Column, decay: Column, attack: Column, crest: Column, unknown: float | None = 0.5) -> Column:
    """Nearness to the profile's band times envelope factors; 4 decimals. An unknown centroid (null, no number, not above
    0) counts ``unknown``; with None it counts what ``band_nearness`` gives."""
    near = band_nearness(centroid, low, high)
    if unknown is not None:
        near = F.when(centroid.isNull() | F.isnan(centroid) | (centroid <= 0), F.lit(unknown)).otherwise(near)
    return F.bround(near * (0.4 + 0.6 * decay) * (0.4 + 0.6 * attack) * (0.5 + 0.5 * F.least(F.lit(1.0), crest / 12)), 4)


def pitched_score(confidence: Column, cents_off: Column, sustain: Column) -> Column:
    return F.pow(confidence, F.lit(2)) * F.exp(-F.abs(cents_off) / 50) * sustain


def effective_root(measured: Column, target: Column, most: Column) -> Column:
    """The target where the correction is at most ``most`` semitones, else the measured pitch rounded half to even."""
    return F.when(measured.isNull() | (F.abs(measured - target) <= most), target).otherwise(F.bround(measured).cast("int"))


SEMITONE = math.pow(2.0, 1 / 12)
