"""Expressions over small signals and frame series held as arrays; no explode, no shuffle, no Python."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def peak(x: Column) -> Column:
    return F.array_max(F.transform(x, lambda v: F.abs(v)))


def total(x: Column) -> Column:
    return F.aggregate(x, F.lit(0.0), lambda a, v: a + v)


def rms(x: Column) -> Column:
    return F.sqrt(F.aggregate(x, F.lit(0.0), lambda a, v: a + v * v) / F.size(x))


def crest(x: Column) -> Column:
    return F.try_divide(peak(x), rms(x))


def share(x: Column, test) -> Column:
    return F.size(F.filter(x, test)) / F.size(x)


def pregate_reason(x: Column) -> Column:
    """Null where the signal may go on: not finite, then silent, then clipped."""
    bad = F.exists(x, lambda v: F.isnan(v) | (F.abs(v) == float("inf")))
    return F.when(F.size(x) == 0, "empty").when(bad, "nan_or_inf").when(peak(x) < 1e-4, "silent").when(share(x, lambda v: F.abs(v) >= 0.999) > 0.01, "clipped")


def _not_finite(x: Column) -> Column:
    return F.exists(x, lambda v: F.isnan(v) | (F.abs(v) == float("inf")))


def prefilter_reason(left: Column, right: Column | None = None) -> Column:
    """The drum gate's cheap rejects, in its order: level, offset and clipping of the mix, then a dead channel."""
    x = left if right is None else mono(left, right)
    bad = _not_finite(left) if right is None else _not_finite(left) | _not_finite(right)
    out = F.when(F.size(left) == 0, "empty").when(bad, "nan_or_inf").when(peak(x) < 1e-4, "silent")
    out = out.when(F.abs(total(x) / F.size(x)) > 0.1 * peak(x), "dc_offset").when(share(x, lambda v: F.abs(v) >= 0.999) > 0.01, "clipped")
    return out if right is None else out.when((F.least(peak(left), peak(right)) < 1e-4) & (F.greatest(peak(left), peak(right)) > 1e-4), "dead_channel")


def pitched_prefilter_reason(left: Column, right: Column | None = None) -> Column:
    """The pitched gate's: over all channels, a peak under -40 dB, an offset over 0.01, one sample in 10,000 clipped;
    then channels whose levels are more than 40 dB apart."""
    x = left if right is None else F.concat(left, right)
    out = F.when(F.size(x) == 0, "empty").when(_not_finite(x), "nan_or_inf").when(peak(x) < 0.01, "silent")
    out = out.when(F.abs(total(x) / F.size(x)) > 0.01, "dc_offset").when(share(x, lambda v: F.abs(v) >= 0.999) > 1e-4, "clipped")
    if right is None:
        return out
    a, b = rms(left), rms(right)
    return out.when((a > 0) & (b > 0) & (20 * F.log10(F.greatest(a, b) / F.least(a, b)) > 40), "dead_channel")


def longest_run(x: Column, test) -> Column:
    """(start, length) of the first longest run that passes; (-1, 0) if none does."""
    start = F.struct(*(F.lit(v).alias(n) for v, n in ((0, "i"), (0, "run"), (-1, "start"), (0, "length"))))

    def step(a: Column, v: Column) -> Column:
        run = F.when(test(v), a["run"] + 1).otherwise(0)
        better = run > a["length"]
        return F.struct((a["i"] + 1).alias("i"), run.alias("run"), F.when(better, a["i"] - run + 1).otherwise(a["start"]).alias("start"), F.when(better, run).otherwise(a["length"]).alias("length"))

    return F.aggregate(x, start, step, lambda a: F.struct(a["start"].alias("start"), a["length"].alias("length")))


def reattacks(x: Column, low: float = 0.15, high: float = 0.5) -> Column:
    """Hits after the first: armed at or under ``low`` of the peak, fired at or over ``high``."""
    top = F.array_max(x)
    start = F.struct(F.lit(False).alias("hit"), F.lit(False).alias("armed"), F.lit(0).alias("n"))

    def step(a: Column, v: Column) -> Column:
        loud, quiet = v >= high * top, v <= low * top
        fires = a["armed"] & loud
        return F.struct((a["hit"] | loud).alias("hit"), F.when(fires, F.lit(False)).otherwise(a["armed"] | (a["hit"] & quiet)).alias("armed"), (a["n"] + fires.cast("int")).alias("n"))

    return F.aggregate(x, start, step, lambda a: a["n"])


def above(x: Column, least: Column) -> Column:
    """Places of the values whose size is at least ``least``."""
    return F.filter(F.transform(x, lambda v, i: F.when(F.abs(v) >= least, i)), lambda i: i.isNotNull())


def trimmed(x: Column, db: float = -45.0, pad: int = 0) -> Column:
    """From the first to the last value over the level under the peak, with ``pad`` more on both sides."""
    at = above(x, peak(x) * 10 ** (db / 20))
    first, last = F.greatest(F.array_min(at) - pad, F.lit(0)), F.least(F.array_max(at) + pad, F.size(x) - 1)
    return F.slice(x, first + 1, last - first + 1)


def attack(x: Column) -> Column:
    """Steps from the first value of a tenth of the peak to the peak."""
    return F.array_min(above(x, peak(x))) - F.array_min(above(x, peak(x) * 0.1))


def decay_ratio(envelope: Column, tail: float = 0.15) -> Column:
    n = F.greatest(F.lit(1), F.floor(F.size(envelope) * tail).cast("int"))
    return F.try_divide(total(F.slice(envelope, F.size(envelope) - n + 1, n)) / n, F.array_max(envelope))


def peak_normalized(x: Column, to: float = 1.0) -> Column:
    top = peak(x)
    return F.when(top > 0, F.transform(x, lambda v: v * (to / top))).otherwise(x)


def faded(x: Column, n: int) -> Column:
    size, k = F.size(x), F.least(F.lit(n), F.size(x))
    return F.transform(x, lambda v, i: v * F.least(F.lit(1.0), (i + 1) / k) * F.least(F.lit(1.0), (size - i) / k))


def truncated(x: Column, n: int) -> Column:
    return F.slice(x, 1, n)


def mono(left: Column, right: Column) -> Column:
    return F.zip_with(left, right, lambda a, b: (a + b) / 2)
