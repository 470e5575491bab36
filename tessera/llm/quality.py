"""Quality classifier: a weak-label model over heuristic labellers, and a hashed linear scorer trained on it.

1. Every document gets the votes of overlapping heuristic labellers, for two questions: junk and toxic.
2. For each question, expectation-maximisation on the counts of vote patterns over the whole corpus (at most
   2**labellers rows for each label, whatever the corpus) estimates how often each labeller fires on bad and on good
   documents. Where people's labels are given, those documents' posteriors are fixed to them, which anchors the rest.
3. The posteriors label a bounded sample: of each side of each question SAMPLE documents, labelled ones first, then
   those of smallest hash; where there are enough labels, the good ones are labelled ones, and WEAK bad ones that only
   the label model judges are added, with their posteriors as targets. A logistic scorer over hashed words, word beginnings and bucketed shape features is trained
   on it; its bias is then set to the corpus's share of bad documents.
4. The scorer rates every document.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import partitions, stored, tidy
from .words import SPACE, U64, mix, seeds, slices, span_hashes, word_bounds, word_hashes

#: Insults that the toxicity labellers look for, in three overlapping lists.
INSULTS = (
    ("clown", "disgusting", "dumb", "fool", "idiot", "imbecile", "loser", "moron", "pathetic", "scum"),
    ("bastard", "clown", "idiot", "jerk", "moron", "pathetic", "stupid", "trash", "vermin", "worthless"),
    ("crap", "disgusting", "filth", "loser", "scum", "shit", "stupid", "suck", "trash", "worthless"),
)
BITS = 20
STARTS = (4, 5, 6, 7)
DIMENSIONS = 1 << BITS
SAMPLE, WEAK = 4000, 1000
LEAST_DEVIATIONS = 4.0
TRAIN_ROWS = 256
#: Documents under this posterior may be examples of good ones.
SURELY_GOOD = 0.01
LEAST_LABELLED = 20
#: Letting toxic text through costs more than losing a clean one.
THRESHOLDS = {"junk": 0.5, "toxic": 0.2}
JUNK = ("symbols", "bangs", "capitals", "pipes", "one_word", "stutter", "few_letters", "few_types", "odd_length", "no_words")
TOXIC = ("insults_a", "insults_b", "insults_c", "two_insults", "dense_insults")
BETWEEN = np.ones(256, bool)
BETWEEN[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


def _hash_of(word: str) -> int:
    data = np.frombuffer(word.encode(), np.uint8)
    return int(word_hashes(data, np.array([0, len(data)]), True, BETWEEN)[0][0])


INSULT_HASHES = [np.sort(np.array([_hash_of(x) for x in words], U64)) for words in INSULTS]


def _sums(flags: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Sum of ``flags`` between consecutive ``cuts``."""
    return np.diff(np.concatenate([[0], np.cumsum(flags)])[cuts])


def shapes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shape shares of each row, hashes of its word tokens, index of each row's first token)."""
    n = len(offsets) - 1
    if not len(data):
        return np.zeros((n, 9)), np.zeros(0, U64), np.zeros(n + 1, np.int64)
    begin, end = word_bounds(data, offsets)
    first = np.searchsorted(begin, offsets)
    words = np.maximum(np.diff(first), 1)
    upper, lower = (data >= 65) & (data <= 90), (data >= 97) & (data <= 122)
    ups, lows = (np.concatenate([[0], np.cumsum(x)]) for x in (upper, lower))
    caps = (ups[end] - ups[begin] >= 2) & (lows[end] == lows[begin])
    tail, before = data[end - 1], data[np.maximum(end - 2, 0)]
    twice = (end - begin >= 2) & (tail == before)
    bangs = twice & (tail == ord("!"))
    symbols = twice & np.isin(tail, np.frombuffer(b"#*%&$@^~=_+<>", np.uint8))
    pipes = (end - begin == 1) & np.isin(tail, np.frombuffer(b"|>/\\", np.uint8))
    tokens, start = word_hashes(data, offsets, True, BETWEEN)
    count = np.diff(start)
    row = np.repeat(np.arange(n), count)
    same = np.zeros(len(tokens), bool)
    same[1:] = (tokens[1:] == tokens[:-1]) & (row[1:] == row[:-1])
    order = np.lexsort((tokens, row))
    fresh = np.ones(len(tokens), bool)
    fresh[1:] = (tokens[order][1:] != tokens[order][:-1]) | (row[order][1:] != row[order][:-1])
    heads = np.flatnonzero(fresh)
    runs = np.diff(np.append(heads, len(tokens)))
    top = np.zeros(n)
    np.maximum.at(top, row[order][heads], runs)
    types = np.bincount(row[order][heads], minlength=n)
    size = np.maximum(np.diff(offsets), 1)
    letters = _sums(upper | lower | (data >= 128), offsets) / np.maximum(_sums(~SPACE[data], offsets), 1)
    count = np.maximum(count, 1)
    out = np.stack([_sums(symbols, first) / words, _sums(bangs, first) / words, _sums(caps, first) / words, _sums(pipes, first) / words, top / count, _sums(same, start) / count, letters, types / count, size / words], 1)
    return out, tokens, start


def votes(share: np.ndarray, tokens: np.ndarray, start: np.ndarray) -> np.ndarray:
    """A bit for each labeller of JUNK and TOXIC."""
    n = np.diff(start)
    long = n >= 20
    junk = [share[:, 0] > 0.05, share[:, 1] > 0.05, share[:, 2] > 0.2, share[:, 3] > 0.05, long & (share[:, 4] > 0.2), long & (share[:, 5] > 0.1), share[:, 6] < 0.8, long & (share[:, 7] < 0.1 + 5 / np.maximum(n, 1)), long & ((share[:, 8] < 2.5) | (share[:, 8] > 20)), n == 0]
    found = [np.isin(tokens, x) for x in INSULT_HASHES]
    each = [_sums(x, start) for x in found]
    total = _sums(np.logical_or.reduce(found), start)
    toxic = [each[0] > 0, each[1] > 0, each[2] > 0, total >= 2, total > 0.002 * n]
    return (np.stack([*junk, *toxic], 1) @ (1 << np.arange(len(junk) + len(toxic)))).astype(np.int32)


@tidy
def _votes(batches):
    for batch in batches:
        out = [votes(*shapes(data, offsets)) for _, data, offsets in slices(batch.column("text"))]
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("key"), pa.array(np.concatenate(out) if out else [], pa.int32())], ["id", "key", "votes"])


def label_model(patterns: np.ndarray, label: np.ndarray, counts: np.ndarray, labellers: int, rounds: int = 200) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expectation-maximisation for one yes-or-no question.

    ``patterns`` are bit masks of labellers that fired, ``label`` is 1 (bad), 0 (good) or -1 (not labelled). Returns
    (posterior of bad for each row, share of bad documents on which each labeller fires, share of good ones). It
    starts from "bad if anything fired".
    """
    fired = (patterns[:, None] >> np.arange(labellers) & 1).astype(float)
    bad = np.where(label >= 0, label, np.where(fired.any(1), 0.9, 0.02)).astype(float)
    for _ in range(rounds):
        weight = np.stack([counts * bad, counts * (1 - bad)])
        prior = np.clip(weight.sum(1) / max(counts.sum(), 1), 1e-6, 1)
        rate = np.clip((weight @ fired + [[0.05], [1e-3]]) / (weight.sum(1, keepdims=True) + 1), 1e-6, 1 - 1e-6)
        # A labeller means "bad": it fires on bad documents more often than on good ones.
        rate[1] = np.minimum(rate[1], rate[0] / 2)
        log = fired @ np.log(rate).T + (1 - fired) @ np.log1p(-rate).T + np.log(prior)
        new = np.where(label >= 0, label, 1 / (1 + np.exp(np.clip(log[:, 1] - log[:, 0], -500, 500))))
        done = np.abs(new - bad).max(initial=0) < 1e-9
        bad = new
        if done:
            break
    return bad, rate[0], rate[1]


def word_starts(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the first k bytes of longer tokens, and the index of each row's first."""
    if not len(data):
        return np.zeros(0, U64), np.zeros(len(offsets), np.int64)
    begin, end = word_bounds(data, offsets, BETWEEN)
    begin = begin[end - begin > k]
    return mix(span_hashes(data, begin, begin + k, True) + seeds(1, k)[0]), np.searchsorted(begin, offsets)


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashed features of all rows, index of each row's first): two places for each distinct token, beginning of a
    longer token and shape bucket."""
    share, tokens, start = shapes(data, offsets)
    n = len(start) - 1
    bucket = np.minimum((share * [20, 20, 20, 20, 20, 20, 20, 20, 1]).astype(np.int64), 40)
    shape = mix(bucket.astype(U64) + np.arange(9, dtype=U64) * U64(64) + seeds(1, 31)[0])
    begins = [word_starts(data, offsets, k) for k in STARTS]
    each = []
    for i in range(n):
        parts = [tokens[start[i] : start[i + 1]], shape[i], *(h[at[i] : at[i + 1]] for h, at in begins)]
        each.append(np.unique(np.concatenate(parts)))
    both = np.concatenate(each) if each else np.zeros(0, U64)
    at = np.cumsum([0, *map(len, each)])
    low = (both & U64(DIMENSIONS - 1)).astype(np.int32)
    high = (both >> U64(64 - BITS)).astype(np.int32) + DIMENSIONS
    return np.stack([low, high], 1).reshape(-1), 2 * at


@tidy
def _features(batches):
    for batch in batches:
        row = 0
        for _, data, offsets in slices(batch.column("text")):
            x, at = features(data, offsets)
            n = len(at) - 1
            yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(row, n) for c in ("key", "own", "label")), pa.array([v.tobytes() for v in np.split(x, at[1:-1])], pa.binary())], ["key", "own", "label", "x"])
            row += len(at) - 1


def train(x: list[np.ndarray], target: np.ndarray, rounds: int = 400, ridge: float = 1e-4) -> tuple[np.ndarray, float]:
    """Logistic regression by Adagrad over all rows each round.

    Only features whose shares of bad and of good documents differ by LEAST_DEVIATIONS or more have a weight, and each
    is scaled by its smoothed log ratio, so what few documents share can't be learnt by heart. ``x`` is used up: each
    row is cut down to its features with a weight, and a round goes over TRAIN_ROWS rows at a time.
    """
    weight, bias = np.zeros(2 * DIMENSIONS, np.float32), 0.0
    on_bad, on_good = np.zeros(2 * DIMENSIONS, np.float32), np.zeros(2 * DIMENSIONS, np.float32)
    for v, t in zip(x, target, strict=True):  # row by row: the driver never holds a second copy of the features
        on_bad[v] += t
        on_good[v] += 1 - t
    n_bad, n_good = target.sum(), (1 - target).sum()
    some = np.flatnonzero(on_bad + on_good > 0)
    share = (on_bad[some] + on_good[some]) / len(x)
    deviations = (on_bad[some] / n_bad - on_good[some] / n_good) / np.sqrt(np.clip(share * (1 - share), 1e-9, 1) * (1 / n_bad + 1 / n_good))
    used = some[np.abs(deviations) >= LEAST_DEVIATIONS]
    scale = (np.log((on_bad[used] + 1) / (n_bad + 2)) - np.log((on_good[used] + 1) / (n_good + 2))).astype(np.float64)
    own = np.full(2 * DIMENSIONS, -1, np.int32)
    own[used] = np.arange(len(used))
    del on_bad, on_good
    n = len(x)
    for i in range(n):
        y = own[x[i]]
        x[i] = y[y >= 0]
    del own
    blocks = []
    while x:
        some = x[:TRAIN_ROWS]
        del x[:TRAIN_ROWS]
        blocks.append((np.array([len(v) for v in some]), np.concatenate(some)))
    w, seen, seen_bias = np.zeros(len(used)), np.full(len(used), 1e-8), 1e-8
    for _ in range(rounds):
        slope, slope_bias, first, scaled = np.zeros(len(used)), 0.0, 0, w * scale
        for sizes, flat in blocks:
            row = np.repeat(np.arange(len(sizes)), sizes)
            p = 1 / (1 + np.exp(-np.clip(np.bincount(row, scaled[flat], len(sizes)) + bias, -30, 30)))
            error = (p - target[first : first + len(sizes)]) / n
            slope += np.bincount(flat, error[row], len(used))
            slope_bias += error.sum()
            first += len(sizes)
        slope = slope * scale + ridge * w
        seen += slope**2
        w -= 0.1 * slope / np.sqrt(seen)
        seen_bias += slope_bias**2
        bias -= 0.1 * slope_bias / np.sqrt(seen_bias)
    weight[used] = w * scale
    return weight, float(bias)


def fit(docs: DataFrame, labels: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> dict:
    """The label models and scorers; the driver gets vote patterns and at most 2.5 * ``sample`` feature rows for each question.

    ``labels`` has ``id_col``, ``quality`` (0: junk) and ``toxic`` (1: toxic); nulls and ids that are not there are
    fine, and of several rows for one id the worst counts.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.select("id", F.xxhash64("id", "text").alias("key"), "text")
    kind = docs.schema[id_col].dataType.simpleString()
    seen = rows.mapInArrow(_votes, f"id {kind}, key long, votes int")
    if labels is not None:
        known = labels.groupBy(F.col(id_col).alias("id")).agg((1 - F.min("quality")).cast("int").alias("junk"), F.max("toxic").cast("int").alias("toxic"))
        seen = seen.join(known, "id", "left").select("key", "votes", F.coalesce("junk", F.lit(-1)).alias("junk"), F.coalesce("toxic", F.lit(-1)).alias("toxic"))
    else:
        seen = seen.select("key", "votes", F.lit(-1).alias("junk"), F.lit(-1).alias("toxic"))
    seen = stored(seen, "votes")
    counted = seen.groupBy("votes", "junk", "toxic").count().collect()
    mask = np.array([r["votes"] for r in counted], np.int64)
    count = np.array([r["count"] for r in counted], float)
    model: dict = {}
    for name, low, n in (("junk", 0, len(JUNK)), ("toxic", len(JUNK), len(TOXIC))):
        part = mask >> low & (1 << n) - 1
        label = np.array([r[name] for r in counted], np.int64)
        bad, on_bad, on_good = label_model(part, label, count, n)
        posterior = {(int(m), int(k)): float(p) for m, k, p in zip(part, label, bad, strict=True)}
        model[name] = {"posterior": posterior, "on_bad": on_bad, "on_good": on_good, "weight": np.zeros(2 * DIMENSIONS, np.float32), "bias": -10.0}
        own = F.shiftright("votes", low).bitwiseAND((1 << n) - 1)
        least = max(SURELY_GOOD, min(posterior.values(), default=0))
        judged = min(count[label == k].sum() for k in (0, 1)) >= LEAST_LABELLED
        counts = count * (label >= 0) if judged else count
        share = float(np.clip(counts @ bad / max(counts.sum(), 1), 1e-4, 0.9999))
        side = F.lit("unsure")
        for k in (-1, 0, 1):
            for word, fits in (("bad", lambda p: p >= 0.5), ("good", lambda p, least=least: p <= least)):
                those = sorted({m for (m, j), p in posterior.items() if j == k and fits(p)})
                side = F.when((F.col(name) == k) & own.isin(those), word).otherwise(side)
        sided = seen.select("key", own.alias("own"), F.col(name).alias("label"), side.alias("side")).dropDuplicates(["key"])
        order = [F.col("label") < 0, F.xxhash64("key")]
        # Labellers are blind to some bad documents, so silence is no proof: with enough labels only those are good.
        few = [("bad", "label >= 0", sample), ("bad", "label < 0", max(1, sample * WEAK // SAMPLE)), ("good", "label >= 0", sample)] if judged else [("bad", "true", sample), ("good", "true", sample)]
        parts = [sided.where(f"side = '{word}' and {which}").orderBy(*order).limit(n) for word, which, n in few]
        picked = stored(functools.reduce(DataFrame.union, parts).select("key", "own", "label"), "picked")  # at most 2.5 * sample rows
        met = rows.join(F.broadcast(picked), "key").dropDuplicates(["key"]).select("key", "own", "label", "text").repartition(partitions(docs.sparkSession), "key")
        got = sorted((r["key"], posterior[r["own"], r["label"]], np.frombuffer(r["x"], np.int32)) for r in met.mapInArrow(_features, "key long, own int, label int, x binary").toLocalIterator())
        target = np.array([p for _, p, _ in got])
        if 0 < (target >= 0.5).sum() < len(target):
            x = [v for _, _, v in got]
            del got  # train() frees the rows as it goes
            model[name]["weight"], bias = train(x, target)
            here = float(np.clip(target.mean(), 1e-4, 0.9999))
            model[name]["bias"] = bias + float(np.log(share / (1 - share)) - np.log(here / (1 - here)))
    return model


def _score(shared):
    @tidy
    def run(batches):
        model = shared.value
        for batch in batches:
            row = 0
            for _, data, offsets in slices(batch.column("text")):
                x, at = features(data, offsets)
                scores = []
                for name in ("junk", "toxic"):
                    weight, bias = model[name]
                    total = np.diff(np.concatenate([[0], np.cumsum(weight[x], dtype=np.float64)])[at]) + bias
                    scores.append(1 / (1 + np.exp(-np.clip(total, -30, 30))))
                n = len(at) - 1
                columns = [c.slice(row, n) for k, c in zip(batch.schema.names, batch.columns, strict=True) if k != "text"]
                yield pa.RecordBatch.from_arrays([*columns, *map(pa.array, scores)], [*(k for k in batch.schema.names if k != "text"), "junk", "toxic"])
                row += n

    return run


def rate(docs: DataFrame, model: dict, carry: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """The ``carry`` columns, ``junk`` and ``toxic`` (0 to 1) and ``kept``: both are under THRESHOLDS.

    A null or empty text has no words and is rated by its shape alone. Repeated rows get equal rates; ids may be null
    or tied. Only ``carry`` is passed on, under its own names. An empty table gives an empty table.
    """
    shared = docs.sparkSession.sparkContext.broadcast({k: (v["weight"], v["bias"]) for k, v in model.items()})
    names = [f"carry{i}" for i in range(len(carry))]
    rows = docs.select(*(F.col(c).alias(a) for c, a in zip(carry, names, strict=True)), F.col(text_col).cast("string").alias("text"))
    schema = ", ".join([*(f"{a} {docs.schema[c].dataType.simpleString()}" for c, a in zip(carry, names, strict=True)), "junk double, toxic double"])
    out = rows.mapInArrow(_score(shared), schema)
    return out.select(*(F.col(a).alias(c) for c, a in zip(carry, names, strict=True)), "junk", "toxic", ((F.col("junk") < THRESHOLDS["junk"]) & (F.col("toxic") < THRESHOLDS["toxic"])).alias("kept"))


def classify(docs: DataFrame, labels: DataFrame | None = None, carry: tuple[str, ...] = ("doc_id",), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return rate(docs, fit(docs, labels, id_col, text_col), carry, text_col)


def op4_quality(spark, sf_dir: str) -> DataFrame:
    return classify(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
