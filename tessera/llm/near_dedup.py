"""MinHash near-dedup: universal hash minima, banding, signature check, exact check, connected components.

Documents with equal shingle sets form a class and only its smallest id goes on, so copies cost one row each.
Pairs are never emitted per bucket: each class is first checked against one leader (the smallest id that it
shares a band with), which joins a large group of near copies in one linear step. Only buckets that then hold
several components are searched further, block against block and only across components; a task returns at
most a spanning forest of the links that it confirmed. Bands and the least share of equal minima follow from the
threshold: banding misses under 1e-7 of the links at it, (1 - 0.85**5)**28 = 7e-8 at 85 and (1 - 0.8**5)**41 = 9e-8
at 80, and the signature check under one in a billion.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .scratch import forget, partitions, stored, tidy
from .words import U64, run_hashes, seeds, slices, window_starts, word_hashes

WORDS_EACH, PERCENT = 5, 85
ROWS = 5
MOST_MISSED, MOST_UNLIKE = 1e-7, 1e-9
BLOCK = 128
CACHE_LINES = 1 << 15


@functools.cache
def plan(percent: int) -> tuple[int, float]:
    """(bands of ROWS minima, least share of equal minima) for links of at least ``percent``."""
    if not 0 < percent < 100:
        raise ValueError("the threshold is a percentage between 1 and 99")
    t = percent / 100
    bands = math.ceil(math.log(MOST_MISSED) / math.log1p(-(t**ROWS)))
    n = bands * ROWS
    below, least = 0.0, 0
    while True:
        log = math.lgamma(n + 1) - math.lgamma(least + 1) - math.lgamma(n - least + 1) + least * math.log(t) + (n - least) * math.log1p(-t)
        below += math.exp(log)
        if below >= MOST_UNLIKE:
            return bands, least / n
        least += 1


def shingle_sets(column: pa.Array, size: int = WORDS_EACH):
    """The sorted distinct 64-bit hashes of each row's shingles, row by row."""
    for _, data, offsets in slices(column):
        words, first = word_hashes(data, offsets, True)
        n = np.diff(first)
        starts, rows = window_starts(first, size)
        hashes = run_hashes(words, starts, size)
        cuts = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=len(n)))])
        short = np.flatnonzero((n > 0) & (n < size))
        whole = dict(zip(short.tolist(), run_hashes(words, first[:-1][short], n[short]), strict=True)) if len(short) else {}
        for i in range(len(n)):
            yield np.array([whole[i]], U64) if i in whole else np.unique(hashes[cuts[i] : cuts[i + 1]])


def signatures(sets: list[np.ndarray], hashes: int) -> np.ndarray:
    """Minima of ``hashes`` universal functions a*x + b over each non-empty set, the upper 32 bits of each."""
    out = np.empty((len(sets), hashes), np.uint32)
    a, b = seeds(hashes, 1000) | U64(1), seeds(hashes, 5000)
    begin = 0
    while begin < len(sets):
        stop, n = begin, 0
        while stop < len(sets) and (n == 0 or n + len(sets[stop]) <= CACHE_LINES):
            n += len(sets[stop])
            stop += 1
        x = np.concatenate(sets[begin:stop])
        heads = np.cumsum([0, *map(len, sets[begin : stop - 1])])
        for k in range(hashes):
            out[begin:stop, k] = np.minimum.reduceat(x * a[k] + b[k], heads) >> U64(32)
        begin = stop
    return out


def _features(bands: int):
    @tidy
    def run(batches):
        for batch in batches:
            sets = list(shingle_sets(batch.column("text")))
            full = [i for i, x in enumerate(sets) if len(x)]
            signs = signatures([sets[i] for i in full], bands * ROWS)
            kind: list[bytes | None] = [None] * len(sets)
            sign: list[bytes | None] = [None] * len(sets)
            for row, i in enumerate(full):
                x = sets[i]
                kind[i] = np.array([x.sum(dtype=U64), ((x ^ (x >> U64(29))) * U64(0x9FB21C651E98DF25)).sum(dtype=U64), len(x)], U64).tobytes()
                sign[i] = signs[row].tobytes()
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(map(len, sets), pa.int64()), pa.array(kind, pa.binary()), pa.array(sign, pa.binary())], ["id", "n_shingles", "kind", "sign"])

    return run


def _alike(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def _edges(found: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], ["a", "b"])


def _check_leaders(percent: int):
    """Rows sorted by group, the leader's before its members': only the leader's sets are held."""
    least = plan(percent)[1]

    @tidy
    def run(batches):
        group, leaders = None, []
        for batch in batches:
            found = []
            sets = shingle_sets(batch.column("text"))
            signs = [np.frombuffer(x.as_py(), np.uint32) for x in batch.column("sign")]
            for key, part, side, own, mine, sign in zip(*(batch.column(c).to_pylist() for c in ("leader", "part", "side", "id")), sets, signs, strict=True):
                if (key, part) != group:
                    group, leaders = (key, part), []
                if side == 0:
                    leaders.append((mine, sign))
                elif any((sign == s).mean() >= least and _alike(mine, x, percent) for x, s in leaders):
                    found.append((own, key))
            yield _edges(found)

    return run


def _by_task(batches, columns: list[str], of_batch):
    """Rows of one task after the other, as tuples of ``columns`` and what ``of_batch`` makes of each row."""
    task, held = None, []
    for batch in batches:
        for *row, more in zip(*(batch.column(c).to_pylist() for c in columns), of_batch(batch), strict=True):
            if row[0] != task and held:
                yield held
                held = []
            task = row[0]
            held.append((*row, more))
    if held:
        yield held


TASK = ["task", "band", "cross", "id", "comp", "side"]


def _signs(batch) -> list[np.ndarray]:
    return [np.frombuffer(x.as_py(), np.uint32) for x in batch.column("sign")]


def _partners(rows: list[tuple], signs: np.ndarray, percent: int):
    """(place of a row, places of later rows that it may be linked with): other components, this band the first that
    both share, enough equal minima."""
    n_bands, least = plan(percent)
    band, cross = rows[0][1], rows[0][2]
    comps, sides = (np.array([r[k] for r in rows]) for k in (4, 5))
    for i in range(len(rows) - 1):
        same = signs[i + 1 :] == signs[i]
        bands = same.reshape(len(same), n_bands, ROWS).all(2)
        may = (comps[i + 1 :] != comps[i]) & (same.mean(1) >= least) & (bands.argmax(1) == band) & bands[:, band]
        if cross:
            may &= sides[i + 1 :] != sides[i]
        if may.any():
            yield i, np.flatnonzero(may) + i + 1


def _survivors(percent: int):
    """Of the rows of each task, by signatures alone, those that may have a link there: only they need their texts."""

    @tidy
    def run(batches):
        for rows in _by_task(batches, TASK, _signs):
            found = set()
            for i, partners in _partners(rows, np.stack([r[-1] for r in rows]), percent):
                found.update((i, *partners.tolist()))
            kept = [rows[i] for i in sorted(found)]
            kinds = (pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in kept], t) for k, t in enumerate(kinds)], TASK)

    return run


def _check_blocks(percent: int):
    """Rows sorted by task; a task holds at most two blocks. Links across components only, as a spanning forest."""

    def solve(rows: list[tuple]) -> list[tuple[int, int]]:
        parent = {r[4]: r[4] for r in rows}

        def root(x):
            while parent[x] != x:
                parent[x] = x = parent[parent[x]]
            return x

        found = []
        for i, partners in _partners(rows, np.stack([r[-1][0] for r in rows]), percent):
            for j in partners:
                x, y = root(rows[i][4]), root(rows[j][4])
                if x != y and _alike(rows[i][-1][1], rows[j][-1][1], percent):
                    parent[max(x, y)] = min(x, y)
                    found.append((rows[i][3], rows[j][3]))
        return found

    @tidy
    def run(batches):
        for rows in _by_task(batches, TASK, lambda batch: zip(_signs(batch), shingle_sets(batch.column("text")), strict=True)):
            yield _edges(solve(rows))

    return run


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row per input row: ``doc_id``, ``n_shingles``, ``component_id``, ``kept``.

    A-Z are folded, words are ``[^\\x20\\x09-\\x0D]+``, a set holds the distinct runs of five words, or the whole
    sequence where there are fewer. Documents with 100 * |both| >= ``percent`` * |either| are linked, checked on full sets;
    ``component_id`` is the smallest id reachable and ``kept`` says whether it is the row's own. Null or empty
    texts have an empty set and no link. A row with a null id is never linked: its component is null and it is
    kept. Rows with one id are one document: any row's link holds for all of them. Ids are integers. Other
    columns are ignored. An empty table gives an empty table.
    """
    spark = docs.sparkSession
    n, bands = partitions(spark), plan(percent)[0]
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    features = stored(rows.mapInArrow(_features(bands), "id long, n_shingles long, kind binary, sign binary"), "features")
    linked = features.where("kind is not null and id is not null")
    classes = linked.groupBy("kind").agg(F.min("id").alias("rep"))
    of_class = stored(linked.select("id", "kind").distinct().join(classes, "kind").select("id", "rep", "kind"), "classes")
    heads = linked.join(of_class.where("id = rep").select("id", "kind"), ["id", "kind"], "left_semi").dropDuplicates(["id", "kind"])

    key = [F.struct(F.lit(k).alias("band"), F.xxhash64(F.lit(k), F.substring("sign", 4 * ROWS * k + 1, 4 * ROWS)).alias("key")) for k in range(bands)]
    banded = heads.select("id", F.explode(F.array(*key)).alias("x")).select("id", "x.band", "x.key")
    crowded = banded.groupBy("band", "key").agg(F.min("id").alias("leader"), F.max("id").alias("last")).where("leader < last").drop("last")
    members = stored(banded.join(crowded, ["band", "key"]).select("id", "band", "key", "leader"), "members")
    wanted = members.select("id").distinct()
    texts = stored(rows.join(wanted, "id", "left_semi").distinct().join(heads.select("id", "sign").join(wanted, "id", "left_semi").groupBy("id").agg(F.count("*").alias("n"), F.min("sign").alias("sign")), "id").select("id", "text", "sign", "n"), "texts")
    # An id with several texts has a signature for each: they are made anew from the texts.
    held = texts
    texts = texts.where("n = 1").drop("n").unionByName(texts.where("n > 1").select("id", "text").mapInArrow(_sign(bands), "id long, text string, sign binary"))

    pairs = members.where("id <> leader").groupBy("id").agg(F.min("leader").alias("leader"))
    pairs = stored(pairs, "pairs")
    crowd = pairs.groupBy("leader").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"))
    lead = crowd.select("leader", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")).join(texts.withColumnRenamed("id", "leader"), "leader").select("leader", "part", F.lit(0).alias("side"), F.col("leader").alias("id"), "text", "sign")
    rest = pairs.join(crowd, "leader").select("leader", F.pmod(F.xxhash64("id"), "parts").cast("int").alias("part"), F.lit(1).alias("side"), "id").join(texts, "id").select("leader", "part", "side", "id", "text", "sign")
    first = lead.unionByName(rest).repartition(n, "leader", "part").sortWithinPartitions("leader", "part", "side")
    several = of_class.groupBy("id").agg(F.min("rep").alias("a"), F.max("rep").alias("z")).where("a < z")
    tied = of_class.join(several.select("id", "a"), "id").select("a", F.col("rep").alias("b"))
    edges = stored(first.mapInArrow(_check_leaders(percent), "a long, b long").unionByName(tied), "edges")
    comps = components(edges)

    split = members.join(comps.withColumnRenamed("node", "id"), "id", "left").select("id", "band", "key", F.coalesce("component", "id").alias("comp"))
    sizes = split.groupBy("band", "key", "comp").agg(F.count("*").alias("n"))
    open_ = sizes.groupBy("band", "key").agg(F.max_by("comp", "n").alias("big"), F.max("n").alias("nb"), F.sum("n").alias("n"), F.count("*").alias("c")).where("c > 1")
    open_ = open_.select("band", "key", "big", F.ceil(F.col("nb") / BLOCK).cast("int").alias("nb"), F.ceil((F.col("n") - F.col("nb")) / BLOCK).cast("int").alias("no"))
    rows2 = split.join(open_, ["band", "key"]).withColumn("other", F.col("comp") != F.col("big"))
    rows2 = rows2.withColumn("own", F.pmod(F.xxhash64("id"), F.when(F.col("other"), F.col("no")).otherwise(F.col("nb"))).cast("int"))
    against_big = F.transform(F.sequence(F.lit(0), F.col("nb") - 1), lambda j: F.struct(F.lit(True).alias("cross"), F.col("own").alias("lo"), j.alias("hi"), F.lit(0).alias("side"), F.lit(0).alias("kind")))
    against_others = F.transform(F.sequence(F.lit(0), F.col("no") - 1), lambda j: F.struct((F.col("own") != j).alias("cross"), F.least("own", j).alias("lo"), F.greatest("own", j).alias("hi"), F.when(F.col("own") <= j, 0).otherwise(1).alias("side"), F.lit(1).alias("kind")))
    from_big = F.transform(F.sequence(F.lit(0), F.col("no") - 1), lambda i: F.struct(F.lit(True).alias("cross"), i.alias("lo"), F.col("own").alias("hi"), F.lit(1).alias("side"), F.lit(0).alias("kind")))
    tasks = rows2.select("id", "comp", "band", "key", F.explode(F.when(F.col("other"), F.concat(against_big, against_others)).otherwise(from_big)).alias("t"))
    tasks = tasks.select("id", "comp", "band", "t.cross", "t.side", F.xxhash64("band", "key", "t.kind", "t.lo", "t.hi").alias("task"))
    # Every block that stands against another goes with its signatures; texts follow for rows with a likely link.
    first_look = tasks.join(texts.select("id", "sign"), "id").select(*TASK, "sign").repartition(n, "task").sortWithinPartitions("task")
    likely = first_look.mapInArrow(_survivors(percent), "task long, band int, cross boolean, id long, comp long, side int")
    second = likely.join(texts, "id").select(*TASK, "sign", "text").repartition(n, "task").sortWithinPartitions("task")
    more = stored(second.mapInArrow(_check_blocks(percent), "a long, b long"), "more")
    if more.limit(1).count():
        comps = components(edges.unionByName(more))
    for done in (members, held, pairs, edges, more):
        forget(done)

    names = of_class.select("id", "kind", "rep").join(comps, F.col("rep") == F.col("node"), "left").select("id", "kind", F.coalesce("component", "rep").alias("component"))
    out = features.select("id", "n_shingles", "kind").join(names, ["id", "kind"], "left")
    return out.select(F.col("id").alias("doc_id"), "n_shingles", F.coalesce("component", "id").alias("component_id"), F.coalesce(F.col("id") == F.coalesce("component", "id"), F.lit(True)).alias("kept"))


def _sign(bands: int):
    @tidy
    def run(batches):
        for batch in batches:
            sets = list(shingle_sets(batch.column("text")))
            full = [i for i, x in enumerate(sets) if len(x)]
            signs = signatures([sets[i] for i in full], bands * ROWS)
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(full, pa.int64())), batch.column("text").take(pa.array(full, pa.int64())), pa.array([x.tobytes() for x in signs], pa.binary())], ["id", "text", "sign"])

    return run


def op2_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))
