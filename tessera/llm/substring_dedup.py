"""Substring dedup: Rabin-Karp hashes of every window of words, counted in Spark, merged to removal spans.

Plan, with every step bounded by a block or a bucket and never by how often a passage occurs:
1. rows are dealt to blocks by a hash of the row; a block sends each of its distinct window hashes once,
   as sorted deltas, to the bucket that owns that range of hashes (the pre-aggregation: a passage in a
   third of all rows costs one entry a block);
2. a bucket tells every block, by a bit for each hash that it sent, which of them another block holds too;
3. blocks send the windows of those hashes again, by a second hash of another kind, and get bits for these;
4. a block marks windows of which both hashes were answered, or which it holds twice itself by both, merges
   overlapping windows to maximal spans and drops the words inside.
The text is shuffled once: steps 1, 3 and 4 read the same exchange. A window of n that is no repeat is taken for one by
chance if both its hashes are met, by any windows: n * (n / 2**64)**2 expected.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import even_labels, partitions, tidy, vacate
from .words import U64, run_hashes, second_hashes, second_run_hashes, slices, window_starts, word_bounds, word_hashes

#: Blocks and buckets that each partition holds; answers are at most blocks * buckets rows.
BLOCKS_EACH, BUCKETS_EACH = 2, 1


def packed(values: np.ndarray) -> bytes:
    """Sorted distinct hashes as deltas of as many bytes as the largest needs; the first byte says how many."""
    deltas = np.diff(values, prepend=U64(0))
    width = max(1, (int(deltas.max()).bit_length() + 7) // 8)
    return bytes([width]) + deltas.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unpacked(blob: bytes) -> np.ndarray:
    width = blob[0]
    wide = np.zeros(((len(blob) - 1) // width, 8), np.uint8)
    wide[:, :width] = np.frombuffer(blob, np.uint8, offset=1).reshape(-1, width)
    return np.cumsum(wide.reshape(-1).view("<u8"), dtype=U64)


class Windows:
    """The windows of a run of rows: ``starts`` (by word), ``rows`` and ``hashes``, each window's."""

    def __init__(self, row: int, data: np.ndarray, offsets: np.ndarray, window: int) -> None:
        self.row, self.window, self.data, self.offsets = row, window, data, offsets
        words, self.first = word_hashes(data, offsets, False)
        self.starts, self.rows = window_starts(self.first, window)
        self.hashes = run_hashes(words, self.starts, window)

    def among(self, sorted_: np.ndarray) -> np.ndarray:
        """Places of the windows whose hash is in ``sorted_``."""
        if not len(sorted_) or not len(self.hashes):
            return np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(sorted_, self.hashes), len(sorted_) - 1)
        return np.flatnonzero(sorted_[at] == self.hashes)

    def seconds(self, places: np.ndarray) -> np.ndarray:
        """The second hashes of some windows; only the rows they are in are looked into."""
        out, rows = np.zeros(len(places), U64), self.rows[places]
        if not len(places):
            return out
        used = np.unique(rows)
        sizes = np.diff(self.offsets)[used]
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        data = np.concatenate([self.data[self.offsets[r] : self.offsets[r + 1]] for r in used])
        begin, end = word_bounds(data, offsets)
        first = np.searchsorted(begin, offsets)
        moved = self.starts[places] - self.first[rows] + first[np.searchsorted(used, rows)]
        return second_run_hashes(second_hashes(data, begin, end), moved, self.window)


def windows_of(column: pa.Array, window: int):
    for row, data, offsets in slices(column):
        yield Windows(row, data, offsets, window)


def heavy(first: np.ndarray, second: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Whether the weights of all entries with an entry's pair of hashes add up to two or more."""
    if not len(first):
        return np.zeros(0, bool)
    order = np.lexsort((second, first))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (first[order][1:] != first[order][:-1]) | (second[order][1:] != second[order][:-1])
    group = np.cumsum(fresh) - 1
    out = np.zeros(len(order), bool)
    out[order] = (np.bincount(group, weight[order]) >= 2)[group]
    return out


def dealt_out(values: np.ndarray, buckets: int) -> list[tuple[int, np.ndarray]]:
    """(bucket, its part) of sorted hashes; a bucket owns a range of them."""
    bucket = (((values >> U64(32)) * U64(buckets)) >> U64(32)).astype(np.int64)
    cuts = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(values)]
    return [(int(bucket[i]), values[i:j]) for i, j in zip(cuts[:-1], cuts[1:], strict=True) if i < j]


def _sent(block: int, values: np.ndarray, labels: list[int]) -> list[tuple]:
    return [(labels[k], block, packed(part)) for k, part in dealt_out(values, len(labels))]


def answered(values: np.ndarray, answers: pa.Table, round_: int, labels: list[int]) -> np.ndarray:
    """Those of a block's sorted hashes whose bits are set."""
    bits = {r["bucket"]: r["bits"] for r in answers.select(["bucket", "round", "bits"]).to_pylist() if r["round"] == round_}
    found = [part[np.unpackbits(np.frombuffer(bits[labels[k]], np.uint8), count=len(part)).astype(bool)] for k, part in dealt_out(values, len(labels)) if labels[k] in bits]
    return np.concatenate([np.zeros(0, U64), *found])


SENT, BITS = ["bucket", "block", "hashes"], ["bucket", "block", "round", "bits"]


def _send(window: int, labels: list[int]):
    @tidy
    def run(batches):
        held: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            blocks = batch.column("block").to_numpy()
            for x in windows_of(batch.column("text"), window):
                of = blocks[x.row :][x.rows]
                order = np.argsort(of, kind="stable")
                cuts = np.flatnonzero(np.diff(of[order])) + 1
                for part in np.split(order, cuts):
                    if len(part):
                        held.setdefault(int(of[part[0]]), []).append(x.hashes[part])
        for block, parts in held.items():
            values = np.unique(np.concatenate(parts))
            parts.clear()
            rows = _sent(block, values, labels)
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int32(), pa.int32(), pa.binary()))], SENT)

    return run


def _answer(round_: int):
    def run(table: pa.Table) -> pa.Table:
        blocks = table.column("block").to_pylist()
        parts = [unpacked(x.as_py()) for x in table.column("hashes")]
        values = np.concatenate(parts)
        order = np.argsort(values, kind="stable")
        same = np.zeros(len(values) + 1, bool)
        same[1:-1] = values[order][1:] == values[order][:-1]
        shared = np.zeros(len(values), bool)
        shared[order] = same[1:] | same[:-1]
        ends = np.cumsum([len(x) for x in parts]).tolist()
        bits = [np.packbits(shared[i:j]).tobytes() if shared[i:j].any() else None for i, j in zip([0, *ends[:-1]], ends, strict=True)]
        kept = [k for k, x in enumerate(bits) if x is not None]
        bucket = table.column("bucket")[0].as_py()
        return pa.table({"bucket": pa.array([bucket] * len(kept), pa.int32()), "block": pa.array([blocks[k] for k in kept], pa.int32()), "round": pa.array([round_] * len(kept), pa.int32()), "bits": pa.array([bits[k] for k in kept], pa.binary())})

    return run


class Block:
    """A block's windows, and which of their hashes were answered in the first round."""

    def __init__(self, docs: pa.Table, answers: pa.Table, window: int, labels: list[int]) -> None:
        self.docs = docs.combine_chunks()
        self.texts = self.docs.column("text").combine_chunks() if docs.num_rows else pa.array([], pa.string())
        self.runs = list(windows_of(self.texts, window))
        values = np.sort(np.concatenate([np.zeros(0, U64), *(x.hashes for x in self.runs)]))
        fresh = np.ones(len(values), bool)
        fresh[1:] = values[1:] != values[:-1]
        self.twice = np.unique(values[~fresh])
        self.shared = answered(values[fresh], answers, 1, labels)

    def second_hashes(self, places: list[np.ndarray]) -> list[np.ndarray]:
        return [x.seconds(p) for x, p in zip(self.runs, places, strict=True)]

    def asked(self) -> np.ndarray:
        """The sorted second hashes of the windows that were answered."""
        return np.unique(np.concatenate([np.zeros(0, U64), *self.second_hashes([x.among(self.shared) for x in self.runs])]))


def _ask_again(window: int, labels: list[int]):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        try:
            rows = []
            if docs.num_rows and answers.num_rows:
                rows = _sent(docs.column("block")[0].as_py(), Block(docs, answers, window, labels).asked(), labels)
            return pa.table({c: pa.array([r[k] for r in rows], t) for k, (c, t) in enumerate(zip(SENT, (pa.int32(), pa.int32(), pa.binary()), strict=True))})
        finally:
            vacate()

    return run


def _remove(window: int, labels: list[int], carried: list[str]):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        try:
            return removed(Block(docs, answers, window, labels), answers)
        finally:
            vacate()

    def removed(block: Block, answers: pa.Table) -> pa.Table:
        maybe = np.sort(np.concatenate([block.twice, block.shared]))
        places = [x.among(maybe) for x in block.runs]
        firsts = np.concatenate([np.zeros(0, U64), *(x.hashes[p] for x, p in zip(block.runs, places, strict=True))])
        seconds = np.concatenate([np.zeros(0, U64), *block.second_hashes(places)])
        outside = np.isin(firsts, block.shared)
        hits = heavy(firsts, seconds, np.ones(len(firsts)))
        hits |= outside & np.isin(seconds, answered(np.unique(seconds[outside]), answers, 2, labels))
        done, n_words, n_removed, kept = 0, [], [], []
        for x, p in zip(block.runs, places, strict=True):
            hit = x.starts[p[hits[done : done + len(p)]]]
            done += len(p)
            edges = np.zeros(x.first[-1] + 1, np.int64)
            np.add.at(edges, hit, 1)
            np.add.at(edges, hit + window, -1)
            stays = np.cumsum(edges)[:-1] == 0
            lost = np.diff(np.concatenate([[0], np.cumsum(~stays)])[x.first])
            n_words += np.diff(x.first).tolist()
            n_removed += lost.tolist()
            for i in range(len(x.first) - 1):
                words = (block.texts[x.row + i].as_py() or "").encode().split()
                kept.append(b" ".join(compress(words, stays[x.first[i] : x.first[i + 1]].tolist()) if lost[i] else words).decode())
        return pa.table([*(block.docs.column(c) for c in carried), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())], [*carried, "n_words", "n_removed", "kept_text"])

    return run


def substring_dedup(docs: DataFrame, text_col: str = "text", carry: tuple[str, ...] = ("doc_id",), window: int = 35) -> DataFrame:
    """One row per input row: the ``carry`` columns, ``n_words``, ``n_removed`` and ``kept_text``.

    Words are ``[^\\x20\\x09-\\x0D]+``. A word goes if a window of ``window`` words covers it whose sequence
    starts at a second place too, in any row or the same. A null or empty text has no words and keeps "".
    Repeated rows are separate documents, so their windows repeat. Texts of under ``window`` words stay.
    Ids may be null or tied: they are only carried. Columns not named in ``carry`` are left out.
    An empty table gives an empty table.
    """
    spark = docs.sparkSession
    n = partitions(spark)
    blocks = even_labels(n, BLOCKS_EACH)
    names = [f"carry{i}" for i in range(len(carry))]
    rows = docs.select(*(docs[c].alias(a) for c, a in zip(carry, names, strict=True)), docs[text_col].cast("string").alias("text"))
    row = F.xxhash64(*names, "text")  # of the row alone, so that a lost block is made of the same rows again
    names_of = F.split(F.lit(",".join(map(str, blocks))), ",").cast("array<int>")
    dealt = rows.withColumn("block", F.get(names_of, F.pmod(row, F.lit(len(blocks))).cast("int"))).repartition(n, "block")
    labels = even_labels(n, BUCKETS_EACH)
    bits = "bucket int, block int, round int, bits binary"
    sent = dealt.mapInArrow(_send(window, labels), "bucket int, block int, hashes binary")
    first = sent.groupBy("bucket").applyInArrow(_answer(1), bits).repartition(n, "block")  # one exchange for both uses
    asked = dealt.groupBy("block").cogroup(first.groupBy("block")).applyInArrow(_ask_again(window, labels), "bucket int, block int, hashes binary")
    answers = first.unionByName(asked.groupBy("bucket").applyInArrow(_answer(2), bits))
    schema = ", ".join([*(f"{a} {docs.schema[c].dataType.simpleString()}" for c, a in zip(carry, names, strict=True)), "n_words long, n_removed long, kept_text string"])
    out = dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_remove(window, labels, names), schema)
    return out.select(*(F.col(a).alias(c) for c, a in zip(carry, names, strict=True)), "n_words", "n_removed", "kept_text")


def op1_substring_dedup(spark, sf_dir: str) -> DataFrame:
    out = substring_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
