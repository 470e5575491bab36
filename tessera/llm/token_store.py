"""Token ids in binary shards: frequency-ranked, byte-aligned variable-length coding with separate control bytes.

A shard file, all integers little-endian:
    b"TSR1", u32 documents, u64 ids, u32 ranks, u32 id bytes (8)
    u32[ranks]      token id of each rank, most frequent first (ties: smaller id)
    i64[documents]  document ids, u8[documents] whether the id is null, u32[documents] number of ids
    u8[(ids+3)//4]  control bytes: two bits an id hold the number of its bytes less one
    u8[...]         the ranks' bytes
Ranks are counted over all documents of a shard, so a shard can be read, added or replaced alone. A reader finds
the lengths of four ids by one look-up of a control byte and gathers the bytes with numpy.
"""

from __future__ import annotations

import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .scratch import Kept, chunks, fresh_path, gathered, partitions, resident, stored

MAGIC = b"TSR1"
SHARD_IDS = 2 << 20
#: What a worker keeps of the cuts of earlier texts.
CACHE_BYTES = 192 << 20
JOINED = 1024
#: The byte-level alphabet's letter for a space.
SPACE = "Ġ"
#: Where a space does not stand alone between two other characters, and white space other than spaces and line ends.
NOT_PLAIN = r"  | \n|\n |^ | $|[\t\x0b\f\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
END_ID = 0
END = np.array([END_ID], np.uint32).tobytes()
LENGTHS = np.array([[1 + (c >> 2 * k & 3) for k in range(4)] for c in range(256)], np.int64)


class Tokens:
    """A byte-level tokenizer of the tokenizers library, with what it gave for each cut of earlier texts.

    The library's own pattern never joins what stands before a lone space to what follows it, so texts are cut
    before every space between two other characters and each distinct cut is encoded by the library once.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        before = str(self.library.pre_tokenizer)
        self.cuttable = "ByteLevel(add_prefix_space=False" in before and "use_regex=True" in before and self.library.normalizer is None
        names = [self.library.id_to_token(i) or "" for i in range(self.library.get_vocab_size())]
        self.leads = np.array([x.startswith(SPACE) for x in names])
        self.cache, self.heads = Kept(CACHE_BYTES), Kept(CACHE_BYTES >> 4)

    def encoded(self, texts: pa.Array, end: bytes = b"") -> tuple[np.ndarray, np.ndarray]:
        """(ids of all the whole texts in turn, each with ``end`` after it; number of ids of each)."""
        if not self.cuttable:
            each = [array("I", x.ids).tobytes() + end for x in self.library.encode_batch(texts.to_pylist(), add_special_tokens=False)]
            return np.frombuffer(b"".join(each), np.uint32), np.array([len(x) // 4 for x in each], np.int64)
        odd = pc.match_substring_regex(texts, NOT_PLAIN)
        if not pc.any(odd).as_py():
            return self._of_cuts(pc.split_pattern(texts, " "), end)
        plain, n_plain = self._of_cuts(pc.split_pattern(texts.filter(pc.invert(odd)), " "), end)
        cut = [re.split(r"(?<=\S) (?=\S)", x) for x in texts.filter(odd).to_pylist()]
        rest, n_rest = self._of_cuts(pa.array(cut, pa.large_list(pa.large_string())), end)
        odd = odd.to_numpy(zero_copy_only=False)
        n = np.empty(len(texts), np.int64)
        n[~odd], n[odd] = n_plain, n_rest
        ids = np.empty(n.sum(), np.uint32)
        of_odd = np.repeat(odd, n)
        ids[~of_odd], ids[of_odd] = plain, rest
        return ids, n

    def _of_cuts(self, split: pa.Array, end: bytes) -> tuple[np.ndarray, np.ndarray]:
        if not len(split):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        at = np.asarray(split.offsets).astype(np.int64)
        at -= at[0]
        cuts = split.flatten()
        firsts, rest = pc.dictionary_encode(cuts.take(pa.array(at[:-1]))), pc.dictionary_encode(cuts)
        known, heads = self._known(rest.dictionary.to_pylist(), self.cache, " "), self._known(firsts.dictionary.to_pylist(), self.heads, "")
        codes = np.array(rest.indices)
        codes[at[:-1]] = len(known) + np.asarray(firsts.indices)
        codes = np.insert(codes, at[1:], len(known) + len(heads))
        ids, n = gathered(codes, [*known, *heads, end])
        return ids, np.add.reduceat(n, at[:-1] + np.arange(len(split)), dtype=np.int64)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each whole text as unsigned 32-bit integers."""
        if not texts:
            return []
        ids, n = self.encoded(pa.array(texts, pa.large_string()))
        return [x.tobytes() for x in np.split(ids, np.cumsum(n)[:-1])]

    def _known(self, cuts: list[str], held: Kept, lead: str) -> list[bytes]:
        found = held.get(cuts)
        if None in found:
            new = self._learned([cut for cut, x in zip(cuts, found, strict=True) if x is None], lead)
            held.add(new)
            found = [new[cut] if x is None else x for cut, x in zip(cuts, found, strict=True)]
        return found

    def _learned(self, cuts: list[str], lead: str) -> dict[str, bytes]:
        """New cuts go to the library as one text, cut again at the ids that begin with a space; odd ones by themselves."""
        new: dict[str, bytes] = {}
        if lead:
            # Line ends within a cut are fine: they never join what follows, a word.
            joined = [x for x in cuts if x and (x.isprintable() or (x[0] != "\n" != x[-1] and x.replace("\n", "").isprintable())) and " " not in x and "<|" not in x]
            for at in range(0, len(joined), JOINED):
                some = joined[at : at + JOINED]
                ids = np.array(self.library.encode_batch_fast([lead + lead.join(some)], add_special_tokens=False)[0].ids, np.uint32)
                starts = np.flatnonzero(self.leads[ids])
                if len(starts) == len(some) and starts[0] == 0:
                    blob, ends = ids.tobytes(), [*(4 * starts[1:]).tolist(), 4 * len(ids)]
                    new.update(zip(some, map(blob.__getitem__, map(slice, [0, *ends[:-1]], ends)), strict=True))
            cuts = [x for x in cuts if x not in new]
        for cut, x in zip(cuts, self.library.encode_batch_fast([lead + x for x in cuts], add_special_tokens=False), strict=True):
            new[cut] = array("I", x.ids).tobytes()
        return new


def loaded(path: str) -> Tokens:
    return resident("tokens", path, lambda: Tokens(path))


def coded(ids: np.ndarray) -> tuple[np.ndarray, bytes, bytes]:
    """(token id of each rank, control bytes, data bytes)."""
    if not len(ids):
        return np.zeros(0, np.uint32), b"", b""
    counts = np.bincount(ids)
    used = np.flatnonzero(counts)
    table = used[np.argsort(-counts[used], kind="stable")].astype(np.uint32)
    rank_of = np.zeros(len(counts), np.uint32)
    rank_of[table] = np.arange(len(table), dtype=np.uint32)
    ranks = rank_of[ids]
    extra = (ranks >= 1 << 8).astype(np.uint8) + (ranks >= 1 << 16) + (ranks >= 1 << 24)
    padded = np.zeros(-(-len(ids) // 4) * 4, np.uint8)
    padded[: len(ids)] = extra
    control = padded.reshape(-1, 4) @ np.array([1, 4, 16, 64], np.uint8)
    data = ranks.astype("<u4").view(np.uint8).reshape(-1, 4)[np.arange(4) <= extra[:, None]]
    return table, control.astype(np.uint8).tobytes(), data.tobytes()


def decoded(table: np.ndarray, control: bytes, data: bytes, n: int) -> np.ndarray:
    lengths = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    at = np.cumsum(lengths) - lengths
    raw = np.frombuffer(data + bytes(3), np.uint8)
    ranks = np.zeros(n, np.uint32)
    for k in range(int(lengths.max(initial=0))):
        has = lengths > k
        ranks[has] |= raw[at[has] + k].astype(np.uint32) << np.uint32(8 * k)
    return table[ranks]


def shard_bytes(doc_ids: list[int | None], lengths: list[int] | np.ndarray, ids: np.ndarray) -> bytes:
    table, control, data = coded(ids)
    head = MAGIC + np.array([len(doc_ids)], "<u4").tobytes() + np.array([len(ids)], "<u8").tobytes() + np.array([len(table), 8], "<u4").tobytes()
    null = np.array([x is None for x in doc_ids], np.uint8)
    return b"".join([head, table.astype("<u4").tobytes(), np.array([x or 0 for x in doc_ids], "<i8").tobytes(), null.tobytes(), np.array(lengths, "<u4").tobytes(), control, data])


def read_shard(blob: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """(document ids, number of ids of each, all ids)."""
    if blob[:4] != MAGIC:
        raise ValueError("not a token shard")
    docs = int(np.frombuffer(blob, "<u4", 1, 4)[0])
    n = int(np.frombuffer(blob, "<u8", 1, 8)[0])
    ranks = int(np.frombuffer(blob, "<u4", 1, 16)[0])
    at = 24

    def take(kind: str, count: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(blob, kind, count, at)
        at += out.nbytes
        return out

    table, doc_ids, null, lengths = take("<u4", ranks), take("<i8", docs), take("u1", docs), take("<u4", docs)
    control = take("u1", -(-n // 4)).tobytes()
    return [None if z else x for x, z in zip(doc_ids.tolist(), null.tolist(), strict=True)], lengths.astype(np.int64), decoded(table, control, blob[at:], n)


def opened(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def put(uri: str, blob: bytes) -> None:
    """Whole files only: a try writes under its own name and then takes the final one, so a repeated task is harmless."""
    store, path = opened(uri)
    context = TaskContext.get()
    own = f"{path}.try{context.taskAttemptId() if context else 0}"
    store.create_dir(path.rpartition("/")[0], recursive=True)
    with store.open_output_stream(own, compression=None) as out:
        out.write(blob)
    store.move(own, path)


def _write(tokenizer_path: str, folder: str):
    def run(batches):
        tokens, part, shard = loaded(tokenizer_path), 0, TaskContext.get().partitionId()
        doc_ids: list = []
        lengths: list[np.ndarray] = []
        held: list[np.ndarray] = []
        total = 0

        def flush():
            nonlocal part, total
            path = f"{folder}/shard-{shard:06d}-{part:05d}.tok"
            ids = np.concatenate(held)
            put(path, shard_bytes(doc_ids, np.concatenate(lengths), ids))
            row = pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()), "part": pa.array([part], pa.int32()), "path": [path], "n_docs": pa.array([len(doc_ids)], pa.int64()), "n_ids": pa.array([len(ids)], pa.int64())})
            for x in (doc_ids, lengths, held):
                x.clear()
            part, total = part + 1, 0
            return row

        for batch in batches:
            for row, texts in chunks(batch.column("text")):
                docs = batch.column("doc").slice(row, len(texts)).to_pylist()
                ids, n = tokens.encoded(texts, END)
                while docs:  # a file ends with the document that fills it
                    sums = np.cumsum(n)
                    k = min(int(np.searchsorted(sums, SHARD_IDS - total)) + 1, len(docs))
                    doc_ids += docs[:k]
                    lengths.append(n[:k])
                    held.append(ids[: sums[k - 1]])
                    total += int(sums[k - 1])
                    docs, n, ids = docs[k:], n[k:], ids[sums[k - 1] :]
                    if total >= SHARD_IDS:
                        yield flush()
        if doc_ids:
            yield flush()

    return run


def write_tokens(docs: DataFrame, tokenizer_path: str, folder: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes, writes the shards below ``folder`` and returns their manifest: shard, part, path, n_docs, n_ids, start.

    Documents go in ascending id order, nulls first; ties by a hash of the text, so that one id with many rows
    still spreads over shards. ``start`` is the number of ids in all files before. Null texts count as empty and
    give the end id alone; repeated rows are written each; other columns are ignored; an empty table gives no file.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"))
    order = ["doc", F.xxhash64("text")]
    sorted_ = rows.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
    made = stored(sorted_.mapInArrow(_write(tokenizer_path, folder), "shard int, part int, path string, n_docs long, n_ids long"), "manifest")
    # The files of a shard add up in its own task; over all there is one number a shard, that is, a partition.
    before = lambda w: F.coalesce(F.sum("n_ids").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).cast("long")
    shards = made.groupBy("shard").agg(F.sum("n_ids").alias("n_ids")).select("shard", before(W.orderBy("shard")).alias("base"))
    within = made.withColumn("start", before(W.partitionBy("shard").orderBy("part")))
    return within.join(F.broadcast(shards), "shard").select("shard", "part", "path", "n_docs", "n_ids", (F.col("start") + F.col("base")).alias("start"))


def _read(with_ids: bool):
    def run(batches):
        for batch in batches:
            for path, base in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist(), strict=True):
                store, name = opened(path)
                with store.open_input_stream(name, compression=None) as f:
                    doc_ids, lengths, ids = read_shard(f.read())
                at = np.concatenate([[0], np.cumsum(lengths)])
                cuts = [ids[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
                last = [pa.array([x.tolist() for x in cuts], pa.list_(pa.int32()))] if with_ids else [pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in cuts], pa.int64())]
                yield pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), pa.array(at[:-1] + base, pa.int64()), pa.array(lengths, pa.int64()), *last], ["doc_id", "start", "n_tokens", "ids" if with_ids else "ids_crc32"])

    return run


def read_tokens(manifest: DataFrame, with_ids: bool = True) -> DataFrame:
    """doc_id, start, n_tokens and ``ids`` (or ``ids_crc32``) of every document in the shards."""
    last = "ids array<int>" if with_ids else "ids_crc32 long"
    paths = manifest.select("path", "start").repartition(partitions(manifest.sparkSession), "path")
    return paths.mapInArrow(_read(with_ids), f"doc_id long, start long, n_tokens long, {last}")


def op3_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    manifest = write_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"), fresh_path(spark, "tokens"))
    return read_tokens(manifest, with_ids=False)
