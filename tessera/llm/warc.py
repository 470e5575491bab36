"""WARC archives with a two-level capture index.

Captures go in order of their key, the URL with its host reversed. Each task writes archives (a gzip member a record)
and beside each an index file: lines of key, page, offset and length in key order, in gzip blocks of BLOCK_LINES.
The sparse directory has a row for each block: its first and last key, file, offset and length. A look-up finds the
block by its keys, reads that range of the index, searches it in halves and reads that range of the archive. All records
are read the same way, block by block: the index says where each is, and is held against what is there.

Of records with equal payloads of at least LEAST_REVISIT bytes, that with the largest page id is a response and the
others revisit it.
"""

from __future__ import annotations

import base64
import hashlib
import json
import zlib
from bisect import bisect_left

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import fresh_path, partitions, stored
from .token_store import opened, put

BLOCK_LINES = 500
ARCHIVE_BYTES = 64 << 20
LEAST_REVISIT = 1000
BROADCAST_ROWS = 200_000
DATE = "2024-01-01T00:00:00Z"
DIRECTORY = "shard int, part int, block int, first_key string, last_key string, lines int, index_path string, offset long, length long, archive_path string"


def surt(url: Column) -> Column:
    """The sort key: ``com,example,www)/path?query``; scheme, user, a default port and the fragment go."""
    whole = F.regexp_replace(F.coalesce(url, F.lit("")), "#.*$", "")
    rest = F.regexp_replace(whole, r"^[a-zA-Z][\w+.-]*://(?:[^/@?]*@)?", "")
    host = F.lower(F.regexp_extract(rest, r"^([^/:?]*)", 1))
    port = F.regexp_extract(rest, r"^[^/:?]*(?::(?!80\b|443\b)(\d+))?", 1)
    path = F.regexp_replace(rest, r"^[^/?]*", "")
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.when(port != "", F.concat(F.lit(":"), port)).otherwise(""), F.lit(")"), path)


def record(page: int | None, url: str, payload: bytes, sha1: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One gzip member. A revisit has the response's HTTP head, whose Content-Length is that of the full payload."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    named = [
        ("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", f"<urn:page:{page}>"), ("WARC-Date", DATE), ("WARC-Target-URI", url),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(sha1).decode()), ("WARC-Block-Digest", "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()),
        *([("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", f"<urn:page:{refers_to}>")] if revisit else []),
        ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block))),
    ]
    lines = "".join(f"{k}: {_plain(v)}\r\n" for k, v in named)
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n") + z.flush()


def _plain(value: str) -> str:
    return value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A") if "\r" in value or "\n" in value else value


def members(blob: memoryview, step: int = 1 << 14):
    """(offset, length, content) of each gzip member."""
    at, end = 0, len(blob)
    while at < end:
        z, pos, out = zlib.decompressobj(31), at, []
        while not z.eof:
            if pos >= end:
                raise ValueError("the archive ends inside a record")
            out.append(z.decompress(blob[pos : pos + step]))
            pos += step
        stop = min(pos, end) - len(z.unused_data)
        yield at, stop - at, b"".join(out)
        at = stop


def parsed(content: bytes) -> dict:
    """page, type, url, refers_to, payload (None for a revisit), payload_bytes, sha1 of the full payload."""
    head, _, rest = content.partition(b"\r\n\r\n")
    named = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = rest[: int(named["Content-Length"])]
    http, _, body = block.partition(b"\r\n\r\n")
    size = int(next(x for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))[15:])
    page = lambda x: None if x == "<urn:page:None>" else int(x[10:-1])
    out = {"page": page(named["WARC-Record-ID"]), "type": named["WARC-Type"], "url": named["WARC-Target-URI"], "payload_bytes": size, "sha1": base64.b32decode(named["WARC-Payload-Digest"][5:]).hex(), "refers_to": None, "payload": None}
    if out["type"] == "revisit":
        out["refers_to"] = page(named["WARC-Refers-To"])
    else:
        out["payload"] = body
        if len(body) != size or hashlib.sha1(body).hexdigest() != out["sha1"]:
            raise ValueError(f"record {out['page']} is damaged")
    return out


def _write(folder: str):
    def run(batches):
        shard, part = TaskContext.get().partitionId(), 0
        held: list[bytes] = []
        lines: list[tuple[str, str]] = []
        size = 0

        def flush():
            nonlocal part, size
            name = f"{folder}/{shard:06d}-{part:05d}"
            put(f"{name}.warc.gz", b"".join(held))
            blocks, rows, at = [], [], 0
            for k in range(0, len(lines), BLOCK_LINES):
                some = lines[k : k + BLOCK_LINES]
                blocks.append(zlib.compress("\n".join(x for _, x in some).encode(), 6))
                rows.append((shard, part, k // BLOCK_LINES, some[0][0], some[-1][0], len(some), f"{name}.cdx", at, len(blocks[-1]), f"{name}.warc.gz"))
                at += len(blocks[-1])
            put(f"{name}.cdx", b"".join(blocks))
            held.clear()
            lines.clear()
            part, size = part + 1, 0
            names = [x.split()[0] for x in DIRECTORY.split(", ")]
            kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}
            return pa.RecordBatch.from_arrays([pa.array(c, kinds[x.split()[1]]) for c, x in zip(zip(*rows, strict=True), DIRECTORY.split(", "), strict=True)], names)

        for batch in batches:
            for page, url, key, payload, keeper, revisit in zip(*(batch.column(c) for c in ("page", "url", "key", "payload", "keeper", "revisit")), strict=True):
                data = (payload.as_py() or "").encode()
                made = record(page.as_py(), url.as_py() or "", data, hashlib.sha1(data).digest(), keeper.as_py(), revisit.as_py())
                lines.append((key.as_py(), json.dumps([key.as_py(), page.as_py(), size, len(made)])))
                held.append(made)
                size += len(made)
                if size >= ARCHIVE_BYTES:
                    yield flush()
        if held:
            yield flush()

    return run


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Writes archives and index files below ``folder`` and returns the block directory.

    Null html is an empty payload, a null URL the empty one, a null id is written as such and is a response only where
    no equal payload has an id. Equal rows are written each. Other columns are ignored; an empty table writes nothing.
    """
    spark = pages.sparkSession
    rows = pages.select(F.col(id_col).cast("long").alias("page"), F.col(url_col).cast("string").alias("url"), surt(F.col(url_col).cast("string")).alias("key"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("payload"))
    digest = [F.sha1(F.col("payload").cast("binary")).alias("sha"), F.octet_length("payload").alias("size")]
    large = rows.select("page", *digest).where(F.col("size") >= LEAST_REVISIT)
    keepers = stored(large.groupBy("sha", "size").agg(F.max("page").alias("keeper"), F.count("*").alias("n")).where("n > 1").select("sha", "size", "keeper"), "keepers")
    if keepers.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        keepers = F.broadcast(keepers)
    met = rows.select("*", *digest).join(keepers, ["sha", "size"], "left")
    met = met.select("page", "url", "key", "payload", "keeper", (F.col("keeper").isNotNull() & ~F.col("page").eqNullSafe(F.col("keeper"))).alias("revisit"))
    order = ["key", "page"]
    return stored(met.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order).mapInArrow(_write(folder), DIRECTORY), "directory")


RECORD = [("page", pa.int64(), "long"), ("url", pa.string(), "string"), ("payload_bytes", pa.int64(), "long"), ("sha1", pa.string(), "string"), ("type", pa.string(), "string"), ("refers_to", pa.int64(), "long"), ("payload", pa.binary(), "binary")]


def _batch(found: list[dict], with_payload: bool) -> pa.RecordBatch:
    columns = RECORD if with_payload else RECORD[:-1]
    return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], t) for k, t, _ in columns], [k for k, _, _ in columns])


def _schema(with_payload: bool) -> str:
    return ", ".join(f"{k} {kind}" for k, _, kind in (RECORD if with_payload else RECORD[:-1]))


def _read(with_payload: bool):
    def run(batches):
        for batch in batches:
            for path in batch.column("archive_path").to_pylist():
                store, name = opened(path)
                with store.open_input_stream(name, compression=None) as f:
                    blob = memoryview(f.read())
                yield _batch([parsed(content) for _, _, content in members(blob)], with_payload)

    return run


def read_archives(directory: DataFrame, with_payload: bool = True) -> DataFrame:
    """All records of the archives from start to end, without the index; every payload is held against its digest."""
    paths = directory.where("block = 0").select("archive_path").repartition(partitions(directory.sparkSession), "archive_path")
    return paths.mapInArrow(_read(with_payload), _schema(with_payload))


def _block(row: dict) -> list[str]:
    return zlib.decompress(_range(row["index_path"], row["offset"], row["length"])).decode().split("\n")


def _read_blocks(with_payload: bool):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                lines = [json.loads(x) for x in _block(row)]
                keys = [x[0] for x in lines]
                if len(lines) != row["lines"] or keys != sorted(keys) or (keys[0], keys[-1]) != (row["first_key"], row["last_key"]):
                    raise ValueError(f"block {row['block']} of {row['index_path']} is not what the directory says")
                begin, found = lines[0][2], []
                held = memoryview(_range(row["archive_path"], begin, lines[-1][2] + lines[-1][3] - begin))
                for k, (_, page, at, length) in enumerate(lines):
                    record = parsed(zlib.decompress(held[at - begin : at - begin + length], 31))
                    if record["page"] != page or (k and at != lines[k - 1][2] + lines[k - 1][3]):
                        raise ValueError(f"line {k} of block {row['block']} of {row['index_path']} points to another record")
                    found.append(record)
                yield _batch(found, with_payload)

    return run


def read_records(directory: DataFrame, with_payload: bool = True) -> DataFrame:
    """All records through the index: a task takes blocks of the directory, reads their lines and the archive range
    they name. Lines out of order, gaps between records, other pages than a line names and payloads that differ from
    their digests are errors."""
    blocks = directory.repartition(partitions(directory.sparkSession), "index_path", "block")
    return blocks.mapInArrow(_read_blocks(with_payload), _schema(with_payload))


def find(directory: DataFrame, url: str) -> list[dict]:
    """Records of one URL: directory, block, halves of the block, range. A revisit's payload is its response's; nothing
    else is read, and of a block's lines only those that the search touches are looked into."""
    key = directory.sparkSession.createDataFrame([(url,)], "u string").select(surt(F.col("u"))).first()[0]
    out = []
    for block in directory.where((F.col("first_key") <= key) & (F.col("last_key") >= key)).orderBy("shard", "part", "block").toLocalIterator():
        lines = _block(block)
        for k in range(bisect_left(lines, key, key=lambda x: json.loads(x)[0]), len(lines)):
            own, _, at, length = json.loads(lines[k])
            if own != key:
                break
            out.append(parsed(zlib.decompress(_range(block["archive_path"], at, length), 31)))
    return out


def _range(uri: str, offset: int, length: int) -> bytes:
    store, name = opened(uri)
    with store.open_input_file(name) as f:
        return f.read_at(length, offset)


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    directory = write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), fresh_path(spark, "warc"))
    out = read_records(directory, with_payload=False)
    return out.select(F.col("page").alias("page_id"), "payload_bytes", F.col("sha1").alias("payload_digest"), F.col("type").alias("record_type"), "refers_to")
