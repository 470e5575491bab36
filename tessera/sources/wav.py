"""WAV bytes to samples and back, and a scan of WAV files; PCM 16, 24, 32 and float."""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def decode(blob: bytes) -> tuple[np.ndarray, int]:
    """(float samples [n, channels], rate)."""
    if blob[:4] != b"RIFF" or blob[8:12] != b"WAVE":
        raise ValueError("not a WAV file")
    at, kind, data = 12, None, None
    while at + 8 <= len(blob):
        name, size = blob[at : at + 4], struct.unpack_from("<I", blob, at + 4)[0]
        body = blob[at + 8 : at + 8 + size]
        if name == b"fmt ":
            tag, channels, rate, _, _, bits = struct.unpack_from("<HHIIHH", body)
            if tag == 0xFFFE and len(body) >= 26:
                tag = struct.unpack_from("<H", body, 24)[0]
            kind = tag, channels, rate, bits
        elif name == b"data":
            data = body
        at += 8 + size + size % 2
    if kind is None or data is None:
        raise ValueError("no format or no data")
    tag, channels, rate, bits = kind
    if tag == 3:
        x = np.frombuffer(data, "<f4" if bits == 32 else "<f8").astype(np.float32)
    elif bits == 16:
        x = np.frombuffer(data[: len(data) // 2 * 2], "<i2") / np.float32(1 << 15)
    elif bits == 24:
        b = np.frombuffer(data[: len(data) // 3 * 3], np.uint8).reshape(-1, 3).astype(np.int32)
        x = ((b[:, 0] << 8 | b[:, 1] << 16 | b[:, 2] << 24) >> 8) / np.float32(1 << 23)
    elif bits == 32:
        x = np.frombuffer(data[: len(data) // 4 * 4], "<i4") / np.float32(1 << 31)
    else:
        raise ValueError(f"{bits} bits")
    return x[: len(x) // channels * channels].astype(np.float32).reshape(-1, channels), rate


def encode(x: np.ndarray, rate: int, bits: int = 24, comment: str | None = None, software: str | None = None) -> bytes:
    """PCM 16 or 24; comment and software go to an INFO list."""
    x = np.clip(np.atleast_2d(x.T).T, -1, 1)
    if bits == 16:
        data = np.round(x * 32767).astype("<i2").tobytes()
    else:
        data = np.round(x * 8388607).astype("<i4").reshape(-1, 1).view(np.uint8).reshape(-1, 4)[:, :3].tobytes()
    channels = x.shape[1]
    chunk = lambda name, body: name + struct.pack("<I", len(body)) + body + b"\0" * (len(body) % 2)
    info = b"".join(chunk(k, v.encode() + b"\0") for k, v in ((b"ICMT", comment), (b"ISFT", software)) if v is not None)
    body = b"WAVE" + chunk(b"fmt ", struct.pack("<HHIIHH", 1, channels, rate, rate * channels * bits // 8, channels * bits // 8, bits)) + chunk(b"data", data) + (chunk(b"LIST", b"INFO" + info) if info else b"")
    return b"RIFF" + struct.pack("<I", len(body)) + body


def read_wavs(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """path, length, content of *.wav files; the audio is only decoded by what needs it."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", "*.wav")
    return reader.option("recursiveFileLookup", str(recursive).lower()).load(path).select("path", "length", "content")


def measured(wavs: DataFrame, kernel: Callable[[np.ndarray, int], dict], schema: str, key: str = "path", content: str = "content") -> DataFrame:
    """key, read_error and the kernel's fields for each file; one damaged file only spoils its own row."""
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for blob in batch.column(content):
                try:
                    rows.append({"read_error": None, **kernel(*decode(blob.as_py()))})
                except Exception as e:
                    rows.append({"read_error": f"read_failed:{e}"})
            kinds = {"double": pa.float64(), "int": pa.int32(), "long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}
            columns = [pa.array([r.get(n) for r in rows], kinds[x.split()[1]]) for n, x in zip(names, schema.split(", "), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array([r["read_error"] for r in rows], pa.string()), *columns], [key, "read_error", *names])

    return wavs.select(key, content).mapInArrow(run, f"{key} {wavs.schema[key].dataType.simpleString()}, read_error string, {schema}")
