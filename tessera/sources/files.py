"""Text, JSON lines and listings; packs."""

from __future__ import annotations

import hashlib
import io
import os
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "packId string, version string, schemaVersion int, buildDate string, sizeBytesUncompressed long, fileCount int"


def prompt_files(spark: SparkSession, path: str) -> DataFrame:
    """(category, text): whole files, since the order of lines matters; the category is the file's stem."""
    df = spark.read.text(path, wholetext=True)
    return df.select(F.regexp_extract("_metadata.file_name", r"^(.*?)(?:\.[^.]*)?$", 1).alias("category"), F.col("value").alias("text"))


def enabled(spark: SparkSession, path: str, only: list[str] | None = None) -> DataFrame:
    """Listed names without comments, in order; ``only`` takes their place."""
    if only:
        return spark.createDataFrame(list(enumerate(only)), "place int, name string")
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\n")).alias("place", "line"))
    return lines.select("place", F.trim(F.split("line", "#")[0]).alias("name")).where("name <> ''")


def json_rows(spark: SparkSession, path: str, schema: str, strict: bool) -> DataFrame:
    """JSON lines: damaged rows stop the query, or are left out."""
    return spark.read.schema(schema).option("mode", "FAILFAST" if strict else "DROPMALFORMED").json(path)


def excluded(path: Column) -> Column:
    """Whether a part of the path begins with an underscore or a dot."""
    return F.exists(F.split(path, "/"), lambda p: p.rlike(r"^[_.]") & (p != "."))


def payload(root: str) -> list[tuple[str, str]]:
    """(name in the pack, file) below a folder, in byte order, without what is excluded."""
    out = []
    for folder, names, files in os.walk(root):
        names[:] = [n for n in names if n[0] not in "_."]
        out += [(os.path.relpath(os.path.join(folder, f), root).replace(os.sep, "/"), os.path.join(folder, f)) for f in files if f[0] not in "_."]
    return sorted(out)


def zip_pack(files: list[tuple[str, str]], manifest: dict) -> bytes:
    """The same bytes for the same files and manifest: fixed times, fixed order. The build date is the caller's."""
    import json

    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, data in [("pack.json", json.dumps(manifest, sort_keys=True).encode()), *((n, open(p, "rb").read()) for n, p in files)]:  # noqa: SIM115
            z.writestr(zipfile.ZipInfo(name, (1980, 1, 1, 0, 0, 0)), data, zipfile.ZIP_DEFLATED)
    return out.getvalue()


def directory_pack(files: list[tuple[str, str]], manifest: dict, out: str) -> None:
    """Copies the payload; refuses a folder that holds something else than a pack."""
    import json
    import shutil

    if os.path.isdir(out) and os.listdir(out) and not os.path.exists(os.path.join(out, "pack.json")):
        raise FileExistsError(f"{out} is not a pack")
    shutil.rmtree(out, ignore_errors=True)
    for name, path in files:
        to = os.path.join(out, name)
        os.makedirs(os.path.dirname(to), exist_ok=True)
        shutil.copyfile(path, to)
    with open(os.path.join(out, "pack.json"), "w") as f:
        json.dump(manifest, f, sort_keys=True)


def digest(blob: bytes) -> str:
    return hashlib.sha256(blob).hexdigest()
