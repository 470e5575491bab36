"""Canonical exact digests of documents, in DataFrame and SQL functions only.

Canonical means: NFKC, full case folding, NFKC again, every run of white space one space, trimmed. The digest is two
64-bit xxhash values of different seeds. Texts whose digests meet are compared byte for byte; should a bucket ever hold
different texts, all its digests are lengthened by the texts' SHA-256, so equal fingerprints always mean equal
canonical texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .scratch import even_labels, partitions, stored

#: Keys of buckets with several members are broadcast up to this number of rows (16 bytes each).
BROADCAST_ROWS = 500_000


def canonical(text: Column) -> Column:
    def icu(kind: str, method: str, x: Column) -> Column:
        return F.reflect(F.lit(f"com.ibm.icu.{kind}"), F.lit(method), x, F.lit(True))

    folded = icu("text.Normalizer", "compose", icu("lang.UCharacter", "foldCase", icu("text.Normalizer", "compose", text)))
    return F.trim(F.regexp_replace(folded, r"(?U)\s+", " "))


def wide_hash(text: Column, *names: str) -> list[Column]:
    return [F.xxhash64(text).alias(names[0]), F.xxhash64(F.lit("second"), text).alias(names[1])]


def _lowered(pos: Column, bounds: Column, key: Column, n: int) -> Column:
    """How many of the n sorted bounds are at most ``key``, by binary steps."""
    steps = F.array(*(F.lit(1 << b) for b in range(max(1, n).bit_length() - 1, -1, -1)))
    return F.aggregate(steps, pos, lambda at, s: F.when((at + s <= n) & (F.get(bounds, at + s - 1) <= key), at + s).otherwise(at))


def with_next(rows: DataFrame, key: str, text: str, name: str) -> DataFrame:
    """Adds the text of the next row in ascending ``key`` order (after the last row: the first).

    Rows are dealt to ranges of the key, whose limits are quantiles; the first row of a range is also sent to the range
    before, so every range finds all its next rows by itself and nothing is ordered in one task. Null keys come first;
    rows with one key go by a hash of the text.
    """
    spark = rows.sparkSession
    n = partitions(spark)
    limits = rows.agg(F.percentile_approx(key, [(i + 1) / n for i in range(n - 1)], 10_000)).first()[0] if n > 1 else []
    limits = sorted(set(limits or []))
    bounds = F.split(F.lit(",".join(map(str, limits))), ",").cast("array<bigint>")
    place = F.coalesce(_lowered(F.lit(0), bounds, F.col(key), len(limits)), F.lit(0)) if limits else F.lit(0)
    placed = rows.withColumns({"_place": place, "_tie": F.xxhash64(text)})
    order = F.struct(F.col(key).isNotNull().alias("a"), F.col(key).alias("b"), F.col("_tie").alias("c"))
    firsts = sorted(placed.groupBy("_place").agg(F.min(order).alias("first")).collect())  # a row for each range
    if not firsts:
        return rows.withColumn(name, F.lit(None).cast("string"))
    labels = even_labels(n, 1)
    before = [firsts[i - 1][0] for i in range(len(firsts))]
    heads = [(before[i], f["b"], f["c"]) for i, (_, f) in enumerate(firsts)]
    also = F.array_compact(F.array(*(F.when(F.col(key).eqNullSafe(F.lit(k).cast("long")) & (F.col("_tie") == F.lit(t).cast("long")), F.lit(to)) for to, k, t in heads))) if len(heads) <= 64 else None
    if also is None:
        table = F.broadcast(spark.createDataFrame(heads, "_to int, _k long, _t long"))
        tails = placed.join(table, F.col(key).eqNullSafe(F.col("_k")) & (F.col("_tie") == F.col("_t"))).select(*rows.columns, "_tie", F.col("_to").alias("_place"), F.lit(True).alias("_tail"))
        dealt = placed.withColumn("_tail", F.lit(False)).unionByName(tails)
    else:
        each = F.concat(F.array(F.struct(F.col("_place").alias("p"), F.lit(False).alias("t"))), F.transform(also, lambda p: F.struct(p.alias("p"), F.lit(True).alias("t"))))
        dealt = placed.withColumn("_e", F.explode(each)).select(*rows.columns, "_tie", F.col("_e.p").alias("_place"), F.col("_e.t").alias("_tail"))
    names = F.split(F.lit(",".join(map(str, labels))), ",").cast("array<int>")
    window = W.partitionBy("_label").orderBy("_tail", F.col(key).asc_nulls_first(), "_tie")
    dealt = dealt.withColumn("_label", F.get(names, "_place")).repartition(n, "_label")
    return dealt.withColumn(name, F.lead(text).over(window)).where("not _tail").select(*rows.columns, name)


def document_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id``, ``n_chars``, ``fingerprint``, and for the text whose last quarter is the
    next document's beginning ``edited_sha256``, ``edited_fingerprint``; ``near_edited`` and ``near_next`` are 1 where
    the canonical texts are equal, else 0.

    Null and empty texts are the empty text, with a fingerprint of its own. Repeated rows each get a row. Null ids come
    first in the order, tied ids go by a hash of the text. Other columns are ignored; an empty table gives an empty one.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    near = with_next(rows, "doc_id", "text", "next")
    near = near.withColumn("n_chars", F.char_length("text").cast("long")).withColumn("cut", F.floor(F.col("n_chars") / 4).cast("int"))
    edited = F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - F.col("cut")).cast("int")), F.substring("next", F.lit(1), F.col("cut")))
    near = near.withColumn("edited", edited)
    canon = near.select("doc_id", "n_chars", "edited", canonical(F.col("text")).alias("c"), canonical(F.col("edited")).alias("e"), canonical(F.col("next")).alias("n"))
    digests = canon.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), *wide_hash(F.col("c"), "c1", "c2"), *wide_hash(F.col("e"), "e1", "e2"),
        F.sha2("c", 256).alias("c_sha"), F.sha2("e", 256).alias("e_sha"), (F.col("c") == F.col("e")).cast("double").alias("near_edited"), (F.col("c") == F.col("n")).cast("double").alias("near_next"),
    )
    digests = stored(digests, "digests")

    pair = F.array(F.struct(F.col("c1").alias("k1"), F.col("c2").alias("k2")), F.struct(F.col("e1").alias("k1"), F.col("e2").alias("k2")))
    several = digests.select(F.inline(pair)).groupBy("k1", "k2").agg(F.count("*").alias("n")).where("n > 1").select("k1", "k2")
    several = stored(several, "several")
    if several.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        several = F.broadcast(several)
    members = canon.select(F.explode(F.array("c", "e")).alias("c")).select(*wide_hash(F.col("c"), "k1", "k2"), "c").join(several, ["k1", "k2"])
    mixed = members.groupBy("k1", "k2").agg(F.min("c").alias("a"), F.max("c").alias("z")).where("a <> z").select("k1", "k2", F.lit(True).alias("mixed"))
    mixed = stored(mixed, "mixed")

    def named(df: DataFrame, x: str, name: str) -> DataFrame:
        plain = F.concat(*(F.lpad(F.lower(F.hex(f"{x}{i}")), 16, "0") for i in (1, 2)))
        met = df.join(mixed.select(F.col("k1").alias(f"{x}1"), F.col("k2").alias(f"{x}2"), "mixed"), [f"{x}1", f"{x}2"], "left")
        return met.withColumn(name, F.when(F.col("mixed"), F.concat(plain, F.lit("-"), F.col(f"{x}_sha"))).otherwise(plain)).drop("mixed")

    if mixed.limit(1).count():
        digests = named(named(digests, "c", "fingerprint"), "e", "edited_fingerprint")
    else:
        digests = digests.withColumns({name: F.concat(*(F.lpad(F.lower(F.hex(f"{x}{i}")), 16, "0") for i in (1, 2))) for x, name in (("c", "fingerprint"), ("e", "edited_fingerprint"))})
    return digests.select(F.col("doc_id").alias(id_col), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def op6_fingerprints(spark, sf_dir: str) -> DataFrame:
    return document_fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet"))
