"""From raw documents to token ids: five stages, each written as Parquet and read again as the next one's input.

Documents that the quality classifier rejects go; one document of each group of near copies stays; passages that
repeat are cut; documents that a benchmark contaminates go, and from those with fewer hit words these are cut; what is
left is encoded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.decontaminate import contamination, without_hits
from tessera.llm.near_dedup import near_dedup
from tessera.llm.pieces import piece_codec
from tessera.llm.quality import classify
from tessera.llm.scratch import forget, fresh_path, stored
from tessera.llm.substring_dedup import substring_dedup

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Ids of dropped copies are broadcast up to this number (8 bytes each), else joined by a shuffle.
BROADCAST_IDS = 1_000_000
#: Near copies are documents whose sets of five words share this many percent or more.
NEAR_PERCENT = 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the classifier keeps. A null or empty text is rated by its shape, as junk; an empty table stays empty."""
    return classify(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), carry=COLUMNS).where("kept").select(*COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row of the smallest id of each group of near copies. Rows of one id are one document and stay or go
    together; rows without an id, words or text are like no other and stay."""
    dropped = stored(near_dedup(docs, percent=NEAR_PERCENT).where("not kept").select("doc_id").distinct(), "copies")
    if dropped.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
        dropped = F.broadcast(dropped)
    return docs.join(dropped, "doc_id", "left_anti").select(*COLUMNS)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, without words of windows that occur again anywhere, in repeated rows too; a null text becomes ""."""
    out = substring_dedup(docs, carry=("doc_id", "lang", "source"))
    return out.select("doc_id", F.col("kept_text").alias("text"), "lang", "source", F.char_length("kept_text").cast("long").alias("n_chars"))


def benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that no benchmark contaminates, without their hit words; rows without words stay, ids may be null or tied."""
    out = contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), keep=COLUMNS[1:]).where("not contaminated")
    out = out.withColumn("text", without_hits(F.col("text"), F.col("hits")))
    return out.select("doc_id", "text", "lang", "source", F.char_length("text").cast("long").alias("n_chars"))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with their ids and the text that these decode to; a null or empty text has the end id alone."""
    import public_tokenizers

    out = piece_codec(docs, public_tokenizers.path("piece_bpe_32k.model"), carry=("doc_id", "lang", "source"))
    return out.withColumnRenamed("decoded", "text")


STAGES = [("quality classifier", quality), ("MinHash near-dedup", near_copies), ("substring dedup", repeated_passages), ("benchmark decontamination", benchmarks), ("SentencePiece encoding and decoding", pieces)]
#: The classifier and the piece agenda have no SQL form. The tests hold run()'s rows against a brute-force version of
#: all stages but the first, whose rates are measured on held-out labels.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*COLUMNS)
    for name, stage in STAGES:
        path = fresh_path(spark, name.split()[0].lower())
        stage(spark, docs, sf_dir).write.parquet(path)
        if name != STAGES[0][0]:
            forget(docs)  # the stage before has been used
        docs = spark.read.parquet(path)
    return docs
