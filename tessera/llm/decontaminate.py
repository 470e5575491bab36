"""Benchmark decontamination by winnowing, in DataFrame functions only.

A gram is GRAM words in a row; of every SPAN consecutive grams the smallest hash is kept, so any two equal runs of
SPAN + GRAM - 1 words, the window, have kept one value and none is missed. Three passes, of which only the first
looks into all texts:
1. each text's kept values are made in generated code, row by row as its words are exploded, and met with the items';
   what comes out are the keys of texts that share a value. A broadcast of the items' values needs no shuffle.
2. in those texts a hit is extended to the whole windows around it: the windows whose smallest gram is shared are
   looked up by the hash of all their words and then compared word by word. Equal texts are worked on once.
3. every row gets the result of its text; overlapping windows make one hit span.
Items shorter than a window are looked up as wholes, all lengths in one pass.
"""

from __future__ import annotations

import string
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import stored

WINDOW, GRAM = 13, 6
SPAN = WINDOW - GRAM + 1
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: What stands between words of either case. Words are what a split leaves: Spark's regexp_extract_all and regexp_count
#: copy the text for every match.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
#: Sides are broadcast up to these numbers of rows: kept values and text keys (16 bytes each), item windows with their
#: words (about 200 bytes), texts with hits (whose hit places are counted as rows too). Beyond, joins shuffle.
BROADCAST_KEYS, BROADCAST_WINDOWS, BROADCAST_HITS = 500_000, 100_000, 1_000_000


def _words(text: Column) -> Column:
    # lower() folds more than A-Z, but not where every character is one byte.
    ascii_ = F.octet_length(text) == F.char_length(text)
    folded = F.when(ascii_, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))
    return F.array_remove(F.split(folded, f"{BETWEEN}+"), "")


def _keys(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit("second"), text).alias("k2")]


def _gram(at: int) -> Column:
    """A gram's hash of its words' hashes; each word counts by its place."""
    return reduce(lambda x, k: x.bitwiseXOR(F.shiftleft(F.col(f"v{at + k}"), k)), range(1, GRAM), F.col(f"v{at}"))


def _hashed(texts: DataFrame, *keep: str) -> DataFrame:
    return texts.select(*keep, F.transform("words", lambda w: F.xxhash64(w)).alias("h"))


def _windows(texts: DataFrame, *keep: str) -> DataFrame:
    """(keep, at, n, value, whole) of every window of each row's ``words``: its smallest gram, the hash of its words.

    There is no filter and no null here on purpose: Spark would push it below, and make the words once more for it.
    """
    at = F.explode(F.when(F.size("h") >= WINDOW, F.sequence(F.lit(0), F.size("h") - WINDOW)))
    placed = _hashed(texts, *keep).select(*keep, "h", at.alias("at"))
    valued = placed.select(*keep, "at", *(F.coalesce(F.get("h", F.col("at") + k), F.lit(0).cast("long")).alias(f"v{k}") for k in range(WINDOW)))
    return valued.select(*keep, "at", F.lit(WINDOW).alias("n"), F.least(*(_gram(k) for k in range(SPAN))).alias("value"), F.xxhash64(*(f"v{k}" for k in range(WINDOW))).alias("whole"))


def _short_runs(texts: DataFrame, lengths: list[int], *keep: str) -> DataFrame:
    """(keep, at, n, value, whole) of every run of as many words as a short item has."""


    def of(n: int) -> Column:
        places = F.sequence(F.lit(0), F.size("h") - n)
        return F.when(F.size("h") >= n, F.transform(places, lambda at: F.struct(at.alias("at"), F.lit(n).alias("n"), F.xxhash64(*(F.get("h", at + k) for k in range(n))).alias("whole"))))

    each = [of(n) for n in lengths]
    runs = _hashed(texts, *keep).select(*keep, "h", F.explode(F.array(*each)).alias("some")).select(*keep, F.inline("some"))
    return runs.select(*keep, "at", "n", F.col("whole").alias("value"), "whole")


def _small(df: DataFrame, most: int) -> DataFrame:
    """``df`` to be broadcast if it was counted to be small, else as it is."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per training row: ``doc_id``, ``n_words``, ``n_hit``, ``items`` (ids as sorted strings), ``contaminated``
    and ``hits``, the places of the hit words from 0; then the columns named in ``keep``.

    Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z are folded. A window is 13 consecutive item words, or
    a whole item of 1 to 12; words inside any occurrence are hit. Contaminated means at least one hit word and at least
    a twentieth of all. Null and empty texts have no words. Rows may repeat and ids may be null or tied: every row gets
    its text's result. Items without an id or words have no windows; items with one id are one item. Empty tables on
    either side are fine. Only the columns named in ``keep`` are passed on, whatever their names; a kept column with
    the name of a result is a ``ValueError``.
    """
    if clash := {id_col, "n_words", "n_hit", "items", "contaminated", "hits"} & set(keep):
        raise ValueError(f"kept columns clash with results: {sorted(clash)}")
    names = [f"kept{i}" for i in range(len(keep))]
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("the_id"), *(F.col(c).alias(a) for c, a in zip(keep, names, strict=True)), text.alias("the_text"))

    item_text = F.coalesce(F.col(item_text_col).cast("string"), F.lit(""))
    wanted = items.where(F.col(item_id_col).isNotNull()).select(F.col(item_id_col).cast("string").alias("item"), _words(item_text).alias("words")).where(F.size("words") > 0)
    lengths = [r[0] for r in wanted.select(F.size("words").alias("n")).where(F.col("n") < WINDOW).distinct().orderBy("n").collect()]  # 12 at most
    runs_of = lambda texts, *keep: _windows(texts, *keep).unionByName(_short_runs(texts, lengths, *keep)) if lengths else _windows(texts, *keep)
    with_words = wanted.select("item", "words", F.xxhash64("words").alias("w")).dropDuplicates(["item", "words"])
    own = runs_of(with_words, "item", "words", "w").where((F.col("n") == WINDOW) | (F.col("n") == F.size("words")))
    windows = own.select("item", "n", "value", "whole", F.array_join(F.slice("words", F.col("at") + 1, F.col("n")), " ").alias("run"))
    windows = stored(windows.groupBy("n", "value", "whole", "run").agg(F.collect_set("item").alias("ids")), "windows")
    values = windows.select("value").distinct()
    few = values.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS

    def shared(runs: DataFrame) -> DataFrame:
        kept = runs.select("k1", "k2", "value")
        # A text's kept values are its distinct smallest grams; where nothing is shuffled the join alone sees to that.
        return (kept.join(F.broadcast(values), "value") if few else kept.distinct().join(values, "value")).select("k1", "k2").distinct()

    texts = rows.select(*_keys(F.col("the_text")), _words(F.col("the_text")).alias("words"))
    met = _small(stored(shared(runs_of(texts, "k1", "k2")), "met"), BROADCAST_KEYS)

    hit_texts = rows.select(*_keys(F.col("the_text")), "the_text").join(met, ["k1", "k2"], "left_semi").groupBy("k1", "k2").agg(F.first("the_text").alias("the_text"))
    hit_texts = stored(hit_texts.select("k1", "k2", _words(F.col("the_text")).alias("words")), "shared")
    spans = runs_of(hit_texts, "k1", "k2").join(_small(windows, BROADCAST_WINDOWS), ["n", "value", "whole"])
    spans = spans.groupBy("k1", "k2").agg(F.collect_list(F.struct("at", "n", "run", "ids")).alias("runs")).join(hit_texts, ["k1", "k2"])
    equal = F.filter("runs", lambda r: F.array_join(F.slice("words", r["at"] + 1, r["n"]), " ") == r["run"])
    spans = spans.select("k1", "k2", equal.alias("runs"))
    places = F.flatten(F.transform("runs", lambda r: F.sequence(r["at"], r["at"] + r["n"] - 1)))
    by_text = spans.select("k1", "k2", F.array_sort(F.array_distinct(places)).alias("hits"), F.array_sort(F.array_distinct(F.flatten("runs.ids"))).alias("items"))
    by_text = stored(by_text, "hits").where(F.size("hits") > 0)
    size = by_text.agg(F.coalesce(F.sum(F.size("hits") + F.size("items") + 1), F.lit(0))).first()[0]

    counted = rows.select("the_id", *names, *_keys(F.col("the_text")), F.size(F.array_remove(F.split("the_text", f"{BETWEEN}+"), "")).cast("long").alias("n_words"))
    out = counted.join(F.broadcast(by_text) if size <= BROADCAST_HITS else by_text, ["k1", "k2"], "left")
    n_hit = F.coalesce(F.size("hits"), F.lit(0))
    results = ["n_words", n_hit.cast("long").alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"), ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"), F.coalesce("hits", F.array().cast("array<int>")).alias("hits")]
    return out.select(F.col("the_id").alias(id_col), *results, *(F.col(a).alias(c) for c, a in zip(keep, names, strict=True)))


def without_hits(text: Column, hits: Column) -> Column:
    """The text without the hit words and what stands before each of them; ``hits`` are sorted places without repeats."""
    pieces = F.split(text, f"(?<!{BETWEEN})(?<!^)(?={BETWEEN})")  # each ends with a word, but for what follows the last one
    before, after = F.concat(F.array(F.lit(-1)), hits), F.concat(hits, F.array(F.size(pieces)))
    gaps = F.filter(F.zip_with(before, after, lambda a, b: F.struct((a + 2).alias("first"), (b - a - 1).alias("n"))), lambda g: g["n"] > 0)
    left = F.flatten(F.transform(gaps, lambda g: F.slice(pieces, g["first"], g["n"])))
    return F.when(F.size(hits) == 0, text).otherwise(F.array_join(left, ""))


def op7_decontaminate(spark, sf_dir: str) -> DataFrame:
    out = contamination(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")
