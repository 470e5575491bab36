"""Token counts under a unigram vocabulary, without making the tokens.

An Aho-Corasick automaton lists every vocabulary match of a word; a pass over the word's ends carries the best score
and the number of pieces of the best segmentation. Rules of the tokenizers library's unigram model: scores are doubles
added from the left; a segmentation replaces another only if its score is greater, and of the matches with one end the
longest is tried first; a character that no one-character piece matches is unknown at the smallest score less 10; an
unknown character counts as its UTF-8 bytes where the vocabulary has byte pieces, else a run of them counts as one.
Texts are cut to words as by its Metaspace splitter; each distinct word is counted once and kept by the worker.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Kept, chunks, resident

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
CACHE_BYTES = 192 << 20


def unigram_vocabulary(model_path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a SentencePiece file, by id."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
    return [(sp.id_to_piece(i), sp.get_score(i)) for i in range(sp.get_piece_size())]


class Counter:
    def __init__(self, vocabulary: list[tuple[str, float]]) -> None:
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        names = {x for x, _ in vocabulary}
        self.bytes = all(f"<0x{b:02X}>" in names for b in range(256))
        self.unknown = min(s for _, s in vocabulary) - UNKNOWN_PENALTY
        self.cache = Kept(CACHE_BYTES)

    def count(self, word: str) -> int:
        n = len(word)
        ending: list[list] = [[] for _ in range(n + 1)]
        single = bytearray(n)
        for last, (size, score) in self.automaton.iter(word):
            ending[last + 1].append((size, score))
            if size == 1:
                single[last] = 1
        best, pieces, open_ = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        for end in range(1, n + 1):
            found, count, unknown = None, 0, False
            for size, score in sorted(ending[end], reverse=True):
                if found is None or score + best[end - size] > found:
                    found, count = score + best[end - size], pieces[end - size] + 1
            if not single[end - 1] and (found is None or self.unknown + best[end - 1] > found):
                found, unknown = self.unknown + best[end - 1], True
                count = pieces[end - 1] + (len(word[end - 1].encode()) if self.bytes else not open_[end - 1])
            best[end], pieces[end], open_[end] = found, count, unknown
        return pieces[n]

    def counts(self, texts: list[str]) -> list[int]:
        if not texts:
            return []
        return self.of_texts(pa.array(texts, pa.large_string())).tolist()

    def of_texts(self, texts: pa.Array) -> np.ndarray:
        split = pc.split_pattern(pc.replace_substring(texts, " ", SPACE), SPACE)
        at = np.asarray(split.offsets).astype(np.int64)
        at -= at[0]
        coded = pc.dictionary_encode(split.flatten())
        words = coded.dictionary.to_pylist()
        known = self.cache.get(words)
        new = {word: self.count(SPACE + word) for word, x in zip(words, known, strict=True) if x is None}
        self.cache.add(new)
        pieces = np.array([new[word] if x is None else x for word, x in zip(words, known, strict=True)], np.int64)
        # The splitter puts a space in front unless there is one, and no text has no word: a first cut without
        # characters is neither.
        counts = pieces[np.asarray(coded.indices)]
        firsts = at[:-1]
        empty = pc.equal(split.flatten().take(pa.array(firsts)), "").to_numpy(zero_copy_only=False)
        counts[firsts[empty]] = 0
        return np.add.reduceat(counts, firsts)


def _count(key: str, vocabulary: list[tuple[str, float]]):
    def run(batches):
        counter = resident("counts", key, lambda: Counter(vocabulary))
        for batch in batches:
            out = [counter.of_texts(texts) for _, texts in chunks(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("carry"), pa.array(np.concatenate(out) if out else [], pa.int64())], ["carry", "n_tokens"])

    return run


def token_counts(docs: DataFrame, vocabulary: list[tuple[str, float]], key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id`` and ``n_tokens``. ``key`` names the vocabulary for workers' memory.

    Null and empty texts count 0. Texts are counted whole, repeated rows each; ids are only carried; other columns are
    ignored; an empty table gives an empty table. There is no shuffle.
    """
    rows = docs.select(F.col(id_col).alias("carry"), F.col(text_col).cast("string").alias("text"))
    out = rows.mapInArrow(_count(key, vocabulary), f"carry {docs.schema[id_col].dataType.simpleString()}, n_tokens long")
    return out.withColumnRenamed("carry", id_col)


def op9_token_counts(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    return token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"), unigram_vocabulary(path), path)
