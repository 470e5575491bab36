import hashlib
import random
import re
import string
import unicodedata
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tessera.llm import token_store
from tessera.llm.decontaminate import WORD, contamination, without_hits
from tessera.llm.fingerprints import document_fingerprints
from tessera.llm.pieces import Pieces, piece_codec
from tessera.llm.token_counts import Counter, token_counts, unigram_vocabulary

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
PARTS = ["a", "the", " ", "  ", "   ", "\n", "\t", " \n", "é", "日本", "😀", "<s>", "</s>", "<|endoftext|>", "<0x41>", "ing", "'ll", "1", "23", "▁", " ", "　", "\x1c", "!?", "x" * 60]


def odd_texts(n, seed):
    random.seed(seed)
    return ["".join(random.choice(PARTS) for _ in range(random.randint(0, 14))) for _ in range(n)] + ["", " ", "  ", " a", "a ", "A b"]


def test_pieces_agree_with_the_library():
    pieces, texts = Pieces(PIECES), odd_texts(3000, 9)
    assert pieces.encode(texts) == [x for x in pieces.library.encode(texts, add_eos=True)]
    assert all(pieces.agenda("▁" + w) == pieces.agendas(["▁" + w])[0] for w in ("anea,", "Öß!", "日b", "aaaaaaa"))


def test_piece_codec_rows(spark):
    rows = [(1, "Hello  wörld\n"), (1, None), (None, ""), (2, "word " * 5000)]
    got = sorted(((r.doc_id or 0), r.n_tokens, r.decoded) for r in piece_codec(spark.createDataFrame(rows, "doc_id long, text string"), PIECES).collect())
    library = Pieces(PIECES).library
    assert got == sorted((i or 0, len(library.encode(t or "")) + 1, library.decode(library.encode(t or ""))) for i, t in rows)
    digest = piece_codec(spark.createDataFrame(rows[:1], "doc_id long, text string"), PIECES, digests=True).first()
    ids = library.encode(rows[0][1], add_eos=True)
    assert digest.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
    assert piece_codec(spark.createDataFrame([], "doc_id long, text string"), PIECES).count() == 0


def test_token_cuts_agree_with_the_library():
    tokens, texts = token_store.Tokens(BYTES), odd_texts(3000, 10)
    assert tokens.cuttable
    assert [np.frombuffer(x, np.uint32).tolist() for x in tokens.encode(texts)] == [x.ids for x in tokens.library.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("n", [0, 1, 3, 4, 5, 1000])
def test_shard_round_trip(n):
    ids = np.random.default_rng(n).zipf(1.3, n).clip(0, 70000).astype(np.uint32)
    table, control, data = token_store.coded(ids)
    assert (token_store.decoded(table, control, data, n) == ids).all()
    counts = np.bincount(ids, minlength=1)
    assert (np.diff(counts[table].astype(int)) <= 0).all() and len(control) == -(-n // 4)
    doc_ids, lengths, back = token_store.read_shard(token_store.shard_bytes([3, None], [n, 0], ids))
    assert doc_ids == [3, None] and lengths.tolist() == [n, 0] and (back == ids).all()


def test_token_store_rows(spark, tmp_path):
    rows = [(7, "b"), (3, "some text"), (None, "no id"), (3, None), (9, "long " * 3000), (-2, "")]
    manifest = token_store.write_tokens(spark.createDataFrame(rows, "doc_id long, text string"), BYTES, f"file://{tmp_path}/t")
    got = token_store.read_tokens(manifest).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, -2, 3, 3, 7, 9]
    library = token_store.Tokens(BYTES).library
    start = 0
    for r in got:
        assert r.start == start and r.ids[-1] == 0 and r.n_tokens == len(r.ids)
        assert any(i == r.doc_id and library.encode(t or "").ids == r.ids[:-1] for i, t in rows)
        start += r.n_tokens
    crc = token_store.read_tokens(manifest, with_ids=False).orderBy("start").collect()
    assert [r.ids_crc32 for r in crc] == [zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in got]
    assert token_store.read_tokens(token_store.write_tokens(spark.createDataFrame([], "doc_id long, text string"), BYTES, f"file://{tmp_path}/e")).count() == 0


@pytest.mark.parametrize("bytes_too", [True, False])
def test_unigram_counts_agree_with_the_library(bytes_too):
    from tokenizers import Tokenizer, models, pre_tokenizers

    vocabulary = [x for x in unigram_vocabulary(PIECES) if bytes_too or not x[0].startswith("<0x")]
    library = Tokenizer(models.Unigram(vocabulary, unk_id=0, byte_fallback=bytes_too))
    library.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    texts = odd_texts(2000, 11)
    assert Counter(vocabulary).counts(texts) == [len(x.ids) for x in library.encode_batch(texts, add_special_tokens=False)]


def test_unigram_ties_go_to_the_longest(spark):
    vocabulary = [("<unk>", 0.0), ("▁", -1.0), ("a", -1.0), ("aa", -2.0), ("aaa", -3.0)]
    assert Counter(vocabulary).counts(["aaa", "aaaa", "", "b", "bb"]) == [2, 3, 0, 2, 2]
    df = spark.createDataFrame([(None, None), (1, "aaa")], "doc_id long, text string")
    assert sorted(r.n_tokens for r in token_counts(df, vocabulary, "ties").collect()) == [0, 2]


#: A word before A-Z are folded.
WORD_OF = WORD.replace(r"\x3A-\x60", r"\x3A-\x40\x5B-\x60")


def hits(docs, items, places=False):
    low = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
    words = lambda x: re.findall(WORD, (x or "").translate(low))
    windows: dict[tuple, set] = {}
    for i, x in items:
        w = words(x)
        if w and i is not None:
            n = min(13, len(w))
            for j in range(len(w) - n + 1):
                windows.setdefault(tuple(w[j : j + n]), set()).add(str(i))
    out = {}
    for i, x in docs:
        w, hit, found = words(x), set(), set()
        for n in {len(k) for k in windows}:
            for j in range(len(w) - n + 1):
                if (k := tuple(w[j : j + n])) in windows:
                    hit.update(range(j, j + n))
                    found |= windows[k]
        out[i] = (len(w), hit) if places else (len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w))
    return out


@pytest.mark.parametrize("short", [False, True])
def test_contamination_brute_force(spark, short):
    random.seed(12)
    letters = ["a", "b", "C", "é", "1"]
    docs = [(i, " ".join(random.choice(letters) for _ in range(random.randint(0, 80)))) for i in range(50)] + [(100, None), (101, ""), (102, " !! "), (103, "A b! " * 30), (104, "A b! " * 30)]
    items = [(i, " ".join(random.choice(letters) for _ in range(random.randint(13, 30)))) for i in range(8)] + [(50, docs[3][1]), (51, " ".join(docs[5][1].split()[2:20])), (51, "a b " * 7), (52, None), (None, docs[7][1])]
    if short:
        items += [(60, "C c C"), (61, docs[9][1][:12]), (62, "1")]
    if not short:
        items = [(i, t) for i, t in items if len((t or "").split()) >= 13 or i in (52, None)]
    out = contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {r.doc_id: (r.n_words, r.n_hit, r["items"], r.contaminated) for r in out.collect()} == hits(docs, items)


def test_contamination_of_nothing(spark):
    docs, none = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    assert contamination(docs, none).first().n_hit == 0
    assert contamination(docs.where("false"), none).count() == 0


def test_without_hits(spark):
    df = spark.createDataFrame([("a, b! C d e.", [1, 2]), ("x", []), ("--a b--", [1])], "t string, h array<int>")
    assert [r[0] for r in df.select(without_hits(F.col("t"), F.col("h"))).collect()] == ["a d e.", "x", "--a--"]


def test_fingerprints(spark):
    docs = [(5, "Straße  ﬁne"), (3, "STRASSE fine"), (9, None), (8, ""), (-4, "éa b c d"), (2, "éa　b c d"), (None, "x y z"), (11, "Ångström"), (11, "Ångström"), (12, "word " * 400)]
    rows = document_fingerprints(spark.createDataFrame(docs, "doc_id long, text string")).collect()

    def canonical(x):
        return " ".join(unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", x).casefold()).split())

    order = sorted(docs, key=lambda r: (r[0] is not None, r[0] or 0))
    want = []
    for k, (i, x) in enumerate(order):
        x, after = x or "", order[(k + 1) % len(order)][1] or ""
        m = len(x) // 4
        edited = x[: len(x) - m] + after[:m]
        want.append((i, len(x), hashlib.sha256(edited.encode()).hexdigest(), float(canonical(x) == canonical(edited)), float(canonical(x) == canonical(after))))
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256, r.near_edited, r.near_next) for r in rows), key=str) == sorted(want, key=str)
    prints = {r.doc_id: r.fingerprint for r in rows}
    assert prints[5] == prints[3] and prints[-4] == prints[2] and prints[8] == prints[9]
    assert len(set(prints.values())) == len({canonical(x or "") for _, x in docs})
    assert document_fingerprints(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_contamination_with_clashing_names(spark):
    docs = spark.createDataFrame([(1, "x " + "q w e r t y u i o p a s d f", 5, "k", 7), (1, None, 6, "m", 8)], "the_id long, the_text string, k1 int, kept0 string, at int")
    items = spark.createDataFrame([(3, "Q w e r t y u i o p a s d"), (4, "X")], "ids long, words string")
    out = contamination(docs, items, "the_id", "the_text", "ids", "words", keep=("k1", "kept0", "at", "the_text"))
    assert out.columns == ["the_id", "n_words", "n_hit", "items", "contaminated", "hits", "k1", "kept0", "at", "the_text"]
    got = sorted(tuple(r) for r in out.collect())
    assert got[0][:6] == (1, 0, 0, [], False, []) and got[0][6:] == (6, "m", 8, None)
    assert got[1][:6] == (1, 15, 14, ["3", "4"], True, list(range(14))) and got[1][6:9] == (5, "k", 7)
    with pytest.raises(ValueError):
        contamination(docs.withColumnRenamed("k1", "hits"), items, "the_id", "the_text", "ids", "words", keep=("hits",))


def test_contamination_by_shuffles(spark, monkeypatch):
    from tessera.llm import decontaminate

    for name in ("BROADCAST_KEYS", "BROADCAST_WINDOWS", "BROADCAST_HITS"):
        monkeypatch.setattr(decontaminate, name, 0)
    random.seed(13)
    docs = [(i, " ".join(random.choice("abc") for _ in range(random.randint(0, 60)))) for i in range(40)]
    items = [(i, docs[i][1][4:50]) for i in range(6)] + [(9, "a b c")]
    out = contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {r.doc_id: (r.n_words, r.n_hit, r["items"], r.contaminated) for r in out.collect()} == hits(docs, items)


def test_a_very_long_text_is_searched_whole(spark):
    item = " ".join(f"i{k}" for k in range(20))
    docs = [(1, "w " * 60000 + item), (2, item + " w" * 60000)]
    out = contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert {r.doc_id: (r.n_words, r.n_hit, r.hits[0], r.contaminated) for r in out.collect()} == {1: (60020, 20, 60000, False), 2: (60020, 20, 0, False)}
    cut = out.withColumn("text", F.when(F.col("doc_id") == 1, F.lit(docs[0][1])).otherwise(F.lit(docs[1][1]))).select("doc_id", without_hits(F.col("text"), F.col("hits")).alias("t")).collect()
    assert {r.doc_id: r.t for r in cut} == {1: ("w " * 60000).rstrip(), 2: " w" * 60000}
