import collections
import hashlib
import random

import pytest

from tessera.llm.components import components
from tessera.llm.near_dedup import near_dedup
from tessera.llm.scratch import even_labels
from tessera.llm.substring_dedup import packed, substring_dedup, unpacked


def windows_removed(texts, n):
    words = [(t or "").encode().split() for t in texts]
    seen = collections.Counter(tuple(w[j : j + n]) for w in words for j in range(len(w) - n + 1))
    out = []
    for w in words:
        keep = [True] * len(w)
        for j in range(len(w) - n + 1):
            if seen[tuple(w[j : j + n])] > 1:
                keep[j : j + n] = [False] * n
        out.append((len(w), len(w) - sum(keep), b" ".join(x for x, k in zip(w, keep, strict=True) if k).decode()))
    return out


def test_substring_dedup_brute_force(spark):
    random.seed(6)
    passage = [f"p{i}" for i in range(60)]
    texts = []
    for i in range(60):
        w = [random.choice("abcdefgh") + str(random.randint(0, 99)) for _ in range(random.randint(0, 120))]
        if i % 3 == 0:
            k = random.randint(0, len(w))
            w[k:k] = passage[random.randint(0, 10) : random.randint(40, 60)]
        texts.append(" \n".join(w))
    texts += ["x " * 200, "", None, texts[4], texts[4], " ".join(passage[:34]), "lone"]
    rows = [(None if i % 7 == 0 else i // 2, t, i) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words int")
    got = {r.n: (r.n_words, r.n_removed, r.kept_text) for r in substring_dedup(df.withColumnRenamed("n_words", "n"), carry=("doc_id", "n")).collect()}
    assert got == dict(enumerate(windows_removed(texts, 35)))
    assert substring_dedup(df.where("false")).count() == 0


def test_substring_dedup_carries_clashing_names(spark):
    df = spark.createDataFrame([(1, "a b c", 5, "q")], "block long, text string, n_words int, kept_text string")
    out = substring_dedup(df, carry=("block",)).collect()
    assert [tuple(r) for r in out] == [(1, 3, 0, "a b c")]


def test_windows_of_one_hash_are_told_apart(monkeypatch):
    """With first hashes of 6 bits nearly all windows collide, in a block and between blocks; the result stays right."""
    import numpy as np
    import pyarrow as pa

    from tessera.llm import substring_dedup as sd

    whole = sd.run_hashes
    monkeypatch.setattr(sd, "run_hashes", lambda *a: whole(*a) & np.uint64(0xFC00000000000000))
    random.seed(11)
    texts = [" ".join(random.choice("abcdefghij") + str(random.randint(0, 30)) for _ in range(60)) for _ in range(12)]
    texts += [texts[0], texts[5][:100] + " z " + texts[7], "", None]
    labels, blocks = [0, 1, 2], {0: [0, 1, 2, 3, 4, 12], 1: [5, 6, 7, 8, 14], 2: [9, 10, 11, 13, 15]}
    docs = {b: pa.table({"block": pa.array([b] * len(i), pa.int32()), "text": pa.array([texts[k] for k in i], pa.string()), "k": pa.array(i)}) for b, i in blocks.items()}
    sent = pa.concat_tables([pa.Table.from_batches(list(sd._send(35, labels)(iter(t.to_batches())))) for t in docs.values()])

    def by(table, column, value):
        return table.filter(pa.compute.equal(table.column(column), value))

    def answers_to(sent, round_):
        return pa.concat_tables([sd._answer(round_)(by(sent, "bucket", k)) for k in labels if by(sent, "bucket", k).num_rows])

    first = answers_to(sent, 1)
    asked = pa.concat_tables([sd._ask_again(35, labels)(t, by(first, "block", b)) for b, t in docs.items()])
    answers = pa.concat_tables([first, answers_to(asked, 2)])
    assert first.num_rows and asked.num_rows
    out = [r for b, t in docs.items() for r in sd._remove(35, labels, ["k"])(t, by(answers, "block", b)).to_pylist()]
    assert {r["k"]: (r["n_words"], r["n_removed"], r["kept_text"]) for r in out} == dict(enumerate(windows_removed(texts, 35)))


def test_packed_hashes_round_trip():
    import numpy as np

    for values in ([0], [5], [1, 2, 3], [2**64 - 1], sorted({random.randrange(2**64) for _ in range(500)})):
        a = np.array(values, np.uint64)
        assert (unpacked(packed(a)) == a).all()


def test_even_labels_fill_partitions(spark):
    from pyspark.sql import functions as F

    labels = spark.createDataFrame([(x,) for x in even_labels(23, 3)], "a int")
    counts = labels.groupBy(F.pmod(F.hash("a"), F.lit(23)).alias("p")).count().collect()
    assert len(counts) == 23 and {r["count"] for r in counts} == {3}


def reachable(nodes, links):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    return {n: root(n) for n in nodes}


def test_components_on_chains_and_stars(spark):
    random.seed(7)
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(random.randint(200, 260), random.randint(200, 260)) for _ in range(50)] + [(7, 7)]
    want = {n: c for n, c in reachable({x for p in links for x in p}, links).items() if n != c}
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def shingles(text):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


@pytest.fixture(scope="module")
def copies():
    random.seed(8)
    texts = []
    for _ in range(12):
        base = [f"w{random.randint(0, 999)}" for _ in range(random.randint(40, 300))]
        for _ in range(12):  # drifting copies: chains, pairs just over and just under the line
            texts.append(" ".join(base))
            for _ in range(random.randint(0, 4)):
                base[random.randrange(len(base))] = f"w{random.randint(0, 999)}"
    return [*texts, texts[3].upper(), texts[3], "", None, "one two", "One  TWO", "two one", "a", "É b c d e", "é b c d e"]


def test_near_dedup_brute_force(spark, copies):
    df = spark.createDataFrame([(i * 3, t, i) for i, t in enumerate(copies)], "doc_id long, text string, component_id int")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dedup(df).collect()}
    sets = {i * 3: shingles(t) for i, t in enumerate(copies)}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    want = reachable(sets, links)
    assert got == {n: (len(sets[n]), c, c == n) for n, c in want.items()}


def test_near_dedup_at_the_stage_line(spark, copies):
    import corpus_pipeline

    docs = spark.createDataFrame([(i * 3, t, "en", "s", 0) for i, t in enumerate(copies)], "doc_id long, text string, lang string, source string, n_chars long")
    sets = {i * 3: shingles(t) for i, t in enumerate(copies)}
    likeness = {(a, b): 100 * len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a in sets for b in sets if a < b and sets[a]}
    kept = {k: {n for n, c in reachable(sets, [p for p, x in likeness.items() if x >= k]).items() if n == c} for k in (80, 85)}
    assert kept[80] < kept[85]
    assert {r.doc_id for r in corpus_pipeline.near_copies(spark, docs, "").collect()} == kept[80]
    assert {r.doc_id for r in near_dedup(docs).where("kept").collect()} == kept[85]


def test_blocks_send_texts_only_of_likely_rows():
    """A bucket of many rows that are not alike: by signatures alone, all but the two that are go no further."""
    import numpy as np
    import pyarrow as pa

    from tessera.llm import near_dedup as nd

    rng = np.random.default_rng(2)
    bands, _ = nd.plan(85)
    signs = rng.integers(0, 1 << 32, (2000, bands * nd.ROWS), dtype=np.uint32)
    signs[:, : nd.ROWS] = 7  # one band of all
    signs[900] = signs[5]
    n = len(signs)
    batch = pa.RecordBatch.from_arrays([pa.array([3] * n, pa.int64()), pa.array([0] * n, pa.int32()), pa.array([False] * n), pa.array(range(n), pa.int64()), pa.array(range(n), pa.int64()), pa.array([0] * n, pa.int32()), pa.array([x.tobytes() for x in signs], pa.binary())], [*nd.TASK, "sign"])
    out = [r["id"] for b in nd._survivors(85)(iter([batch.slice(0, 700), batch.slice(700)])) for r in b.to_pylist()]
    assert out == [5, 900]


def test_near_dedup_odd_ids(spark):
    text = " ".join(f"t{i}" for i in range(30))
    rows = [(5, text), (5, text), (5, "quite another text of more than five words"), (2, "quite another text of more than five words"), (None, text), (9, text)]
    got = near_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == 6
    assert {r.component_id for r in got if r.doc_id is not None} == {2}
    assert [(r.component_id, r.kept) for r in got if r.doc_id is None] == [(None, True)]
    assert near_dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_op_queries_match_brute_force(spark, sf_dir):
    from tessera.llm.queries import QUERIES

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    want = windows_removed([r.text for r in docs], 35)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in QUERIES["op1_substring_dedup"](spark, sf_dir).collect()}
    assert got == {r.doc_id: (n, k, hashlib.sha256(t.encode()).hexdigest()) for r, (n, k, t) in zip(docs, want, strict=True)}


@pytest.mark.parametrize("name", ["op1_substring_dedup", "op2_near_dedup", "op5_warc", "op7_decontaminate"])
def test_queries_agree_with_sql(spark, sf_dir, name):
    import duckdb

    from tessera.llm.queries import ORACLE_SQL, QUERIES

    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    want = con.sql(ORACLE_SQL[name])
    df = QUERIES[name](spark, sf_dir)
    assert sorted(df.columns) == sorted(want.columns)
    assert sorted((tuple(r[c] for c in want.columns) for r in df.collect()), key=str) == sorted(want.fetchall(), key=str)
