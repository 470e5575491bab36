import hashlib
import html
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import warc
from tessera.llm.html_text import Sample, aligned, leaves, main_text, page_text, parsed
from tessera.llm.quality import fit, label_model, rate


def text_of(page):
    root = parsed(page)
    leaves(root)
    return main_text(root, set())


def test_article_without_its_surroundings():
    page = (
        "<html><head><title>x</title><style>p{}</style></head><body><header class='site-header'><h1>Site</h1></header><nav><ul><li>menu</ul></nav><div id=cookie-notice>cookies</div><main><article><header><h1>Tit&eacute;</h1></header>"
        "<p>One <b>bo</b>ld a < b &amp; c<p>two<br>three<aside>side</aside><section class='comments'><p>c</section><form><input>q</form><span class='ad'>buy</span><!-- no --><article>reply</article></article></main>"
        "<div class='sidebar widget'>w</div><script>if(a<b){'</p>'}</script><footer>f</footer>"
    )
    assert text_of(page) == "Tité One bold a < b & c two three"


def test_pages_without_an_article():
    assert text_of("<div class='content'><p>a</p><p>b</div><div class=ad>z</div>") == "a b"
    assert text_of("<p>x</p><ul class=menu><li>1<li>2</ul><table><tr><td>c1<td>c2</table>") == "x c1 c2"
    assert (text_of(""), text_of("plain  text"), text_of("<script>never closed")) == ("", "plain text", "")


def test_an_article_that_pages_share_stays(spark):
    pages = [(i, f"http://h.example/{i}", "<nav>menu</nav><article class='post share'><h1>One</h1><p>story for all</p></article>") for i in range(15)]
    got = page_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    assert {r.text for r in got} == {"One story for all"}


def test_tree_matching_finds_the_same_slots():
    one, two = Sample("<div><h2>Same</h2><p>one</p><p>two</p></div>"), parsed("<div><h2>Same</h2><div>new</div><p>uno</p></div>")
    leaves(two)
    ((_, pairs),) = aligned(two, [one])
    assert ("Same", "Same") in [(p.text, q.text) for p, q in pairs] and len(pairs) == 2


def test_long_lists_are_matched_as_short_ones(monkeypatch):
    import random

    from tessera.llm import html_text

    random.seed(4)

    def page(n, name):
        parts = ["<p>{t}</p>", "<h2>{t}</h2>", "<div><p>{t}</p><p>more</p></div>", "<ul><li>{t}</li></ul>", "{t}<hr>"]
        return parsed("<body><p>same</p>" + "".join(random.choice(parts).format(t=random.choice(["same", f"{name}{i}"])) for i in range(n)) + "<p>end</p></body>")

    for n, m in ((0, 9), (1, 30), (25, 40), (40, 25)):
        a, b = page(n, "x"), page(m, "y")
        want = html_text.match(a, b)
        monkeypatch.setattr(html_text, "CELLS", 20)
        got = html_text.match(a, b)
        monkeypatch.undo()
        assert got[0] == want[0] and len({id(p) for p, _ in got[1]}) == len({id(q) for _, q in got[1]}) == len(got[1])
    one = parsed("<body>" + "".join(f"<p>a{i}</p>" for i in range(1000)) + "<p>Call us now</p><p>a</p></body>")
    two = parsed("<body>" + "".join(f"<p>b{i}</p>" for i in range(300)) + "<p>Call us now</p><p>b</p></body>")
    assert ("Call us now", "Call us now") in [(p.text, q.text) for p, q in html_text.match(one, two)[1]]


def test_template_is_what_stays(spark):
    pages = [(i, f"http://h.example/{i}", f"<body><div>Welcome to us</div><div><p>Story {i} of its own</p></div><div>Call us now</div></body>") for i in range(30)]
    pages += [(100, None, None), (101, "x", ""), (102, "http://other/", "<p>alone</p>"), (102, "http://other/", "<p>alone</p>")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").selectExpr("*", "'t' as text", "1 as host")
    got = [(r.page_id, r.text, r.n_chars) for r in page_text(df).collect()]
    assert sorted(got) == sorted([(i, t := f"Story {i} of its own", len(t)) for i in range(30)] + [(100, "", 0), (101, "", 0), (102, "alone", 5), (102, "alone", 5)])
    assert page_text(df.where("false")).count() == 0


@pytest.mark.parametrize("most", [0, 1 << 25])
def test_every_layout_of_a_host_has_its_template(spark, monkeypatch, most):
    from tessera.llm import html_text

    monkeypatch.setattr(html_text, "BROADCAST_BYTES", most)
    shapes = ["<div>Top {k}</div><div><p>{t}</p></div><div>End {k}</div>", "<table><tr><td>Top {k}</td><td><p>{t}</p></td></tr></table><h4>End {k}</h4>", "<h2>Top {k}</h2><ul><li>{t}</li></ul><pre>End {k}</pre>", "<section><h3>Top {k}</h3></section><blockquote>{t}</blockquote><address>End {k}</address>"]
    pages = [(100 * k + i, f"http://h.example/{k}/{i}", "<body>" + shape.format(k=k, t=f"Story {k} {i} of its own") + "</body>") for k, shape in enumerate(shapes) for i in range(15)]
    got = page_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in got} == {100 * k + i: f"Story {k} {i} of its own" for k in range(4) for i in range(15)}


def test_small_hosts_have_a_template(spark):
    page = "<body><div>Welcome to us</div><div><p>Story {i} of its own</p></div><div>Call us now</div></body>"
    pages = [(10 * n + i, f"http://h{n}.example/{i}", page.format(i=i)) for n in (2, 3, 9) for i in range(n)]
    pages += [(200 + i, "http://same.example/", page.format(i=0)) for i in range(3)]  # one page, repeated, tells nothing
    got = {r.page_id: r.text for r in page_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got == {i: f"Story {i % 10} of its own" if i < 200 else "Welcome to us Story 0 of its own Call us now" for i, _, _ in pages}


def test_large_tables_join_samples_by_host(spark, monkeypatch):
    from tessera.llm import html_text

    monkeypatch.setattr(html_text, "BROADCAST_BYTES", 0)
    pages = [(i, f"http://h.example/{i}", f"<body><div>Welcome</div><p>Story {i}</p></body>") for i in range(20)]
    got = page_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    assert sorted(r.text for r in got) == sorted(f"Story {i}" for i in range(20))


def test_op8_query_on_all_pages(spark, sf_dir):
    from tessera.llm.queries import QUERIES

    got = {r.page_id: r.text for r in QUERIES["op8_page_text"](spark, sf_dir).collect()}
    for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect():
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)
        assert got[r.page_id] == " ".join(html.unescape(re.sub(r"<[^>]*>", " ", article[1])).split())


def test_warc_round_trip_and_look_up(spark, tmp_path):
    long = "é" * 700
    rows = [(i, f"http://a.example/{i % 7}", f"<p>{i}</p>") for i in range(40)] + [(50, "http://a.example/x", long), (51, None, long), (None, "http://A.example:80/x#f", long), (52, "http://a.example/y\n z", None), (53, "", "short"), (54, "", "short"), (54, "", "short")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    directory = warc.write_archives(df, f"file://{tmp_path}/w")
    out = warc.read_archives(directory)
    best: dict[bytes, int] = {}
    for i, _, h in rows:
        p = (h or "").encode()
        if len(p) >= 1000 and i is not None:
            best[p] = max(best.get(p, i), i)
    want = []
    for i, _, h in rows:
        p = (h or "").encode()
        again = p in best and best[p] != i
        want.append((i, len(p), hashlib.sha1(p).hexdigest(), "revisit" if again else "response", best[p] if again else None))
    for read in (out, warc.read_records(directory), warc.read_records(directory, with_payload=False)):
        assert sorted(((r.page, r.payload_bytes, r.sha1, r.type, r.refers_to) for r in read.collect()), key=str) == sorted(want, key=str)
    assert sorted(r["page"] for r in warc.find(directory, "https://a.example/3")) == [3, 10, 17, 24, 31, 38]
    assert {(r["page"], r["type"]) for r in warc.find(directory, "http://a.example/x")} == {(50, "revisit"), (None, "revisit")}
    assert warc.find(directory, "http://nowhere/") == []
    with pytest.raises(Exception, match="is not what the directory says"):
        warc.read_records(directory.withColumn("first_key", F.lit("a"))).collect()
    none = warc.write_archives(df.where("false"), f"file://{tmp_path}/e")
    assert warc.read_archives(none).count() == warc.read_records(none).count() == 0


def test_warc_blocks_of_a_long_index(spark, tmp_path, monkeypatch):
    pages = [(i, f"http://h{i % 50}.example/{i}", f"<p>{i % 900}</p>", "x") for i in range(3000)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string, payload string")
    directory = warc.write_archives(df, f"file://{tmp_path}/w").cache()
    assert directory.count() >= 6 and directory.agg(F.sum("lines")).first()[0] == 3000
    got = {r.page: bytes(r.payload).decode() for r in warc.read_records(directory).collect()}
    assert got == {i: h for i, _, h, _ in pages}
    assert all([r["page"] for r in warc.find(directory, f"http://h{i % 50}.example/{i}")] == [i] for i in (0, 1499, 2999))


def test_label_model_finds_accuracies():
    rng = np.random.default_rng(3)
    bad = rng.random(20000) < 0.2
    rates = np.array([[0.8, 0.6, 0.7], [0.05, 0.1, 0.02]])
    fired = rng.random((20000, 3)) < rates[1 - bad.astype(int)]
    patterns, counts = np.unique(fired @ (1 << np.arange(3)), return_counts=True)
    _, on_bad, on_good = label_model(patterns, np.full(len(patterns), -1), counts.astype(float), 3)
    assert np.abs(on_bad - rates[0]).max() < 0.05 and np.abs(on_good - rates[1]).max() < 0.03


def test_classifier_on_held_out_labels(spark):
    """Fitted on half of the labels, judged by the other half."""
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    docs = docs.join(labels.select("doc_id"), "doc_id", "left_semi")
    model = fit(docs, labels.where("doc_id % 2 = 0"))
    rows = rate(docs, model).select("doc_id", "kept").join(labels.where("doc_id % 2 = 1"), "doc_id").collect()
    clean = [r.kept for r in rows if r.quality == 1 and r.toxic == 0]
    junk = [r.kept for r in rows if r.quality == 0]
    toxic = [r.kept for r in rows if r.toxic == 1]
    assert np.mean(clean) > 0.98 and np.mean(junk) < 0.1 and np.mean(toxic) < 0.3


def test_scorer_learns_from_the_whole_sample():
    import inspect

    from tessera.llm import quality

    assert quality.SAMPLE == 4000 and inspect.signature(quality.train).parameters["rounds"].default == 400
    # One bad document among many good ones: what only it has still gets a weight.
    x = [np.array([1, 2], np.int32), *(np.array([2, 3], np.int32) for _ in range(600))]
    weight, _ = quality.train(x, np.array([1.0] + [0.0] * 600))
    assert weight[1] > 0


def test_classifier_edges(spark):
    rows = [(1, None), (None, ""), (2, "a fine text of common words " * 5), (2, "THIS!! IS!! LOUD!! " * 20)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as junk")
    assert rate(df, fit(df)).count() == 4
    assert rate(df.where("false"), fit(df.where("false"))).count() == 0


def test_pipeline(spark, sf_dir):
    import corpus_pipeline as pipeline

    raw = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*pipeline.COLUMNS)
    docs = raw
    seen = []
    for _, stage in pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir).collect()
        assert set(out[0].asDict()) == set(pipeline.COLUMNS)
        docs = spark.createDataFrame(out, raw.schema)
        seen.append({r.doc_id: r.text for r in out})
    labels = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    clean = [i for i, r in labels.items() if r.quality == 1 and r.toxic == 0]
    assert sum(i in seen[0] for i in clean) >= 0.95 * len(clean)
    assert len(seen[0]) > len(seen[1]) >= len(seen[2]) >= len(seen[3])
    windows: dict[tuple, int] = {}
    for text in seen[1].values():
        w = text.split()
        for j in range(len(w) - 34):
            windows[tuple(w[j : j + 35])] = windows.get(tuple(w[j : j + 35]), 0) + 1
    for i, text in seen[1].items():
        w, keep = text.split(), [True] * len(text.split())
        for j in range(len(w) - 34):
            if windows[tuple(w[j : j + 35])] > 1:
                keep[j : j + 35] = [False] * 35
        assert seen[2][i] == " ".join(x for x, k in zip(w, keep, strict=True) if k)
    last = pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    assert {r.doc_id: r.text for r in last} == seen[3] and all(r.ids[-1] == 2 for r in last)


def test_names_in_an_article():
    page = "<article><header class='entry-header'><h1>Title</h1></header><div class='long-form'><p>one</p></div><div class='alert'>two</div><p>x <math><mi>a</mi><mo>=</mo><mn>1</mn></math></p><div class='related widget'>no</div><div class='ad'>no</div><footer>no</footer></article><div class='alert'>no</div>"
    assert text_of(page) == "Title one two x a=1"


def test_deeply_nested_pages(spark):
    deep = lambda i, n: "<body>" + "<div>" * n + f"<p>Welcome</p><p>Story {i}</p>" + "</div>" * n + "</body>"
    pages = [(i, "http://h.example/", deep(i, 3000)) for i in range(4)] + [(9, "http://g.example/", deep(9, 20000))]
    got = {r.page_id: r.text for r in page_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got == {**{i: f"Story {i}" for i in range(4)}, 9: "Welcome Story 9"}


def test_passages_that_articles_share_stay(spark):
    """In a host whose pages often begin alike, and in one with copies of an article, only the site's line goes."""
    pages = [(i, "http://h.example/", f"<nav>m</nav><article><p>{'A common opening.' if i % 3 == 0 else f'Opening {i}.'}</p><p>Story {i}</p><p>Read on in our shop</p></article><ul><li>{i}</ul>") for i in range(40)]
    pages += [(100 + i, "http://copies.example/", f"<article><p>{'The very same long first paragraph of an article. ' * 3}</p><p>copy {i}</p></article>") for i in range(20)]
    got = {r.page_id: r.text for r in page_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert all(got[i] == f"{'A common opening.' if i % 3 == 0 else f'Opening {i}.'} Story {i}" for i in range(40))
    assert all(got[100 + i] == f"{('The very same long first paragraph of an article. ' * 3).strip()} copy {i}" for i in range(20))


def test_pages_without_any_mark_by_induction_alone(spark):
    """Only what changes from page to page tells the content here: no article, no names, no roles."""
    random.seed(5)
    pages, want = [], {}
    for i in range(60):
        story = [f"Paragraph {i} {k} {random.random()}" for k in range(random.randint(1, 5))]
        want[i] = " ".join(story)
        pages.append((i, "http://plain.example/", "<body><table><tr><td>Home</td><td>Products</td></tr></table><div><div>Breaking offers</div>" + "".join(f"<p>{x}</p>" for x in story) + "</div><div>Call 555</div><div>All rights reserved</div></body>"))
    got = {r.page_id: r.text for r in page_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got == want


def test_run_against_brute_force(spark, sf_dir):
    """Every stage after the trained one, by plain Python over what the classifier kept."""
    import corpus_pipeline as pipeline
    from test_dedup import reachable, shingles, windows_removed
    from test_texts import WORD_OF, hits

    from tessera.llm.pieces import Pieces

    got = {r.doc_id: (r.text, r.ids, r.lang, r.source) for r in pipeline.run(spark, sf_dir).collect()}
    raw = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs = {r.doc_id: r for r in pipeline.quality(spark, raw, sf_dir).collect()}
    sets = {i: shingles(r.text) for i, r in docs.items()}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    kept = [i for i, c in reachable(sets, links).items() if i == c]
    texts = dict(zip(kept, (t for _, _, t in windows_removed([docs[i].text for i in kept], 35)), strict=True))
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    found = hits(list(texts.items()), items, places=True)
    import public_tokenizers

    library = Pieces(public_tokenizers.path("piece_bpe_32k.model")).library
    want = {}
    for i, text in texts.items():
        n, hit = found[i]
        if hit and 20 * len(hit) >= n:
            continue
        if hit:  # each word goes with what stands before it
            ends = [m.end() for m in re.finditer(WORD_OF, text)]
            cuts = [text[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]
            text = "".join(c for k, c in enumerate(cuts) if k not in hit) + text[ends[-1] :]
        want[i] = (text, library.encode(text, add_eos=True), docs[i].lang, docs[i].source)
    assert len(want) < len(docs) < raw.count()
    assert got == want


def test_pipeline_stages_take_odd_rows(spark, sf_dir):
    """Nulls, empty and repeated texts, tied ids, no rows at all, a column that a stage uses itself."""
    import corpus_pipeline as pipeline

    text = " ".join(f"word{i}" for i in range(50))
    rows = [(1, None, "en", "s", None), (2, "", None, "s", 0), (3, text, "en", None, 5), (3, text, "en", "t", 5), (None, text + " end", "en", "s", 1), (9, "one two", "de", "s", 7)]
    docs = spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, lang string, source string, n_chars long, k1 string")
    for name, stage in pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        found = out.collect()
        assert stage(spark, docs.where("false"), sf_dir).count() == 0
        assert {"doc_id", "text", "lang", "source"} <= set(out.columns)
        assert len(found) == len(rows) or name in ("quality classifier", "MinHash near-dedup")
