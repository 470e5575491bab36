"""Small exact cases and invariants of the operators."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.functions import arrays, scalars
from tessera.operators import gates, jobs, reports, retry, similarity, zones


def test_prompt_lines_keep_order_and_numbers(spark):
    df = spark.createDataFrame([("a", "# head\none\n\n  Two  \nONE"), ("b", None)], "category string, text string")
    rows = [tuple(r) for r in jobs.prompt_lines(df, ["category"]).orderBy("line_no").collect()]
    assert rows == [("a", 2, "one"), ("a", 4, "Two"), ("a", 5, "ONE")]
    first = jobs.ordered_dedup(jobs.prompt_lines(df, ["category"]), "category", ["line_no"]).orderBy("line_no").collect()
    assert [r.prompt for r in first] == ["one", "Two"]


def test_numbered_runs_over_partitions(spark):
    df = spark.range(1000).select((F.col("id") % 3 == 0).cast("int").alias("k"), "id")
    out = jobs.numbered(df, "k", ["id"], "n").orderBy("k", "n").collect()
    for k in (0, 1):
        mine = [r for r in out if r.k == k]
        assert [r.n for r in mine] == list(range(1, len(mine) + 1))
        assert [r.id for r in mine] == sorted(r.id for r in mine)


@pytest.mark.parametrize(("offset", "want"), [(0, [0, 1, 2]), (64, [64, 65, 66])])
def test_variants(spark, offset, want):
    one = spark.createDataFrame([("kick-a", 3)], "id string, variants int")
    assert [r.variant_index for r in jobs.fan_out_variants(one, "variants", offset).collect()] == want


def test_variants_default_and_existing(spark):
    df = spark.createDataFrame([("a", None), ("b", 0)], "id string, variants int")
    units = jobs.fan_out_variants(df, "variants")
    assert sorted((r.id, r.variant_index) for r in units.collect()) == [("a", 0), ("b", 0)]
    there = spark.createDataFrame([("a", 0)], "id string, variant_index int")
    assert [r.id for r in jobs.not_there(units, there, ["id", "variant_index"]).collect()] == ["b"]


def test_best_of_group_ties_and_failures(spark):
    rows = [("g", 0, 0.5, None, True), ("g", 1, 0.9, None, True), ("g", 2, 0.9, None, True), ("h", 0, None, "silent", False), ("h", 1, None, "silent", False), ("h", 2, None, "clipped", False)]
    v = spark.createDataFrame(rows, "id string, variant int, score double, reason string, passed boolean")
    assert [(r.id, r.variant) for r in gates.best_of_group(v, ["id"], "score", "variant", "passed").collect()] == [("g", 1)]
    lost = gates.failed_groups(v, ["id"], "reason", "passed").collect()
    assert [(r.id, r.attempts, r.rejection_reasons) for r in lost] == [("h", 3, {"silent": 2, "clipped": 1})]


def test_first_failure_ignores_null_checks(spark):
    df = spark.createDataFrame([(None, 1), (5, 1), (5, 9)], "a int, b int")
    got = df.select(gates.first_failure(("a", F.col("a") > 9), ("b", F.col("b") > 5)).alias("r"), gates.until_failed(F.col("b"), F.col("a") > 9).alias("m")).collect()
    assert [(r.r, r.m) for r in got] == [(None, 1), (None, 1), ("b", 9)]


def test_assess_saves_siblings(spark):
    j = spark.createDataFrame([("b-p1a", "b", "P1"), ("b-p1b", "b", "P1"), ("b-p2a", "b", "P2"), ("b-p2b", "b", "P2")], "id string, category string, prompt string")
    won = spark.createDataFrame([("b-p1a",)], "id string")
    row = retry.assess(j, won, target=3).first()
    assert (row.pool, row.survivors, row.failed_jobs, row.short, row.top_up_to) == (2, 1, 2, True, 2 + 2 + 25)
    assert sorted(r.id for r in retry.failed_rows(j, won).collect()) == ["b-p2a", "b-p2b"]


def test_until_target_stops(spark):
    j = spark.createDataFrame([(f"k-{i}", "k", f"p{i}") for i in range(4)], "id string, category string, prompt string")

    def run(todo, offset):
        return todo.where(F.pmod(F.xxhash64("id", F.lit(offset)), F.lit(3)) == 0).select("id")

    def author(short, round_):
        return short.select(F.explode(F.sequence(F.lit(1), F.col("top_up_to") - F.col("pool"))).alias("i"), "category").select(F.concat_ws("-", F.lit(f"n{round_}"), "i").alias("id"), "category", F.concat_ws(" ", F.lit(f"new {round_}"), "i").alias("prompt"))

    all_jobs, winners, log = retry.until_target(j, run, author, target=6, margin=2)
    assert log[-1]["short"] == 0
    assert retry.assess(all_jobs, winners, 6).first().survivors >= 6


def test_zone_plan_covers_every_note_once(spark):
    random.seed(1)
    rows = [(i, sorted(random.sample(range(128), random.randint(1, 6)))) for i in range(40)] + [(99, [0]), (100, [127])]
    df = spark.createDataFrame(rows, "id int, sources array<int>")
    plan = zones.zone_plan(df, "id", "sources", 12, 5)
    assert zones.zone_faults(plan, "id").count() == 0
    sources = dict(rows)
    for r in plan.collect():
        assert r.source == min(sources[r.id], key=lambda s: (abs(s - r.root), s)) and r.shift == r.root - r.source
    broken = plan.withColumn("max_midi", F.when(F.col("zone") == 0, F.col("max_midi") - 1).otherwise(F.col("max_midi")))
    assert zones.zone_faults(broken, "id").count() > 0


def test_overlaps_against_all_pairs(spark):
    random.seed(2)
    rows = [(i, i % 3, b := random.uniform(0, 50), b + random.uniform(0, 9)) for i in range(80)]
    df = spark.createDataFrame(rows, "id int, g int, b double, e double")
    got = {(r.left, r.right) for r in zones.overlapping(df, ["g"], "id", "b", "e", 0.1, 4.0).collect()}
    assert got == {(p[0], q[0]) for p in rows for q in rows if p[0] < q[0] and p[1] == q[1] and min(p[3], q[3]) - max(p[2], q[2]) > 0.1}


def test_array_kernels_against_loops(spark):
    random.seed(3)
    rows = [(i, [round(random.uniform(0, 1), 3) for _ in range(60)]) for i in range(60)] + [(60, [0.0, 0.0]), (61, [1.0])]
    df = spark.createDataFrame(rows, "id int, x array<double>")
    got = df.select("id", arrays.longest_run(F.col("x"), lambda v: v >= 0.5).alias("r"), arrays.reattacks(F.col("x")).alias("n")).collect()
    for r, (_, x) in zip(sorted(got), rows, strict=True):
        best, run, start = 0, 0, -1
        for i, v in enumerate(x):
            run = run + 1 if v >= 0.5 else 0
            if run > best:
                best, start = run, i - run + 1
        hit = armed = False
        n = 0
        for v in x:
            if armed and v >= 0.5 * max(x):
                n, armed = n + 1, False
            elif v >= 0.5 * max(x):
                hit = True
            elif hit and v <= 0.15 * max(x):
                armed = True
        assert (r.r.start, r.r.length) == (start, best)
        if max(x) > 0:
            assert r.n == n


def test_rounding_and_octaves(spark):
    df = spark.createDataFrame([(2.5, 48, 5), (3.5, 48, 0), (-0.5, 40, 4)], "x double, target int, pc int")
    got = df.select(scalars.half_even(F.col("x")).alias("r"), scalars.octave_reseat(F.col("pc"), F.col("target")).alias("p"), scalars.note_name(F.col("target")).alias("n")).collect()
    assert [(r.r, r.p, r.n) for r in got] == [(2.0, 53, "C3"), (4.0, 48, "C3"), (0.0, 40, "E2")]


def test_report_with_nothing(spark):
    won = spark.createDataFrame([], "category string, measured double, target int, cents double")
    lost = spark.createDataFrame([("a",)], "category string")
    row = reports.category_report(won, lost, "category", "measured", "target", "cents").first()
    assert (row.category, row.winners, row.failures, row.survival, row.class_accuracy) == ("a", 0, 1, 0.0, None)


def test_near_duplicates_and_greedy(spark):
    random.seed(4)
    words = "deep warm punchy kick short bright soft analog tape room dry wet long fat thin sub".split()
    texts = [" ".join(random.sample(words, 14)) for _ in range(40)] + ["deep, warm kick", "Kick warm  deep", "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    sets = [frozenset((t or "").lower().replace(",", " ").split()) for t in texts]
    alike = lambda a, b: bool(a and b) and len(a & b) / len(a | b) >= 0.85
    got = {r.id: (r.class_id, r.n_links) for r in similarity.near_duplicates(df, "id", "text").collect()}
    assert got == {i: (min([j for j in range(len(sets)) if sets[j] and sets[j] == s] or [i]), sum(alike(s, sets[j]) for j in range(len(sets)) if j != i)) for i, s in enumerate(sets)}
    accepted = []
    for i, s in enumerate(sets):
        if s and not any(alike(s, sets[j]) for j in accepted):
            accepted.append(i)
    assert sorted(r.id for r in similarity.greedy_accept(df, "id", "text").collect()) == accepted


def test_profiles(spark):
    from tessera.plans import profiles

    df = spark.createDataFrame([("kick",), ("nothing",)], "category string")
    got = {r.category: (r.kind, r.centroid_hi, r.variants) for r in profiles.with_profile(df).collect()}
    assert got == {"kick": ("sub", 600.0, 6), "nothing": ("percussive", 12000.0, 5)}
    assert profiles.with_config(spark.createDataFrame([("basses",)], "category string")).first().targets == [28, 40, 52]
    with pytest.raises(Exception, match="no configuration"):
        profiles.with_config(df).collect()
    for low, high in ((r.centroid_lo, r.centroid_hi) for r in profiles.drums(spark).collect()):
        assert 0 < low < high
    for r in profiles.pitched(spark, several=False).collect():
        assert all(0 <= t <= 127 for t in r.targets) and r.span >= 0 and r.step >= 1 and r.variants >= 1


def test_authoring_is_stable_and_free_of_copies(spark):
    from tessera.catalog import QUERIES

    a, b = (sorted(map(tuple, QUERIES["authored_prompts"](spark, "/root/testdata/sf0.001").collect())) for _ in range(2))
    assert a == b and {r[0] for r in a} == {"kick", "bass"}
    for category in ("kick", "bass"):
        sets = [frozenset(r[3].lower().replace(",", " ").split()) for r in a if r[0] == category]
        assert all(len(x & y) < 0.85 * len(x | y) for i, x in enumerate(sets) for y in sets[:i])


def test_prompt_file_and_rows(spark, tmp_path):
    from tessera.sources import sinks
    from tessera.sources.files import json_rows

    lines = spark.createDataFrame([("k", "curated", 1, "a"), ("k", "generated", 2, "c"), ("k", "generated", 1, "b")], "category string, section string, place int, prompt string")
    assert sinks.prompt_file(lines).first().text == "# k: 3 prompts\n\n# --- curated ---\na\n\n# --- generated ---\nb\nc\n"
    sinks.write_json_rows(lines, str(tmp_path / "j"), ["place"])
    assert json_rows(spark, str(tmp_path / "j"), "prompt string", strict=True).count() == 3


def test_prompt_lines_are_split_and_stripped_as_python_does(spark):
    text = "one\r\n\t# gone\r\n\u00a0two\u2003\x0bthree\x85 #four\u2028\x1cfive \rsix\t\n\n  \n#"
    got = [r.prompt for r in jobs.prompt_lines(spark.createDataFrame([(1, text)], "k int, text string"), ["k"]).orderBy("line_no").collect()]
    assert got == [x.strip() for x in text.splitlines() if x.strip() and not x.strip().startswith("#")]


def test_unit_names_and_back(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("kick-ab", v) for v in (0, 9, 10, 99, 100, 128, 1234)], "id string, v int")
    units = df.select("id", "v", jobs.unit_name(F.col("id"), F.col("v"), F.lit(True)).alias("stem"))
    rows = units.select("*", jobs.pitched_variant(F.col("stem")).alias("p"), jobs.drum_variant(F.col("stem")).alias("d")).collect()
    assert len({r.stem for r in rows}) == len(rows) and all((r.p.id, r.p.variant) == (r.id, r.v) for r in rows)
    assert {r.v: (r.d.id, r.d.variant) for r in rows if r.v < 100} == {v: ("kick-ab", v) for v in (0, 9, 10, 99)}
    odd = spark.createDataFrame([("a_v1",), ("b",), ("_v22",), ("x_v",), (None,)], "s string")
    assert [tuple(r[0]) for r in odd.select(jobs.drum_variant(F.col("s"))).collect()] == [("a_v1", -1), ("b", -1), ("", 22), ("x_v", -1), (None, None)]


def test_retries_without_a_target_and_stuck_ones(spark):
    rows = spark.createDataFrame([(f"{c}{i}", c, f"{c} prompt {i}") for c in "ab" for i in range(6)], "id string, category string, prompt string")
    tries = []

    def run(todo, offset):
        tries.append((offset, sorted(r.id for r in todo.collect())))
        return todo.where(f"category = 'a' and substr(id, 2) <= {offset // 64}").select("id")

    jobs_, winners, log = retry.until_target(rows, run, lambda short, n: short.sparkSession.createDataFrame([], rows.schema), target=0)
    assert [o for o, _ in tries] == [0, 64, 128] and sorted(r.id for r in winners.collect()) == ["a0", "a1", "a2"]
    assert jobs_.count() == 12 and tries[1][1] == [f"a{i}" for i in range(1, 6)] + [f"b{i}" for i in range(6)] and log[-1]["stuck"] == ["a", "b"]


def test_drum_checks_leave_effects_and_unknown_centroids(spark):
    from pyspark.sql import functions as F

    from tessera.plans import profiles

    rows = [("riser", 1e6, 500.0), ("kick", float("nan"), 1.0), ("kick", float("inf"), 1.0), ("kick", 1e5, 1.0), ("kick", 100.0, 500.0), ("nowhere", 1.0, 1.0)]
    df = profiles.with_profile(spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, category string, centroid double, onset double"))
    none = F.lit(None).cast("string")
    got = df.select("i", profiles.drum_reason(none, none, F.lit(9.0), F.col("onset"), F.lit(0.1), F.lit(0), F.col("centroid")).alias("r")).orderBy("i").collect()
    assert [r.r for r in got] == [None, None, None, "off_band", "slow_attack", "off_band"]


def test_drum_score_of_unknown_centroids(spark):
    """A gate counts an unknown centroid 0.5; the bare formula has 0 at 0 Hz and no number below."""
    df = spark.createDataFrame([(0, 0.0), (1, None), (2, float("nan")), (3, -1.0), (4, 120.0)], "i int, centroid double")
    args = (F.col("centroid"), F.lit(80.0), F.lit(180.0), F.lit(1.0), F.lit(1.0), F.lit(12.0))
    rows = df.select(scalars.drum_score(*args).alias("gate"), scalars.drum_score(*args, unknown=None).alias("bare")).orderBy("i").collect()
    assert [r.gate for r in rows] == [0.5, 0.5, 0.5, 0.5, 1.0]
    assert [str(r.bare) for r in rows] == ["0.0", "None", "nan", "nan", "1.0"]


def test_prefilters_in_order(spark):
    from pyspark.sql import functions as F

    from tessera.functions import arrays

    wave = [0.5, -0.5] * 100
    cases = [([], []), ([float("nan")] * 4, [0.0] * 4), ([0.0] * 4, [0.0] * 4), ([1.0] * 200, [1.0] * 200), ([1.0, -1.0] * 100, [1.0, -1.0] * 100), (wave, [0.0] * 200), (wave, [x / 1000 for x in wave]), (wave, wave)]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, l array<double>, r array<double>")
    rows = df.select("i", arrays.prefilter_reason(F.col("l"), F.col("r")).alias("d"), arrays.pitched_prefilter_reason(F.col("l"), F.col("r")).alias("p")).orderBy("i").collect()
    assert [r.d for r in rows] == ["empty", "nan_or_inf", "silent", "dc_offset", "clipped", "dead_channel", None, None]
    assert [r.p for r in rows] == ["empty", "nan_or_inf", "silent", "dc_offset", "clipped", None, "dead_channel", None]
