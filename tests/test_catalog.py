"""Every query of the catalogue against its SQL, at the smallest scale."""

import decimal

import duckdb
import pytest

from tessera import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, bool):
        return str(v)
    return str(round(float(v), 6)) if isinstance(v, (int, float, decimal.Decimal)) else str(v)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, sf_dir, db, name):
    df = catalog.QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    if name not in catalog.ORACLE_SQL:
        assert got
        return
    want = db.sql(catalog.ORACLE_SQL[name])
    names = want.columns
    assert sorted(names) == columns
    assert got == sorted(tuple(plain(r[names.index(c)]) for c in columns) for r in want.fetchall())


def test_scores_of_odd_values(spark, tmp_path):
    """Values that no band is near to, which the smallest scale lacks: zero first, of which the larger tables have some."""
    values = [0.0, -0.0, None, float("nan"), float("inf"), float("-inf"), -5.0, 5e-324, 1e300, 137.0, 250.0]
    rows = [(i * 20 + k, v) for i, v in enumerate(values) for k in range(20)]
    spark.createDataFrame(rows, "event_id long, value double").write.parquet(str(tmp_path / "events.parquet"))
    got = [tuple(map(str, r)) for r in catalog.QUERIES["candidate_scores"](spark, str(tmp_path)).orderBy("event_id").collect()]
    con = duckdb.connect()
    con.sql(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    want = [tuple(map(str, r)) for r in con.sql(f"SELECT * FROM ({catalog.ORACLE_SQL['candidate_scores']}) ORDER BY event_id").fetchall()]
    assert len(got) == len(rows) and got == want


def test_entry_contract(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("gone", [("tessera/llm",), ("tessera/llm", "corpus_pipeline.py")])
def test_entry_without_the_corpus_operators(tmp_path, gone):
    import os
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for name in ("tessera", "__spark_entry__.py", "corpus_pipeline.py"):
        at = os.path.join(root, name)
        if os.path.isdir(at):
            shutil.copytree(at, tmp_path / name, ignore=shutil.ignore_patterns("__pycache__", "llm"))
        elif os.path.exists(at) and name not in gone:
            shutil.copy(at, tmp_path / name)
    code = "import __spark_entry__ as e; q = e.queries(); assert q and set(e.oracle_sql()) <= set(q) and not [n for n in q if n == 'pipeline' or n.startswith('op')]"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
