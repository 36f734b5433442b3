"""Queries against their SQL on the smallest tables, and the entry points without the llm subpackage."""

import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

from assayer.plans import queries as engine

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    return round(v, 6) if isinstance(v, float) else v if isinstance(v, int | type(None)) else str(v)


@pytest.mark.parametrize("name", sorted(engine.queries()))
def test_query(spark, name):
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    df = engine.queries()[name](spark, DATA)
    cols = sorted(df.columns)
    got = sorted([tuple(plain(r[c]) for c in cols) for r in df.collect()], key=repr)
    run = db.execute(engine.oracle_sql()[name])
    names = [d[0] for d in run.description]
    want = sorted([tuple(plain(r[names.index(c)]) for c in cols) for r in run.fetchall()], key=repr)
    assert sorted(names) == cols and got == want


def test_entry_without_llm(tmp_path):
    """On a copy without the subpackage, its tests and the pipeline everything else imports, and nothing asks for them."""
    root = Path(__file__).resolve().parent.parent
    copy = tmp_path / "copy"
    shutil.copytree(root, copy, ignore=lambda folder, names: [n for n in names if n in (".git", "__pycache__", "corpus_pipeline.py", "llm")])
    assert not list(copy.rglob("llm"))
    code = "import pkgutil, importlib, assayer, __spark_entry__ as e; [importlib.import_module(m.name) for m in pkgutil.walk_packages(assayer.__path__, 'assayer.')]; assert e.queries() and set(e.oracle_sql()) <= set(e.queries()) and not any(k.startswith('op') or k == 'pipeline' for k in e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=copy, check=True, timeout=120)
