"""Registered queries against their SQL on the smallest tables, and the entry without the corpus operators."""

import os
import shutil
import subprocess
import sys

import duckdb
import pytest

from loamstack.plans import registry

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the driver's tables")


@pytest.mark.parametrize("name", ["flagship_split_counts", "region_word", "class_map_exact_then_substring", "source_share_cap", "quota_sample", "ratio_gap", "qc_report", "export_openai"])
def test_query_gives_what_its_sql_gives(spark, name):
    db = duckdb.connect()
    for t in TABLES:
        db.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    want = db.sql(registry.ORACLE_SQL[name])
    df = registry.QUERIES[name](spark, DATA)
    assert sorted(df.columns) == sorted(want.columns)
    place = [want.columns.index(c) for c in df.columns]
    assert sorted(map(tuple, df.collect()), key=repr) == sorted((tuple(r[i] for i in place) for r in want.fetchall()), key=repr)


def test_entry_imports_without_the_corpus_operators(tmp_path):
    shutil.copytree(f"{ROOT}/loamstack", tmp_path / "loamstack", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not any(k.startswith('op') and k[2].isdigit() for k in q) and set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}, check=True)
