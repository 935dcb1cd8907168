"""Every query against its SQL, on the smallest tables."""

import glob
import os

import duckdb
import pandas as pd
import pytest

from twinframe.operators import extraction as X
from twinframe.plans import catalogue

# Assignment runs in rounds; a few queries over it stand for the others here, all run in the driver's gate.
SLOW = {"unassigned", "assigned_suspects", "match_stats", "suggestions", "leaf_map", "inspect_manifest", "feedback_document", "image_pairs"}


def normal(value):
    if pd.isna(value):
        return "null"
    if isinstance(value, float):
        return f"{value:.5f}"
    if isinstance(value, bool):
        return str(value)
    return f"{float(value):.5f}" if isinstance(value, int) else str(value)


def rows(df):
    names = sorted(df.columns)
    return names, sorted(tuple(normal(getattr(v, "item", lambda v=v: v)()) for v in r) for r in df[names].astype(object).itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for f in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return con


@pytest.mark.parametrize("name", [n for n in catalogue.QUERIES if n not in SLOW])
def test_query(name, spark, sf, duck):
    got = catalogue.QUERIES[name](spark, sf).toPandas()
    if name in catalogue.ORACLE:
        assert rows(got) == rows(duck.execute(catalogue.ORACLE[name]).df())
    else:
        assert len(got)


def test_entry_manifest_beyond_four_digits(spark, tmp_path):
    docs = spark.range(20_000).selectExpr("id AS doc_id", "repeat('text ', 50) AS text", "'src0' AS source")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    got = catalogue.QUERIES["entry_manifest"](spark, str(tmp_path)).toPandas()
    assert got["ord"].max() > 10_000
    assert rows(got) == rows(con.execute(catalogue.ORACLE["entry_manifest"]).df())
    # the files themselves go to paths of their own
    made = X.manifest(X.named_entries(catalogue._entries(spark, str(tmp_path))), min_bytes=200)
    assert made.select("doc", "out_path").distinct().count() == len(got)


def test_entry_points_name_the_same_queries():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert catalogue.FLAGSHIP in entry.queries()


def test_the_rest_works_without_the_corpus_operators():
    import subprocess
    import sys

    code = "import sys; sys.modules['twinframe.llm'] = None; import __spark_entry__ as e; assert 'candidates' in e.queries() and 'pipeline' not in e.queries()"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=os.path.dirname(os.path.dirname(__file__)))
