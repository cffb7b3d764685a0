"""Every registered query of the library runs on the smallest tables and agrees with its SQL."""

import glob
import math
import os
import random

import duckdb
import pytest

from corpusmill.operators import features
from corpusmill.plans import catalogue
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{SMALL}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return con


def plain(v):
    return round(v, 6) if isinstance(v, float) and not math.isnan(v) else v


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, duck, name):
    df = catalogue.QUERIES[name](spark, SMALL)
    order = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in order) for r in df.collect()), key=repr)
    assert got
    if name in catalogue.ORACLES:
        cur = duck.execute(catalogue.ORACLES[name])
        names = [d[0] for d in cur.description]
        assert sorted(names) == order
        at = [names.index(c) for c in order]
        assert got == sorted((tuple(plain(r[i]) for i in at) for r in cur.fetchall()), key=repr)


@pytest.mark.parametrize("name", ["minhash_signature", "minhash_buckets"])
def test_signatures_are_computed_once(spark, name):
    df = catalogue.QUERIES[name](spark, SMALL)
    assert df._jdf.queryExecution().executedPlan().toString().count("EvalPython") == 1


def test_release_computes_features_once(spark):
    plan = catalogue.release_export(spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("startswith") + plan.count("StartsWith") <= 2, plan  # lines with and without #, in one heading ratio


def test_tasks_grow_in_number_not_in_size(spark, monkeypatch):
    monkeypatch.setattr(catalogue, "TASK_BYTES", 10_000)
    size = os.path.getsize(f"{SMALL}/documents.parquet")
    assert catalogue._spread(catalogue._docs(spark, SMALL)).rdd.getNumPartitions() == -(-size // 10_000)


def rows_of(spark, duck, name, folder, table, rows, schema):
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{table}.parquet")
    got = [tuple(r) for r in catalogue.QUERIES[name](spark, str(folder)).collect()]
    con = duckdb.connect()
    con.execute(f"create view {table} as select * from '{folder}/{table}.parquet/*.parquet'")
    sql = catalogue.ORACLES[name]
    return sorted(got), lambda text=sql: sorted(con.execute(text).fetchall())


def test_affine_of_large_keys(spark, duck, tmp_path):
    rows = [(k, 1 + k % 7, 3 * k, k) for k in (0, 1, 921_000, 922_000, 36_000_000, 1 << 40)]
    got, want = rows_of(spark, duck, "affine_61", tmp_path, "lineitem", rows, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long")
    wide = catalogue.ORACLES["affine_61"].replace("l_orderkey *", "l_orderkey::HUGEINT *").replace("l_suppkey *", "l_suppkey::HUGEINT *").replace("l_partkey *", "l_partkey::HUGEINT *")
    assert got == want(wide)


@pytest.mark.parametrize("name", ["line_filter", "line_filter_strict"])
def test_texts_without_lines(spark, duck, tmp_path, name):
    long = "some words that make a line which is long enough to be kept by its score of words and letters alone here\n"
    texts = [None, "", "\n", "\n\n", "a", long, f"{long}\n{long}", f"x\n{long}", "\r\n", " "]
    got, want = rows_of(spark, duck, name, tmp_path, "documents", list(enumerate(texts)), "doc_id long, text string")
    assert got == want() and len(got) == len(texts) - 2


def test_discrete_quantiles(spark):
    r = random.Random(4)
    for values in ([r.gauss(9, 1) for _ in range(30_001)], [1.5] * 50 + [2.5] * 50, [1.0, 1.0 + 2**-52, 3e300, -1e300, 5e-324], [7.0], []):
        df = spark.createDataFrame([(v,) for v in values], "v double")
        told = duckdb.execute("select quantile_disc(v, [1 / 3.0, 2 / 3.0]) from (select unnest(?::double[]) as v)", [values]).fetchone()[0]
        assert features.discrete_quantiles(df, "v", (1 / 3, 2 / 3)) == (told or [None, None])


def test_imports_without_the_pipeline():
    """The library does not import its llm subpackage."""
    import subprocess
    import sys

    code = "import corpusmill.plans.catalogue, corpusmill.plans.curation, sys; assert not [m for m in sys.modules if 'llm' in m]"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
