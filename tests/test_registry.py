import glob
import math
import os

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def plain(v):
    return round(v, 6) if isinstance(v, float) and not math.isnan(v) else v


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for p in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"create view {os.path.basename(p)[:-8]} as select * from read_parquet('{p}')")
    return con


def core() -> list[str]:
    from lamina.plans import ALL

    return [n for r in ALL for n in r.sql]


@pytest.mark.parametrize("name", core())
def test_agrees_with_its_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr)
    res = duck.execute(entry.oracle_sql()[name])
    have = [d[0] for d in res.description]
    assert sorted(have) == cols
    want = sorted((tuple(plain(r[have.index(c)]) for c in cols) for r in res.fetchall()), key=repr)
    assert got == want


def test_entry_and_names(spark):
    assert entry.entry(spark).limit(1).count() == 1
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_the_core_does_not_import_the_subpackage():
    root = os.path.dirname(os.path.abspath(entry.__file__))
    for path in glob.glob(f"{root}/lamina/**/*.py", recursive=True):
        if f"{os.sep}llm{os.sep}" not in path:
            with open(path, encoding="utf-8") as f:
                assert "lamina.llm" not in f.read(), path
