"""The driver contract: smoke entry, and every query against its DuckDB oracle (sf0.001)."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from ledgerline.plans.catalogue import TABLES
from ledgerline.plans.driver import QUERIES
from tools.check_oracle import digest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    yield con
    con.close()


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "label" in df.columns and "title_key" in df.columns


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.oracle_sql()) and set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(E.oracle_sql()[name])
    drows = cur.fetchall()
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(df.columns, srows) == digest(dcols, drows)


def test_entry_without_the_optional_packages(tmp_path):
    """With the llm folders gone the rest still imports."""
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    shutil.copytree(f"{root}/ledgerline", tmp_path / "ledgerline", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as E; assert len(E.queries()) == len(E.oracle_sql()) > 20"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=120, env={**os.environ, "PYTHONPATH": str(tmp_path)})


def test_monthly_snapshots_write_few_files(spark):
    from ledgerline.plans.driver import q_latest_snapshot
    from ledgerline.session import _SCRATCH, clean_scratch
    from ledgerline.sources import fs

    clean_scratch(spark)
    q_latest_snapshot(spark, SF).count()
    path = _SCRATCH[-1] + "/atp_orders"
    days = fs.list_dirs(spark, path)
    assert all(len([f for f in fs.list_files(spark, f"{path}/{d}") if f.startswith("part-")]) == 1 for d in days) and len(days) > 50
    assert clean_scratch(spark) >= 1 and not fs.exists(spark, path)
