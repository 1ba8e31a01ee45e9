import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parents[1])
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")])
DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "4g").getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def compare(spark):
    """Runs a query and its SQL over the smallest tables and compares them as bags of rows."""
    import duckdb

    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for f in Path(DATA).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")

    def norm(x):
        if isinstance(x, float):
            return round(x, 6)
        if isinstance(x, (list, tuple)):
            return tuple(map(norm, x))
        return x

    def check(query, sql):
        df = query(spark, DATA)
        cols = sorted(df.columns)
        own = sorted(repr([norm(r[c]) for c in cols]) for r in df.collect())
        r = con.execute(sql)
        names = [c[0] for c in r.description]
        assert sorted(names) == cols
        other = sorted(repr([norm(row[names.index(c)]) for c in cols]) for row in r.fetchall())
        assert own == other
        return own

    return check
