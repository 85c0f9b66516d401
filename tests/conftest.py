import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pepweave.plans.session import ship

    s = (
        SparkSession.builder.master("local[4]").appName("tests").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g").config("spark.sql.session.timeZone", "UTC").config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared"))).getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield ship(s)
    s.stop()


@pytest.fixture(scope="session")
def compare(spark):
    """Spark's rows of a registered query against DuckDB's, on sf0.001."""
    import duckdb

    con = duckdb.connect()
    folder = "/root/testdata/sf0.001"
    for p in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")

    def norm(v):
        return repr(round(v, 8)) if isinstance(v, float) else repr(v)

    def run(query, sql):
        df = query(spark, folder)
        cols = sorted(df.columns)
        got = sorted(tuple(norm(r[c]) for c in cols) for r in df.collect())
        res = con.execute(sql)
        names = [d[0] for d in res.description]
        assert sorted(names) == cols
        want = sorted(tuple(norm(r[names.index(c)]) for c in cols) for r in res.fetchall())
        assert got == want

    return run
