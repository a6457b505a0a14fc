import os
import sys
import tempfile

os.environ.setdefault("TZ", "UTC")
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark():
    at = tempfile.mkdtemp(prefix="halyard-tests-")
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", at)
        .config("spark.sql.warehouse.dir", f"{at}/warehouse")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def against_oracle(spark):
    """Runs a query and its SQL and compares names and values as the driver does, in any row order."""
    import duckdb

    def same(run, sql: str, sf_dir: str) -> int:
        got = run(spark, sf_dir).toPandas()
        db = duckdb.connect()
        for file in os.listdir(sf_dir):
            db.sql(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{sf_dir}/{file}')")
        want = db.sql(sql).df()
        assert sorted(got.columns) == sorted(want.columns)
        columns = sorted(got.columns)
        rows = [x[columns].astype(str).sort_values(columns).to_numpy().tolist() for x in (got, want)]
        assert rows[0] == rows[1]
        return len(got)

    return same
