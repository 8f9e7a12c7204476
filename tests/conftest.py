import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}{os.pathsep}{os.environ.get('PYTHONPATH', '')}"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "4g").getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def duck(sf_dir):
    import duckdb

    c = duckdb.connect()
    for p in Path(sf_dir).glob("*.parquet"):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}{'/*.parquet' if p.is_dir() else ''}'")
    return c
