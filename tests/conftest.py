import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = {"tiny": "/root/testdata/sf0.001", "small": "/root/testdata/sf0.01"}


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    scratch = tempfile.mkdtemp(prefix="duotier-test-", dir="/tmp")
    s = (
        SparkSession.builder.master("local[*]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.warehouse.dir", os.path.join(scratch, "warehouse"))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    # tests only: the cluster would name a shared checkpoint folder itself
    from duotier.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(s, os.path.join(scratch, "checkpoints"))
    s.conf.set("duotier.root", os.path.join(scratch, "store"))
    yield s


@pytest.fixture(scope="session")
def duck_tiny():
    import duckdb

    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF['tiny']}/{t}.parquet')")
    return con
