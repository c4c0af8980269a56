import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from eventindex.session import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (SparkSession.builder.master("local[8]").appName("tests")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.ui.enabled", "false")
               .config("spark.driver.memory", "8g")
               .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
               .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    return configure(session)


LEAF_COLUMNS = ("event_key string, event_ts timestamp, event_date date, dataset_name string,"
                "group_name string, value string, value_num double, size bigint, seq bigint")


@pytest.fixture(scope="session")
def make_leaf(spark):
    """Leaf rows from (event, dataset, value) triples, in walk order."""
    from datetime import datetime, timezone

    def make(rows):
        out = []
        for seq, (event, name, value) in enumerate(rows):
            ts = datetime(2018, 5, 13, 12, 0, 0, tzinfo=timezone.utc)
            try:
                number = None if value is None else float(value)
            except ValueError:
                number = None
            out.append((event, ts, ts.date(), name, name.rsplit("/", 1)[0] or "/", value, number,
                        64 if value is None else 1, seq))
        return spark.createDataFrame(out, LEAF_COLUMNS)
    return make
