import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession
    session = (SparkSession.builder.master("local[8]").appName("ledgerpulse-tests")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
               .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
               .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
               .config("spark.driver.memory", "6g").getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def txn(spark):
    """Builds a transaction table from dicts; what is not given gets a constant."""
    from ledgerpulse.schema import TXN_SCHEMA
    base = dict(CardNumber="C", TransactionType="PAYMENT", Channel="ATM", TransactionAmount=10.0,
                MerchandCode="M", MerchandGroup="TECH", Country="MA", City="Rabat", Country2="FR",
                City2="Paris", CardType="VISA", Age=30, Gender="F", Bank="CDM", AccountNumber="A")
    start = dt.datetime(2024, 1, 1)

    def build(rows):
        full = []
        for i, r in enumerate(rows):
            row = {**base, "TransactionID": f"{i:06d}", "Time": start + dt.timedelta(hours=i), **r}
            full.append(tuple(row[f] for f in TXN_SCHEMA.fieldNames()))
        return spark.createDataFrame(full, TXN_SCHEMA)
    return build


def by_id(df):
    return {r["TransactionID"]: r.asDict() for r in df.collect()}
