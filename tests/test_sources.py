import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_DIR, by_id
from ledgerpulse.functions.clean import feature_vector, parse_time
from ledgerpulse.operators import dims
from ledgerpulse.schema import TABLES, TXN_COLS
from ledgerpulse.sources import feeds
from ledgerpulse.sources.events import read_events
from ledgerpulse.sources.tables import append_rows, compact_day, create_tables, overwrite_table, read_table, write_csv
from ledgerpulse.storage import delete_folder, materialize, owned, shared_root


def test_json_messages(spark):
    rows = spark.createDataFrame([
        ('{"TransactionID": "1", "AccountNumber": "A", "Time": "2024-03-01T10:20:30", "Age": 7}',),
        ('{"TransactionID": "2", "Time": "2024-03-01T10:20:30.5+02:00", "TransactionAmount": 1.5}',),
        ('{"TransactionID": "3", "Acc',), (None,)], "value string")
    got = feeds.parse_json(rows).collect()
    assert got[0]["Time"] == dt.datetime(2024, 3, 1, 10, 20, 30) and got[0]["Age"] == 7
    assert got[1]["Time"] == dt.datetime(2024, 3, 1, 8, 20, 30, 500000) and got[1]["AccountNumber"] is None
    assert got[2]["_corrupt"].startswith("{") and got[2]["TransactionID"] is None
    assert all(got[3][c] is None for c in TXN_COLS)
    assert [r["TransactionID"] for r in feeds.valid_events(feeds.parse_json(rows)).collect()] == ["1"]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_time_texts_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        texts = ["3/9/2024 7:05", "2024-03-09 07:05:00", "2024-03-09T07:05:00Z", "2024-03-09T09:05:00+02:00",
                 "2024-03-10T02:30:00", "nonsense"]
        got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(parse_time("t")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == [dt.datetime(2024, 3, 9, 7, 5)] * 4 + [dt.datetime(2024, 3, 10, 2, 30), None]


def test_kafka_options():
    got = feeds.kafka_options("broker:9092", "transactions", 5000)
    assert got == {"kafka.bootstrap.servers": "broker:9092", "subscribe": "transactions",
                   "startingOffsets": "latest", "failOnDataLoss": "false", "maxOffsetsPerTrigger": "5000"}


def test_training_file(spark, tmp_path):
    lines = ["TransactionID,Time,Account Number,Transaction Amount,Age,Country 2",
             '1,12/31/2023 23:00,A,"1,234.50",30.0,MA', "2,1/2/2024 1:30,A,7,31,FR", "3,1/1/2024 0:10,A,2.5,32,ES"]
    (tmp_path / "t.csv").write_text("\n".join(lines))
    got = by_id(feeds.load_train(spark, str(tmp_path / "t.csv")))
    # ranked by time, not by the text of the time
    assert [round(got[i]["rank"], 3) for i in "123"] == [0.333, 1.0, 0.667]
    assert got["1"]["TransactionAmount"] == 1234.5 and got["1"]["Age"] == 30 and got["1"]["Country2"] == "MA"
    assert got["2"]["Date"] == dt.date(2024, 1, 2) and got["2"]["Hour"] == 1


def test_labeled_file_drops_client_columns(spark, tmp_path):
    lines = ["ClientID,ClientName,AnomalyType,TransactionID,Time,Account Number,Transaction Amount,Age,isAnomaly",
             "9,N,big,1,2024-01-01 00:00:00,A,5,40,1"]
    (tmp_path / "v.csv").write_text("\n".join(lines))
    row = feeds.load_labeled(spark, str(tmp_path / "v.csv")).first().asDict()
    assert not {"ClientID", "ClientName", "AnomalyType"} & set(row) and row["isAnomaly"] == 1
    assert feeds.anomaly_types(spark, str(tmp_path / "v.csv")).first()["AnomalyType"] == "big"


def test_tables_are_created_once_and_reset_on_request(spark, tmp_path):
    root = str(tmp_path / "lake")
    names = create_tables(spark, root, "t_")
    assert len(names) == len(TABLES) == 7
    txn = read_events(spark, SF_DIR).withColumn("bronzetimestamp", F.current_timestamp())
    for batch in (0, 1, 0):
        assert append_rows(txn, root, "bronze.transactions", batch, "t_") == txn.count()
    assert spark.table("t_bronze.transactions").count() == 2 * txn.count()
    plan = spark.table("t_bronze.transactions").filter("date = DATE'2024-01-03'")
    assert "PartitionFilters: [isnotnull(date" in plan._jdf.queryExecution().executedPlan().toString()
    create_tables(spark, root, "t_")
    assert spark.table("t_bronze.transactions").count() == 2 * txn.count()
    compact_day(spark, root, "bronze.transactions", "2024-01-03", catalog="t_")
    assert spark.table("t_bronze.transactions").count() == 2 * txn.count()
    assert {r[0] for r in spark.table("t_bronze.transactions").where("date = DATE'2024-01-03'")
            .select("batch_id").distinct().collect()} == {-1}
    rows = read_table(spark, root, "bronze.transactions")
    assert rows.count() == 2 * txn.count()
    assert [r[0] for r in rows.where("date = DATE'2024-01-03'").select("batch_id").distinct().collect()] == [-1]
    # interrupted between the deletes and the rename: nothing is doubled, and the next call finishes it
    day = tmp_path / "lake/bronze/transactions/date=2024-01-03"
    (day / "batch_id=-1").rename(day / "_merged")
    assert read_table(spark, root, "bronze.transactions").where("date = DATE'2024-01-03'").count() == 0
    compact_day(spark, root, "bronze.transactions", "2024-01-03", catalog="t_")
    assert read_table(spark, root, "bronze.transactions").count() == 2 * txn.count()
    assert spark.table("t_bronze.transactions").count() == 2 * txn.count()
    create_tables(spark, root, "t_", reset=True)
    assert spark.table("t_bronze.transactions").count() == 0 and not (tmp_path / "lake/bronze/transactions").exists()
    for n in names:
        spark.sql(f"DROP TABLE {n}")
    for layer in ("bronze", "silver", "gold"):
        spark.sql(f"DROP DATABASE t_{layer}")


def test_overwrite_replaces_and_counts(spark, tmp_path):
    df = dims.client_dim(read_events(spark, SF_DIR))
    for _ in range(2):
        assert overwrite_table(df, str(tmp_path), "gold.ClientDim") == df.count()
    assert spark.read.parquet(str(tmp_path / "gold" / "ClientDim")).count() == df.count()
    with pytest.raises(ValueError):
        append_rows(df, str(tmp_path), "gold.ClientDim", 0)


def test_csv_export(spark, tmp_path):
    write_csv(spark.createDataFrame([("a", 1.5)], "name string, score double"), str(tmp_path / "out"))
    assert spark.read.option("header", True).csv(str(tmp_path / "out")).collect()[0].asDict() == {
        "name": "a", "score": "1.5"}


def test_vector_needs_every_column(spark):
    with pytest.raises(ValueError, match="missing"):
        feature_vector(spark.range(1), ["id", "other"])


def test_shared_folder_comes_from_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert shared_root(spark) == root
    df = materialize(spark.range(3), "t")
    assert all(root in f for f in df.inputFiles()) and df.count() == 3


def test_calendar(spark):
    df = dims.time_dim(spark, 2023, 2024)
    assert df.count() == (365 + 366) * 1440
    row = df.filter("Time = TIMESTAMP_NTZ'2024-02-29 23:59:00'").first()
    assert (row["Year"], row["Quarter"], row["Month"], row["Day"], row["Hour"], row["Minute"], row["Second"]) \
        == (2024, 1, 2, 29, 23, 59, 0)


def test_owned_tables_are_deleted_at_the_end(spark):
    with owned(spark) as write:
        df = write(spark.range(3), "owned")
        path = df.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://")
        assert df.count() == 3 and os.path.isdir(path)
    assert not os.path.exists(path)
    with pytest.raises(ValueError, match="below"):
        delete_folder(spark, "/elsewhere/x", shared_root(spark))


def test_rejected_messages(spark):
    rows = spark.createDataFrame([('{"TransactionID": "1", "AccountNumber": "A"}',), ('{"TransactionID": "2"}',),
                                  ("{broken",), (None,)], "value string")
    assert sorted((r["value"] or "", r["reason"]) for r in feeds.rejected(rows).collect()) == [
        ("", "malformed"), ('{"TransactionID": "2"}', "no account"), ("{broken", "malformed")]
