import pytest
from pyspark.sql import functions as F

from ledgerpulse.operators import dims
from ledgerpulse.schema import TABLES
from ledgerpulse.sources.tables import append_rows, compact_day, read_table
from ledgerpulse.storage import delete_folder
from ledgerpulse.streaming import dim_refresh


def silver(df):
    """Transactions as silver rows; the columns no dimension reads are null."""
    schema = TABLES["silver.features"][0]
    return df.select(*[F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
                       for f in schema])


def rows(df):
    return sorted(map(str, df.collect()))


def same_as_full(spark, root):
    full = read_table(spark, root, "silver.features")
    for part, table in ((dims.client_dim, "gold.ClientDim"), (dims.merchand_dim, "gold.MerchandDim")):
        assert rows(read_table(spark, root, table)) == rows(part(full))


@pytest.fixture
def lake(spark, txn, tmp_path):
    root = str(tmp_path / "lake")

    def add(batch, first, n=8):
        made = [{"TransactionID": f"{first + k:06d}", "AccountNumber": None if k == 5 else f"A{k % 3}",
                 "TransactionAmount": None if k == 4 else 0.1 * (first + k), "Channel": ["ATM", "POS", None][k % 3],
                 "MerchandCode": f"M{k % 2}", "City2": f"c{first + k}", "Age": first + k} for k in range(n)]
        append_rows(silver(txn(made)), root, "silver.features", batch)
    return root, add


def test_a_refresh_reads_the_new_batches_only(spark, lake):
    root, add = lake
    add(0, 0)
    assert dim_refresh.refresh(spark, root) == {"folders": 1, "rebuilt": True}
    add(1, 100)
    add(2, 50)        # older ids at the same times: they must not win
    assert dim_refresh.refresh(spark, root) == {"folders": 2, "rebuilt": False}
    same_as_full(spark, root)
    add(1, 100)       # repeated as it was
    assert dim_refresh.refresh(spark, root) == {"folders": 0, "rebuilt": False}
    same_as_full(spark, root)


def test_compacted_days(spark, lake):
    root, add = lake
    day, table = "2024-01-01", "silver.features"
    add(0, 0)
    add(1, 100)
    dim_refresh.refresh(spark, root)
    compact_day(spark, root, table, day)
    assert dim_refresh.refresh(spark, root) == {"folders": 0, "rebuilt": False}
    add(2, 200)
    compact_day(spark, root, table, day)      # one batch the states have not seen, two they have
    assert dim_refresh.refresh(spark, root) == {"folders": 1, "rebuilt": True}
    same_as_full(spark, root)
    add(3, 300)
    assert dim_refresh.refresh(spark, root) == {"folders": 1, "rebuilt": False}
    same_as_full(spark, root)
    delete_folder(spark, f"{root}/silver/features/date={day}/batch_id=3", root)      # rows were taken away
    assert dim_refresh.refresh(spark, root)["rebuilt"]
    same_as_full(spark, root)


def test_a_refresh_that_fails_is_done_again(spark, lake, monkeypatch):
    root, add = lake
    add(0, 0)
    dim_refresh.refresh(spark, root)
    add(1, 100)
    monkeypatch.setattr(dim_refresh.States, "commit", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        dim_refresh.refresh(spark, root)
    monkeypatch.undo()
    assert dim_refresh.refresh(spark, root) == {"folders": 1, "rebuilt": False}
    same_as_full(spark, root)
