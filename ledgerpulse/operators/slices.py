"""Accounts too large for one window task are cut into time-ordered slices.

A window partitioned by account puts every row of that account in one task. Accounts above
``max_rows`` are therefore range-partitioned by (account, time, id), and the windows run per
(account, slice). What a window needs from before its slice is put in front of it:

* the last rows before the slice (``HALO`` copies), enough for the row frames and ``lag``;
* per category value that the slice or those copies hold, how many rows came before (``CARRIED`` cells);
* per category, what all earlier values add up to (``HEAD``): rows, sum of n ln n, distinct values.

So the rows put in front of slices grow with the (value, slice) cells that exist, not with values times slices.
Every other account keeps one plain window; with no large account the plan has no extra step.
"""

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerpulse.operators.prefix import running_totals
from ledgerpulse.schema import CAT_COLS, KEY, ORDER
from ledgerpulse.storage import materialize

HOT_ROWS = 2_000_000          # rows of one account a single window task may hold
BROADCAST_ROWS = 1_000_000    # rows of a key list that may be broadcast
HEAD, CARRIED, HALO, OWN = 0, 1, 2, 3
# what a profile needs of the rows before a slice: nothing, their number, counts of values, and ranks of values
NOTHING, ROWS, VALUES, RANKS = range(4)
EXTRA = {"_cat": "int", "_n": "long", "_w": "double", "_u": "long", "_rank": "long"}


@dataclass
class HotKeys:
    table: DataFrame    # key, n
    keys: int
    rows: int

    def sized(self) -> DataFrame:
        """The table, marked for broadcast only while it is known to be small."""
        return F.broadcast(self.table) if self.keys <= BROADCAST_ROWS else self.table


@dataclass
class Keyed:
    """Rows ready for per-account windows: partition by ``part``, order by ``order``."""

    df: DataFrame
    part: list[str] = field(default_factory=lambda: [KEY])
    order: list[str] = field(default_factory=lambda: list(ORDER))
    hot: HotKeys | None = None

    @property
    def sliced(self) -> bool:
        return self.hot is not None

    def window(self, *extra: str):
        return Window.partitionBy(*self.part, *extra).orderBy(*self.order)

    @property
    def over(self) -> str:
        """The account window as SQL text."""
        return f"OVER (PARTITION BY {', '.join(self.part)} ORDER BY {', '.join(self.order)})"

    def own(self, df: DataFrame) -> DataFrame:
        """The input rows only, without what was put in front of the slices."""
        return df.filter(F.col("_kind") == OWN) if self.sliced else df


def hot_keys(df: DataFrame, key: str, max_rows: int = HOT_ROWS) -> HotKeys | None:
    """Keys with more than ``max_rows`` rows (at most total/max_rows of them), or None."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > max_rows)
    found = counts.agg(F.count(F.lit(1)).alias("keys"), F.sum("n").alias("rows")).first()
    if not found["keys"]:
        return None
    return HotKeys(materialize(counts, "hot-keys"), found["keys"], found["rows"])


def split_hot(df: DataFrame, key: str, hot: HotKeys) -> tuple[DataFrame, DataFrame]:
    """(rows of hot keys, all other rows)."""
    keys = hot.sized().select(F.col(key).alias("_hot"))
    same = F.col(key).eqNullSafe(F.col("_hot"))
    return df.join(keys, same, "left_semi"), df.join(keys, same, "left_anti")


def slice_accounts(txn: DataFrame, halo: int, totals: int, max_rows: int = HOT_ROWS) -> Keyed:
    hot = hot_keys(txn, KEY, max_rows)
    if hot is None:
        return Keyed(txn)
    hot_rows, cold_rows = split_hot(txn, KEY, hot)
    n_slices = 2 * math.ceil(hot.rows / max_rows)
    # written once: the slice numbers must be the same for rows, halo and totals
    ranged = materialize(
        hot_rows.repartitionByRange(n_slices, KEY, *ORDER)
                .withColumn("_slice", F.spark_partition_id()), "slices")
    before = _rows_before(ranged, halo) if halo else ranged.limit(0)
    rows = (cold_rows.withColumns({"_slice": F.lit(-1), "_kind": F.lit(OWN)})
            .unionByName(ranged.withColumn("_kind", F.lit(OWN)))
            .unionByName(before.withColumn("_kind", F.lit(HALO))))
    if totals == ROWS:
        rows = rows.unionByName(_rows_total(ranged, before), allowMissingColumns=True)
    elif totals:
        rows = rows.unionByName(_totals_before(ranged, before, totals == RANKS), allowMissingColumns=True)
    rows = rows.withColumns({c: F.lit(None).cast(t) for c, t in EXTRA.items() if c not in rows.columns})
    # carried totals come before every row of their slice
    rows = rows.withColumn("_follows", F.col("_kind") > CARRIED)
    return Keyed(rows, [KEY, "_slice"], ["_follows", *ORDER], hot)


def _rows_before(ranged: DataFrame, halo: int) -> DataFrame:
    """For each (account, slice) copies of the ``halo`` rows of the account just before it."""
    piece = Window.partitionBy(KEY, "_slice")
    newest = piece.orderBy(*[F.desc(c) for c in ORDER])
    # the last rows of every slice; the rows before a slice are always among them
    tails = (ranged.withColumn("_rank", F.row_number().over(newest))
             .filter(F.col("_rank") <= halo).drop("_rank"))
    previous = Window.partitionBy(KEY).orderBy(*ORDER).rowsBetween(-halo, -1)
    columns = [c for c in ranged.columns if c != "_slice"]
    return (tails
            .withColumn("_before", F.collect_list(F.struct(*columns)).over(previous))
            .withColumn("_first", F.row_number().over(piece.orderBy(*ORDER)))
            .filter(F.col("_first") == 1)
            .select("_slice", F.explode("_before").alias("_row"))
            .select("_row.*", "_slice"))


def _category_values(df: DataFrame) -> DataFrame:
    pairs = [F.struct(F.lit(i).alias("_cat"), F.col(c).alias("_value"))
             for i, c in enumerate(CAT_COLS)]
    return df.select(KEY, "_slice", F.inline(F.array(*pairs)))


def _rows_total(ranged: DataFrame, before: DataFrame) -> DataFrame:
    """For each (account, slice) the number of the account's rows before the slice's halo."""
    counts = (ranged.select(KEY, "_slice", F.lit(1).alias("_here"), F.lit(0).alias("_halo"))
              .unionByName(before.select(KEY, "_slice", F.lit(0).alias("_here"), F.lit(1).alias("_halo")))
              .groupBy(KEY, "_slice").agg(F.sum("_here").alias("_here"), F.sum("_halo").alias("_halo")))
    return counts.select(KEY, "_slice", F.lit(HEAD).alias("_kind"), F.lit(0).alias("_cat"),
                         (_sum_before("_here", KEY) - F.col("_halo")).alias("_n"))


def _sum_before(value: str, *by: str) -> Column:
    """Sum of ``value`` over the earlier slices of the same account (and category, and value)."""
    earlier = Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(earlier), F.lit(0))


def n_log_n(n: Column) -> Column:
    return F.when(n > 0, n * F.log(n)).otherwise(0.0)


def _totals_before(ranged: DataFrame, before: DataFrame, ranks: bool) -> DataFrame:
    """Heads and cells of every slice: what came before it, less the halo rows, which are counted as rows.

    A cell is a value that the slice or its halo holds, with its earlier rows. All other earlier values matter
    only in sum: each cell adds its step of n ln n, and of distinct values, to the heads of the later slices.
    """
    cell = [KEY, "_slice", "_cat", "_value"]
    one, none = F.lit(1), F.lit(0)
    held = (_category_values(ranged).withColumns({"_here": one, "_halo": none})
            .unionByName(_category_values(before).withColumns({"_here": none, "_halo": one}))
            .groupBy(*cell).agg(F.sum("_here").alias("_here"), F.sum("_halo").alias("_halo")))
    cells = materialize(held.withColumn("_prior", _sum_before("_here", KEY, "_cat", "_value")), "slice-cells")
    prior, here, halo = F.col("_prior"), F.col("_here"), F.col("_halo")
    steps = cells.groupBy(KEY, "_slice", "_cat").agg(
        F.sum("_here").alias("_rows"), F.sum(n_log_n(prior + here) - n_log_n(prior)).alias("_gain"),
        F.count_if((prior == 0) & (here > 0)).alias("_new"), F.sum("_halo").alias("_halo"),
        F.sum(n_log_n(prior) - n_log_n(prior - halo)).alias("_back"),
        F.count_if((halo > 0) & (prior == halo)).alias("_old"))
    heads = steps.select(
        KEY, "_slice", F.lit(HEAD).alias("_kind"), "_cat",
        (_sum_before("_rows", KEY, "_cat") - F.col("_halo")).alias("_n"),
        (_sum_before("_gain", KEY, "_cat") - F.col("_back")).alias("_w"),
        (_sum_before("_new", KEY, "_cat") - F.col("_old")).alias("_u"))
    if ranks:
        values = cells.select(KEY, "_cat", "_value").distinct().withColumn("_rank", F.lit(1).cast("long"))
        ranked = running_totals(values, [KEY, "_cat"], ["_value"], ["_rank"], "slice-values").select(
            F.col(KEY).alias("_r_key"), F.col("_cat").alias("_r_cat"), F.col("_value").alias("_r_value"), "_rank_upto")
        same = (F.col(KEY).eqNullSafe(F.col("_r_key")) & (F.col("_cat") == F.col("_r_cat"))
                & F.col("_value").eqNullSafe(F.col("_r_value")))
        cells = cells.join(ranked, same).withColumn("_rank", F.col("_rank_upto"))
    else:
        cells = cells.filter(prior > halo).withColumn("_rank", F.lit(None).cast("long"))
    return cells.select(
        KEY, "_slice", F.lit(CARRIED).alias("_kind"), "_cat", (prior - halo).alias("_n"), "_rank",
        *[F.when(F.col("_cat") == i, F.col("_value")).alias(c) for i, c in enumerate(CAT_COLS)]).unionByName(
        heads, allowMissingColumns=True)


def attach(rows: DataFrame, per_key: DataFrame, key: str, how: str = "left",
           max_rows: int = HOT_ROWS, spread_by: str = "TransactionID") -> DataFrame:
    """Join one-row-per-key values to rows, spreading the rows of hot keys over many tasks."""
    hot = hot_keys(rows, key, max_rows)
    if hot is None:
        return rows.join(per_key, key, how)
    salts = 2 * math.ceil(hot.rows / max_rows)
    marks = hot.sized().select(F.col(key).alias("_hot"), F.lit(salts).alias("_salts"))
    salt = F.pmod(F.xxhash64(spread_by), F.coalesce("_salts", F.lit(1))).cast("int")
    # a missing key may be the hot one: it is salted too, though it meets no values
    left = (rows.join(marks, F.col(key).eqNullSafe(F.col("_hot")), "left")
            .withColumn("_salt", salt).drop("_salts", "_hot"))
    right = (per_key.join(marks, F.col(key) == F.col("_hot"), "left")
             .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)))
             .drop("_salts", "_hot"))
    return left.join(right, [key, "_salt"], how).drop("_salt")


def is_carried(category: int) -> Column:
    return (F.col("_kind") == CARRIED) & (F.col("_cat") == category)


def is_head(category: int) -> Column:
    return (F.col("_kind") == HEAD) & (F.col("_cat") == category)


def in_front() -> Column:
    """True of heads and cells, which are no rows of the account."""
    return F.col("_kind") <= CARRIED
