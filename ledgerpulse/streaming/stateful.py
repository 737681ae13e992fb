"""Trailing features on a stream: each account's last rows live in Spark's state store."""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ledgerpulse.functions.trailing import category_arrays, trailing_rows
from ledgerpulse.schema import (CAT_COLS, ENGINEERED_COLS, EPS, KEY, TXN_COLS, TXN_SCHEMA,
                                WINDOW_ROWS)

STATE_SCHEMA = T.StructType([
    T.StructField("seconds", T.ArrayType(T.LongType())),
    T.StructField("logs", T.ArrayType(T.DoubleType())),
    *[T.StructField(c, T.ArrayType(T.StringType())) for c in CAT_COLS],
])
OUTPUT_SCHEMA = T.StructType(
    [*TXN_SCHEMA.fields, *[T.StructField(c, T.DoubleType()) for c in ENGINEERED_COLS]])


def stateful_features(stream: DataFrame, ttl_ms: int | None = None, window: int = WINDOW_ROWS) -> DataFrame:
    """One output row per input row, with features over the account's last ``window`` rows.

    Rows of one micro-batch are ordered by (Time, TransactionID); a row that arrives in a later
    micro-batch counts as newer, and its negative gap is clamped. A function call holds one
    account's rows of one micro-batch, so the source's per-trigger limit bounds its memory.
    With ``ttl_ms`` accounts that stay silent that long are forgotten. A checkpoint belongs to one window: restarted with a larger
    one, it first has the rows that the smaller one kept.
    """
    if window < 1:
        raise ValueError("a window has at least one row")
    timeout = GroupStateTimeout.ProcessingTimeTimeout if ttl_ms else GroupStateTimeout.NoTimeout

    def advance(key, blocks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        frames = list(blocks)
        rows = frames[0] if len(frames) == 1 else pd.concat(frames, ignore_index=True)
        stamp = rows["Time"].to_numpy().astype("datetime64[us]")
        stamp = np.where(np.isnat(stamp), np.datetime64(0, "us"), stamp).astype(np.int64)
        order = np.lexsort((rows["TransactionID"].to_numpy(dtype=object).astype(str), stamp))
        seconds = stamp[order] // 1_000_000
        amount = rows["TransactionAmount"].to_numpy(dtype=float)[order]
        logs = np.log(np.where(amount > EPS, amount, EPS))
        cats = [c[order] for c in category_arrays(rows)]
        before = 0
        if state.exists:
            kept = state.get
            before = len(kept[0])
            seconds = np.concatenate([np.array(kept[0], dtype=np.int64), seconds])
            logs = np.concatenate([np.array(kept[1], dtype=float), logs])
            cats = [np.concatenate([np.array(k, dtype=object), c]) for k, c in zip(kept[2:], cats)]
        features = trailing_rows(seconds, logs, cats, seconds // 3600 % 24, window)
        state.update((seconds[-window:].tolist(), logs[-window:].tolist(),
                      *[[None if pd.isna(v) else v for v in c[-window:]] for c in cats]))
        if ttl_ms:
            state.setTimeoutDuration(ttl_ms)
        # two blocks put together: adding columns one by one costs more than computing them
        added = pd.DataFrame(np.column_stack([features[c][before:] for c in ENGINEERED_COLS]), columns=ENGINEERED_COLS)
        yield pd.concat([rows[TXN_COLS].take(order).set_axis(added.index), added], axis=1)

    return (stream.select(*TXN_COLS).groupBy(KEY)
            .applyInPandasWithState(advance, OUTPUT_SCHEMA, STATE_SCHEMA, "append", timeout))
