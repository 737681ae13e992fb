"""Rows of the bronze, silver and gold tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerpulse.functions.clean import anomaly_flags
from ledgerpulse.schema import (ANOMALY_THRESHOLD, CRITICAL_THRESHOLD, ENGINEERED_COLS, FACT_COLS,
                                TXN_COLS)


def bronze_rows(txn: DataFrame) -> DataFrame:
    return txn.select(*TXN_COLS, F.current_timestamp().alias("bronzetimestamp"))


def silver_rows(scored: DataFrame, score: str, explain: str) -> DataFrame:
    return scored.select(*TXN_COLS, *ENGINEERED_COLS, F.col(score).alias("modelscore"),
                         F.col(explain).alias("modelexplain"),
                         F.current_timestamp().alias("silvertimestamp"))


def transaction_fact(silver: DataFrame, anomaly: float = ANOMALY_THRESHOLD,
                     critical: float = CRITICAL_THRESHOLD) -> DataFrame:
    return anomaly_flags(silver, "modelscore", anomaly, critical).select(
        *FACT_COLS, "modelscore", "IsAnomaly", "IsCritical",
        F.current_timestamp().alias("goldtimestamp"))


def explain_fact(silver: DataFrame) -> DataFrame:
    """One row per (transaction, feature)."""
    return silver.select("TransactionID", "Time",
                         F.explode("modelexplain").alias("FeatureName", "FeatureValue"))
