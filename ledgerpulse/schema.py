"""Names, types and constants shared by every module."""

from pyspark.sql import types as T

# The transaction event, its categories and the model input order.
TXN_SCHEMA = T.StructType([
    T.StructField("TransactionID", T.StringType()),
    T.StructField("Time", T.TimestampNTZType()),
    T.StructField("AccountNumber", T.StringType()),
    T.StructField("CardNumber", T.StringType()),
    T.StructField("TransactionType", T.StringType()),
    T.StructField("Channel", T.StringType()),
    T.StructField("TransactionAmount", T.DoubleType()),
    T.StructField("MerchandCode", T.StringType()),
    T.StructField("MerchandGroup", T.StringType()),
    T.StructField("Country", T.StringType()),
    T.StructField("City", T.StringType()),
    T.StructField("Country2", T.StringType()),
    T.StructField("City2", T.StringType()),
    T.StructField("CardType", T.StringType()),
    T.StructField("Age", T.IntegerType()),
    T.StructField("Gender", T.StringType()),
    T.StructField("Bank", T.StringType()),
])
TXN_COLS = TXN_SCHEMA.fieldNames()

# category column -> prefix of its Freq / Entropy feature
CATEGORIES = {
    "TransactionType": "TransactionType",
    "Channel": "Channel",
    "CardType": "CardType",
    "MerchandGroup": "Merchand",
    "Country": "Country",
    "City": "City",
}
CAT_COLS = list(CATEGORIES)
FREQ_COLS = [f"{p}Freq" for p in CATEGORIES.values()]
ENTROPY_COLS = [f"{p}Entropy" for p in CATEGORIES.values()]
TIME_COLS = ["LogAmount", "AmountZScore", "MovingAvg", "MovingStd",
             "LogTimeDiff", "HourSin", "HourCos"]
FEATURE_COLS = ["Age", *TIME_COLS, *FREQ_COLS, *ENTROPY_COLS]
ENGINEERED_COLS = FEATURE_COLS[1:]

# columns scaled over the whole table / within the account; the hour pair stays as it is
GLOBAL_COLS = ["Age", "LogAmount", "LogTimeDiff", *ENTROPY_COLS]
CLIENT_COLS = ["AmountZScore", "MovingAvg", "MovingStd", *FREQ_COLS]

WINDOW_ROWS = 7
EPS = 1e-6
ANOMALY_THRESHOLD = 3.5
CRITICAL_THRESHOLD = 5.25

KEY = "AccountNumber"
ORDER = ["Time", "TransactionID"]


def _doubles(names):
    return [T.StructField(n, T.DoubleType()) for n in names]


BRONZE_SCHEMA = T.StructType(
    [*TXN_SCHEMA.fields, T.StructField("bronzetimestamp", T.TimestampType())])

SILVER_SCHEMA = T.StructType([
    *TXN_SCHEMA.fields,
    *_doubles(ENGINEERED_COLS),
    T.StructField("modelscore", T.DoubleType()),
    T.StructField("modelexplain", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("silvertimestamp", T.TimestampType()),
])

TIME_DIM_SCHEMA = T.StructType([
    T.StructField("Time", T.TimestampNTZType()),
    T.StructField("Date", T.DateType()),
    *[T.StructField(n, T.IntegerType())
      for n in ("Year", "Quarter", "Month", "Day", "Hour", "Minute", "Second")],
])

CLIENT_DIM_SCHEMA = T.StructType([
    T.StructField("AccountNumber", T.StringType()),
    T.StructField("CardNumber", T.StringType()),
    T.StructField("Age", T.IntegerType()),
    T.StructField("Gender", T.StringType()),
    T.StructField("Bank", T.StringType()),
    T.StructField("CardType", T.StringType()),
    T.StructField("AvgTxnAmount", T.DoubleType()),
    T.StructField("UsualChannel", T.StringType()),
])

MERCHAND_DIM_SCHEMA = T.StructType(
    [T.StructField(n, T.StringType())
     for n in ("MerchandCode", "MerchandGroup", "Country", "City")])

FACT_COLS = ["TransactionID", "Time", "AccountNumber", "MerchandCode", "TransactionType",
             "Channel", "TransactionAmount", "Country", "City"]
TRANSACTION_FACT_SCHEMA = T.StructType([
    *[TXN_SCHEMA[c] for c in FACT_COLS],
    T.StructField("modelscore", T.DoubleType()),
    T.StructField("IsAnomaly", T.BooleanType()),
    T.StructField("IsCritical", T.BooleanType()),
    T.StructField("goldtimestamp", T.TimestampType()),
])

EXPLAIN_FACT_SCHEMA = T.StructType([
    T.StructField("TransactionID", T.StringType()),
    T.StructField("Time", T.TimestampNTZType()),
    T.StructField("FeatureName", T.StringType()),
    T.StructField("FeatureValue", T.DoubleType()),
])

# table -> (schema, partitioned by the calendar day of Time)
TABLES = {
    "bronze.transactions": (BRONZE_SCHEMA, True),
    "silver.features": (SILVER_SCHEMA, True),
    "gold.TimeDim": (TIME_DIM_SCHEMA, False),
    "gold.ClientDim": (CLIENT_DIM_SCHEMA, False),
    "gold.MerchandDim": (MERCHAND_DIM_SCHEMA, False),
    "gold.TransactionFact": (TRANSACTION_FACT_SCHEMA, True),
    "gold.ExplainFact": (EXPLAIN_FACT_SCHEMA, True),
}
