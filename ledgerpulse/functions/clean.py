"""Row and column cleaning: casts, calendar parts, missing values, flags, vectors."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerpulse.schema import ANOMALY_THRESHOLD, CRITICAL_THRESHOLD, FEATURE_COLS


def drop_null_rows(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return df.na.drop(subset=columns)


def clean_number(column: str) -> Column:
    """'12,345.60' -> 12345.6"""
    return F.regexp_replace(F.col(column).cast("string"), ",", "").cast("double")


def date_hour(df: DataFrame) -> DataFrame:
    return df.withColumns({"Date": F.to_date("Time"), "Hour": F.hour("Time")})


def finite(column: str) -> Column:
    """The value, or null where it is missing, NaN or infinite."""
    c = F.col(column).cast("double")
    return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)


def fill_zero(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: F.coalesce(finite(c), F.lit(0.0)) for c in columns})


@dataclass
class MeanImputer:
    """Missing, NaN and infinite values become the mean of the column's finite values."""

    columns: list[str]
    means: dict[str, float] | None = None

    def fit(self, df: DataFrame) -> "MeanImputer":
        row = df.agg(*[F.avg(finite(c)).alias(c) for c in self.columns]).first()
        self.means = row.asDict()
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: F.coalesce(finite(c), F.lit(self.means[c]).cast("double"))
                               for c in self.columns})


def anomaly_flags(df: DataFrame, score: str = "modelscore", anomaly: float = ANOMALY_THRESHOLD,
                  critical: float = CRITICAL_THRESHOLD) -> DataFrame:
    return df.withColumns({"IsAnomaly": F.col(score) > anomaly, "IsCritical": F.col(score) > critical})


def feature_vector(df: DataFrame, columns: list[str] = FEATURE_COLS, name: str = "vector") -> DataFrame:
    """The columns as one array, in the given order; every column must exist."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"feature columns missing: {missing}")
    return df.withColumn(name, F.array(*[F.coalesce(finite(c), F.lit(0.0)) for c in columns]))


def parse_time(column: str) -> Column:
    """Timestamp text as UTC wall-clock time.

    Accepts month/day/year hour:minute, ISO text, and ISO text with an offset (shifted to UTC).
    """
    text = F.col(column).cast("string")
    wall = F.expr(f"try_cast(`{column}` AS timestamp_ntz)")
    instant = F.expr(f"convert_timezone(current_timezone(), 'UTC', "
                     f"cast(try_cast(`{column}` AS timestamp) AS timestamp_ntz))")
    us_style = text.rlike(r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}$")
    with_offset = text.rlike(r"\d{2}:\d{2}.*(Z|[+-]\d{2}(:?\d{2})?)$")
    return (F.when(us_style, F.to_timestamp_ntz(text, F.lit("M/d/yyyy H:mm")))
            .when(with_offset, instant).otherwise(wall))
