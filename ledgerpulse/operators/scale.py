"""Feature scaling as fit / transform pairs."""

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerpulse.operators.slices import HOT_ROWS, attach
from ledgerpulse.schema import CLIENT_COLS, EPS, FEATURE_COLS, GLOBAL_COLS, KEY
from ledgerpulse.storage import materialize

# Scaling methods and their report labels.
METHODS = {
    "none": "No Scaling",
    "global_minmax": "Global MinMax",
    "global_standard": "Global Standard",
    "global_minmax_client_minmax": "Global MinMax + Client MinMax",
    "global_standard_client_standard": "Global Standard + Client Standard",
}


def _seen(column: str) -> Column:
    c = F.col(column).cast("double")
    return F.when(~F.isnan(c), c)


@dataclass
class Scaler:
    """``fit`` learns (centre, divisor) per column, ``transform`` applies (x - centre) / divisor.

    Whole-table statistics are scalars of the model. Per-account statistics stay a written table
    that is joined to the rows.
    """

    method: str = "none"
    global_cols: list[str] | None = None
    client_cols: list[str] | None = None
    key: str = KEY
    max_rows: int = HOT_ROWS
    centers: dict[str, tuple[float | None, float | None]] = field(default_factory=dict)
    clients: DataFrame | None = None

    def __post_init__(self):
        if self.method not in METHODS:
            raise ValueError(f"unknown scaling method {self.method!r}")
        self.per_client = "client" in self.method
        self.minmax = "minmax" in self.method
        if self.global_cols is None:
            self.global_cols = GLOBAL_COLS if self.per_client else FEATURE_COLS
        if self.client_cols is None:
            self.client_cols = CLIENT_COLS if self.per_client else []

    def _center(self, c: str) -> Column:
        return F.min(_seen(c)) if self.minmax else F.avg(_seen(c))

    def _divisor(self, c: str) -> Column:
        if self.minmax:
            spread = F.max(_seen(c)) - F.min(_seen(c))
        else:
            spread = F.stddev_samp(_seen(c)) if self.per_client else F.stddev_pop(_seen(c))
        if self.per_client:
            return spread + F.lit(EPS)
        return F.when(spread == 0, 1.0).otherwise(spread)    # a constant column is only shifted

    def _stats(self, columns: list[str]) -> list[Column]:
        return [f(c).alias(f"{c}{s}") for c in columns
                for s, f in (("__center", self._center), ("__divisor", self._divisor))]

    def fit(self, df: DataFrame) -> "Scaler":
        if self.method == "none":
            return self
        row = df.agg(*self._stats(self.global_cols)).first()
        self.centers = {c: (row[f"{c}__center"], row[f"{c}__divisor"]) for c in self.global_cols}
        if self.client_cols:
            self.clients = materialize(
                df.groupBy(self.key).agg(*self._stats(self.client_cols)), "client-scale")
        return self

    def transform(self, df: DataFrame, suffix: str = "") -> DataFrame:
        """Scaled columns in place of the raw ones, or beside them under ``name + suffix``."""
        out = {c: (F.col(c) - F.lit(a).cast("double")) / F.lit(b).cast("double")
               for c, (a, b) in self.centers.items()}
        rows = df
        if self.clients is not None:
            rows = attach(df, self.clients, self.key, "left", self.max_rows)
            out |= {c: (F.col(c) - F.col(f"{c}__center")) / F.col(f"{c}__divisor")
                    for c in self.client_cols}
        out = {f"{c}{suffix}": e for c, e in out.items()}
        return rows.withColumns(out).select(*dict.fromkeys([*df.columns, *out])) if out else df


def minmax_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Each score column stretched to 0..1."""
    return Scaler("global_minmax", global_cols=columns).fit(df).transform(df)
