"""The registered queries as plain SQL over the same tables, written independently of the code."""

from ledgerpulse.schema import (CAT_COLS, CLIENT_COLS, ENGINEERED_COLS, ENTROPY_COLS,
                                FEATURE_COLS, FREQ_COLS, GLOBAL_COLS, TABLES, TXN_COLS)

ORACLES: dict[str, str] = {}
ACC = "AccountNumber"
ID = "TransactionID"
MOVING = ["MovingAvg", "MovingStd", "AmountZScore"]

TXN = """
raw AS (SELECT *, CAST(props->>'k' AS INT) AS k FROM events),
txn AS (
  SELECT CAST(event_id AS VARCHAR) AS TransactionID, ts AS Time,
    'ACC' || CAST(100000 + user_id AS VARCHAR) AS AccountNumber,
    'CARD' || CAST(1000 + user_id % 9000 AS VARCHAR) AS CardNumber,
    event_type AS TransactionType,
    CASE k % 4 WHEN 0 THEN 'ATM' WHEN 1 THEN 'POS' WHEN 2 THEN 'WEB' ELSE 'MOBILE' END AS Channel,
    value AS TransactionAmount,
    'MER' || CAST(1000 + k AS VARCHAR) AS MerchandCode,
    CASE k % 7 % 4 WHEN 0 THEN 'GROCERY' WHEN 1 THEN 'TECH' WHEN 2 THEN 'TRAVEL' ELSE 'RESTAURANT' END AS MerchandGroup,
    CASE event_id % 11 % 4 WHEN 0 THEN 'MA' WHEN 1 THEN 'FR' WHEN 2 THEN 'ES' ELSE 'US' END AS Country,
    CASE event_id % 13 % 5 WHEN 0 THEN 'Casablanca' WHEN 1 THEN 'Rabat' WHEN 2 THEN 'Paris' WHEN 3 THEN 'Madrid' ELSE 'New York' END AS City,
    CASE k % 4 WHEN 0 THEN 'MA' WHEN 1 THEN 'FR' WHEN 2 THEN 'ES' ELSE 'US' END AS Country2,
    CASE k % 5 WHEN 0 THEN 'Casablanca' WHEN 1 THEN 'Rabat' WHEN 2 THEN 'Paris' WHEN 3 THEN 'Madrid' ELSE 'New York' END AS City2,
    CASE k % 3 WHEN 0 THEN 'VISA' WHEN 1 THEN 'MASTERCARD' ELSE 'AMEX' END AS CardType,
    CAST(18 + user_id % 63 AS INT) AS Age,
    CASE WHEN user_id % 2 = 0 THEN 'M' ELSE 'F' END AS Gender,
    'CDM' AS Bank,
    CASE WHEN value >= 150 AND k % 2 = 0 THEN 1 ELSE 0 END AS isAnomaly
  FROM raw)"""
SCORED = TXN + """,
scored AS (SELECT TransactionID, isAnomaly,
    CAST(floor(TransactionAmount) + 10 * hour(Time) AS DOUBLE) AS s1, TransactionAmount AS s2,
    CAST(minute(Time) AS DOUBLE) AS s3 FROM txn)"""
O = "PARTITION BY AccountNumber ORDER BY Time, TransactionID"
WINDOWS = (f"WINDOW o AS ({O}), w AS ({O} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), "
           f"h AS ({O} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")
HOURS = "sin(2 * pi() * hour(Time) / 24.0) AS HourSin, cos(2 * pi() * hour(Time) / 24.0) AS HourCos"


def r6(column: str, name: str | None = None) -> str:
    return f"round({column}, 6) + 0.0 AS {name or column}"


def add(name: str, ctes: str, columns: list[str], source: str, tail: str = "") -> None:
    ORACLES[name] = f"WITH {ctes.strip()}\nSELECT {', '.join(columns)}\nFROM {source} {tail}".strip()


def txn_columns(columns=TXN_COLS) -> list[str]:
    return [r6(c) if c == "TransactionAmount" else c for c in columns]


# --- features -----------------------------------------------------------------------------

def _features(profile: str) -> str:
    return TXN + ",\n" + {"trailing": _trailing, "expanding": _expanding, "value_frame": _value_frame}[profile]()


def _trailing(window: int = 7) -> str:
    shares = ", ".join(
        f"count(CASE WHEN b.{c} IS NOT DISTINCT FROM a.{c} THEN 1 END) / CAST(count(*) AS DOUBLE) AS {f}"
        for c, f in zip(CAT_COLS, FREQ_COLS))
    entropies = ", ".join(
        f"CASE WHEN count(DISTINCT {c}) OVER w > 1 THEN entropy({c}) OVER w / log2(count(DISTINCT {c}) OVER w) "
        f"ELSE 0 END AS {e}" for c, e in zip(CAT_COLS, ENTROPY_COLS))
    return f"""
logged AS (SELECT *, ln(greatest(TransactionAmount, 1e-6)) AS LogAmount, epoch_us(Time) // 1000000 AS s FROM txn),
moved AS (SELECT *, row_number() OVER o AS rn, avg(LogAmount) OVER w AS MovingAvg,
    stddev_pop(LogAmount) OVER w AS MovingStd, s - lag(s) OVER o AS gap, {HOURS}, {entropies}
  FROM logged {WINDOWS.replace("6 PRECEDING", f"{window - 1} PRECEDING")}),
shares AS (SELECT a.TransactionID, {shares} FROM moved a JOIN moved b
  ON a.AccountNumber = b.AccountNumber AND b.rn BETWEEN a.rn - {window - 1} AND a.rn GROUP BY a.TransactionID),
feat AS (SELECT moved.*, shares.* EXCLUDE (TransactionID),
    (LogAmount - MovingAvg) / (MovingStd + 1e-6) AS AmountZScore,
    CASE WHEN rn = 1 THEN 0.0 ELSE ln(greatest(gap / 3600.0, 1e-6)) END AS LogTimeDiff
  FROM moved JOIN shares USING (TransactionID))"""


def _expanding() -> str:
    counts = ", ".join(
        f"row_number() OVER (PARTITION BY AccountNumber, {c} ORDER BY Time, TransactionID) "
        f"/ CAST(row_number() OVER o AS DOUBLE) AS {f}" for c, f in zip(CAT_COLS, FREQ_COLS))
    entropies = ", ".join(
        f"CASE WHEN count(DISTINCT {c}) OVER h > 1 THEN entropy({c}) OVER h / log2(count(DISTINCT {c}) OVER h) "
        f"ELSE 0 END AS {e}" for c, e in zip(CAT_COLS, ENTROPY_COLS))
    return f"""
logged AS (SELECT *, CASE WHEN TransactionAmount > 0 THEN ln(TransactionAmount) END AS LogAmount FROM txn),
moved AS (SELECT *, CASE WHEN count(LogAmount) OVER w = 7 THEN avg(LogAmount) OVER w END AS MovingAvg,
    CASE WHEN count(LogAmount) OVER w = 7 THEN stddev_samp(LogAmount) OVER w END AS MovingStd,
    (epoch_us(Time) - lag(epoch_us(Time)) OVER o) / 3.6e9 AS gap, {HOURS}, {counts}, {entropies}
  FROM logged {WINDOWS}),
feat AS (SELECT *, (LogAmount - MovingAvg) / (MovingStd + 1e-6) AS AmountZScore,
    CASE WHEN gap IS NOT NULL THEN ln(greatest(gap, 1e-6)) END AS LogTimeDiff FROM moved)"""


def _value_frame() -> str:
    frames = ", ".join(
        f"count(*) OVER (PARTITION BY AccountNumber, {c} ORDER BY Time, TransactionID "
        f"ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS c{i}, "
        f"dense_rank() OVER (PARTITION BY AccountNumber ORDER BY {c}) AS d{i}"
        for i, c in enumerate(CAT_COLS))
    shares = ", ".join(f"c{i} / CAST(n AS DOUBLE) AS {f}" for i, f in enumerate(FREQ_COLS))
    sums = ", ".join(f"sum({f} * ln({f}) / c{i}) OVER w AS h{i}, max(d{i}) OVER w AS u{i}"
                     for i, f in enumerate(FREQ_COLS))
    entropies = ", ".join(f"CASE WHEN u{i} > 1 THEN -h{i} / ln(u{i}) ELSE 0 END AS {e}"
                          for i, e in enumerate(ENTROPY_COLS))
    return f"""
logged AS (SELECT *, CASE WHEN TransactionAmount > 0 THEN ln(TransactionAmount) END AS LogAmount,
    epoch_us(Time) // 1000000 AS s FROM txn),
framed AS (SELECT *, avg(LogAmount) OVER w AS MovingAvg, stddev_samp(LogAmount) OVER w AS MovingStd,
    (s - lag(s) OVER o) / 3600.0 AS gap, count(*) OVER w AS n, {HOURS}, {frames} FROM logged {WINDOWS}),
shared AS (SELECT *, {shares} FROM framed),
summed AS (SELECT *, {sums} FROM shared {WINDOWS}),
feat AS (SELECT *, (LogAmount - MovingAvg) / (MovingStd + 1e-6) AS AmountZScore,
    ln(CASE WHEN gap > 1e-6 THEN gap ELSE 1e-6 END) AS LogTimeDiff, {entropies} FROM summed)"""


for _profile in ("trailing", "expanding", "value_frame"):
    for _name, _columns in {
        f"moving_stats_{_profile}": MOVING, f"freq_{_profile}": FREQ_COLS,
        f"entropy_{_profile}": ENTROPY_COLS, f"features_{_profile}": ENGINEERED_COLS,
        "time_diff" if _profile == "trailing" else f"time_diff_{_profile}": ["LogTimeDiff"],
    }.items():
        add(_name, _features(_profile), [ID, ACC, "Time", *map(r6, _columns)], "feat")
FEAT = _features("trailing")
add("log_amount", FEAT, [ID, ACC, "Time", r6("LogAmount")], "feat")
add("hour_cyclic", FEAT, [ID, ACC, "Time", r6("HourSin"), r6("HourCos")], "feat")

# --- sources ------------------------------------------------------------------------------

RANK = f"row_number() OVER ({O}) / CAST(count(*) OVER (PARTITION BY AccountNumber) AS DOUBLE) AS rank"
CALENDAR = "CAST(Time AS DATE) AS Date, CAST(hour(Time) AS INT) AS Hour"
RANKED = TXN + f", ranked AS (SELECT *, {RANK}, {CALENDAR}, TransactionAmount * 100 AS hundred FROM txn)"

add("parse_json_events", TXN, txn_columns(), "txn")
add("valid_events", TXN, [ID, ACC, "MerchandCode"], "txn", "WHERE MerchandCode <> 'MER1000'")
add("load_train", RANKED, [ID, "Time", ACC, r6("round(hundred, 2)", "TransactionAmount"), "Country2", "Age",
                           r6("rank"), "Date", "Hour"], "ranked")
add("load_labeled", RANKED, [ID, "Time", ACC, r6("round(hundred, 2)", "TransactionAmount"), "City2", "Bank",
                             r6("rank"), "Date", "Hour", "isAnomaly"], "ranked")
add("csv_to_events", TXN, ["AccountNumber AS key", ID, "date_trunc('minute', Time) AS Time",
                           *txn_columns([c for c in TXN_COLS if c not in (ID, "Time")])], "txn")

# --- projections and filters --------------------------------------------------------------

EXPANDING = _features("expanding")
GAPS = MOVING + ["LogTimeDiff"]
add("drop_null_rows", EXPANDING, [ID, *map(r6, GAPS)], "feat",
    "WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in GAPS))
add("clean_amount", TXN, [ID, r6("round(TransactionAmount * 1000, 2)", "amount")], "txn")
add("date_hour", TXN, [ID, CALENDAR], "txn")
add("fill_zero", EXPANDING, [ID, *[r6(f"coalesce({c}, 0)", c) for c in GAPS]], "feat")
add("impute_mean", EXPANDING, [ID, *[r6(f"coalesce({c}, avg({c}) OVER ())", c) for c in GAPS]], "feat")
add("anomaly_flags", FEAT, [ID, r6("LogAmount"), "LogAmount > 3.5 AS IsAnomaly", "LogAmount > 5.25 AS IsCritical"],
    "feat")
add("rank_pct", RANKED, [ID, ACC, r6("rank")], "ranked")
add("time_split", RANKED, [ID, ACC, r6("TransactionAmount"),
                           "CASE WHEN rank <= 0.8 THEN 'train' ELSE 'test' END AS part"], "ranked")
ORACLES["feature_vector"] = f"WITH {FEAT.strip()}\n" + "\nUNION ALL ".join(
    f"SELECT TransactionID, CAST({i} AS INT) AS position, {r6(f'CAST({c} AS DOUBLE)', 'value')} FROM feat"
    for i, c in enumerate(FEATURE_COLS))

# --- dimensions and joins -----------------------------------------------------------------

LATEST = """latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {key}
    ORDER BY Time DESC, TransactionID DESC) AS rn FROM txn) WHERE rn = 1)"""
CHANNELS = """usual AS (SELECT AccountNumber, Channel AS UsualChannel FROM (
    SELECT AccountNumber, Channel, row_number() OVER (PARTITION BY AccountNumber
      ORDER BY count(*) DESC, Channel DESC) AS rn FROM txn GROUP BY AccountNumber, Channel) WHERE rn = 1)"""
PROFILE = ["CardNumber", "Age", "Gender", "Bank", "CardType"]
add("client_dim", f"{TXN}, {LATEST.format(key=ACC)}, {CHANNELS}, mean AS (SELECT AccountNumber, "
    "avg(TransactionAmount) AS AvgTxnAmount FROM txn GROUP BY 1)",
    [ACC, *PROFILE, r6("AvgTxnAmount"), "UsualChannel"],
    "latest JOIN usual USING (AccountNumber) JOIN mean USING (AccountNumber)")
add("merchand_dim", f"{TXN}, {LATEST.format(key='MerchandCode')}",
    ["MerchandCode", "MerchandGroup", "Country2 AS Country", "City2 AS City"], "latest")
add("time_dim", """span AS (SELECT date_trunc('year', min(ts)) AS a, date_trunc('year', max(ts)) + INTERVAL 1 YEAR AS b
    FROM events), minutes AS (SELECT unnest(generate_series(a, b - INTERVAL 1 MINUTE, INTERVAL 1 MINUTE)) AS t FROM span)""",
    ["CAST(t AS TIMESTAMP) AS Time", "CAST(t AS DATE) AS Date",
     *[f"CAST({f}(t) AS INT) AS {n}" for f, n in (("year", "Year"), ("quarter", "Quarter"), ("month", "Month"),
                                                  ("day", "Day"), ("hour", "Hour"), ("minute", "Minute"),
                                                  ("second", "Second"))]], "minutes")
PER_ACCOUNT = ", ".join(
    f"CASE WHEN count(DISTINCT {c}) > 1 THEN entropy({c}) / log2(count(DISTINCT {c})) ELSE 0 END AS {e}"
    for c, e in zip(CAT_COLS, ENTROPY_COLS))
ENTROPY = TXN + f", e AS (SELECT AccountNumber, {PER_ACCOUNT} FROM txn GROUP BY 1)"
add("attach_account_entropy", ENTROPY, [ID, "txn.AccountNumber", *map(r6, ENTROPY_COLS)],
    "txn LEFT JOIN e USING (AccountNumber)")
add("account_norm_entropy", ENTROPY, [ACC, *map(r6, ENTROPY_COLS)], "e")
add("account_entropy", TXN, [ACC, *[r6(f"entropy({c}) * ln(2)", e) for c, e in zip(CAT_COLS, ENTROPY_COLS)]],
    "txn", "GROUP BY AccountNumber")
BUCKETS = TXN + """, activity AS (SELECT AccountNumber, count(*) AS activity FROM txn GROUP BY 1),
cuts AS (SELECT quantile_cont(activity, 0.33) AS a, quantile_cont(activity, 0.66) AS b FROM activity),
buckets AS (SELECT AccountNumber, activity, CASE WHEN activity <= a THEN 'low' WHEN activity <= b THEN 'medium'
    ELSE 'high' END AS bucket FROM activity, cuts)"""
SAMPLE = BUCKETS + """, sample AS (SELECT AccountNumber, activity, bucket FROM (SELECT *, row_number() OVER (
    PARTITION BY bucket ORDER BY md5(AccountNumber || ':42'), AccountNumber) AS rn FROM buckets) WHERE rn <= 5)"""
add("activity_buckets", BUCKETS, [ACC, "activity", "bucket"], "buckets")
add("stratified_sample", SAMPLE, [ACC, "activity", "bucket"], "sample")
add("semi_sampled_accounts", SAMPLE, [ID, ACC, r6("TransactionAmount")], "txn",
    "WHERE AccountNumber IN (SELECT AccountNumber FROM sample)")
add("attach_label", TXN, [ID, ACC, "isAnomaly",
                          "CASE WHEN isAnomaly = 1 THEN 'amount' ELSE 'none' END AS AnomalyType"], "txn")

# --- aggregations -------------------------------------------------------------------------

LOGGED = TXN + ", logged AS (SELECT *, ln(greatest(TransactionAmount, 1e-6)) AS LogAmount FROM txn)"
add("usual_channel", f"{TXN}, {CHANNELS}", [ACC, "UsualChannel"], "usual")
add("latest_profile", f"{TXN}, {LATEST.format(key=ACC)}", [ACC, *PROFILE], "latest")
add("client_stats", LOGGED, [ACC, *[e for c in ("LogAmount", "TransactionAmount") for e in (
    f"count({c}) AS {c}_count", r6(f"avg({c})", f"{c}_mean"), r6(f"stddev_samp({c})", f"{c}_std"))]],
    "logged", "GROUP BY AccountNumber")
add("account_activity", BUCKETS, [ACC, "activity"], "activity")
DAILY = LOGGED + ", daily AS (SELECT AccountNumber, CAST(Time AS DATE) AS date, avg(LogAmount) AS m FROM logged GROUP BY 1, 2)"
add("daily_mean", DAILY, [ACC, "date", r6("m", "mean_LogAmount")], "daily")
add("pivot_daily", SAMPLE + DAILY[len(TXN):] + """, places AS (
    SELECT AccountNumber, row_number() OVER (ORDER BY AccountNumber) AS place FROM sample)""",
    ["date", *[r6(f"max(CASE WHEN place = {i} THEN m END)", f"top{i}") for i in range(1, 16)]],
    "daily JOIN places USING (AccountNumber)", "GROUP BY date")
FIVE = ["TransactionType", "Channel", "CardType", "MerchandGroup", "Country"]
ORACLES["crosstab_share"] = f"WITH {TXN.strip()}\n" + "\nUNION ALL ".join(
    f"SELECT AccountNumber, '{c}' AS category, {c} AS value, "
    + r6(f"count(*) / CAST(sum(count(*)) OVER (PARTITION BY AccountNumber) AS DOUBLE)", "share")
    + f" FROM txn GROUP BY AccountNumber, {c}" for c in FIVE)
add("crosstab_channel", TXN, [ACC, *[r6(f"count(CASE WHEN Channel = '{v}' THEN 1 END) / CAST(count(*) AS DOUBLE)", v)
                                     for v in ("ATM", "POS", "WEB", "MOBILE")]], "txn", "GROUP BY AccountNumber")
ORACLES["value_counts"] = f"WITH {TXN.strip()}\n" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS category, {c} AS value, count(*) AS n FROM txn GROUP BY {c}" for c in CAT_COLS)
ORACLES["describe_numeric"] = f"WITH {LOGGED.strip()}\n" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count({c}) AS count, {r6(f'avg({c})', 'mean')}, {r6(f'stddev_samp({c})', 'std')}, "
    f"{r6(f'CAST(min({c}) AS DOUBLE)', 'min')}, "
    + ", ".join(r6(f"CAST(quantile_cont({c}, {q / 100}) AS DOUBLE)", f"q{q}") for q in (25, 50, 75))
    + f", {r6(f'CAST(max({c}) AS DOUBLE)', 'max')} FROM logged" for c in ("Age", "TransactionAmount", "LogAmount"))


def _histogram(keys: list[str]) -> str:
    part = f"PARTITION BY {', '.join(keys)}" if keys else ""
    return TXN + f""", limits AS (SELECT *, min(TransactionAmount) OVER ({part}) AS low,
    (max(TransactionAmount) OVER ({part}) - min(TransactionAmount) OVER ({part})) / 30.0 AS width FROM txn),
binned AS (SELECT *, CAST(least(floor((TransactionAmount - low) / width), 29) AS BIGINT) AS bin FROM limits)"""


for _name, _keys in (("histogram", []), ("histogram_by_account", [ACC])):
    add(_name, _histogram(_keys), [*_keys, "bin", r6("min(low) + bin * min(width)", "left_edge"), "count(*) AS n"],
        "binned", "GROUP BY " + ", ".join([*_keys, "bin"]))


def _box(keys: list[str]) -> str:
    group = f"GROUP BY {', '.join(keys)}" if keys else ""
    join = f"JOIN q USING ({', '.join(keys)})" if keys else ", q"
    return TXN + f""", q AS (SELECT {''.join(k + ', ' for k in keys)}quantile_cont(TransactionAmount, 0.25) AS q1,
    quantile_cont(TransactionAmount, 0.5) AS median, quantile_cont(TransactionAmount, 0.75) AS q3 FROM txn {group}),
marked AS (SELECT txn.*, q1, median, q3,
    TransactionAmount BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside FROM txn {join})"""


for _name, _keys in (("box_stats", []), ("box_stats_by_age", ["Age"])):
    add(_name, _box(_keys), [*_keys, "count(*) AS n", *[r6(f"max({c})", c) for c in ("q1", "median", "q3")],
        r6("min(CASE WHEN inside THEN TransactionAmount END)", "whisker_low"),
        r6("max(CASE WHEN inside THEN TransactionAmount END)", "whisker_high"),
        "count(CASE WHEN NOT inside THEN 1 END) AS outliers"], "marked",
        "GROUP BY " + ", ".join(_keys) if _keys else "")

SKEW = "(avg(s2 * s2 * s2) - 3 * avg(s2) * avg(s2 * s2) + 2 * avg(s2) * avg(s2) * avg(s2)) / pow(stddev_pop(s2), 3)"
add("score_distribution", SCORED, [
    r6("avg(s2)", "score_mean"), r6("quantile_cont(s2, 0.5)", "score_median"), r6("stddev_pop(s2)", "score_std"),
    r6(SKEW, "score_skew"), r6("quantile_cont(s2, 0.95)", "score_p95"), r6("quantile_cont(s2, 0.99)", "score_p99"),
    r6("quantile_cont(s2, 0.99) - quantile_cont(s2, 0.9)", "tailsep")], "scored")
add("top_scores", SCORED, [ID, "isAnomaly", r6("s1")], "scored", "ORDER BY s1 DESC, TransactionID LIMIT 30")

# --- scaling ------------------------------------------------------------------------------

add("scale_none", FEAT, [ID, *[c if c == "Age" else r6(c) for c in FEATURE_COLS]], "feat")


def _over(part: str, minmax: bool, per_client: bool):
    def scaled(c: str) -> str:
        low, high = f"min({c}) OVER ({part})", f"max({c}) OVER ({part})"
        if minmax:
            divisor = f"({high} - {low} + 1e-6)" if per_client else \
                f"(CASE WHEN {high} = {low} THEN 1 ELSE {high} - {low} END)"
            return r6(f"({c} - {low}) / {divisor}", c)
        if per_client:
            return r6(f"({c} - avg({c}) OVER ({part})) / (stddev_samp({c}) OVER ({part}) + 1e-6)", c)
        spread = f"stddev_pop({c}) OVER ({part})"
        return r6(f"({c} - avg({c}) OVER ({part})) / (CASE WHEN {spread} = 0 THEN 1 ELSE {spread} END)", c)
    return scaled


BY_CLIENT = "PARTITION BY AccountNumber"
for _name, _minmax in (("minmax", True), ("standard", False)):
    add(f"scale_global_{_name}", FEAT, [ID, *map(_over("", _minmax, False), FEATURE_COLS)], "feat")
    add(f"scale_client_{_name}", FEAT, [ID, *map(_over("", _minmax, True), GLOBAL_COLS),
                                        *map(_over(BY_CLIENT, _minmax, True), CLIENT_COLS)], "feat")
add("score_minmax", SCORED, [ID, *map(_over("", True, False), ("s1", "s2", "s3"))], "scored")

# --- evaluation ---------------------------------------------------------------------------

CURVE = SCORED + """,
per_score AS (SELECT s1 AS threshold, sum(isAnomaly) AS pos, count(*) AS cnt FROM scored GROUP BY 1),
curve AS (SELECT threshold, CAST(pos AS DOUBLE) AS pos, CAST(cnt AS DOUBLE) AS cnt,
    CAST(sum(pos) OVER (ORDER BY threshold DESC) AS DOUBLE) AS tp,
    CAST(sum(cnt) OVER (ORDER BY threshold DESC) AS DOUBLE) AS predicted,
    CAST(sum(pos) OVER () AS DOUBLE) AS positives, CAST(sum(cnt) OVER () AS DOUBLE) AS n FROM per_score),
pr AS (SELECT threshold, tp / predicted AS precision, tp / positives AS recall FROM curve),
f AS (SELECT *, 2 * precision * recall / (precision + recall + 1e-10) AS f1 FROM pr)"""
add("roc_curve", CURVE, [r6("threshold"), r6("(predicted - tp) / (n - positives)", "fpr"),
                         r6("tp / positives", "tpr")], "curve")
add("pr_curve", CURVE, [r6("threshold"), r6("precision"), r6("recall")], "pr")
add("roc_auc", CURVE, [r6("sum((cnt - pos) * (2 * tp - pos) / 2) / max(positives * (n - positives))", "roc_auc")],
    "curve")
add("pr_auc", CURVE, [r6("sum(pos / positives * tp / predicted)", "pr_auc"),
                      r6("max(positives / n)", "base_rate")], "curve")
add("best_f1", CURVE, [r6("f1"), r6("precision"), r6("recall"), r6("threshold")], "f",
    "ORDER BY f1 DESC, threshold LIMIT 1")
FLAGGED = """count(CASE WHEN {s} > t AND isAnomaly = 1 THEN 1 END) AS tp,
    count(CASE WHEN {s} > t THEN 1 END) AS flagged, sum(isAnomaly) AS positives"""
RATIOS = [r6("CASE WHEN flagged > 0 THEN tp / CAST(flagged AS DOUBLE) ELSE 0 END", "precision"),
          r6("CASE WHEN positives > 0 THEN tp / CAST(positives AS DOUBLE) ELSE 0 END", "recall"),
          r6("2 * tp / CAST(flagged + positives AS DOUBLE)", "f1")]
add("p95_metrics", SCORED + f""", cut AS (SELECT quantile_cont(s1, 0.95) AS t FROM scored),
hits AS (SELECT max(t) AS t, {FLAGGED.format(s='s1')} FROM scored, cut)""",
    [r6("t", "threshold"), *RATIOS], "hits")
UNIT = SCORED + """, unit AS (SELECT TransactionID, isAnomaly, """ + ", ".join(
    f"({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ()) AS {c}" for c in ("s1", "s2", "s3")) + " FROM scored)"
add("ensemble_blend", UNIT, [ID, r6("0.65 * s3 + 0.35 * s2 + 0.0 * s1", "ensemble")], "unit")
add("ensemble_search", UNIT + f""",
weights AS (SELECT i, j, i * CAST(0.05 AS DOUBLE) AS w1, j * CAST(0.05 AS DOUBLE) AS w2,
    greatest(0.0, CAST(1.0 AS DOUBLE) - i * CAST(0.05 AS DOUBLE) - j * CAST(0.05 AS DOUBLE)) AS w3
  FROM range(21) a(i), range(21) b(j) WHERE i + j <= 20),
blended AS (SELECT i, j, isAnomaly, w1 * s1 + w2 * s2 + w3 * s3 AS s FROM unit, weights),
cut AS (SELECT i, j, quantile_cont(s, 0.95) AS t FROM blended GROUP BY 1, 2),
hits AS (SELECT i, j, max(t) AS t, {FLAGGED.format(s='s')} FROM blended JOIN cut USING (i, j) GROUP BY 1, 2),
part AS (SELECT i, j, s AS part, count(*) AS n, sum(isAnomaly) AS pos FROM blended GROUP BY 1, 2, 3),
run AS (SELECT *, sum(n) OVER w AS seen, sum(pos) OVER w AS tps FROM part WINDOW w AS (PARTITION BY i, j ORDER BY part DESC)),
drawn AS (SELECT i, j, sum((n - pos) * (2 * tps - pos) / 2.0) / (sum(pos) * CAST(sum(n - pos) AS DOUBLE)) AS roc,
    sum(pos * (tps / CAST(seen AS DOUBLE))) / sum(pos) AS pr FROM run GROUP BY 1, 2),
rated AS (SELECT *, 2 * tp / CAST(flagged + positives AS DOUBLE) AS f FROM hits JOIN drawn USING (i, j) JOIN weights USING (i, j))""",
    [r6("w1"), r6("w2"), r6("w3"), r6("t", "threshold"), *RATIOS, r6("roc", "roc_auc"), r6("pr", "pr_auc"),
     "row_number() OVER (ORDER BY f DESC, i, j) = 1 AS best"], "rated")

# --- table rows ---------------------------------------------------------------------------

add("bronze", TXN, txn_columns(), "txn")
add("silver_features", FEAT, [*txn_columns(), *map(r6, ENGINEERED_COLS)], "feat")
FACT = [ID, "Time", ACC, "MerchandCode", "TransactionType", "Channel", "TransactionAmount", "Country", "City"]
add("transaction_fact", FEAT, [*txn_columns(FACT), r6("LogAmount", "modelscore"), "LogAmount > 3.5 AS IsAnomaly",
                               "LogAmount > 5.25 AS IsCritical"], "feat")
TOTAL = " + ".join(FREQ_COLS)
ORACLES["explain_fact"] = f"WITH {FEAT.strip()}\n" + "\nUNION ALL ".join(
    f"SELECT TransactionID, Time, '{c}' AS FeatureName, {r6(f'{c} / ({TOTAL})', 'FeatureValue')} FROM feat"
    for c in FREQ_COLS)

# --- streams and tables -------------------------------------------------------------------

ORACLES["stream_features_trailing"] = ORACLES["features_trailing"]
ORACLES["stream_features_window"] = ORACLES["features_trailing"].replace(_trailing().strip(), _trailing(3).strip())
ORACLES["stream_memoryless"] = ORACLES["features_value_frame"]
ORACLES["stream_medallion"] = "\nUNION ALL ".join(
    f"SELECT '{t}' AS \"table\", {n} * count(*) AS rows, count(*) AS keys FROM events" for t, n in (
        ("bronze.transactions", 1), ("silver.features", 1), ("gold.TransactionFact", 1),
        ("gold.ExplainFact", len(FEATURE_COLS))))
ORACLES["stream_resume"] = """WITH span AS (SELECT min(epoch_us(ts)) AS a, max(epoch_us(ts)) AS b FROM events),
parts AS (SELECT ts, CAST(floor((epoch_us(ts) - a) * 3 / (b - a + 1)) AS BIGINT) AS batch_id FROM events, span)
SELECT batch_id, count(*) AS rows, min(ts) AS first, max(ts) AS last FROM parts GROUP BY 1"""
ORACLES["dim_overwrite"] = ORACLES["client_dim"]
_inputs = ", ".join(f"coalesce(CAST({c} AS DOUBLE), 0)" for c in FEATURE_COLS)
_names = ", ".join(f"'{c}'" for c in FEATURE_COLS)
_engineered = ", ".join(f"'{c}'" for c in ENGINEERED_COLS), ", ".join(f"CAST({c} AS DOUBLE)" for c in ENGINEERED_COLS)
ORACLES["stream_medallion_values"] = f"""WITH {FEAT.strip()},
span AS (SELECT min(epoch_us(Time)) AS a, max(epoch_us(Time)) AS b FROM feat),
parts AS (SELECT TransactionID, CAST(floor((epoch_us(Time) - a) * 2 / (b - a + 1)) AS BIGINT) AS batch_id FROM feat, span),
inputs AS (SELECT TransactionID, unnest(range({len(FEATURE_COLS)})) AS j, unnest([{_names}]) AS name, unnest([{_inputs}]) AS x
  FROM feat),
book AS (SELECT u, j, CASE WHEN j = 0 THEN 20.0 + 6 * u ELSE ((7 * u + 3 * j) % 11) / 4.0 END AS w
  FROM range(9) a(u), range({len(FEATURE_COLS)}) b(j)),
dist AS (SELECT TransactionID, u, sqrt(sum((x - w) * (x - w))) AS d FROM inputs JOIN book USING (j) GROUP BY 1, 2),
bmu AS (SELECT TransactionID, u, d FROM (SELECT *, row_number() OVER (PARTITION BY TransactionID ORDER BY d, u) AS rn
  FROM dist) WHERE rn = 1),
dev AS (SELECT TransactionID, name, abs(x - w) AS e FROM bmu JOIN inputs USING (TransactionID) JOIN book USING (u, j)),
held AS (
  SELECT 'bronze.transactions' AS "table", TransactionID, 'TransactionAmount' AS name, CAST(TransactionAmount AS DOUBLE) AS value
  FROM feat
  UNION ALL SELECT 'silver.features', TransactionID, unnest([{_engineered[0]}]), unnest([{_engineered[1]}]) FROM feat
  UNION ALL SELECT unnest(['silver.features', 'gold.TransactionFact']), TransactionID, 'modelscore', d FROM bmu
  UNION ALL SELECT 'gold.TransactionFact', TransactionID, unnest(['IsAnomaly', 'IsCritical']),
    unnest([CAST(d > 3.5 AS DOUBLE), CAST(d > 5.25 AS DOUBLE)]) FROM bmu
  UNION ALL SELECT 'gold.ExplainFact', TransactionID, name, e / (sum(e) OVER (PARTITION BY TransactionID) + 1e-8) FROM dev)
SELECT "table", batch_id, TransactionID, name, {r6("value")} FROM held JOIN parts USING (TransactionID)"""

# --- map of the embeddings: prototypes are the label means, grid of 5 x 2 -----------------

MAP = """v AS (SELECT vec_id, label, unnest(range(64)) AS j, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings),
book AS (SELECT dense_rank() OVER (ORDER BY label) - 1 AS u, j, w FROM (
    SELECT label, j, avg(x) AS w FROM v GROUP BY 1, 2)),
dist AS (SELECT vec_id, u, sqrt(sum((x - w) * (x - w))) AS d FROM v JOIN book USING (j) GROUP BY 1, 2),
bmu AS (SELECT vec_id, u, d FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, u) AS rn FROM dist)
    WHERE rn = 1)"""
add("som_score", MAP, ["vec_id", r6("d", "score")], "bmu")
add("som_explain", MAP + """, dev AS (SELECT vec_id, j, abs(x - w) AS a FROM bmu JOIN v USING (vec_id) JOIN book USING (u, j))""",
    ["vec_id", "'e' || CAST(j AS VARCHAR) AS feature",
     r6("a / (sum(a) OVER (PARTITION BY vec_id) + 1e-8)", "value")], "dev")
add("som_epoch", MAP + """, won AS (SELECT u AS b, j, sum(x) AS s, count(*) AS n FROM bmu JOIN v USING (vec_id) GROUP BY 1, 2),
near AS (SELECT p.u, q.u AS b, exp(-((p.u // 2 - q.u // 2) * (p.u // 2 - q.u // 2)
    + (p.u % 2 - q.u % 2) * (p.u % 2 - q.u % 2)) / (2 * 0.8 * 0.8)) AS h
  FROM (SELECT DISTINCT u FROM book) p, (SELECT DISTINCT u FROM book) q)""",
    ["CAST(u AS INT) AS unit", "CAST(j AS INT) AS position", r6("sum(h * s) / sum(h * n)", "weight")],
    "near JOIN won USING (b)", "GROUP BY u, j")

# --- detectors with weights given by a rule -----------------------------------------------


def _layer(source: str, width: int, layer: int, relu: bool) -> str:
    z = (f"sum(x * ((31 * j + 17 * o.range + {7 * layer}) % 13 - 6) / 20.0) + (o.range % 5 - 2) / 10.0")
    return (f"SELECT vec_id, o.range AS j, {f'greatest({z}, 0.0)' if relu else z} AS x "
            f"FROM {source}, range({width}) o GROUP BY vec_id, o.range")


CODER = MAP + f""",
x0 AS (SELECT vec_id, j, x FROM v),
x1 AS ({_layer('x0', 12, 0, True)}), x2 AS ({_layer('x1', 6, 1, True)}),
x3 AS ({_layer('x2', 12, 2, True)}), x4 AS ({_layer('x3', 64, 3, False)}),
missed AS (SELECT vec_id, j, (x0.x - x4.x) * (x0.x - x4.x) AS e FROM x0 JOIN x4 USING (vec_id, j)),
ae AS (SELECT vec_id, avg(e) AS ae_score FROM missed GROUP BY 1)"""
PATH = "CASE WHEN {n} = 1 THEN 0 ELSE 2 * (ln({n} - 1) + 0.5772156649015329) - 2 * ({n} - 1) / CAST({n} AS DOUBLE) END"
FOREST = f"""
cells AS (SELECT vec_id, t.range AS t, CAST(embedding[3 * t.range % 64 + 1] AS DOUBLE) AS a,
    CAST(embedding[(3 * t.range + 1) % 64 + 1] AS DOUBLE) AS b,
    CAST(embedding[(3 * t.range + 2) % 64 + 1] AS DOUBLE) AS c FROM embeddings, range(5) t),
walks AS (SELECT vec_id, t, a <= 0 AS goes_left, CASE WHEN a <= 0 THEN CASE WHEN b <= 0.05 THEN 100 ELSE 60 END
    ELSE CASE WHEN c <= -0.05 THEN 1 ELSE 95 END END AS n FROM cells),
forest AS (SELECT vec_id, pow(2, -avg(2 + {PATH.format(n='n')}) / ({PATH.format(n='256')})) - 0.5 AS if_score
  FROM walks GROUP BY 1),
passed AS (SELECT vec_id, 3 * t % 64 AS j, 1.0 AS w FROM walks UNION ALL
    SELECT vec_id, CASE WHEN goes_left THEN 3 * t + 1 ELSE 3 * t + 2 END % 64, 0.5 FROM walks)"""
add("ae_encode_rule", CODER, ["vec_id", *[r6(f"max(CASE WHEN j = {i} THEN x END)", f"z{i}") for i in range(6)]],
    "x2", "GROUP BY vec_id")
add("ae_explain_rule", CODER, ["vec_id", "'e' || CAST(j AS VARCHAR) AS feature",
                               r6("e / (sum(e) OVER (PARTITION BY vec_id) + 1e-8)", "value")], "missed")
add("iforest_explain_rule", FOREST, [
    "vec_id", "'e' || CAST(c.range AS VARCHAR) AS feature",
    r6("coalesce((SELECT sum(w) FROM passed p WHERE p.vec_id = m.vec_id AND p.j = c.range), 0) / (7.5 + 1e-8)",
       "value")], "embeddings m, range(64) c")
add("ensemble_score_rule", f"{CODER}, {FOREST}", ["vec_id", r6("if_score"), r6("ae_score"), r6("d", "som_score")],
    "forest JOIN ae USING (vec_id) JOIN bmu USING (vec_id)")
ORACLES["model_roundtrip"] = f"WITH {TXN.strip()} SELECT TransactionID, TRUE AS same FROM txn"

TABLE_ROWS = {
    "bronze.transactions": "count(*)", "silver.features": "count(*)", "gold.TransactionFact": "count(*)",
    "gold.ExplainFact": f"{len(FEATURE_COLS)} * count(*)", "gold.ClientDim": "count(DISTINCT user_id)",
    "gold.MerchandDim": "count(DISTINCT props->>'k')",
    "gold.TimeDim": "CAST(date_diff('minute', date_trunc('year', min(ts)), date_trunc('year', max(ts)) "
                    "+ INTERVAL 1 YEAR) AS BIGINT)",
}
ORACLES["table_schemas"] = "\nUNION ALL ".join(
    f"SELECT '{t}' AS \"table\", (SELECT {TABLE_ROWS[t]} FROM events) AS rows, CAST({i} AS INT) AS position, "
    f"'{f.name}' AS \"column\", '{f.dataType.simpleString()}' AS type"
    for t, (schema, _) in TABLES.items() for i, f in enumerate(schema))
ORACLES["table_catalog"] = ORACLES["table_schemas"]
