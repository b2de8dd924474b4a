"""Jobs over the ``events`` table: series per user, admission, drift match,
tumbling windows, a calorie-style diary, validation, JSON and the
change log (key = ``user:<id>``, seq = event_id, error events delete)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import epoch_seconds, local_day as local_day_of, seconds_to_window_end, tumbling_index
from ..functions.jsonx import canonical_json, claim_status as claim_rule, field_text, record_checksum
from ..operators import changelog as kv
from ..operators.admission import sliding_admission as admit
from ..operators.joins import band_match, first_offset_pair, zero_sum_triples
from ..operators.series import (best_window_sum, change_points as change_pts, longest_distinct_run,
                                max_drawdown as drawdown, underwater_depth as depth)
from ..operators.validate import first_failure
from ..sources.tables import table

def _order():
    return [F.col("ts"), F.col("event_id")]


def events(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    return table(spark, sf_dir, "events", *(cols or ("event_id", "ts", "user_id", "event_type", "value", "props")))


def k_of(props="props"):
    return F.get_json_object(F.col(props), "$.k").cast("bigint")


# ------------------------------------------------------------------ series
def max_drawdown(spark, sf_dir):
    e = events(spark, sf_dir, "event_id", "ts", "user_id", "value")
    return drawdown(e, ["user_id"], _order(), "value")


def max_k_sum(spark, sf_dir, k: int = 3):
    e = events(spark, sf_dir, "event_id", "ts", "user_id", "value") \
        .withColumn("cents", F.round(F.col("value") * 100).cast("bigint"))
    return best_window_sum(e, ["user_id"], _order(), "cents", k)


def longest_unique_run(spark, sf_dir):
    e = events(spark, sf_dir, "event_id", "ts", "user_id", "event_type")
    return longest_distinct_run(e, ["user_id"], _order(), "event_type")


def change_points(spark, sf_dir):
    e = events(spark, sf_dir, "event_id", "ts", "user_id", "event_type")
    return change_pts(e, ["user_id"], _order(), "event_type")


def underwater_depth(spark, sf_dir):
    e = events(spark, sf_dir, "event_id", "ts", "user_id", "props").withColumn("h", k_of() % 10)
    return depth(e, ["user_id"], _order(), "h")


def offset_pairs(spark, sf_dir, target: int = 9):
    e = events(spark, sf_dir, "event_id", "user_id", "props").withColumn("v", k_of() % 10)
    return first_offset_pair(e, "user_id", "event_id", "v", target)


def netting_triples(spark, sf_dir):
    """Three amounts of a user that cancel out: purchases in cents count up, other events down."""
    cents = F.round(F.col("value") * 100).cast("bigint")
    e = events(spark, sf_dir, "user_id", "event_type", "value") \
        .withColumn("v", F.when(F.col("event_type") == "purchase", cents).otherwise(-cents))
    return zero_sum_triples(e, "user_id", "v")


def tumbling_index_q(spark, sf_dir, width: int = 300):
    e = events(spark, sf_dir, "event_id", "ts")
    s = epoch_seconds(F.col("ts"))
    return e.select("event_id", tumbling_index(s, width).alias("window_index"),
                    seconds_to_window_end(s, width).alias("seconds_left"))


# --------------------------------------------------------------- admission
ADMIT_LIMIT, ADMIT_WINDOW = 2, 86400


def sliding_admission(spark, sf_dir, limit: int = ADMIT_LIMIT, window: int = ADMIT_WINDOW):
    e = events(spark, sf_dir, "event_id", "ts", "user_id").withColumn("t", epoch_seconds(F.col("ts")))
    a = admit(e, "user_id", "t", "event_id", limit, window)
    return a.select(F.col("id").alias("event_id"), F.col("key").cast("bigint").alias("user_id"), "allowed",
                    F.col("remaining").cast("bigint").alias("remaining"), "retry_after")


# -------------------------------------------------------------- drift match
DRIFT_WINDOW, DRIFT = 86400, 1


def drift_match(spark, sf_dir, width: int = DRIFT_WINDOW, drift: int = DRIFT):
    e = events(spark, sf_dir, "event_id", "ts", "user_id", "event_type", "props")
    w = tumbling_index(epoch_seconds(F.col("ts")), width)
    base = e.select("event_id", "user_id", "event_type", (k_of() % 10).alias("code"), w.alias("w"))
    issues = base.where(F.col("event_type") == "signup").select(
        F.col("event_id").alias("issue_id"), "user_id", "code", F.col("w").alias("issue_window"))
    attempts = base.where(F.col("event_type") == "purchase").select(
        F.col("event_id").alias("attempt_id"), "user_id", "code", F.col("w").alias("attempt_window"))
    return band_match(issues, attempts, ["user_id", "code"], "issue_window", "attempt_window", drift) \
        .select("issue_id", "attempt_id", "user_id", "code", "issue_window", "attempt_window")


# ------------------------------------------------------------------- diary
def entries(spark, sf_dir):
    e = events(spark, sf_dir, "event_id", "ts", "event_type", "value")
    return e.select(F.col("event_id").alias("id"), F.to_date("ts").alias("entry_date"),
                    F.col("event_type").alias("food_item"), F.round("value").cast("bigint").alias("calories"),
                    F.col("ts").alias("created_at"))


def daily_total(spark, sf_dir):
    """Total per day for every day between the first and last entry, 0 when
    a day has none: day spine LEFT JOIN daily sums."""
    en = entries(spark, sf_dir)
    lo, hi = en.agg(F.min("entry_date")).scalar(), en.agg(F.max("entry_date")).scalar()
    spine = en.sparkSession.range(1).select(F.explode(F.sequence(lo, hi)).alias("entry_date"))
    sums = en.groupBy("entry_date").agg(F.sum("calories").alias("t"))
    return spine.join(sums, "entry_date", "left").select(
        "entry_date", F.coalesce("t", F.lit(0)).cast("bigint").alias("total_calories"))


def distinct_dates(spark, sf_dir):
    return entries(spark, sf_dir).select("entry_date").distinct().orderBy(F.desc("entry_date"))


DEFAULT_DAY = "2024-02-01"


def dates_with_default(spark, sf_dir, default: str = DEFAULT_DAY):
    d = entries(spark, sf_dir).select("entry_date")
    extra = d.sparkSession.range(1).select(F.lit(default).cast("date").alias("entry_date"))
    return d.unionByName(extra).distinct()


LISTING_DAY = "2024-01-15"


def day_listing(spark, sf_dir, day: str = LISTING_DAY):
    en = entries(spark, sf_dir)
    return en.where(F.col("entry_date") == F.lit(day).cast("date")).orderBy(F.desc("created_at"), F.desc("id"))


def local_day(spark, sf_dir, zone: str = "Asia/Kolkata"):
    e = events(spark, sf_dir, "event_id", "ts")
    return e.select("event_id", local_day_of(F.col("ts"), zone).alias("local_day"))


def latest_n(spark, sf_dir, n: int = 24):
    e = events(spark, sf_dir, "event_id", "ts", "user_id", "event_type")
    return e.orderBy(F.desc("ts"), F.desc("event_id")).limit(n)


def latest_per_name(spark, sf_dir):
    """Newest row per user (largest id); partial aggregate, skew-safe."""
    e = events(spark, sf_dir, "event_id", "ts", "user_id", "event_type", "value")
    g = e.groupBy("user_id").agg(F.max_by(F.struct("event_id", "ts", "event_type", "value"), "event_id").alias("r"))
    return g.select("user_id", "r.*")


# ------------------------------------------------------ validation, JSON
KNOWN_TYPES = ["click", "view", "purchase", "signup"]


def validate_rows(spark, sf_dir):
    e = events(spark, sf_dir, "event_id", "event_type", "value", "props")
    digits = k_of().cast("string")
    code = F.when(F.length(digits) < 6, F.lpad(digits, 6, "0")).otherwise(digits)  # padded, never cut
    rules = [
        ("missing_type", F.col("event_type").isNull() | (F.trim("event_type") == "")),
        ("unknown_type", ~F.col("event_type").isin(*KNOWN_TYPES)),
        ("value_out_of_range", (F.col("value") <= 0) | (F.col("value") > 400)),
        ("bad_props", F.try_parse_json("props").isNull()),
        ("code_not_digits", ~code.rlike("^[0-9]{6}$") | (F.length(code) != 6)),
    ]
    reason = first_failure(rules)
    return e.select("event_id", reason.isNull().alias("is_valid"), reason.alias("reason"))


AUDIENCE = "otp"


def claims_column():
    ts_s = F.floor(epoch_seconds(F.col("ts"))).cast("bigint")
    exp = F.when(F.col("event_type") == "view", F.lit(None)).otherwise(ts_s + k_of() * 60)
    aud = F.when(F.col("event_type") == "click", "web").otherwise(AUDIENCE)
    return F.to_json(F.struct(F.col("user_id").alias("sub"), aud.alias("aud"), exp.alias("exp")))


def claim_status(spark, sf_dir):
    e = events(spark, sf_dir, "event_id", "ts", "user_id", "event_type", "props")
    now = F.floor(epoch_seconds(F.col("ts"))).cast("bigint") + 3000
    return e.select("event_id", claim_rule(claims_column(), now.cast("double"), AUDIENCE).alias("status"))


def written_props():
    """Properties as they might be written, picked by id: as they are, in an object with other fields, with a repeated
    field, with text after the value, and as no JSON at all."""
    k = F.col("event_id") % 20
    return (F.when(k == 1, F.concat(F.lit('{ "b" : 1.0,\t"a":"x : \\\\\\"y" , "p":'), "props", F.lit(' }')))
             .when(k == 2, F.concat(F.lit('{"k":1e5, "k" : '), k_of().cast("string"), F.lit("}")))
             .when(k == 3, F.concat("props", F.lit(" x"))).when(k == 4, F.lit("k=v")).otherwise(F.col("props")))


def json_ops(spark, sf_dir):
    e = events(spark, sf_dir, "event_id", "event_type", "value", "props").withColumn("written", written_props())
    return e.select("event_id", canonical_json(F.col("props")).alias("props_json"), k_of().alias("k"),
                    canonical_json(F.col("written")).alias("written_json"), field_text(F.col("written"), "k").alias("written_k"),
                    F.to_json(F.struct("event_id", "event_type", "value"))
                    .alias("row_json"))


def map_ops(spark, sf_dir):
    e = events(spark, sf_dir, "event_id", "props")
    m = F.from_json("props", "map<string,bigint>")
    return e.select("event_id", F.try_element_at(m, F.lit("k")).alias("k"),
                    F.try_element_at(m, F.lit("zz")).isNull().alias("zz_missing"),  # absent key -> NULL
                    F.size(m).cast("bigint").alias("n_keys"))


# -------------------------------------------------------------- change log
INDEXED = ["k"]


def change_log(spark, sf_dir) -> DataFrame:
    e = events(spark, sf_dir, "event_id", "ts", "user_id", "event_type", "props")
    is_del = F.col("event_type") == "error"
    return e.select(F.col("event_id").alias("seq"), F.concat(F.lit("user:"), F.col("user_id")).alias("key"),
                    F.when(is_del, kv.DELETE).otherwise(kv.SET).alias("flag"),
                    F.when(is_del, F.lit(None)).otherwise(F.col("props")).alias("value"), "ts")


def kv_current_state(spark, sf_dir):
    return kv.current_state(change_log(spark, sf_dir))


def kv_get(spark, sf_dir):
    c = table(spark, sf_dir, "customer", "c_custkey").select(F.concat(F.lit("user:"), "c_custkey").alias("key"))
    return kv.point_get(kv_current_state(spark, sf_dir), c, "{}")


def kv_prefix_scan(spark, sf_dir, prefix: str = "user:1"):
    return kv.prefix_scan(kv_current_state(spark, sf_dir), prefix)


def kv_range_scan(spark, sf_dir, start: str = "user:10", end: str = "user:19"):
    return kv.range_scan(kv_current_state(spark, sf_dir), start, end)


def kv_field_query(spark, sf_dir, field: str = "k", json_value: str = "42"):
    return kv.field_query(kv_current_state(spark, sf_dir), field, json_value, INDEXED)


def kv_stats(spark, sf_dir):
    log = change_log(spark, sf_dir)
    return kv.stats(log, kv.current_state(log), INDEXED)


SPLIT_TS = "2024-01-15 00:00:00"


def _split_seq(log):
    return log.where(F.col("ts") < F.lit(SPLIT_TS).cast("timestamp_ntz")).agg(F.max("seq")).scalar()


def apply_changes(spark, sf_dir):
    """State of the first half as the base table, second half as changes."""
    log = change_log(spark, sf_dir)
    first = log.where(F.col("ts") < F.lit(SPLIT_TS).cast("timestamp_ntz"))
    later = log.where(F.col("ts") >= F.lit(SPLIT_TS).cast("timestamp_ntz"))
    return kv.apply_changes(kv.current_state(first), later)


def kv_compaction(spark, sf_dir):
    """Compact the log up to the split point into a new snapshot, then read
    through the snapshot with the rest of the log merged on top."""
    log = change_log(spark, sf_dir)
    cut = log.where(F.col("ts") < F.lit(SPLIT_TS).cast("timestamp_ntz")).agg(F.max("seq")).first()[0]
    path = kv.compact(log, upto_seq=cut)
    return kv.read_compacted(path, log, cut)


def log_checksum(spark, sf_dir):
    """Audit against the checksum stored with each record; every 37th record
    was damaged after it was stored."""
    log = change_log(spark, sf_dir)
    stored = log.withColumn("checksum", record_checksum(F.col("flag"), F.col("key"), F.col("value")))
    damaged = F.when(F.col("seq") % 37 == 0, F.concat(F.coalesce("value", F.lit("")), F.lit(" "))).otherwise(F.col("value"))
    return kv.audit(stored.withColumn("value", damaged))


# ------------------------------------------------------------ oracle SQL
_EV = "SELECT *, epoch_us(ts) / 1e6 AS t, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events"

MAX_DRAWDOWN_SQL = f"""
WITH e AS ({_EV}),
m AS (SELECT user_id, value, max(value) OVER (PARTITION BY user_id ORDER BY ts, event_id
                                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS rm FROM e)
SELECT user_id, min((value - rm) / rm) AS max_drawdown FROM m GROUP BY user_id
"""

MAX_K_SUM_SQL = f"""
WITH e AS (SELECT *, CAST(round(value * 100) AS BIGINT) AS cents FROM events),
w AS (SELECT user_id, sum(cents) OVER x AS s, count(*) OVER x AS c FROM e
      WINDOW x AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW))
SELECT user_id, CAST(max(CASE WHEN c = 3 THEN s END) AS BIGINT) AS max_k_sum FROM w GROUP BY user_id
"""

LONGEST_UNIQUE_RUN_SQL = """
WITH p AS (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn
           FROM events),
q AS (SELECT *, coalesce(lag(rn) OVER (PARTITION BY user_id, event_type ORDER BY rn) + 1, 1) AS sc FROM p),
r AS (SELECT *, max(sc) OVER (PARTITION BY user_id ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS st
      FROM q)
SELECT user_id, CAST(max(rn - st + 1) AS BIGINT) AS longest_run FROM r GROUP BY user_id
"""

CHANGE_POINTS_SQL = """
WITH p AS (SELECT user_id, event_type,
                  lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev,
                  row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events)
SELECT user_id, count(*) FILTER (WHERE rn = 1 OR event_type IS DISTINCT FROM prev) AS n_kept FROM p GROUP BY user_id
"""

UNDERWATER_DEPTH_SQL = f"""
WITH e AS ({_EV}),
h AS (SELECT user_id, k % 10 AS h,
             max(k % 10) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS f,
             max(k % 10) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS b
      FROM e)
SELECT user_id, CAST(sum(greatest(0, least(f, b) - h)) AS BIGINT) AS depth FROM h GROUP BY user_id
"""

OFFSET_PAIRS_SQL = f"""
WITH e AS (SELECT event_id, user_id, k % 10 AS v FROM ({_EV})),
j AS (SELECT b.user_id, min(b.event_id) AS j FROM e b
      WHERE EXISTS (SELECT 1 FROM e a WHERE a.user_id = b.user_id AND a.v = 9 - b.v AND a.event_id < b.event_id)
      GROUP BY b.user_id)
SELECT j.user_id, max(a.event_id) AS i, j.j AS j
FROM j JOIN e b ON b.user_id = j.user_id AND b.event_id = j.j
       JOIN e a ON a.user_id = j.user_id AND a.v = 9 - b.v AND a.event_id < j.j
GROUP BY j.user_id, j.j
"""

NETTING_TRIPLES_SQL = """
WITH e AS (SELECT user_id, CAST(round(value * 100) AS BIGINT) * CASE WHEN event_type = 'purchase' THEN 1 ELSE -1 END AS v
           FROM events),
d AS (SELECT user_id, v, count(*) AS m FROM e GROUP BY ALL)
SELECT a.user_id, a.v AS a, b.v AS b, c.v AS c
FROM d a JOIN d b ON a.user_id = b.user_id AND a.v <= b.v
         JOIN d c ON c.user_id = a.user_id AND c.v = -(a.v + b.v) AND b.v <= c.v
WHERE CASE WHEN a.v = b.v AND b.v = c.v THEN a.m >= 3
           WHEN a.v = b.v THEN a.m >= 2
           WHEN b.v = c.v THEN b.m >= 2 ELSE TRUE END
"""

TUMBLING_INDEX_SQL = f"""
SELECT event_id, CAST(floor(t / 300) AS BIGINT) AS window_index,
       CAST(300 - floor(t - 300 * floor(t / 300)) AS BIGINT) AS seconds_left
FROM ({_EV})
"""

SLIDING_ADMISSION_SQL = """
WITH RECURSIVE ev AS (
  SELECT user_id, event_id, epoch_us(ts) / 1e6 AS t,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn
  FROM events),
fold AS (
  SELECT user_id, rn, event_id, TRUE AS allowed, CAST(1 AS BIGINT) AS remaining, CAST(0 AS BIGINT) AS retry_after,
         [t] AS q
  FROM ev WHERE rn = 1
  UNION ALL
  SELECT user_id, rn, event_id,
         len(p) < 2 AS allowed,
         CAST(CASE WHEN len(p) < 2 THEN 2 - len(p) - 1 ELSE 0 END AS BIGINT) AS remaining,
         CAST(CASE WHEN len(p) < 2 THEN 0 ELSE floor(p[1] - (t - 86400)) + 1 END AS BIGINT) AS retry_after,
         CASE WHEN len(p) < 2 THEN list_append(p, t) ELSE p END AS q
  FROM (
    SELECT e.user_id, e.rn, e.event_id, e.t, list_filter(f.q, lambda x: x >= e.t - 86400) AS p
    FROM fold f JOIN ev e ON e.user_id = f.user_id AND e.rn = f.rn + 1))
SELECT event_id, user_id, allowed, remaining, retry_after FROM fold
"""

DRIFT_MATCH_SQL = f"""
WITH e AS (SELECT event_id, user_id, event_type, k % 10 AS code, CAST(floor(t / 86400) AS BIGINT) AS w FROM ({_EV}))
SELECT i.event_id AS issue_id, a.event_id AS attempt_id, i.user_id, i.code,
       i.w AS issue_window, a.w AS attempt_window
FROM e i JOIN e a ON i.user_id = a.user_id AND i.code = a.code AND abs(i.w - a.w) <= 1
WHERE i.event_type = 'signup' AND a.event_type = 'purchase'
"""

_ENTRIES = """SELECT event_id AS id, CAST(ts AS DATE) AS entry_date, event_type AS food_item,
       CAST(round(value) AS BIGINT) AS calories, ts AS created_at FROM events"""

DAILY_TOTAL_SQL = f"""
WITH en AS ({_ENTRIES}),
sp AS (SELECT CAST(unnest(generate_series(min(entry_date), max(entry_date), INTERVAL 1 DAY)) AS DATE) AS entry_date
       FROM en)
SELECT sp.entry_date, CAST(coalesce(sum(calories), 0) AS BIGINT) AS total_calories
FROM sp LEFT JOIN en ON sp.entry_date = en.entry_date GROUP BY sp.entry_date
"""
DISTINCT_DATES_SQL = f"SELECT DISTINCT entry_date FROM ({_ENTRIES}) ORDER BY entry_date DESC"
DATES_WITH_DEFAULT_SQL = f"SELECT entry_date FROM ({_ENTRIES}) UNION SELECT DATE '2024-02-01'"
DAY_LISTING_SQL = f"SELECT * FROM ({_ENTRIES}) WHERE entry_date = DATE '2024-01-15' ORDER BY created_at DESC, id DESC"
LOCAL_DAY_SQL = "SELECT event_id, CAST(ts + INTERVAL '5 hours 30 minutes' AS DATE) AS local_day FROM events"
LATEST_N_SQL = "SELECT event_id, ts, user_id, event_type FROM events ORDER BY ts DESC, event_id DESC LIMIT 24"
LATEST_PER_NAME_SQL = """
SELECT user_id, event_id, ts, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1
"""

VALIDATE_ROWS_SQL = f"""
WITH e AS ({_EV}),
r AS (SELECT event_id,
        CASE WHEN event_type IS NULL OR trim(event_type) = '' THEN 'missing_type'
             WHEN event_type NOT IN ('click', 'view', 'purchase', 'signup') THEN 'unknown_type'
             WHEN value <= 0 OR value > 400 THEN 'value_out_of_range'
             WHEN try(json(props)) IS NULL THEN 'bad_props'
             WHEN NOT regexp_full_match(CASE WHEN length(CAST(k AS VARCHAR)) < 6 THEN lpad(CAST(k AS VARCHAR), 6, '0')
                                            ELSE CAST(k AS VARCHAR) END, '[0-9]{{6}}') THEN 'code_not_digits'
        END AS reason FROM e)
SELECT event_id, reason IS NULL AS is_valid, reason FROM r
"""

CLAIM_STATUS_SQL = f"""
WITH e AS ({_EV}),
c AS (SELECT event_id, CAST(floor(t) AS BIGINT) + 3000 AS now,
             CASE WHEN event_type = 'view' THEN NULL ELSE CAST(floor(t) AS BIGINT) + k * 60 END AS exp,
             CASE WHEN event_type = 'click' THEN 'web' ELSE 'otp' END AS aud FROM e)
SELECT event_id, CASE WHEN coalesce(exp, 0) < now THEN 'expired' WHEN aud <> 'otp' THEN 'invalid'
                      ELSE 'active' END AS status FROM c
"""

JSON_OPS_SQL = f"""
SELECT event_id, CAST(json(props) AS VARCHAR) AS props_json, k,
       CASE event_id % 20 WHEN 1 THEN '{{"b":1.0,"a":"x : \\\\\\"y","p":' || CAST(json(props) AS VARCHAR) || '}}'
                         WHEN 2 THEN '{{"k":1e5,"k":' || k || '}}' WHEN 3 THEN CAST(to_json(props || ' x') AS VARCHAR)
                         WHEN 4 THEN '"k=v"' ELSE CAST(json(props) AS VARCHAR) END AS written_json,
       CASE WHEN event_id % 20 NOT IN (1, 3, 4) THEN CAST(k AS VARCHAR) END AS written_k,
       CAST(to_json(struct_pack(event_id := event_id, event_type := event_type, value := value)) AS VARCHAR)
         AS row_json
FROM ({_EV})
"""

MAP_OPS_SQL = f"""
SELECT event_id, k, json_extract(props, '$.zz') IS NULL AS zz_missing, CAST(len(json_keys(props)) AS BIGINT) AS n_keys
FROM ({_EV})
"""

_LOG = """
log AS (SELECT event_id AS seq, 'user:' || user_id AS key,
               CASE WHEN event_type = 'error' THEN 'DELETE' ELSE 'SET' END AS flag,
               CASE WHEN event_type = 'error' THEN NULL ELSE props END AS value, ts FROM events),
st AS (SELECT key, seq, value FROM log QUALIFY row_number() OVER (PARTITION BY key ORDER BY seq DESC) = 1
       AND flag = 'SET')
"""

KV_CURRENT_STATE_SQL = "WITH " + _LOG + "SELECT * FROM st"
KV_GET_SQL = "WITH " + _LOG + """
SELECT r.key, coalesce(st.value, '{}') AS value, st.key IS NOT NULL AS exists
FROM (SELECT 'user:' || c_custkey AS key FROM customer) r LEFT JOIN st ON r.key = st.key
"""
KV_PREFIX_SCAN_SQL = "WITH " + _LOG + "SELECT * FROM st WHERE starts_with(key, 'user:1') ORDER BY key"
KV_RANGE_SCAN_SQL = "WITH " + _LOG + "SELECT * FROM st WHERE key >= 'user:10' AND key <= 'user:19' ORDER BY key"
KV_FIELD_QUERY_SQL = "WITH " + _LOG + """
SELECT * FROM st WHERE json_type(value, '$.k') IN ('BIGINT', 'UBIGINT') AND CAST(json_extract(value, '$.k') AS VARCHAR) = '42'
ORDER BY key
"""
KV_STATS_SQL = "WITH " + _LOG + """
SELECT (SELECT count(*) FROM st) AS live_keys, (SELECT count(*) FROM log) AS log_rows,
       (SELECT count(*) FROM st WHERE list_contains(json_keys(value), 'k')) AS indexed_keys
"""
APPLY_CHANGES_SQL = KV_CURRENT_STATE_SQL
KV_COMPACTION_SQL = KV_CURRENT_STATE_SQL

_CRC = """
crc_steps AS (SELECT i, list_reduce(list_prepend(i::BIGINT, range(8)),
                                    lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) AS v
              FROM range(256) r(i)),
crc AS (SELECT list(v ORDER BY i) AS steps FROM crc_steps)
"""


def _crc32_sql(x: str) -> str:
    octets = f"list_transform(range(1, octet_length(encode({x})) + 1), lambda p: ('0x' || substr(hex(encode({x})), 2 * p - 1, 2))::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295, {octets}), lambda a, b: xor(a >> 8, steps[(xor(a, b) & 255) + 1])), 4294967295)"


LOG_CHECKSUM_SQL = "WITH " + _LOG + ", " + _CRC + f""",
read AS (SELECT *, CASE WHEN seq % 37 = 0 THEN coalesce(value, '') || ' ' ELSE value END AS found FROM log),
sums AS (SELECT seq, key, flag, {_crc32_sql("flag || key || coalesce(value, '')")} AS stored,
                {_crc32_sql("flag || key || coalesce(found, '')")} AS crc FROM read, crc)
SELECT seq, key, CAST(crc AS BIGINT) AS crc,
       CASE WHEN key IS NULL OR key = '' THEN 'missing_key' WHEN flag NOT IN ('SET', 'DELETE') THEN 'unknown_flag'
            WHEN stored <> crc THEN 'checksum_mismatch' ELSE 'ok' END AS status FROM sums
"""
