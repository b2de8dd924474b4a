"""FX lookup join: transactions with mixed date formats x one rate per
(currency, day). Transactions = orders (currency = order priority; every
seventh has a currency without rates), rates = one row per (priority, day)
derived from all orders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import with_iso_date, with_mixed_date
from ..operators.joins import duplicate_keys, lookup_join
from .pnl import money_out
from ..sources.tables import table

KEYS = ["currency", "trade_date"]
UNQUOTED_EVERY = 7  # transactions whose currency key is mapped to one without rates


def _ending(day):
    """The English ending of a day's number."""
    last = F.when(day.isin(11, 12, 13), 0).otherwise(day % 10)
    return F.when(last == 1, "st").when(last == 2, "nd").when(last == 3, "rd").otherwise("th")


#: Spellings of a full date; ~ stands for the ending of the day's number.
SPELLINGS = ["yyyy-MM-dd", "yyyy/MM/dd", "MMM dd yyyy", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm", "dd-MMM-yy", "MMM d'~' yyyy",
             "M/d/yy", "MM-dd-yyyy", "EEE MMM dd yyyy", "\u00a0dd\u00a0MMMM\u00a0yyyy\u2003", "EEEE, MMMM d, yyyy 'at' hh:mm a",
             "yyyyMMdd", "yyyy.MM.dd"]


def render_mixed(d, key, spellings=SPELLINGS):
    """A textual rendering of a date, in the spelling that the row key picks."""
    spelling = F.replace(F.get(F.array(*map(F.lit, spellings)), key % len(spellings)), F.lit("~"), _ending(F.day(d)))
    return F.call_function("date_format", d, spelling)


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_totalprice")
    return o.select(
        F.col("o_orderkey").alias("transaction_id"),
        F.col("o_custkey").alias("client_id"),
        render_mixed(F.col("o_orderdate"), F.col("o_orderkey")).alias("trade_date"),
        F.when(F.col("o_orderkey") % UNQUOTED_EVERY == 0, F.concat(F.lit("X-"), "o_orderpriority"))
         .otherwise(F.col("o_orderpriority")).alias("currency"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("amount_local"),
        F.lit("orders").alias("source"),
    )


def raw_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One quote per order (so keys repeat): the input of the duplicate guard."""
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_orderdate", "o_orderpriority")
    return o.select(
        F.col("o_orderpriority").alias("currency"),
        F.date_format("o_orderdate", "yyyy/MM/dd").alias("trade_date"),
        F.col("o_orderkey").alias("quote_id"))


def rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unique (currency, day) rates: 1 + 0.01 * number of quotes."""
    r = raw_rates(spark, sf_dir)
    return (r.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n"))
             .select(*KEYS, (F.lit(1) + F.col("n") * F.lit(0.01).cast("decimal(3,2)")).cast("decimal(10,4)")
                     .alias("usd_rate"), F.lit("rates").alias("source")))


def normalize_keys(df: DataFrame, strict: bool = True) -> DataFrame:
    """Parse the mixed-format date key to a DATE. With ``strict`` an
    unparseable date raises (ANSI ``assert_true``) instead of turning NULL."""
    df = with_mixed_date(df, "trade_date", "_d")
    d = F.col("_d")
    if strict:
        d = F.when(F.col("trade_date").isNull() | d.isNotNull(), d).otherwise(
            F.raise_error(F.concat(F.lit("unparseable trade_date: "), F.col("trade_date"))))
    return df.withColumn("trade_date", d.cast("date")).drop("_d")


def fx_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = normalize_keys(transactions(spark, sf_dir))
    fx = normalize_keys(rates(spark, sf_dir))
    j = lookup_join(tx, fx, KEYS, how="left", suffix="_fx")
    return j.select(
        "transaction_id", "client_id", "trade_date", "currency",
        F.col("amount_local").cast("double").alias("amount_local"), "source",
        F.col("usd_rate").cast("double").alias("usd_rate"), "source_fx",
        money_out(F.col("amount_local") * F.col("usd_rate")).alias("amount_usd"),  # exact product, then cents
        F.col("_matched").alias("rate_found"))


def fx_join_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows written, rows whose rate is missing (by the match marker, not by
    a column name), and rows whose right-side columns are all NULL."""
    j = fx_join(spark, sf_dir)
    return j.agg(F.count(F.lit(1)).alias("rows_written"),
                 F.count_if(~F.col("rate_found")).alias("missing_rates"),
                 F.count_if(F.col("usd_rate").isNull() & F.col("source_fx").isNull()).alias("all_null_rows"))


def fx_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sample of duplicated keys (first five in key order) of the raw quotes."""
    return duplicate_keys(normalize_keys(raw_rates(spark, sf_dir)), KEYS, 5)


#: The spellings above and those whose reading depends on the date itself, padded, impossible or of half a date.
MORE_SPELLINGS = [*SPELLINGS, "dd-MMM-yyyy", "MMMM dd yyyy", "MM/dd/yyyy", "dd/MM/yyyy", "  yyyy-MM-dd ", "yyyy'-02-30'",
                  "\u00a0MMMM yyyy", "yyyy-MM-dd' 25:00'"]


def normalize_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates in many spellings (three without a date) -> ISO or ``FAILED: <text>``."""
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_orderdate")
    raw = render_mixed(F.col("o_orderdate"), F.col("o_orderkey"), MORE_SPELLINGS)
    return with_iso_date(o.select(F.col("o_orderkey").alias("id"), raw.alias("raw")), "raw", "iso")


_TX_SQL = """
txn AS (
  SELECT o_orderkey AS transaction_id, o_custkey AS client_id,
         CAST(o_orderdate AS DATE) AS trade_date,
         CASE WHEN o_orderkey % 7 = 0 THEN 'X-' || o_orderpriority ELSE o_orderpriority END AS currency,
         CAST(o_totalprice AS DECIMAL(18,2)) AS amount_local, 'orders' AS source
  FROM orders),
fx AS (
  SELECT o_orderpriority AS currency, CAST(o_orderdate AS DATE) AS trade_date,
         CAST(1 + count(*) * 0.01 AS DECIMAL(10,4)) AS usd_rate, 'rates' AS source_fx
  FROM orders GROUP BY ALL),
j AS (
  SELECT txn.*, fx.usd_rate, fx.source_fx, fx.currency IS NOT NULL AS rate_found
  FROM txn LEFT JOIN fx ON txn.currency = fx.currency AND txn.trade_date = fx.trade_date)
"""

FX_JOIN_SQL = "WITH " + _TX_SQL + """
SELECT transaction_id, client_id, trade_date, currency, CAST(amount_local AS DOUBLE) AS amount_local, source,
       CAST(usd_rate AS DOUBLE) AS usd_rate, source_fx,
       CAST(round_even(amount_local * usd_rate, 2) AS DOUBLE) AS amount_usd, rate_found
FROM j
"""

FX_JOIN_STATS_SQL = "WITH " + _TX_SQL + """
SELECT count(*) AS rows_written, count(*) FILTER (WHERE NOT rate_found) AS missing_rates,
       count(*) FILTER (WHERE usd_rate IS NULL AND source_fx IS NULL) AS all_null_rows
FROM j
"""

FX_DUPLICATE_KEYS_SQL = """
SELECT o_orderpriority AS currency, CAST(o_orderdate AS DATE) AS trade_date, count(*) AS n_rows
FROM orders
GROUP BY ALL HAVING count(*) > 1
ORDER BY currency, trade_date LIMIT 5
"""

NORMALIZE_DATES_SQL = """
WITH r AS (
  SELECT o_orderkey AS id, o_orderkey % 22 AS k, o_orderdate AS d,
         CASE o_orderkey % 22
           WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d')
           WHEN 1 THEN strftime(o_orderdate, '%Y/%m/%d')
           WHEN 2 THEN strftime(o_orderdate, '%b %d %Y')
           WHEN 3 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S')
           WHEN 4 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M')
           WHEN 5 THEN strftime(o_orderdate, '%d-%b-%y')
           WHEN 6 THEN strftime(o_orderdate, '%b ') || day(o_orderdate)
                       || CASE WHEN day(o_orderdate) IN (1, 21, 31) THEN 'st' WHEN day(o_orderdate) IN (2, 22) THEN 'nd'
                               WHEN day(o_orderdate) IN (3, 23) THEN 'rd' ELSE 'th' END || strftime(o_orderdate, ' %Y')
           WHEN 7 THEN month(o_orderdate) || '/' || day(o_orderdate) || strftime(o_orderdate, '/%y')
           WHEN 8 THEN strftime(o_orderdate, '%m-%d-%Y')
           WHEN 9 THEN strftime(o_orderdate, '%a %b %d %Y')
           WHEN 10 THEN chr(160) || strftime(o_orderdate, '%d') || chr(160) || strftime(o_orderdate, '%B') || chr(160)
                        || strftime(o_orderdate, '%Y') || chr(8195)
           WHEN 11 THEN strftime(o_orderdate, '%A, %B ') || day(o_orderdate) || strftime(o_orderdate, ', %Y at %I:%M %p')
           WHEN 12 THEN strftime(o_orderdate, '%Y%m%d')
           WHEN 13 THEN strftime(o_orderdate, '%Y.%m.%d')
           WHEN 14 THEN strftime(o_orderdate, '%d-%b-%Y')
           WHEN 15 THEN strftime(o_orderdate, '%B %d %Y')
           WHEN 16 THEN strftime(o_orderdate, '%m/%d/%Y')
           WHEN 17 THEN strftime(o_orderdate, '%d/%m/%Y')
           WHEN 18 THEN '  ' || strftime(o_orderdate, '%Y-%m-%d') || ' '
           WHEN 19 THEN strftime(o_orderdate, '%Y') || '-02-30'
           WHEN 20 THEN chr(160) || strftime(o_orderdate, '%B %Y')
           ELSE strftime(o_orderdate, '%Y-%m-%d') || ' 25:00' END AS raw
  FROM orders)
SELECT id, raw, CASE WHEN k IN (19, 21) THEN 'FAILED: ' || raw
                     WHEN k = 20 THEN 'FAILED: ' || strftime(d, '%B %Y')
                     -- day first where the first number can be no month
                     WHEN k = 17 AND day(d) <= 12 THEN strftime(d, '%Y-%d-%m')
                     ELSE strftime(d, '%Y-%m-%d') END AS iso
FROM r
"""
