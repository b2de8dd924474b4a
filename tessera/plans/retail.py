"""Sales mart and customer metrics over orders x customer (x payments).

Mart: orders LEFT JOIN the customer dimension (every fifth order refers to an
unknown customer, so some orders miss), text clean-up, grouped by (day, city,
segment).
Metrics: cleaned recent orders INNER JOIN customers INNER JOIN payments
(one status per order, aggregated from lineitem), then windows, ranks,
pivots and inactivity.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.dates import with_mixed_date
from .pnl import money_out
from ..functions.text import title_case
from ..operators.scan import keyed_scan
from ..operators.topn import top_n_per_group
from ..sources.tables import table

# ---------------------------------------------------------------- sales mart
UNKNOWN_CUSTOMER_EVERY = 5  # orders whose customer key is mapped out of range


def mart_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = table(spark, sf_dir, "nation", "n_nationkey", "n_name")
    raw = (c.join(n, c.c_nationkey == n.n_nationkey, "left")
            .select(F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"),
                    F.col("n_name").alias("city"), F.lower("c_mktsegment").alias("segment"),
                    F.col("c_custkey").alias("_file_order")))
    return transform_customers(raw)


def dedup_first(df: DataFrame, keys, order_col: str) -> DataFrame:
    """``drop_duplicates(subset=keys)`` keeping the first row by ``order_col``.
    ``min_by`` is a partial aggregate: a hot key is reduced map-side."""
    others = [c for c in df.columns if c not in keys]
    packed = F.min_by(F.struct(*others), F.col(order_col)).alias("_r")
    return df.groupBy(*keys).agg(packed).select(*keys, "_r.*")


def transform_customers(raw: DataFrame) -> DataFrame:
    t = raw.withColumn("city", title_case(F.coalesce("city", F.lit("Unknown")))) \
           .withColumn("segment", F.replace(F.coalesce("segment", F.lit("consumer")), F.lit("_"), F.lit(" ")))
    return dedup_first(t, ["customer_id"], "_file_order").drop("_file_order")


def mart_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_totalprice")
    # transform_orders keeps status 'completed' (raw F) and quantity > 0 (total
    # >= 100 000); stating the same predicates on the raw columns lets them
    # reach the parquet scan, which cannot see through the mapping below.
    o = o.where((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") >= 100000))
    raw = o.select(
        F.col("o_orderkey").alias("order_id"),
        F.when(F.col("o_orderkey") % UNKNOWN_CUSTOMER_EVERY == 0, -F.col("o_custkey"))
         .otherwise(F.col("o_custkey")).alias("customer_id"),
        F.col("o_orderdate").alias("order_date"),
        F.floor(F.col("o_totalprice") / 100000).cast("int").alias("quantity"),  # whole 100k blocks
        F.col("o_totalprice").cast("decimal(18,2)").alias("unit_price"),
        F.when(F.col("o_orderstatus") == "F", "COMPLETED").when(F.col("o_orderstatus") == "O", "Open")
         .otherwise("pending").alias("status"))
    return transform_orders(raw)


def transform_orders(raw: DataFrame) -> DataFrame:
    """Mixed-format text dates are parsed (first matching format); timestamps
    are truncated to the day."""
    textual = isinstance(raw.schema["order_date"].dataType, StringType)
    if textual:
        raw = with_mixed_date(raw, "order_date", "_day")
    day = F.col("_day") if textual else F.to_date("order_date")
    return (raw.withColumn("status", F.lower("status"))
               .where((F.col("status") == "completed") & (F.col("quantity") > 0))
               .withColumn("gross_revenue", F.col("quantity") * F.col("unit_price"))
               .withColumn("order_date", day).drop("_day"))


def enrich_orders(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Left join with an explicit match marker, then fill the gaps."""
    c = customers.withColumn("_has_customer", F.lit(True))
    e = orders.join(c, "customer_id", "left")
    return e.select(*orders.columns,
                    F.coalesce("customer_name", F.lit("Unknown")).alias("customer_name"),
                    F.coalesce("city", F.lit("Unknown")).alias("city"),
                    F.coalesce("segment", F.lit("unknown")).alias("segment"),
                    F.coalesce("_has_customer", F.lit(False)).alias("has_customer"))


def build_sales_mart(enriched: DataFrame) -> DataFrame:
    """Distinct orders, distinct customers and revenue per day, city and segment.

    The rows are brought down to (group, order, customer) once; an order then counts at its first customer, so that both
    distinct counts are plain sums of what follows, without a copy of the rows for each of them."""
    group = ["order_date", "city", "segment"]
    per_order = (enriched.repartition(*group, "order_id").groupBy(*group, "order_id", "customer_id")
                 .agg(F.sum("gross_revenue").alias("revenue")))
    first = F.row_number().over(Window.partitionBy(*group, "order_id").orderBy("customer_id")) == 1
    per_customer = (per_order.withColumn("new_order", (first & F.col("order_id").isNotNull()).cast("bigint"))
                    .groupBy(*group, "customer_id").agg(F.sum("new_order").alias("orders"), F.sum("revenue").alias("revenue")))
    return (per_customer.groupBy(*group)
            .agg(F.sum("orders").alias("total_orders"), F.count("customer_id").alias("unique_customers"),
                 money_out(F.sum("revenue")).alias("total_revenue"))
            .orderBy(F.asc_nulls_last("order_date"), F.desc_nulls_last("total_revenue")))


def sales_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_sales_mart(enrich_orders(mart_orders(spark, sf_dir), mart_customers(spark, sf_dir)))


def orders_without_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders whose customer is not in the dimension (anti join)."""
    o = mart_orders(spark, sf_dir)
    return o.join(mart_customers(spark, sf_dir).select("customer_id"), "customer_id", "left_anti") \
            .select("order_id", "customer_id", "order_date")


_MART_BASE_SQL = """
c AS (
  SELECT c_custkey AS customer_id, c_name AS customer_name,
         coalesce(n_name, 'Unknown') AS city0, replace(coalesce(lower(c_mktsegment), 'consumer'), '_', ' ') AS segment
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey),
ct AS (
  SELECT customer_id, customer_name, segment,
         array_to_string(list_transform(regexp_extract_all(city0, '(\\p{L}+|\\P{L}+)'),
                                        lambda t: upper(t[1]) || lower(t[2:])), '') AS city
  FROM c),
o AS (
  SELECT o_orderkey AS order_id, CASE WHEN o_orderkey % 5 = 0 THEN -o_custkey ELSE o_custkey END AS customer_id,
         CAST(o_orderdate AS DATE) AS order_date,
         CAST(floor(o_totalprice / 100000) AS INTEGER) * CAST(o_totalprice AS DECIMAL(18,2)) AS gross_revenue
  FROM orders WHERE o_orderstatus = 'F' AND floor(o_totalprice / 100000) > 0)
"""

SALES_MART_SQL = "WITH " + _MART_BASE_SQL + """
SELECT order_date, coalesce(ct.city, 'Unknown') AS city, coalesce(ct.segment, 'unknown') AS segment,
       count(DISTINCT order_id) AS total_orders, count(DISTINCT o.customer_id) AS unique_customers,
       CAST(round_even(sum(gross_revenue), 2) AS DOUBLE) AS total_revenue
FROM o LEFT JOIN ct ON o.customer_id = ct.customer_id
GROUP BY ALL
"""

ORDERS_WITHOUT_CUSTOMER_SQL = "WITH " + _MART_BASE_SQL + """
SELECT order_id, customer_id, order_date FROM o
WHERE NOT EXISTS (SELECT 1 FROM ct WHERE ct.customer_id = o.customer_id)
"""

# ---------------------------------------------------------- customer metrics
RECENT_FROM = "1997-01-01"
BAND_LOW, BAND_HIGH = 500, 2000


def metric_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    return o.select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
                    F.to_date("o_orderdate").alias("order_date"),
                    F.floor(F.col("o_totalprice") / 100).cast("bigint").alias("amount"))


def clean_orders_df(orders: DataFrame, since: str = RECENT_FROM) -> DataFrame:
    """amount > 0, whole-row de-duplication, recent orders only."""
    return (orders.where(F.col("amount") > 0).dropDuplicates()
                  .where(F.col("order_date") >= F.lit(since).cast("date")))


def clean_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_orders_df(metric_orders(spark, sf_dir))


def metric_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = table(spark, sf_dir, "nation", "n_nationkey", "n_name")
    return c.join(n, c.c_nationkey == n.n_nationkey, "left").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("name"),
        F.coalesce("c_mktsegment", F.lit("Unknown")).alias("segment"), F.col("n_name").alias("city"))


def _min_is(c: str, v: str):
    """``min(c) = v`` as two boolean aggregates (some value equals v, none is
    smaller). Boolean buffers keep the aggregate hash-based; a string
    ``min`` would force a sort-based aggregate on both sides of the shuffle."""
    return F.max(F.col(c) == v) & ~F.coalesce(F.max(F.col(c) < v), F.lit(False))


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One payment row per order from its lines (partial aggregate first):
    method by the smallest return flag (A card, N upi, else cash), status
    Success when the smallest line status is F."""
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linestatus", "l_returnflag")
    g = li.groupBy("l_orderkey").agg(_min_is("l_returnflag", "A").alias("rf_a"),
                                     _min_is("l_returnflag", "N").alias("rf_n"),
                                     _min_is("l_linestatus", "F").alias("ls_f"))
    return g.select(F.col("l_orderkey").alias("order_id"),
                    F.when(F.col("rf_a"), "card").when(F.col("rf_n"), "upi").otherwise("cash")
                     .alias("payment_method"),
                    F.when(F.col("ls_f"), "Success").otherwise("Failed").alias("payment_status"))


def order_band(amount) -> "F.Column":
    return (F.when(amount < BAND_LOW, "Low").when(amount.between(BAND_LOW, BAND_HIGH), "Medium")
             .when(amount > BAND_HIGH, "High").otherwise("Unknown"))


def enriched_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = clean_orders(spark, sf_dir)
    e = o.join(metric_customers(spark, sf_dir), "customer_id", "inner") \
         .join(payments(spark, sf_dir), "order_id", "inner") \
         .where(F.col("payment_status") == "Success")
    return e.select("order_id", "customer_id", "name", "segment", "city", "order_date", "amount",
                    "payment_method",
                    F.year("order_date").cast("bigint").alias("year"),
                    F.month("order_date").cast("bigint").alias("month"),
                    order_band(F.col("amount")).alias("order_category"))


def orders_enriched(spark, sf_dir):
    return enriched_orders(spark, sf_dir)


def order_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = metric_orders(spark, sf_dir)
    return o.select("order_id", "amount", order_band(F.col("amount")).alias("order_category"))


def cumulative_spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = enriched_orders(spark, sf_dir).select("order_id", "customer_id", "order_date", "amount")
    s = keyed_scan(e, ["customer_id"], [F.col("order_date"), F.col("order_id")], "amount")
    return s.select("order_id", "customer_id", "order_date", "amount",
                    F.col("run_sum").cast("bigint").alias("cumulative_spend"))


def rolling_avg_3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean of the last three orders (in date order); NULL until three."""
    e = enriched_orders(spark, sf_dir).select("order_id", "customer_id", "order_date", "amount")
    s = keyed_scan(e, ["customer_id"], [F.col("order_date"), F.col("order_id")], "amount", lags=2)
    full = F.col("amount").isNotNull() & F.col("lag1").isNotNull() & F.col("lag2").isNotNull()
    avg3 = (F.col("amount") + F.col("lag1") + F.col("lag2")).cast("double") / F.lit(3.0)
    return s.select("order_id", "customer_id", "amount", F.when(full, avg3).alias("rolling_avg"))


def avg_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Descending rank of amount per customer, ties get the average rank.
    Distinct (customer, amount) counts first, then a skew-safe running count."""
    e = enriched_orders(spark, sf_dir).select("order_id", "customer_id", "amount")
    d = e.groupBy("customer_id", "amount").agg(F.count(F.lit(1)).alias("c"))
    s = keyed_scan(d, ["customer_id"], [F.col("amount").isNull(), -F.col("amount")], "c")
    r = s.select("customer_id", "amount",
                 (F.col("run_sum") - (F.col("c") - 1) / F.lit(2.0)).cast("double").alias("amount_rank"))
    return e.join(r, ["customer_id", "amount"], "inner").select("order_id", "customer_id", "amount", "amount_rank")


def customer_metrics_df(e: DataFrame) -> DataFrame:
    return e.groupBy("customer_id").agg(
        F.count("order_id").alias("total_orders"),
        F.sum("amount").cast("bigint").alias("total_spent"),
        F.avg("amount").alias("avg_order_value"),
        F.max("order_date").alias("last_order_date"))


def customer_metrics(spark, sf_dir):
    return customer_metrics_df(enriched_orders(spark, sf_dir))


def high_value_customers(spark, sf_dir, min_orders: int = 5, min_spent: int = 10000):
    m = customer_metrics(spark, sf_dir)
    return m.where((F.col("total_orders") >= min_orders) & (F.col("total_spent") > min_spent))


MONTHS = list(range(1, 13))


def pivot_city_month(spark, sf_dir):
    """Sum of amount per city x month; the month list is given, so no extra
    job to discover pivot values. Empty cells stay NULL."""
    e = enriched_orders(spark, sf_dir)
    p = e.groupBy("city").pivot("month", MONTHS).agg(F.sum("amount"))
    return p.select("city", *[F.col(str(m)).cast("bigint").alias(f"m{m:02d}") for m in MONTHS])


def top3_per_city(spark, sf_dir):
    e = enriched_orders(spark, sf_dir).select("city", "customer_id", "order_id", "amount")
    t = top_n_per_group(e, ["city"], [F.desc("amount")], 3, rank_col="city_rank", method="dense_rank")
    return t.withColumn("city_rank", F.col("city_rank").cast("bigint"))


def inactive_customers(spark, sf_dir, days: int = 180):
    """Customers whose last order is more than ``days`` before the newest
    order; the newest date is a scalar subquery, not a cross join."""
    e = enriched_orders(spark, sf_dir)
    m = customer_metrics_df(e)
    latest = e.agg(F.max("order_date")).scalar()
    return m.where(F.date_diff(latest, F.col("last_order_date")) > days) \
            .withColumn("days_inactive", F.date_diff(latest, F.col("last_order_date")).cast("bigint"))


_METRICS_BASE_SQL = """
o AS (
  SELECT DISTINCT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_date,
         CAST(floor(o_totalprice / 100) AS BIGINT) AS amount
  FROM orders),
oc AS (SELECT * FROM o WHERE amount > 0 AND order_date >= DATE '1997-01-01'),
cu AS (
  SELECT c_custkey AS customer_id, c_name AS name, coalesce(c_mktsegment, 'Unknown') AS segment, n_name AS city
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey),
pay AS (
  SELECT l_orderkey AS order_id,
         CASE min(l_returnflag) WHEN 'A' THEN 'card' WHEN 'N' THEN 'upi' ELSE 'cash' END AS payment_method,
         CASE WHEN min(l_linestatus) = 'F' THEN 'Success' ELSE 'Failed' END AS payment_status
  FROM lineitem GROUP BY l_orderkey),
e AS (
  SELECT oc.order_id, oc.customer_id, name, segment, city, order_date, amount, payment_method,
         CAST(year(order_date) AS BIGINT) AS year, CAST(month(order_date) AS BIGINT) AS month,
         CASE WHEN amount < 500 THEN 'Low' WHEN amount BETWEEN 500 AND 2000 THEN 'Medium'
              WHEN amount > 2000 THEN 'High' ELSE 'Unknown' END AS order_category
  FROM oc JOIN cu ON oc.customer_id = cu.customer_id JOIN pay ON oc.order_id = pay.order_id
  WHERE payment_status = 'Success'),
m AS (
  SELECT customer_id, count(order_id) AS total_orders, CAST(sum(amount) AS BIGINT) AS total_spent,
         avg(amount) AS avg_order_value, max(order_date) AS last_order_date
  FROM e GROUP BY customer_id)
"""

CLEAN_ORDERS_SQL = "WITH " + _METRICS_BASE_SQL + "SELECT * FROM oc"
ORDERS_ENRICHED_SQL = "WITH " + _METRICS_BASE_SQL + "SELECT * FROM e"
ORDER_CATEGORY_SQL = """
SELECT o_orderkey AS order_id, CAST(floor(o_totalprice / 100) AS BIGINT) AS amount,
       CASE WHEN floor(o_totalprice / 100) < 500 THEN 'Low'
            WHEN floor(o_totalprice / 100) BETWEEN 500 AND 2000 THEN 'Medium'
            WHEN floor(o_totalprice / 100) > 2000 THEN 'High' ELSE 'Unknown' END AS order_category
FROM orders
"""
CUMULATIVE_SPEND_SQL = "WITH " + _METRICS_BASE_SQL + """
SELECT order_id, customer_id, order_date, amount,
       CAST(sum(amount) OVER (PARTITION BY customer_id ORDER BY order_date, order_id
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cumulative_spend
FROM e
"""
ROLLING_AVG_3_SQL = "WITH " + _METRICS_BASE_SQL + """
SELECT order_id, customer_id, amount,
       CASE WHEN count(amount) OVER w = 3 THEN
         CAST(amount + lag(amount, 1) OVER w0 + lag(amount, 2) OVER w0 AS DOUBLE) / 3.0 END AS rolling_avg
FROM e
WINDOW w AS (PARTITION BY customer_id ORDER BY order_date, order_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW),
       w0 AS (PARTITION BY customer_id ORDER BY order_date, order_id)
"""
AVG_RANK_SQL = "WITH " + _METRICS_BASE_SQL + """
SELECT order_id, customer_id, amount,
       CAST(rank() OVER (PARTITION BY customer_id ORDER BY amount DESC)
            + (count(*) OVER (PARTITION BY customer_id, amount) - 1) / 2.0 AS DOUBLE) AS amount_rank
FROM e
"""
CUSTOMER_METRICS_SQL = "WITH " + _METRICS_BASE_SQL + "SELECT * FROM m"
HIGH_VALUE_CUSTOMERS_SQL = "WITH " + _METRICS_BASE_SQL + \
    "SELECT * FROM m WHERE total_orders >= 5 AND total_spent > 10000"
PIVOT_CITY_MONTH_SQL = "WITH " + _METRICS_BASE_SQL + "SELECT city, " + ", ".join(
    f"CAST(sum(amount) FILTER (WHERE month = {m}) AS BIGINT) AS m{m:02d}" for m in MONTHS) + \
    " FROM e GROUP BY city"
TOP3_PER_CITY_SQL = "WITH " + _METRICS_BASE_SQL + """
SELECT * FROM (
  SELECT city, customer_id, order_id, amount,
         CAST(dense_rank() OVER (PARTITION BY city ORDER BY amount DESC) AS BIGINT) AS city_rank
  FROM e) WHERE city_rank <= 3
"""
INACTIVE_CUSTOMERS_SQL = "WITH " + _METRICS_BASE_SQL + """
SELECT m.*, CAST(date_diff('day', last_order_date, (SELECT max(order_date) FROM e)) AS BIGINT) AS days_inactive
FROM m WHERE date_diff('day', last_order_date, (SELECT max(order_date) FROM e)) > 180
"""
