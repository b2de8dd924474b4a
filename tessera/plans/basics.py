"""Small relational operators over the driver tables: lookups, slices,
parameterised SQL, profiles, type-driven rules, element-wise arithmetic,
group sums, shares, unions, de-duplication, semi joins, run report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType, DecimalType, DoubleType, FloatType, StructType

from ..functions.text import file_suffix, safe_filename
from ..operators.changelog import assign_ids
from ..operators.topn import position_slice as pos_slice, top_n_per_group
from ..sources.files import parse_csv_lines
from ..sources.tables import table
from . import pnl


def label_lookup(spark, sf_dir, key: int = 7):
    c = table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_acctbal")
    return c.where(F.col("c_custkey") == key)


def position_slice(spark, sf_dir, offset: int = 100, n: int = 10):
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_totalprice")
    return pos_slice(o, [F.col("o_orderkey")], offset, n)


def param_lookup(spark, sf_dir, segment: str = "BUILDING", nation: int = 7):
    """Named parameter markers are bound by Spark, never spliced into text."""
    c = table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_acctbal", "c_mktsegment", "c_nationkey")
    return spark.sql("SELECT c_custkey, c_name, c_acctbal FROM {c} WHERE c_mktsegment = :seg AND c_nationkey = :nat",
                     args={"seg": segment, "nat": nation}, c=c)


def frame_profile(spark, sf_dir, n: int = 5):
    """head(n) and tail(n) by key, with the frame's shape on every row."""
    df = table(spark, sf_dir, "nation")
    rows = df.agg(F.count(F.lit(1))).scalar()
    head = df.orderBy("n_nationkey").limit(n).withColumn("section", F.lit("head"))
    tail = df.orderBy(F.desc("n_nationkey")).limit(n).withColumn("section", F.lit("tail"))
    return head.unionByName(tail).select("section", "n_nationkey", "n_name",
                                         rows.alias("n_rows"), F.lit(len(df.columns)).cast("bigint").alias("n_cols"))


def numeric_sums(df: DataFrame) -> DataFrame:
    """Type-driven rule, numeric half: one row with the sum of every numeric
    column (fractional sums rounded half-even to cents)."""
    aggs = []
    for f in df.schema.fields:
        if isinstance(f.dataType, NumericType):
            s = F.sum(f.name)
            if isinstance(f.dataType, (DoubleType, FloatType)):  # exact: the order of the rows plays no part
                s = F.bround(F.sum(F.col(f.name).cast("decimal(28,10)")), 2).cast("double")
            elif isinstance(f.dataType, DecimalType):
                s = F.bround(s, 2).cast("double")
            else:
                s = s.cast("bigint")
            aggs.append(s.alias(f"sum_{f.name}"))
    return df.agg(*aggs)


def upper_strings(df: DataFrame) -> DataFrame:
    """Type-driven rule, string half: every string column upper-cased."""
    return df.select(*[F.upper(f.name).alias(f.name) if isinstance(f.dataType, StringType) else F.col(f.name)
                       for f in df.schema.fields])


def schema_rule(spark, sf_dir):
    return numeric_sums(table(spark, sf_dir, "part"))


def elementwise(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_quantity")
    return li.select("l_orderkey", "l_linenumber", (F.col("l_quantity") * 2).alias("doubled"),
                     (F.col("l_quantity") * F.col("l_quantity")).alias("squared"))


def group_sum(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem", "l_returnflag", "l_quantity", "l_extendedprice")
    return li.where(F.col("l_returnflag").isNotNull()).groupBy("l_returnflag").agg(
        F.sum(F.col("l_quantity").cast("decimal(12,2)")).cast("double").alias("sum_qty"),
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("sum_price"))


def share_of_total(spark, sf_dir):
    """Share of customers per segment in percent, one decimal; the total is a
    scalar subquery (no global window, no cross join)."""
    c = table(spark, sf_dir, "customer", "c_mktsegment")
    g = c.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))
    total = c.agg(F.count(F.lit(1))).scalar()
    return g.select("c_mktsegment", "n", F.bround(F.lit(100.0) * F.col("n") / total, 1).alias("share_pct"))


def union_chunks(spark, sf_dir):
    """Pieces processed separately (known order statuses, and every other
    row) and concatenated; together the pieces hold each row once."""
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus", "o_totalprice")
    known = ("F", "O", "P")
    others = ~F.coalesce(F.col("o_orderstatus").isin(*known), F.lit(False))
    parts = [(F.col("o_orderstatus") == s, s) for s in known] + [(others, "other")]
    pieces = [o.where(cond).select("o_orderkey", F.lit(s).alias("chunk"), F.col("o_totalprice").alias("amount"))
              for cond, s in parts]
    out = pieces[0]
    for p in pieces[1:]:
        out = out.unionByName(p)
    return out


def dedup_first(spark, sf_dir):
    """First order per customer by (date, key): ``min_by`` partial aggregate."""
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    g = o.groupBy("o_custkey").agg(F.min_by(F.struct("o_orderkey", "o_orderdate"),
                                            F.struct("o_orderdate", "o_orderkey")).alias("r"))
    return g.select("o_custkey", "r.o_orderkey", "r.o_orderdate")


def top5_salary(spark, sf_dir):
    """Top five per department (segment) by salary (balance), ties by id."""
    c = table(spark, sf_dir, "customer", "c_custkey", "c_mktsegment", "c_acctbal")
    t = top_n_per_group(c, ["c_mktsegment"], [F.desc("c_acctbal"), F.asc("c_custkey")], 5)
    return t.withColumn("rank", F.col("rank").cast("bigint"))


def date_spine(spark, sf_dir):
    """Every day between the first and the last order date."""
    o = table(spark, sf_dir, "orders", "o_orderdate")
    lo = o.agg(F.min(F.to_date("o_orderdate"))).scalar()
    hi = o.agg(F.max(F.to_date("o_orderdate"))).scalar()
    return spark.range(1).select(F.explode(F.sequence(lo, hi)).alias("day"))


def first_days_semi(spark, sf_dir, days: int = 3):
    """Top-N PnL rows of the first ``days`` trade days. The days (at most
    ``days`` rows) are found first, so only their trades are aggregated."""
    li = table(spark, sf_dir, "lineitem", "l_suppkey", "l_shipdate", "l_returnflag", "l_linestatus",
               "l_linenumber", "l_quantity", "l_extendedprice", "l_tax", "l_discount")
    trades = pnl.trades_from_lineitem(li.where((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O")))
    trades = trades.where(F.col("trade_date").isNotNull() & F.col("trader_id").isNotNull())
    first = trades.select("trade_date").distinct().orderBy("trade_date").limit(days)
    own = trades.join(F.broadcast(first), "trade_date", "left_semi")
    return pnl.top_traders_per_day(pnl.daily_trader_pnl(pnl.compute_pnl(own)))


def run_report(spark, sf_dir, n: int = pnl.TOP_N):
    """Run metrics of the PnL job as one row: rows read, rows kept by the
    filter, (day, trader) groups, days and rows in the output."""
    li = table(spark, sf_dir, "lineitem", "l_suppkey", "l_shipdate", "l_returnflag", "l_linestatus")
    kept = F.coalesce((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O"), F.lit(False))
    day, trader = F.to_date("l_shipdate"), F.col("l_suppkey")
    # one pass: rows per (day, trader) of the kept rows, all others in one group; then per day
    groups = li.groupBy(kept.alias("kept"), F.when(kept, day).alias("day"), F.when(kept, trader).alias("trader")) \
               .agg(F.count(F.lit(1)).alias("n"))
    counted = F.col("kept") & F.col("day").isNotNull() & F.col("trader").isNotNull()
    days = groups.groupBy("kept", "day").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("groups"),
                                             F.count_if(counted).alias("traders"))
    listed = F.col("traders") > 0
    return days.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows_read"),
                    F.coalesce(F.sum(F.when(F.col("kept"), F.col("n"))), F.lit(0)).alias("rows_kept"),
                    F.coalesce(F.sum(F.when(F.col("kept"), F.col("groups"))), F.lit(0)).alias("daily_groups"),
                    F.count_if(listed).alias("days"),
                    F.coalesce(F.sum(F.when(listed, F.least(F.col("traders"), F.lit(n)))), F.lit(0)).alias("output_rows"))


def upper_text(spark, sf_dir):
    """String half of the type-driven rule over ``part``."""
    return upper_strings(table(spark, sf_dir, "part", "p_partkey", "p_name", "p_brand", "p_type", "p_size"))


def order_ids(spark, sf_dir, start_after: int = 1000):
    """Auto-increment ids of the orders in (date, key) order."""
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_orderdate")
    return assign_ids(o, start_after, ["o_orderdate", "o_orderkey"]).select("o_orderkey", "id")


def page_files(spark, sf_dir):
    """Safe file name and suffix of each page address."""
    p = table(spark, sf_dir, "pages", "page_id", "url")
    return p.select("page_id", safe_filename(F.col("url")).alias("name"), file_suffix(F.col("url")).alias("suffix"))


def csv_orders(spark, sf_dir):
    """Orders rendered as CSV lines, some of them faulty, and read tolerantly:
    key 0 mod 7 lacks the last field, 1 has one too many, 2 a word as price."""
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderpriority")
    k = F.col("o_orderkey") % 7
    price = F.when(k == 2, "oops").otherwise(F.col("o_custkey").cast("string"))
    line = F.concat_ws(",", F.col("o_orderkey").cast("string"), price, F.when(k != 0, F.concat(F.lit('"'), "o_orderpriority", F.lit(', x"'))),
                       F.when(k == 1, "more"))
    schema = StructType.fromDDL("id bigint, price bigint, note string")
    return parse_csv_lines(o.select("o_orderkey", line.alias("line")), "line", schema).select(
        "o_orderkey", F.when(F.col("reason").isNull(), F.col("id")).alias("id"),
        F.when(F.col("reason").isNull(), F.col("price")).alias("price"),
        F.when(F.col("reason").isNull(), F.col("note")).alias("note"), "reason")


LABEL_LOOKUP_SQL = "SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_custkey = 7"
POSITION_SLICE_SQL = "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 10 OFFSET 100"
PARAM_LOOKUP_SQL = ("SELECT c_custkey, c_name, c_acctbal FROM customer "
                    "WHERE c_mktsegment = 'BUILDING' AND c_nationkey = 7")
FRAME_PROFILE_SQL = """
SELECT section, n_nationkey, n_name, (SELECT count(*) FROM nation) AS n_rows, CAST(3 AS BIGINT) AS n_cols FROM (
  (SELECT 'head' AS section, n_nationkey, n_name FROM nation ORDER BY n_nationkey LIMIT 5)
  UNION ALL
  (SELECT 'tail' AS section, n_nationkey, n_name FROM nation ORDER BY n_nationkey DESC LIMIT 5))
"""
SCHEMA_RULE_SQL = """
SELECT CAST(sum(p_partkey) AS BIGINT) AS sum_p_partkey, CAST(sum(p_size) AS BIGINT) AS sum_p_size,
       CAST(round_even(sum(CAST(p_retailprice AS DECIMAL(28,10))), 2) AS DOUBLE) AS sum_p_retailprice FROM part
"""
ELEMENTWISE_SQL = ("SELECT l_orderkey, l_linenumber, l_quantity * 2 AS doubled, l_quantity * l_quantity AS squared "
                   "FROM lineitem")
GROUP_SUM_SQL = """
SELECT l_returnflag, CAST(sum(CAST(l_quantity AS DECIMAL(12,2))) AS DOUBLE) AS sum_qty,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS sum_price
FROM lineitem WHERE l_returnflag IS NOT NULL GROUP BY l_returnflag
"""
SHARE_OF_TOTAL_SQL = """
SELECT c_mktsegment, count(*) AS n, round_even(100.0 * count(*) / (SELECT count(*) FROM customer), 1) AS share_pct
FROM customer GROUP BY c_mktsegment
"""
UNION_CHUNKS_SQL = """
SELECT o_orderkey, CASE WHEN o_orderstatus IN ('F', 'O', 'P') THEN o_orderstatus ELSE 'other' END AS chunk,
       o_totalprice AS amount
FROM orders
"""
DEDUP_FIRST_SQL = """
SELECT o_custkey, o_orderkey, o_orderdate FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1
"""
TOP5_SALARY_SQL = """
SELECT * FROM (
  SELECT c_custkey, c_mktsegment, c_acctbal,
         CAST(row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey) AS BIGINT) AS "rank"
  FROM customer) WHERE "rank" <= 5
"""
DATE_SPINE_SQL = """
SELECT CAST(unnest(generate_series(min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)), INTERVAL 1 DAY))
            AS DATE) AS day FROM orders
"""
FIRST_DAYS_SEMI_SQL = "WITH top AS (" + pnl.TOPN_PNL_SQL + """)
SELECT * FROM top WHERE trade_date IN (SELECT DISTINCT trade_date FROM top ORDER BY trade_date LIMIT 3)
"""
RUN_REPORT_SQL = "WITH top AS (" + pnl.TOPN_PNL_SQL + """)
SELECT count(*) AS rows_read,
       count(*) FILTER (WHERE l_returnflag = 'N' AND l_linestatus = 'O') AS rows_kept,
       (SELECT count(*) FROM (SELECT DISTINCT l_suppkey, CAST(l_shipdate AS DATE) FROM lineitem
                              WHERE l_returnflag = 'N' AND l_linestatus = 'O')) AS daily_groups,
       (SELECT count(DISTINCT trade_date) FROM top) AS days,
       (SELECT count(*) FROM top) AS output_rows
FROM lineitem
"""
UPPER_TEXT_SQL = ("SELECT p_partkey, upper(p_name) AS p_name, upper(p_brand) AS p_brand, upper(p_type) AS p_type, p_size "
                  "FROM part")
ORDER_IDS_SQL = """
SELECT o_orderkey, CAST(1000 + row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS BIGINT) AS id FROM orders
"""
PAGE_FILES_SQL = r"""
SELECT page_id, regexp_replace(regexp_extract(url, '([^/\\]*)$', 1), '[^A-Za-z0-9._-]', '_', 'g') AS name,
       lower(regexp_extract(url, '(\.[^./\\]+)$', 1)) AS suffix
FROM pages
"""
CSV_ORDERS_SQL = """
WITH o AS (SELECT *, o_orderkey % 7 AS k, o_orderkey % 7 IN (1, 2) AS bad FROM orders)
SELECT o_orderkey, CASE WHEN NOT bad THEN o_orderkey END AS id, CASE WHEN NOT bad THEN o_custkey END AS price,
       CASE WHEN NOT bad AND k <> 0 THEN o_orderpriority || ', x' END AS note,
       CASE k WHEN 1 THEN 'too_many_fields' WHEN 2 THEN 'bad_value' END AS reason
FROM o
"""
