"""Physical-plan properties the library relies on, and every registered
query against its DuckDB oracle on the smallest tables."""

import decimal
import math

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tessera.operators import scan
from tessera.plans import events, fx, pnl, retail, text
from tessera.sources.tables import TABLES

SMALL = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_plan(spark):
    df = pnl.topn_pnl_per_day(spark, SMALL)
    p = df._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "PushedFilters: [IsNotNull(l_returnflag), IsNotNull(l_linestatus)" in p
    assert "EqualTo(l_returnflag,N), EqualTo(l_linestatus,O)" in p
    assert "WindowGroupLimit" in p and "Partial" in p        # top-N cut before the shuffle
    assert "partial_sum" in p                                 # map-side combine
    assert "l_comment" not in p and "ReadSchema: struct<l_suppkey:bigint" in p


def test_no_row_at_a_time_python(spark):
    for q in (pnl.topn_pnl_per_day(spark, SMALL), retail.sales_mart(spark, SMALL), fx.fx_join(spark, SMALL),
              text.normalize_text(spark, SMALL), events.kv_current_state(spark, SMALL)):
        p = plan_of(q)
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_lookup_side_is_broadcast(spark):
    df = fx.fx_join(spark, SMALL)
    df.collect()
    assert "BroadcastHashJoin" in plan_of(df)


def test_scan_has_no_single_key_window(spark, monkeypatch):
    """The windows over the rows of large keys run on (key, chunk), never on the key alone."""
    monkeypatch.setattr(scan, "CHUNK_ROWS", 5)
    df = retail.cumulative_spend(spark, SMALL)
    p = df._jdf.queryExecution().optimizedPlan().toString()
    assert "windowspecdefinition(_k" in p and "windowspecdefinition(customer_id" not in p
    windows = [line for line in p.splitlines() if "Window [" in line and "amount" in line]
    assert windows and all("_chunk" in line.split("windowspecdefinition(", 1)[1].split(" ASC")[0] for line in windows)


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, list):
        return tuple(_norm(x) for x in v)
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SMALL)
    cur = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(sdf.columns) == sorted(dcols)
    order = sorted(dcols)
    s_rows = sorted((tuple(_norm(r[c]) for c in order) for r in sdf.collect()), key=repr)
    di = [dcols.index(c) for c in order]
    d_rows = sorted((tuple(_norm(r[i]) for i in di) for r in cur.fetchall()), key=repr)
    assert s_rows == d_rows


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["trade_date", "rank", "trader_id", "pnl"]
    assert df.count() > 0


@pytest.mark.parametrize("name", ["tumbling_index", "drift_match", "sliding_admission", "claim_status", "local_day",
                                  "daily_total", "normalize_dates", "fx_join", "topn_pnl_per_day"])
def test_results_do_not_depend_on_session_zone(spark, duck, name):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        test_query_matches_oracle(spark, duck, name)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_date_column_list_matches_spark_schemas(spark):
    from pyspark.sql.types import DateType
    from tessera.plans import registry
    found = {}
    for name, fn in registry.QUERIES.items():
        cols = [f.name for f in fn(spark, SMALL).schema.fields if isinstance(f.dataType, DateType)]
        if cols:
            found[name] = cols
    assert found == registry.DATE_COLUMNS
    for name in registry.QUERIES:
        assert not any(isinstance(f.dataType, DateType) for f in E.queries()[name](spark, SMALL).schema.fields), name


def test_lookup_join_leaves_the_strategy_to_the_planner(spark):
    from tessera.operators.joins import lookup_join
    left = spark.range(2000).select((F.col("id") % 60).alias("k"), F.col("id").alias("v"))
    right = spark.range(50).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    got = {}
    try:
        for threshold in ("10m", "-1"):
            for k in keys:
                spark.conf.set(k, threshold)
            j = lookup_join(left, right, ["k"])
            got[threshold] = sorted(map(str, j.collect()))
            assert ("BroadcastHashJoin" in plan_of(j)) == (threshold != "-1")
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert got["10m"] == got["-1"] and len(got["-1"]) == 2000


def test_compacted_snapshot_is_clustered_and_prunable(spark):
    from tessera.operators import changelog as kv
    log = events.change_log(spark, SMALL)
    path = kv.compact(log)
    snap = spark.read.parquet(path)
    one = snap.where(F.col("key") == "user:5")
    p = one._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "EqualTo(key,user:5)" in p
    keys = [r.key for r in snap.collect()]
    assert sorted(keys) == sorted(r.key for r in kv.current_state(log).collect())


@pytest.mark.parametrize("name", ["topn_pnl_per_day", "top3_per_city", "top5_salary"])
def test_top_n_cuts_groups_before_the_shuffle(spark, name):
    from tessera.plans import registry
    df = registry.QUERIES[name](spark, SMALL)
    df.collect()
    p = plan_of(df)
    assert "WindowGroupLimit" in p and "Partial" in p, name


def test_every_query_has_an_oracle():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    from tessera.plans import registry
    assert set(registry.QUERIES) <= set(o)
