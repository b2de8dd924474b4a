"""Registry of named queries and their DuckDB oracle SQL."""

from __future__ import annotations

from . import basics as bx, events as ev, fx, pnl, retail, text as tx

QUERIES = {
    "topn_pnl_per_day": pnl.topn_pnl_per_day,
    "fx_join": fx.fx_join,
    "fx_join_stats": fx.fx_join_stats,
    "fx_duplicate_keys": fx.fx_duplicate_keys,
    "normalize_dates": fx.normalize_dates,
    "sales_mart": retail.sales_mart,
    "orders_without_customer": retail.orders_without_customer,
    "clean_orders": retail.clean_orders,
    "orders_enriched": retail.orders_enriched,
    "order_category": retail.order_category,
    "cumulative_spend": retail.cumulative_spend,
    "rolling_avg_3": retail.rolling_avg_3,
    "avg_rank": retail.avg_rank,
    "customer_metrics": retail.customer_metrics,
    "high_value_customers": retail.high_value_customers,
    "pivot_city_month": retail.pivot_city_month,
    "top3_per_city": retail.top3_per_city,
    "inactive_customers": retail.inactive_customers,
    "max_drawdown": ev.max_drawdown,
    "max_k_sum": ev.max_k_sum,
    "longest_unique_run": ev.longest_unique_run,
    "change_points": ev.change_points,
    "underwater_depth": ev.underwater_depth,
    "offset_pairs": ev.offset_pairs,
    "netting_triples": ev.netting_triples,
    "sliding_admission": ev.sliding_admission,
    "drift_match": ev.drift_match,
    "daily_total": ev.daily_total,
    "distinct_dates": ev.distinct_dates,
    "dates_with_default": ev.dates_with_default,
    "day_listing": ev.day_listing,
    "local_day": ev.local_day,
    "latest_n": ev.latest_n,
    "latest_per_name": ev.latest_per_name,
    "validate_rows": ev.validate_rows,
    "claim_status": ev.claim_status,
    "json_ops": ev.json_ops,
    "map_ops": ev.map_ops,
    "kv_current_state": ev.kv_current_state,
    "kv_get": ev.kv_get,
    "kv_prefix_scan": ev.kv_prefix_scan,
    "kv_range_scan": ev.kv_range_scan,
    "kv_field_query": ev.kv_field_query,
    "kv_stats": ev.kv_stats,
    "apply_changes": ev.apply_changes,
    "kv_compaction": ev.kv_compaction,
    "tumbling_index": ev.tumbling_index_q,
    "log_checksum": ev.log_checksum,
    "normalize_text": tx.normalize_text,
    "combined_export": tx.combined_export,
    "tag_text": tx.tag_text,
    "tag_attr": tx.tag_attr,
    "string_ops": tx.string_ops,
    "array_ops": tx.array_ops,
    "dictionary_lookup": tx.dictionary_lookup,
    "fuzzy_lookup": tx.fuzzy_lookup,
    "label_lookup": bx.label_lookup,
    "position_slice": bx.position_slice,
    "param_lookup": bx.param_lookup,
    "frame_profile": bx.frame_profile,
    "schema_rule": bx.schema_rule,
    "elementwise": bx.elementwise,
    "group_sum": bx.group_sum,
    "share_of_total": bx.share_of_total,
    "union_chunks": bx.union_chunks,
    "dedup_first": bx.dedup_first,
    "top5_salary": bx.top5_salary,
    "date_spine": bx.date_spine,
    "first_days_semi": bx.first_days_semi,
    "run_report": bx.run_report,
    "upper_text": bx.upper_text,
    "order_ids": bx.order_ids,
    "page_files": bx.page_files,
    "csv_orders": bx.csv_orders,
}

ORACLE_SQL = {
    "topn_pnl_per_day": pnl.TOPN_PNL_SQL,
    "fx_join": fx.FX_JOIN_SQL,
    "fx_join_stats": fx.FX_JOIN_STATS_SQL,
    "fx_duplicate_keys": fx.FX_DUPLICATE_KEYS_SQL,
    "normalize_dates": fx.NORMALIZE_DATES_SQL,
    "sales_mart": retail.SALES_MART_SQL,
    "orders_without_customer": retail.ORDERS_WITHOUT_CUSTOMER_SQL,
    "clean_orders": retail.CLEAN_ORDERS_SQL,
    "orders_enriched": retail.ORDERS_ENRICHED_SQL,
    "order_category": retail.ORDER_CATEGORY_SQL,
    "cumulative_spend": retail.CUMULATIVE_SPEND_SQL,
    "rolling_avg_3": retail.ROLLING_AVG_3_SQL,
    "avg_rank": retail.AVG_RANK_SQL,
    "customer_metrics": retail.CUSTOMER_METRICS_SQL,
    "high_value_customers": retail.HIGH_VALUE_CUSTOMERS_SQL,
    "pivot_city_month": retail.PIVOT_CITY_MONTH_SQL,
    "top3_per_city": retail.TOP3_PER_CITY_SQL,
    "inactive_customers": retail.INACTIVE_CUSTOMERS_SQL,
    "max_drawdown": ev.MAX_DRAWDOWN_SQL,
    "max_k_sum": ev.MAX_K_SUM_SQL,
    "longest_unique_run": ev.LONGEST_UNIQUE_RUN_SQL,
    "change_points": ev.CHANGE_POINTS_SQL,
    "underwater_depth": ev.UNDERWATER_DEPTH_SQL,
    "offset_pairs": ev.OFFSET_PAIRS_SQL,
    "netting_triples": ev.NETTING_TRIPLES_SQL,
    "sliding_admission": ev.SLIDING_ADMISSION_SQL,
    "drift_match": ev.DRIFT_MATCH_SQL,
    "daily_total": ev.DAILY_TOTAL_SQL,
    "distinct_dates": ev.DISTINCT_DATES_SQL,
    "dates_with_default": ev.DATES_WITH_DEFAULT_SQL,
    "day_listing": ev.DAY_LISTING_SQL,
    "local_day": ev.LOCAL_DAY_SQL,
    "latest_n": ev.LATEST_N_SQL,
    "latest_per_name": ev.LATEST_PER_NAME_SQL,
    "validate_rows": ev.VALIDATE_ROWS_SQL,
    "claim_status": ev.CLAIM_STATUS_SQL,
    "json_ops": ev.JSON_OPS_SQL,
    "map_ops": ev.MAP_OPS_SQL,
    "kv_current_state": ev.KV_CURRENT_STATE_SQL,
    "kv_get": ev.KV_GET_SQL,
    "kv_prefix_scan": ev.KV_PREFIX_SCAN_SQL,
    "kv_range_scan": ev.KV_RANGE_SCAN_SQL,
    "kv_field_query": ev.KV_FIELD_QUERY_SQL,
    "kv_stats": ev.KV_STATS_SQL,
    "apply_changes": ev.APPLY_CHANGES_SQL,
    "kv_compaction": ev.KV_COMPACTION_SQL,
    "log_checksum": ev.LOG_CHECKSUM_SQL,
    "tumbling_index": ev.TUMBLING_INDEX_SQL,
    "normalize_text": tx.NORMALIZE_TEXT_SQL,
    "combined_export": tx.COMBINED_EXPORT_SQL,
    "tag_text": tx.TAG_TEXT_SQL,
    "tag_attr": tx.TAG_ATTR_SQL,
    "string_ops": tx.STRING_OPS_SQL,
    "array_ops": tx.ARRAY_OPS_SQL,
    "dictionary_lookup": tx.DICTIONARY_LOOKUP_SQL,
    "fuzzy_lookup": tx.FUZZY_LOOKUP_SQL,
    "label_lookup": bx.LABEL_LOOKUP_SQL,
    "position_slice": bx.POSITION_SLICE_SQL,
    "param_lookup": bx.PARAM_LOOKUP_SQL,
    "frame_profile": bx.FRAME_PROFILE_SQL,
    "schema_rule": bx.SCHEMA_RULE_SQL,
    "elementwise": bx.ELEMENTWISE_SQL,
    "group_sum": bx.GROUP_SUM_SQL,
    "share_of_total": bx.SHARE_OF_TOTAL_SQL,
    "union_chunks": bx.UNION_CHUNKS_SQL,
    "dedup_first": bx.DEDUP_FIRST_SQL,
    "top5_salary": bx.TOP5_SALARY_SQL,
    "date_spine": bx.DATE_SPINE_SQL,
    "first_days_semi": bx.FIRST_DAYS_SEMI_SQL,
    "run_report": bx.RUN_REPORT_SQL,
    "upper_text": bx.UPPER_TEXT_SQL,
    "order_ids": bx.ORDER_IDS_SQL,
    "page_files": bx.PAGE_FILES_SQL,
    "csv_orders": bx.CSV_ORDERS_SQL,
}

# Output columns of DATE type per query. The driver-facing layer returns them
# as TIMESTAMP_NTZ at midnight (the convention of the input tables) on both
# the Spark and the SQL side: a DATE reaches pandas as a date on one engine
# and as a timestamp on the other, while a timestamp reads the same in every
# client. ``tests/test_plans.py`` checks this list against the Spark schemas.
DATE_COLUMNS = {
    "clean_orders": ["order_date"],
    "cumulative_spend": ["order_date"],
    "customer_metrics": ["last_order_date"],
    "daily_total": ["entry_date"],
    "date_spine": ["day"],
    "dates_with_default": ["entry_date"],
    "day_listing": ["entry_date"],
    "distinct_dates": ["entry_date"],
    "first_days_semi": ["trade_date"],
    "fx_duplicate_keys": ["trade_date"],
    "fx_join": ["trade_date"],
    "high_value_customers": ["last_order_date"],
    "inactive_customers": ["last_order_date"],
    "local_day": ["local_day"],
    "orders_enriched": ["order_date"],
    "orders_without_customer": ["order_date"],
    "sales_mart": ["order_date"],
    "topn_pnl_per_day": ["trade_date"],
}


def days_as_timestamps(df):
    """Every DATE column of ``df`` as TIMESTAMP_NTZ at midnight (zone-free)."""
    from pyspark.sql import functions as F
    from pyspark.sql.types import DateType
    return df.select(*[F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, DateType)
                       else F.col(f.name) for f in df.schema.fields])


def driver_query(fn):
    def run(spark, sf_dir):
        return days_as_timestamps(fn(spark, sf_dir))
    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    return run


def driver_sql(name: str, sql: str) -> str:
    cols = DATE_COLUMNS.get(name)
    if not cols:
        return sql
    repl = ", ".join(f'CAST("{c}" AS TIMESTAMP) AS "{c}"' for c in cols)
    return f"SELECT * REPLACE ({repl}) FROM ({sql.strip()}) AS q"
