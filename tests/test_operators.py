import collections
import difflib
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tessera.operators import changelog as kv
from tessera.operators.admission import sliding_admission
from tessera.operators.fuzzy import best_close_match
from tessera.operators.joins import DuplicateKeyError, band_match, first_offset_pair, lookup_join, zero_sum_triples
from tessera.operators.series import (best_window_sum, change_points, longest_distinct_run, max_drawdown,
                                      underwater_depth)
from tessera.operators.topn import top_n_per_group
from tessera.plans import fx, pnl, retail


def series(spark, name, values, ddl="v long"):
    return spark.createDataFrame([(name, i, v) for i, v in enumerate(values)], f"s string, pos long, {ddl}")


def test_pnl_fixture(spark):
    rows = [  # trader, date, country, asset, side, qty, entry, exit, status
        ("T1", "2024-01-02", "India", "Equity", "BUY", 10, "100.00", "110.00", "COMPLETED"),
        ("T2", "2024-01-02", "India", "Equity", "SELL", 5, "50.00", "40.00", "COMPLETED"),
        ("T3", "2024-01-02", "India", "Equity", "BUY", 5, "50.00", "70.00", "COMPLETED"),  # ties T1 at 100
        ("T4", "2024-01-02", "USA", "Equity", "BUY", 99, "1.00", "9.00", "COMPLETED"),
        ("T5", "2024-01-02", "India", "Bond", "BUY", 99, "1.00", "9.00", "COMPLETED"),
        ("T6", "2024-01-02", "India", "Equity", "BUY", 99, "1.00", "9.00", "PENDING"),
        (None, "2024-01-02", "India", "Equity", "BUY", 1, "1.00", "2.00", "COMPLETED"),
        ("T1", "2024-01-03", "India", "Equity", "SELL", 1, "10.00", "10.125", "COMPLETED"),
    ]
    df = spark.createDataFrame(rows, "trader_id string, d string, country string, asset_class string, "
                                     "buy_sell string, quantity int, e string, x string, status string")
    trades = df.select("trader_id", F.to_date("d").alias("trade_date"), "country", "asset_class", "buy_sell",
                       F.col("quantity").cast("decimal(12,2)").alias("quantity"),
                       F.col("e").cast("decimal(18,4)").alias("entry_price"),
                       F.col("x").cast("decimal(18,4)").alias("exit_price"), "status")
    f = pnl.filter_trades(trades, country="India", asset_class="Equity", status="COMPLETED")
    out = pnl.top_traders_per_day(pnl.daily_trader_pnl(pnl.compute_pnl(f)), n=2).orderBy("trade_date", "rank")
    got = [(str(r.trade_date), r.rank, r.trader_id, r.pnl) for r in out.collect()]
    assert got == [("2024-01-02", 1, "T1", 100.0), ("2024-01-02", 2, "T3", 100.0),
                   ("2024-01-03", 1, "T1", -0.12)]  # exact -0.125 rounds half-even


def test_fx_fixture(spark):
    tx = spark.createDataFrame(
        [(7, "k9", "2021-11-30", "SEK", 12.5), (8, "k9", "2021/11/30", "NOK", 40.0), (9, "k3", "Dec 05 2021", "PLN", 7.75),
         (10, "k4", "2021-12-06", "NOK", 3.0), (11, "k4", "2021-12-06", "HUF", 90.0), (12, "k4", "2021-12-06", None, 2.0)],
        "transaction_id int, client_id string, trade_date string, currency string, amount_local double")
    rates = spark.createDataFrame(
        [("2021-11-30", "SEK", 0.5), ("2021-11-30", "NOK", 0.25), ("2021-12-05", "PLN", 2.5),
         ("2021-12-06", "NOK", 0.75), ("2021-12-06", None, 4.0)], "trade_date string, currency string, usd_rate double")
    j = lookup_join(fx.normalize_keys(tx), fx.normalize_keys(rates), fx.KEYS, suffix="_fx")
    got = {r.transaction_id: r.usd_rate for r in j.collect()}
    assert got == {7: 0.5, 8: 0.25, 9: 2.5, 10: 0.75, 11: None, 12: None}
    assert j.where(~F.col("_matched")).count() == 2
    dup = rates.unionByName(rates.limit(1))
    with pytest.raises(DuplicateKeyError):
        lookup_join(fx.normalize_keys(tx), fx.normalize_keys(dup), fx.KEYS)


def test_fx_suffix_and_strict_dates(spark):
    tx = spark.createDataFrame([(1, "2024-01-01", "USD", "a")], "id int, trade_date string, currency string, note string")
    r = spark.createDataFrame([("2024-01-01", "USD", 1.0, "b")], "trade_date string, currency string, usd_rate double, note string")
    j = lookup_join(fx.normalize_keys(tx), fx.normalize_keys(r), fx.KEYS, suffix="_fx")
    assert j.select("note", "note_fx").first() == ("a", "b")
    bad = spark.createDataFrame([(1, "nope", "USD")], "id int, trade_date string, currency string")
    with pytest.raises(Exception):
        fx.normalize_keys(bad).collect()


def test_sales_mart_fixture(spark):
    customers = spark.createDataFrame(
        [("a1", "Ines", "porto", "key_account", 0), ("a2", "Olof", "Umea", "start_up", 1), ("a3", "Rui", "porto", None, 2),
         ("a4", "Mira", None, "retail", 3), ("a1", "again", "d'arc-le", "x", 4)],
        "customer_id string, customer_name string, city string, segment string, _file_order int")
    orders = spark.createDataFrame(
        [(1, "a1", "2020-02-28", 3, 10.0, "completed"), (2, "a2", "2020/02/28", 1, 99.5, "completed"),
         (3, "a3", "Feb 29 2020", 2, 7.0, "completed"), (4, "a3", "2020-02-29", 5, 1.0, "open"),
         (5, "a4", "2020-03-01", 1, 60.0, "completed"), (6, "zz", "2020-03-01", 2, 25.0, "completed"),
         (7, "a1", "2020-03-01", 0, 5.0, "completed")],
        "order_id int, customer_id string, order_date string, quantity int, unit_price double, status string")
    c = retail.transform_customers(customers)
    o = retail.transform_orders(orders)
    e = retail.enrich_orders(o, c)
    assert e.where(~F.col("has_customer")).count() == 1
    mart = retail.build_sales_mart(e)
    got = [(str(r.order_date), r.city, r.segment, r.total_orders, r.unique_customers, float(r.total_revenue))
           for r in mart.collect()]
    assert got == [("2020-02-28", "Umea", "start up", 1, 1, 99.5), ("2020-02-28", "Porto", "key account", 1, 1, 30.0),
                   ("2020-02-29", "Porto", "consumer", 1, 1, 14.0),
                   ("2020-03-01", "Unknown", "retail", 1, 1, 60.0), ("2020-03-01", "Unknown", "unknown", 1, 1, 50.0)]


def test_order_bands(spark):
    df = spark.createDataFrame([(499,), (500,), (2000,), (2001,), (None,)], "amount long")
    got = [r[0] for r in df.select(retail.order_band(F.col("amount"))).collect()]
    assert got == ["Low", "Medium", "Medium", "High", "Unknown"]


def test_series_answers(spark):
    rng = random.Random(12)
    for n in (1, 2, 9, 40):
        v = [rng.randint(1, 9) for _ in range(n)]
        rows = series(spark, "a", v)
        at = [F.col("pos")]
        sums = [sum(v[i:i + 3]) for i in range(n - 2)]
        assert best_window_sum(rows, ["s"], at, "v", 3).first()[1] == (max(sums) if sums else None)
        runs = [k for i in range(n) for k in range(1, n - i + 1) if len(set(v[i:i + k])) == k]
        assert longest_distinct_run(rows, ["s"], at, "v").first()[1] == max(runs)
        assert change_points(rows, ["s"], at, "v").first()[1] == 1 + sum(x != y for x, y in zip(v, v[1:]))
        depth = sum(max(0, min(max(v[:i + 1]), max(v[i:])) - x) for i, x in enumerate(v))
        assert underwater_depth(rows, ["s"], at, "v").first()[1] == depth
        drop = min((x - max(v[:i + 1])) / max(v[:i + 1]) for i, x in enumerate(v))
        assert abs(max_drawdown(rows, ["s"], at, "v").first()[1] - drop) < 1e-12
        pairs = [(j, max(i for i in range(j) if v[i] + v[j] == 10)) for j in range(n) if 10 - v[j] in v[:j]]
        pair = first_offset_pair(rows, "s", "pos", "v", 10).first()
        assert (pair and (pair.j, pair.i)) == (min(pairs) if pairs else None)


def test_top5_with_tie(spark):
    pay = {"ops": [31, 44, 44, 52, 29, 60, 47], "lab": [12, 15], "art": [70, 70, 70, 70, 70, 70]}
    rows = [(f"{team}{i}", team, p) for team, own in pay.items() for i, p in enumerate(own)]
    df = spark.createDataFrame(rows, "emp_name string, Department string, Salary int")
    t = top_n_per_group(df, ["Department"], [F.desc("Salary"), F.asc("emp_name")], 5)
    names = {team: [r.emp_name for r in t.where(F.col("Department") == team).orderBy("rank").collect()] for team in pay}
    assert names == {"ops": ["ops5", "ops3", "ops6", "ops1", "ops2"], "lab": ["lab1", "lab0"],
                     "art": [f"art{i}" for i in range(5)]}


def test_changelog(spark):
    log = spark.createDataFrame(
        [(10, "cart:a", "SET", '{"items":2,"state":"open"}'), (11, "cart:b", "SET", '{"items":5,"state":"open"}'),
         (12, "bill:77", "SET", '{"cart":"cart:a","total":8.5}'), (13, "cart:a", "SET", '{"items":3,"state":"paid"}'),
         (14, "cart:b", "DELETE", None)], "seq long, key string, flag string, value string")
    st = kv.current_state(log)
    assert sorted(r.key for r in st.collect()) == ["bill:77", "cart:a"]
    assert [r.key for r in kv.range_scan(st, "cart:a", "cart:z").collect()] == ["cart:a"]
    assert [r.key for r in kv.field_query(st, "state", '"paid"', ["state"]).collect()] == ["cart:a"]
    with pytest.raises(ValueError):
        kv.field_query(st, "items", "1", ["state"])
    got = kv.point_get(st, spark.createDataFrame([("cart:b",), ("cart:a",)], "key string"), "none")
    assert {r.key: r.exists for r in got.collect()} == {"cart:a": True, "cart:b": False}
    assert kv.audit(log).where("status != 'ok'").count() == 0
    applied = kv.apply_changes(kv.current_state(log.where("seq <= 12")), log.where("seq > 12"))
    assert sorted(map(tuple, applied.collect())) == sorted(map(tuple, st.collect()))


def test_older_changes_alter_nothing(spark):
    base = spark.createDataFrame([("a", 10, "new", False), ("b", 4, None, True)], "key string, seq long, value string, deleted boolean")
    changes = spark.createDataFrame([(5, "a", "SET", "old"), (3, "b", "SET", "late"), (6, "c", "DELETE", None), (7, "d", "SET", "d")],
                                    "seq long, key string, flag string, value string")
    got = {r.key: (r.seq, r.value, r.deleted) for r in kv.apply_changes(base, changes).collect()}
    assert got == {"a": (10, "new", False), "b": (4, None, True), "c": (6, None, True), "d": (7, "d", False)}
    plain = {r.key: r.value for r in kv.apply_changes(base.drop("deleted").where("key = 'a'"), changes).collect()}
    assert plain == {"a": "new", "b": "late", "d": "d"}


def test_audit_against_a_stored_checksum(spark):
    log = spark.createDataFrame([(1, "k", "SET", "v"), (2, "k", "SET", "w"), (3, None, "SET", "x"), (4, "k", "??", "x")],
                                "seq long, key string, flag string, value string")
    stored = log.withColumn("checksum", kv.record_checksum(F.col("flag"), F.col("key"), F.col("value")))
    broken = stored.withColumn("value", F.when(F.col("seq") == 2, "W").otherwise(F.col("value")))
    assert {r.seq: r.status for r in kv.audit(broken).collect()} == {
        1: "ok", 2: "checksum_mismatch", 3: "missing_key", 4: "unknown_flag"}


def test_admission_fixture(spark):
    ts = [0, 1, 2, 9, 10, 11, 12, 30]
    rows = [("a", float(t), i) for i, t in enumerate(ts)] + [("b", 5.0, 100)]
    df = spark.createDataFrame(rows[::-1], "key string, t double, id long")  # shuffled input order
    out = sliding_admission(df, "key", "t", "id", 2, 10).where("key = 'a'").orderBy("id").collect()
    assert [r.allowed for r in out] == [True, True, False, False, False, True, True, True]
    assert [r.retry_after for r in out] == [0, 0, 9, 2, 1, 0, 0, 0]
    assert [r.remaining for r in out] == [1, 0, 0, 0, 0, 0, 0, 1]


def test_drift_band(spark):
    issues = spark.createDataFrame([(1, "u", 10)], "issue_id int, user string, w long")
    att = spark.createDataFrame([(1, "u", 9), (2, "u", 10), (3, "u", 11), (4, "u", 13)], "attempt_id int, user string, aw long")
    m = band_match(issues, att, ["user"], "w", "aw", 1)
    assert sorted(r.attempt_id for r in m.collect()) == [1, 2, 3]


def test_fuzzy_matches_difflib(spark):
    words = ["rain", "train", "brain", "rains", "drain", "grain", "apple", "maple"]
    queries = ["rainn", "RAIN", "zzzz", "aple", "trian", "bran"]
    d = spark.createDataFrame([(w,) for w in words], "word string")
    q = spark.createDataFrame([(x,) for x in queries], "query string")
    got = {r.query: r.match for r in best_close_match(q, "query", d, "word").collect()}
    want = {}
    for x in queries:
        m = difflib.get_close_matches(x.lower(), words, n=1, cutoff=0.6)
        if m:
            want[x] = m[0]
    assert got == want


def test_ratios_equal_difflib():
    from tessera.operators.fuzzy import ratios
    rnd = random.Random(3)
    word = lambda most: "".join(rnd.choice("abcd é\U0001f600") for _ in range(rnd.randint(0, most)))
    pairs = [(word(most), word(most)) for most in (3, 8, 20, 60) for _ in range(400)] + [("", ""), ("a", ""), ("", "a")]
    pairs += [(word(260), "ab" * 60 + word(150)) for _ in range(5)]  # long enough for difflib to leave frequent characters out
    want = [difflib.SequenceMatcher(None, a, b).ratio() for a, b in pairs]
    assert ratios([a for a, _ in pairs], [b for _, b in pairs]).tolist() == want


def test_null_keys_never_match_unless_null_safe(spark):
    left = spark.createDataFrame([(1, "a", None), (2, None, "x")], "id int, k1 string, k2 string")
    right = spark.createDataFrame([("a", None, 10), (None, "x", 20)], "k1 string, k2 string, v int")
    plain = {r.id: r.v for r in lookup_join(left, right, ["k1", "k2"]).collect()}
    assert plain == {1: None, 2: None}                       # SQL rule: NULL matches nothing
    safe = {r.id: r.v for r in lookup_join(left, right, ["k1", "k2"], null_safe=True).collect()}
    assert safe == {1: 10, 2: 20}                            # pandas-style NULL == NULL on request


def test_null_group_keys_are_dropped(spark):
    rows = [("T1", "2024-01-02", "BUY", "1", "1.00", "2.00"), (None, "2024-01-02", "BUY", "1", "1.00", "2.00")]
    df = spark.createDataFrame(rows, "trader_id string, d string, buy_sell string, q string, e string, x string")
    t = df.select("trader_id", F.to_date("d").alias("trade_date"), "buy_sell",
                  F.col("q").cast("decimal(12,2)").alias("quantity"), F.col("e").cast("decimal(18,2)").alias("entry_price"),
                  F.col("x").cast("decimal(18,2)").alias("exit_price"))
    assert [r.trader_id for r in pnl.daily_trader_pnl(pnl.compute_pnl(t)).collect()] == ["T1"]


def test_fuzzy_prefix_filter_is_exact_on_random_strings(spark):
    import random
    rnd = random.Random(11)
    alphabet = "abcdeé"

    def word(lo, hi):
        return "".join(rnd.choice(alphabet) for _ in range(rnd.randint(lo, hi)))

    words = sorted({word(2, 9) for _ in range(150)})
    queries = sorted({word(1, 10) for _ in range(60)} | {w.upper() for w in words[:5]})
    d = spark.createDataFrame([(w,) for w in words], "word string")
    q = spark.createDataFrame([(x,) for x in queries], "query string")
    got = {r.query: (r.match, round(r.score, 12)) for r in best_close_match(q, "query", d, "word").collect()}
    want = {}
    for x in queries:
        m = difflib.get_close_matches(x.lower(), words, n=1, cutoff=0.6)
        if m:
            want[x] = (m[0], round(difflib.SequenceMatcher(None, m[0], x.lower()).ratio(), 12))
    assert got == want


def test_admission_split_at_idle_gaps_is_exact(spark):
    import random
    from tessera.operators.admission import idle_segments
    rnd = random.Random(5)
    rows, t = [], 0.0
    for i in range(1500):
        t += rnd.choice([0.5, 1.0, 2.0, 3.0, 10.0, 10.0001, 25.0])  # bursts, exact-window gaps, idle gaps
        rows.append(("hot" if i % 4 else f"k{i % 7}", t, i))
    df = spark.createDataFrame(rows, "key string, t double, id long")
    split = sliding_admission(df, "key", "t", "id", 3, 10, split_idle=True)
    whole = sliding_admission(df, "key", "t", "id", 3, 10, split_idle=False)
    assert sorted(map(tuple, split.collect())) == sorted(map(tuple, whole.collect()))
    segs = idle_segments(df.select("key", F.col("t").alias("ts"), "id"), 10)
    assert segs.where("key = 'hot'").agg(F.max("seg")).first()[0] > 10   # the hot key is cut into many pieces


@pytest.mark.parametrize("steps, most", [((0.5, 1.0, 2.0, 3.0, 4.0), 5), ((1.0,), None)])
def test_admission_of_a_key_that_is_never_idle(spark, steps, most):
    """Slices folded at the same time give the fold's decisions: runs that meet again, and runs that never do."""
    from tessera.operators.admission import idle_segments, settle, slice_segments
    rnd = random.Random(6)
    rows, t = [], 0.0
    for i in range(4000):
        t += rnd.choice(steps)
        rows.append((None if i % 3 == 0 else "hot" if i % 20 else f"k{i % 7}", t, i))
    df = spark.createDataFrame(rows, "key string, t double, id long")
    whole = sliding_admission(df, "key", "t", "id", 3, 40, split_idle=False)
    split = sliding_admission(df, "key", "t", "id", 3, 40, slice_rows=250)
    assert sorted(map(str, split.collect())) == sorted(map(str, whole.collect()))
    own = slice_segments(idle_segments(df.select("key", F.col("t").alias("ts"), "id"), 40), 250).where("slice IS NOT NULL")
    assert own.groupBy("nokey", "seg").agg(F.countDistinct("slice").alias("n")).agg(F.min("n")).first()[0] > 4
    if most:
        states, rounds = settle(own, 3, 40)
        assert rounds <= most and states.where("size(held) > 3").isEmpty()


def test_triples_of_a_large_group_in_parts(spark):
    rng = random.Random(4)
    rows = [("hot", rng.randint(-300, 300)) for _ in range(900)] + [("small", v) for v in (-4, 2, 2, 0, 0, 0, 5, -1)]
    df = spark.createDataFrame(rows, "g string, v long")
    want = set()
    for g in ("hot", "small"):
        m = collections.Counter(v for k, v in rows if k == g)
        want |= {(g, a, b, -a - b) for a in m for b in m if a <= b <= -a - b
                 and not collections.Counter([a, b, -a - b]) - m}
    for size in (5000, 40):
        got = [tuple(r) for r in zero_sum_triples(df, "g", "v", size).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_mart_counts_like_distinct_counts(spark):
    rng = random.Random(6)
    rows = [(rng.choice(["d1", "d2"]), rng.choice(["x", None]), "s", rng.choice([None, *range(40)]), rng.choice([None, 1, 2, 3]), Decimal(i))
            for i in range(400)]
    e = spark.createDataFrame(rows, "order_date string, city string, segment string, order_id int, customer_id int, "
                                    "gross_revenue decimal(18,2)").repartition(5)
    mart = retail.build_sales_mart(e)
    group = ["order_date", "city", "segment"]
    want = e.groupBy(*group).agg(F.count_distinct("order_id"), F.count_distinct("customer_id"), F.sum("gross_revenue").cast("double"))
    assert sorted(map(tuple, mart.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert "Expand" not in mart._jdf.queryExecution().optimizedPlan().toString()
