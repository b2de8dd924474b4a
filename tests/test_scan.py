import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators.scan import keyed_scan


def test_keyed_scan_matches_windows_with_hot_key(spark):
    random.seed(7)
    rows = []
    for i in range(2500):
        k = random.choice(["hot", None]) if random.random() < 0.6 else f"k{random.randint(0, 30)}"
        rows.append((k, i, random.choice([None] + list(range(-5, 40)))))
    df = spark.createDataFrame(rows, "k string, pos long, v long")
    res = keyed_scan(df, ["k"], [F.col("pos")], "v", lags=3, chunk_rows=90, suffix=True)
    w = Window.partitionBy("k").orderBy("pos")
    wr = w.rowsBetween(Window.unboundedPreceding, 0)
    ws = w.rowsBetween(0, Window.unboundedFollowing)
    ref = df.select("*", F.row_number().over(w).alias("rn"), F.sum("v").over(wr).alias("run_sum"),
                    F.max("v").over(wr).alias("run_max"), F.min("v").over(wr).alias("run_min"),
                    F.count("v").over(wr).alias("run_cnt"),
                    F.sum("v").over(ws).alias("suf_sum"), F.max("v").over(ws).alias("suf_max"),
                    F.min("v").over(ws).alias("suf_min"),
                    *[F.lag("v", j).over(w).alias(f"lag{j}") for j in (1, 2, 3)])
    a = sorted(map(tuple, res.select(ref.columns).collect()), key=str)
    b = sorted(map(tuple, ref.collect()), key=str)
    assert a == b


def test_hot_key_is_split_across_chunks(spark):
    df = spark.range(5000).select(F.lit("hot").alias("k"), F.col("id").alias("pos"), F.lit(1).alias("v"))
    res = keyed_scan(df, ["k"], [F.col("pos")], "v", chunk_rows=600)
    assert res.agg(F.max("run_sum")).first()[0] == 5000
    assert res.where(F.col("rn") != F.col("pos") + 1).count() == 0


def test_chunks_follow_the_order_and_stay_small(spark):
    from tessera.operators import scan
    df = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 500)).alias("k"),
                                    F.pmod(F.col("id") * 7919, F.lit(5000)).alias("a"), F.col("id"))
    cuts, _ = scan._cuts(df, ["k"], [F.col("a"), F.col("id")], 300)
    assert [r["_k"]["c0"] for r in cuts.collect()] == ["hot"]
    place = scan._place(F.col("_cuts"), F.struct(F.col("a").alias("c0"), F.col("id").alias("c1")))
    rows = (df.where("k = 'hot'").crossJoin(cuts).select("a", "id", place.alias("chunk")).orderBy("a", "id").collect())
    chunks = [r.chunk for r in rows]
    assert chunks == sorted(chunks)
    sizes = [chunks.count(c) for c in set(chunks)]
    assert len(sizes) > 10 and max(sizes) < 4 * 300


def test_one_full_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), "id", F.lit(1).alias("v"))
    plan = keyed_scan(df, ["k"], [F.col("id")], "v", lags=2, suffix=True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_series_with_large_keys_like_without(spark):
    from tessera.operators import series
    rng = random.Random(9)
    rows = [(rng.choice(["hot", "hot", None, "a", "b", "c"]), i, rng.randint(0, 6), f"i{rng.randint(0, 9)}") for i in range(1500)]
    df = spark.createDataFrame(rows, "k string, pos long, v long, item string").repartition(6)
    got = {r.k: r.longest_run for r in series.longest_distinct_run(df, ["k"], [F.col("pos")], "item", chunk_rows=100).collect()}
    plain = {r.k: r.longest_run for r in series.longest_distinct_run(df, ["k"], [F.col("pos")], "item").collect()}
    want = {}
    for k in {r[0] for r in rows}:
        items = [r[3] for r in rows if r[0] == k]
        want[k] = max(n for i in range(len(items)) for n in range(1, 11) if len(set(items[i:i + n])) == n <= len(items) - i)
    assert got == plain == want
