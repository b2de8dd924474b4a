"""Sources, sinks, blobs, ids, and two more streaming forms."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from tessera.functions.text import file_suffix, safe_filename
from tessera.operators.changelog import assign_ids
from tessera.operators.validate import validate
from tessera.sources import files, sinks
from tessera.streaming import rules

PNG = bytes.fromhex("89504E470D0A1A0A") + b"\x00" * 20
JPEG = bytes.fromhex("FFD8FFE0") + b"\x00" * 20


def tmp():
    return tempfile.mkdtemp(prefix="tessera-io-")


def test_tolerant_csv(spark):
    d = tmp()
    with open(os.path.join(d, "trades.csv"), "w") as f:
        f.write("trader_id,quantity,price\nT1,10,1.5\nT2,5,2.0,EXTRA\nT3,abc,1.0\nT4,7\nT5,3,4.25\n")
    schema = StructType([StructField("trader_id", StringType()), StructField("quantity", IntegerType()),
                         StructField("price", DoubleType())])
    good, bad = files.read_csv_tolerant(spark, d, schema)
    assert sorted(map(tuple, good.collect())) == [("T1", 10, 1.5), ("T4", 7, None), ("T5", 3, 4.25)]
    assert sorted(r.reason for r in bad.collect()) == ["bad_value", "too_many_fields"]


def test_json_dictionary_and_text(spark):
    d = tmp()
    with open(os.path.join(d, "data.json"), "w") as f:
        json.dump({"rain": ["water falling"], "train": ["a vehicle", "to teach"]}, f)
    got = {r.word: r.meanings for r in files.read_json_dictionary(spark, d).collect()}
    assert got == {"rain": ["water falling"], "train": ["a vehicle", "to teach"]}
    assert files.read_text(spark, d, whole=True).count() == 1


def test_blobs_sniff_and_validate(spark):
    d = tmp()
    for name, data in [("ok.png", PNG), ("photo.gif", b"GIF89a" + b"\x00" * 10), ("big.png", PNG + b"\x00" * 200_000),
                       ("fake.png", JPEG), ("empty.jpg", b"")]:
        with open(os.path.join(d, name), "wb") as f:
            f.write(data)
    blobs = files.read_blobs(spark, d).withColumn("name", safe_filename(F.col("path")))
    fmt = files.sniff_format(F.col("content"))
    ext = file_suffix(F.col("name"))
    ext_fmt = F.element_at(F.create_map(*[F.lit(x) for kv in files.EXT_FORMAT.items() for x in kv]), ext)
    rules_ = [("empty", F.col("length") == 0),
              ("extension_not_allowed", ~ext.isin(".png", ".jpg", ".jpeg")),
              ("too_large", F.col("length") > 100 * 1024),
              ("content_mismatch", fmt.isNull() | (fmt != ext_fmt))]
    ok, rejected = validate(blobs, rules_)
    assert [r.name for r in ok.collect()] == ["ok.png"]
    reasons = {r.name: r.reason for r in rejected.collect()}
    # zero-byte files are skipped by Spark's file listing; the "empty" rule
    # covers blobs that come from tables instead
    assert reasons == {"photo.gif": "extension_not_allowed", "big.png": "too_large", "fake.png": "content_mismatch"}
    assert ok.select(files.mime_of(fmt)).first()[0] == "image/png"


def test_sinks_round_trip(spark):
    d = tmp()
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, s string")
    sinks.write_csv(df, os.path.join(d, "csv"))
    back = spark.read.option("header", True).schema("id int, s string").csv(os.path.join(d, "csv"))
    assert sorted(map(tuple, back.collect())) == [(1, "a"), (2, "b")]
    sinks.write_parquet(df, os.path.join(d, "pq"), partition_by=["s"])
    assert spark.read.parquet(os.path.join(d, "pq")).count() == 2
    sinks.write_text(df.select("s"), os.path.join(d, "txt"))
    sinks.write_text(df.select("s"), os.path.join(d, "txt"), mode="append")
    assert spark.read.text(os.path.join(d, "txt")).count() == 4
    obs_df, obs = sinks.observed(df, "run", rows=F.count(F.lit(1)), total=F.sum("id"))
    sinks.write_parquet(obs_df, os.path.join(d, "obs"))
    assert obs.get == {"rows": 2, "total": 3}
    rep = sinks.write_run_report(spark, {"rows": 2, "name": "x"}, os.path.join(d, "report"))
    assert rep.first()[0]["rows"] == "2"


def test_assign_ids(spark):
    rows = spark.createDataFrame([(f"n{i:03d}",) for i in range(50)][::-1], "name string")
    got = assign_ids(rows, 100, ["name"]).orderBy("id").collect()
    assert [r.id for r in got] == list(range(101, 151))
    assert [r.name for r in got] == sorted(r.name for r in got)


def test_filter_append_and_lookup_stream(spark):
    d = tmp()
    src = os.path.join(d, "in")
    for i in range(3):
        spark.createDataFrame([(i * 10 + j, "EUR" if j % 2 else "GBP") for j in range(5)], "id int, cur string") \
            .coalesce(1).write.parquet(os.path.join(src, f"b{i}"))
    stream = spark.readStream.schema("id int, cur string").option("recursiveFileLookup", "true") \
        .option("maxFilesPerTrigger", 1).parquet(src)
    q = rules.filter_append(stream, F.col("id") % 2 == 0, os.path.join(d, "out"), os.path.join(d, "ck1"))
    q.awaitTermination(300)
    assert sorted(r.id for r in spark.read.parquet(os.path.join(d, "out")).collect()) == [0, 2, 4, 10, 12, 14, 20, 22, 24]
    lookup = spark.createDataFrame([("EUR", 1.1)], "cur string, rate double")
    missing = []

    def sink(batch, _bid):
        missing.append(batch.where(~F.col("_matched")).count())

    q2 = rules.lookup_stream(stream, lookup, ["cur"]).writeStream.foreachBatch(sink) \
        .option("checkpointLocation", os.path.join(d, "ck2")).trigger(availableNow=True).start()
    q2.awaitTermination(300)
    assert sum(missing) == 9 and len(missing) == 3


def test_write_export_matches_combined_string(spark):
    from tessera.plans import text as tx
    d = tmp()
    conv = spark.createDataFrame([(1, 0, "user", "Alpha  \r\n"), (1, 1, "assistant", "Beta"), (2, 0, "user", "Gamma")],
                                 "conv_id long, turn long, role string, text string")
    tx.write_export(conv, os.path.join(d, "export"))
    lines = [r.value for r in spark.read.text(os.path.join(d, "export", "conv_id=1")).collect()]
    assert "\n".join(lines) == "===== Turn 1: user =====\nAlpha\n\n===== Turn 2: assistant =====\nBeta"


def test_combined_export_is_the_whole_document(spark, monkeypatch):
    import duckdb
    from tessera.plans import text as tx
    d = tmp()
    rows = [(1, 0, "user", "Alpha  \r\n"), (1, 1, "assistant", "Beta"), (1, 1, "assistant", "Beta"), (1, 1, "assistant", "Abc"),
            (1, None, "user", "last"), (1, 2, None, "no role"), (1, 3, "user", None), (2, 0, "user", " \n"), (3, 0, None, "x"),
            (None, 0, "user", "no id")] + [(4, i, None if 5 < i < 14 else "user", f"a\n\n\n\nb {i}") for i in range(20)]
    conv = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    conv.repartition(3).write.parquet(os.path.join(d, "conversations.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{d}/conversations.parquet/*.parquet')")
    want = dict(con.execute(tx.COMBINED_EXPORT_SQL).fetchall())
    assert want[1] == "\n\n".join(f"===== Turn {n}: {t}" for n, t in (
        (1, "user =====\nAlpha"), (2, "assistant =====\nAbc"), (3, "assistant =====\nBeta"), (4, "assistant =====\nBeta"),
        (6, "user =====\nNo text detected."), (7, "user =====\nlast")))
    assert want[3] is None and len(want) == 5
    for most in (1000, 3):
        monkeypatch.setattr(tx, "PART_SECTIONS", most)
        assert sorted(map(tuple, tx.combined_export(spark, d).collect()), key=str) == sorted(want.items(), key=str)


def test_pnl_job_report_matches_query(spark):
    from tessera.plans import pnl
    d = tmp()
    rep = pnl.run_job(spark, "/root/testdata/sf0.001", d)
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    assert rep["rows_read"] == li.count()
    assert rep["rows_kept"] == li.where("l_returnflag = 'N' AND l_linestatus = 'O'").count()
    groups = li.where("l_returnflag = 'N' AND l_linestatus = 'O'").select("l_suppkey", F.to_date("l_shipdate")).distinct()
    assert rep["daily_groups"] == groups.count()
    top = pnl.topn_pnl_per_day(spark, "/root/testdata/sf0.001")
    assert rep["output_rows"] == top.count()
    assert rep["days"] == top.select("trade_date").distinct().count()
    back = spark.read.option("header", True).csv(os.path.join(d, "top_traders"))
    assert back.count() == rep["output_rows"]
    assert json.loads(spark.read.text(os.path.join(d, "run_report")).first()[0])["rows_read"] == rep["rows_read"]


def test_tolerant_csv_with_date_column(spark):
    from pyspark.sql.types import DateType
    d = tmp()
    with open(os.path.join(d, "orders.csv"), "w") as f:
        f.write("order_id,order_date,amount\n1,2023-01-05,10.5\n2,2023-02-30,3.0\n3,2023-03-01\n")
    schema = StructType([StructField("order_id", IntegerType()), StructField("order_date", DateType()),
                         StructField("amount", DoubleType())])
    good, bad = files.read_csv_tolerant(spark, d, schema)
    import datetime as dt
    assert sorted(map(tuple, good.collect())) == [(1, dt.date(2023, 1, 5), 10.5), (3, dt.date(2023, 3, 1), None)]
    assert [(r.reason, r.raw) for r in bad.collect()] == [("bad_value", "2,2023-02-30,3.0")]


@pytest.mark.parametrize("sep", [",", "|"])
def test_short_rows_with_quoted_separators_are_kept(spark, sep):
    d = tempfile.mkdtemp(prefix="tessera-csv-")
    lines = ["name,n,note", '"Lee, K",7', "T4,8", 'a,9,"x,y"', "b,10,c,d", "e,oops", "f"]
    with open(os.path.join(d, "x.csv"), "w") as f:
        f.write("\n".join(line.replace(",", sep) for line in lines) + "\n")
    good, bad = files.read_csv_tolerant(spark, d, StructType.fromDDL("name string, n int, note string"), sep=sep)
    assert {tuple(r) for r in good.collect()} == {
        ("T4", 8, None), (f"Lee{sep} K", 7, None), ("a", 9, f"x{sep}y"), ("f", None, None)}
    assert sorted((r.raw.split(sep)[0], r.reason) for r in bad.collect()) == [("b", "too_many_fields"), ("e", "bad_value")]
