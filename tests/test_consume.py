"""Cursors, offsets, commits, resets, timeouts."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidelog.operators import consume as CON
from tidelog.operators import offsets as offsets_of
from tidelog.operators.offsets import assign_offsets, running_total
from tidelog.sources import testdata as td


def test_offsets_equal_row_number(spark, sf_small):
    base = td.base_events(spark, sf_small)
    ours = assign_offsets(base).select("event_id", "offset")
    w = Window.partitionBy("event_type", "partition").orderBy("ts", "event_id")
    ref = base.select("event_id", (F.row_number().over(w) - 1).alias("offset"))
    assert ours.exceptAll(ref).count() == 0 and ref.exceptAll(ours).count() == 0


def test_offsets_hot_key(spark, sf_small):
    """All rows in ONE key: still dense 0..n-1 without a single-key window."""
    base = td.base_events(spark, sf_small).withColumn("event_type", F.lit("hot")).withColumn("partition", F.lit("0"))
    got = sorted(r.offset for r in assign_offsets(base).select("offset").collect())
    assert got == list(range(base.count()))


@pytest.mark.parametrize("id_of", ["printf('evt-%08d', id)", "md5(cast(id AS string))", "if(id % 4 = 0, NULL, cast(id AS string))"])
def test_hot_second_is_cut(spark, id_of):
    """Two thirds of the rows in one second, most of them in one microsecond: positions as by row_number, in pieces."""
    df = spark.range(6000).selectExpr(
        "if(id % 5 = 0, 'b', 'a') AS k", f"{id_of} AS id1", "id AS id2",
        "timestamp_micros(if(id % 3 = 0, id * 997000, 5000000 + if(id % 7 = 0, id, 0))) AS ts", "id % 11 AS v")
    order = ("ts", "id1", "id2")
    w = Window.partitionBy("k").orderBy(*order)
    want = {r.id2: (r.n, r.s) for r in df.select("id2", (F.row_number().over(w) - 1).alias("n"), F.sum("v").over(
        w.rowsBetween(Window.unboundedPreceding, 0)).alias("s")).collect()}
    got = running_total(df, order, [None, "v"], ["n", "s"], keys=("k",), rows_per_piece=200)
    assert set(got.columns) == {*df.columns, "n", "s"}
    rows = got.collect()
    assert len(rows) == 6000 and {r.id2: (r.n - 1, r.s) for r in rows} == want
    offsets = assign_offsets(df, ("k",), order, rows_per_piece=200).collect()
    assert {r.id2: r.offset for r in offsets} == {i: n for i, (n, _) in want.items()}

    x = df.withColumn("_c", F.lit(0)).withColumn("_f", F.floor(F.unix_micros("ts") / 1_000_000))
    cut = x.join(offsets_of._cuts(x, ["k", "_c", "_f"], list(order), 200), ["k", "_c", "_f"], "left") \
        .withColumn("_s", offsets_of._piece(F.col("_cuts"), F.struct(*order)))
    sizes = [r["count"] for r in cut.groupBy("k", "_f", "_s").count().collect()]
    assert max(sizes) < 800 and len([n for n in sizes if n > 1]) > 10
    brute = cut.filter("_cuts IS NOT NULL").select("_s", F.size(F.filter(
        "_cuts", lambda c: c <= F.struct(*order))).alias("n"))
    assert brute.count() > 3000 and brute.filter("_s <> n").count() == 0


def test_hot_second_of_equal_rows_stays_whole(spark):
    df = spark.range(900).selectExpr("'a' AS k", "timestamp '2024-05-06 07:08:09' AS ts", "0 AS id")
    got = assign_offsets(df, ("k",), ("ts", "id"), rows_per_piece=60).collect()
    assert sorted(r.offset for r in got) == list(range(900))
    assert assign_offsets(df.limit(0), ("k",), ("ts", "id")).count() == 0


def test_running_total_exclusive(spark):
    df = spark.createDataFrame([(i, float(i), i % 2) for i in range(50)], "t long, v double, k long") \
        .withColumn("ts", F.timestamp_seconds(F.col("t") * 7000))
    out = running_total(df, ("ts", "t"), "v", "s", keys=("k",), exclusive=True).collect()
    for r in out:
        assert r.s == sum(x for x in range(r.t) if x % 2 == r.k)


def test_commit_and_reset(spark):
    stored = spark.createDataFrame([("s", "t", "0", "10", "a"), ("s", "t", "1", "BEGIN", "b")],
                                   "subscription_id string, event_type string, partition string, offset string, "
                                   "cursor_token string")
    commits = spark.createDataFrame([("s", "t", "0", "9", "c"), ("s", "t", "0", "12", "d"),
                                     ("s", "t", "1", "0", "e")], stored.schema)
    table, results = CON.commit_cursors(stored, commits)
    assert sorted((r.partition, r.offset, r.result) for r in results.collect()) == [
        ("0", "12", "committed"), ("0", "9", "outdated"), ("1", "0", "committed")]
    assert sorted((r.partition, r.offset, r.cursor_token) for r in table.collect()) == [
        ("0", "12", "d"), ("1", "0", "e")]
    subs = spark.createDataFrame([("s",)], "id string")
    resets = spark.createDataFrame([("s", "t", "0", "BEGIN", "r"), ("zz", "t", "0", "1", "r")], stored.schema)
    t2, res = CON.reset_cursors(stored, subs, resets)
    assert {r.subscription_id: r.reset for r in res.collect()} == {"s": True, "zz": False}
    assert sorted((r.partition, r.offset) for r in t2.collect()) == [("0", "BEGIN"), ("1", "BEGIN")]


def test_expired_batches(spark):
    sent = spark.createDataFrame([("t", "0", "10", "2024-01-01 00:00:00"), ("t", "0", "20", "2024-01-01 00:00:10"),
                                  ("t", "1", "5", "2024-01-01 00:00:00")],
                                 "event_type string, partition string, offset string, sent_ts string") \
        .withColumn("sent_ts", F.col("sent_ts").cast("timestamp"))
    commits = spark.createDataFrame([("t", "0", "20", "2024-01-01 00:00:35"), ("t", "1", "4", "2024-01-01 00:00:01")],
                                    "event_type string, partition string, offset string, commit_ts string") \
        .withColumn("commit_ts", F.col("commit_ts").cast("timestamp"))
    lost = CON.expired_batches(sent, commits, 30)
    assert sorted((r.partition, r.offset) for r in lost.collect()) == [("0", "10"), ("1", "5")]


def test_keepalive_runs(spark):
    flags = [False, True, True, True, False, True]
    df = spark.createDataFrame([(i, f) for i, f in enumerate(flags)], "t long, keepalive boolean") \
        .withColumn("sent_ts", F.timestamp_seconds("t"))
    out = CON.keepalive_runs(df, 2, order=("sent_ts",)).orderBy("t").collect()
    assert [r.run_length for r in out] == [0, 1, 2, 3, 0, 1]
    assert [r.closes for r in out] == [False, False, True, False, False, False]


def test_expired_batches_buckets(spark):
    """Small offset buckets (covering commits several buckets later) equal the unbucketed answer."""
    import random

    rnd = random.Random(7)
    sent = [("t", "0", str(o), f"2024-01-01 00:{o // 60:02d}:{o % 60:02d}") for o in range(0, 200, 5)]
    com = [("t", "0", str(o), f"2024-01-01 00:{(o + d) // 60:02d}:{(o + d) % 60:02d}")
           for o in range(0, 200, 5) for d in [rnd.choice([10, 40, 90])] if rnd.random() < 0.4]
    s = spark.createDataFrame(sent, "event_type string, partition string, offset string, sent_ts string") \
        .withColumn("sent_ts", F.col("sent_ts").cast("timestamp"))
    c = spark.createDataFrame(com, "event_type string, partition string, offset string, commit_ts string") \
        .withColumn("commit_ts", F.col("commit_ts").cast("timestamp"))
    a = sorted(r.offset for r in CON.expired_batches(s, c, 60, bucket=7).collect())
    b = sorted(r.offset for r in CON.expired_batches(s, c, 60, bucket=10 ** 9).collect())
    assert a == b and 0 < len(a) < len(sent)


def test_write_and_prune_log(spark, sf_small):
    import tempfile

    from tidelog.sources.tables import read_log, write_log

    path = tempfile.mkdtemp(prefix="tidelog-log-") + "/log"
    log = td.event_log(spark, sf_small)
    write_log(log, path, mode="overwrite")
    one = read_log(spark, path, ["click"])
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "click" in plan
    assert one.count() == log.filter(F.col("event_type") == "click").count()


def test_commit_keepalive_sends_nothing(spark):
    stored = spark.createDataFrame([("s", "t", "0", "10", "a")],
                                   "subscription_id string, event_type string, partition string, offset string, "
                                   "cursor_token string")
    table, results = CON.commit_cursors(stored, stored, event_batch=False)
    assert results is None and table is stored


def test_batch_limit_zero_is_one_batch(spark, sf_small):
    env = td.with_envelope(td.event_log(spark, sf_small))
    lines = td.batch_lines(env, batch_limit=0).filter(~F.col("keepalive"))
    assert lines.count() == env.select("event_type", "partition").distinct().count()


def test_running_total_keeps_rows_without_an_order_value(spark):
    import pytest

    from tidelog.operators.offsets import assign_offsets
    df = spark.createDataFrame([("a", None, "1"), ("a", 5.0, "2"), ("a", 3.0, "3"), ("b", None, "4")],
                               "k string, ts double, id string")
    got = {r.id: r.offset for r in assign_offsets(df, ("k",), ("ts", "id")).collect()}
    assert got == {"1": 0, "3": 1, "2": 2, "4": 0}
    with pytest.raises(Exception, match="null key"):
        assign_offsets(df.selectExpr("nullif(k, 'a') AS k", "ts", "id"), ("k",), ("ts", "id")).collect()


def test_bucket_bases_are_not_broadcast(spark, sf_small):
    """Up to one row per event: the join with them is a shuffle join, also where the table's file is small."""
    from tidelog.sources import testdata as td

    log = td.event_log(spark, sf_small)
    plan = log._jdf.queryExecution().sparkPlan().toString().splitlines()
    joins = [line for line in plan if "Join" in line]
    assert "SortMergeJoin" in joins[0] and "_f#" in joins[0]


def test_expired_stream_looks_at_two_slots(spark, tmp_path):
    """Commits at, before and after the edges of a slot, two at once, and none; compared within slots only."""
    from tidelog.streaming.stateful import expired_stream

    sent = [("a", "0", n, str(n), 1_700_000_000 + 7 * n) for n in range(60)] + [("end", "0", 0, "0", 1_700_100_000)]
    commits = [("a", "0", "4", 1_700_000_088), ("a", "0", "9", 1_700_000_123), ("a", "0", "9", 1_700_000_124),
               ("a", "0", "30", 1_700_000_260), ("a", "0", "59", 1_700_000_473), ("b", "0", "59", 1_700_000_300),
               ("end", "0", "0", 1_700_100_000)]
    spark.createDataFrame(sent, "event_type string, partition string, batch_no long, offset string, s long") \
        .withColumn("sent_ts", F.timestamp_seconds("s")).drop("s").write.parquet(f"{tmp_path}/sent")
    spark.createDataFrame(commits, "event_type string, partition string, offset string, s long") \
        .withColumn("commit_ts", F.timestamp_seconds("s")).drop("s").write.parquet(f"{tmp_path}/commits")
    lost = expired_stream(*[spark.readStream.schema(spark.read.parquet(f"{tmp_path}/{t}").schema).parquet(f"{tmp_path}/{t}")
                            for t in ("sent", "commits")])
    analyzed = lost._jdf.queryExecution().analyzed().toString()
    assert "(_slot#" in next(line for line in analyzed.splitlines() if "Join LeftOuter" in line)
    lost.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/ck") \
        .trigger(availableNow=True).start().awaitTermination()
    got = {r.batch_no for r in spark.read.schema(lost.schema).parquet(f"{tmp_path}/out").collect() if r.event_type == "a"}
    want = {n for t, p, n, o, at in sent if t == "a" and not any(
        c[:2] == (t, p) and int(c[2]) >= n and at <= c[3] <= at + 60 for c in commits)}
    assert got == want and 0 < len(want) < 60
