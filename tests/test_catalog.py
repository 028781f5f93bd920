from pyspark.sql import functions as F

from tidelog.operators import catalog as CAT


def subs(spark):
    return spark.createDataFrame([
        ("a", "app", ["x", "y"], "g1", "2024-01-01 00:00:00"),
        ("b", "app", ["x", "y", "z"], None, "2024-01-02 00:00:00"),
        ("c", "other", ["x"], None, "2024-01-03 00:00:00"),
    ], "id string, owning_application string, event_types array<string>, consumer_group string, created_at string") \
        .withColumn("created_at", F.col("created_at").cast("timestamp"))


def test_find_subscription_wildcards(spark):
    req = spark.createDataFrame([(1, "app", ["y", "x"], None, None), (2, "app", ["x"], "g1", None),
                                 (3, "app", ["q"], None, None)],
                                "request_id long, owning_application string, event_types array<string>, "
                                "consumer_group string, id string")
    got = {r.request_id: r.subscription_id for r in CAT.find_subscription(subs(spark), req).collect()}
    assert got == {1: "b", 2: "a"}                   # newest first; null group is a wildcard
    table, res = CAT.create_if_absent(subs(spark), req, F.current_timestamp())
    r = {x.request_id: (x.subscription_id, x.created) for x in res.collect()}
    assert r[1] == ("b", False) and r[3][1] is True and table.count() == 4


def test_list_and_pages(spark):
    s = CAT.list_subscriptions(subs(spark), "app", ["x"], limit=1, offset=1)
    assert [r.id for r in s.collect()] == ["a"]
    p = CAT.page_links(subs(spark), 1, 0, "app").first()
    assert (p.total, p.has_prev, p.has_next) == (2, False, True)


def test_scope_allowed(spark):
    df = spark.createDataFrame([(None,), ([],), (["a"],), (["b"],)], "s array<string>")
    got = [r.ok for r in df.select(CAT.scope_allowed(F.col("s"), ["a"]).alias("ok")).collect()]
    assert got == [True, True, True, False]


def test_compact_keeps_null_keys(spark):
    log = spark.createDataFrame([("t", "0", "k", 1, 0), ("t", "0", "k", 2, 1), ("t", "0", None, 3, 2),
                                 ("t", "0", None, 4, 3)],
                                "event_type string, partition string, partition_compaction_key string, "
                                "event_id long, offset long")
    assert sorted(r.event_id for r in CAT.compact_latest(log).collect()) == [2, 3, 4]


def test_order_in_instance(spark):
    df = spark.createDataFrame([(1, 1, 1), (1, 3, 2), (1, 2, 3), (2, 1, 1)], "o long, k long, a long")
    out = {(r.o, r.k): r.out_of_order for r in CAT.order_in_instance(df, ["o"], ["k"], ["a"]).collect()}
    assert out == {(1, 1): False, (1, 3): False, (1, 2): True, (2, 1): False}


def test_create_if_absent_keeps_every_column(spark):
    subs = spark.createDataFrame(
        [("s1", "app", ["t"], "g", None, "begin")],
        "id string, owning_application string, event_types array<string>, consumer_group string, "
        "created_at timestamp_ntz, read_from string")
    req = spark.createDataFrame([(1, "app", ["t"], "g", None), (2, "app", ["u"], "g", None)],
                                "request_id long, owning_application string, event_types array<string>, "
                                "consumer_group string, id string")
    table, results = CAT.create_if_absent(subs, req, F.lit("2025-01-01 00:00:00").cast("timestamp_ntz"))
    assert {(r.id == "s1", r.read_from) for r in table.collect()} == {(True, "begin"), (False, None)}
    assert {r.request_id: r.created for r in results.collect()} == {1: False, 2: True}
