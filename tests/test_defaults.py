"""P7 / P8 defaults (random: invariants only) and the nested stats shape (A1)."""

from pyspark.sql import functions as F

from tidelog.functions.columns import is_uuid
from tidelog.operators import consume as CON
from tidelog.operators import envelope as ENV


def test_default_metadata_and_flow_id(spark):
    df = spark.range(500).select(ENV.default_metadata().alias("md"),
                                 ENV.default_flow_id().alias("flow"),
                                 ENV.default_flow_id(F.lit("given")).alias("kept"))
    r = df.agg(F.countDistinct("md.eid").alias("ids"), F.min(is_uuid(F.col("md.eid")).cast("int")).alias("uuid"),
               F.countDistinct("flow").alias("flows"), F.max("md.occurred_at").isNotNull().alias("ts"),
               F.countDistinct("kept").alias("kept")).first()
    assert (r.ids, r.uuid, r.flows, r.ts, r.kept) == (500, 1, 500, True, 1)
    own = spark.range(1).select(ENV.default_metadata(F.lit("6f1d2c3b-5a47-4e89-9b10-2d7c8e4f0a61")).alias("m"))
    assert own.first().m.eid == "6f1d2c3b-5a47-4e89-9b10-2d7c8e4f0a61"


def test_nested_stats_shape(spark):
    stats = spark.createDataFrame([("t", "1", 3, 10), ("t", "0", 0, 0), ("u", "0", 5, None)],
                                  "event_type string, partition string, unconsumed_events long, "
                                  "consumer_lag_seconds long")
    got = {r.event_type: [(p.partition, p.unconsumed_events) for p in r.partitions]
           for r in CON.nested_stats(stats).collect()}
    assert got == {"t": [("0", 0), ("1", 3)], "u": [("0", 5)]}


def test_business_deep_merge(spark):
    import json

    from tidelog import schemas as S

    df = spark.createDataFrame(
        [({"eid": "6f1d2c3b-5a47-4e89-9b10-2d7c8e4f0a61", "event_type": "x"},
          {"a": 1, "metadata": {"trace": "t-1", "event_type": "payload-type"}})],
        T_SCHEMA)
    enc = df.select(ENV.encode_event(F.lit("business"), F.col("md"), F.col("payload"), F.lit(None), F.lit(None),
                                     ["a", "metadata"], ["trace", "event_type"]).alias("j")).first().j
    assert json.loads(enc) == {"a": 1, "metadata": {"eid": "6f1d2c3b-5a47-4e89-9b10-2d7c8e4f0a61",
                                                    "event_type": "x", "trace": "t-1"}}
    assert S.METADATA.fieldNames()[0] == "eid"


T_SCHEMA = ("md struct<eid:string, occurred_at:timestamp, event_type:string, received_at:timestamp, "
            "parent_eids:array<string>, flow_id:string, partition:string, partition_compaction_key:string, "
            "span_ctx:map<string,string>, published_by:string>, "
            "payload struct<a:int, metadata:struct<trace:string, event_type:string>>")
