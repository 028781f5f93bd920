import pytest
from pyspark.sql import functions as F

from tidelog.functions import columns as C


def one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first().x


def test_backoff_compounds(spark):
    df = spark.range(6).select(C.backoff_delay_ms(F.col("id")).alias("d"))
    got = [round(r.d, 1) for r in df.collect()]
    assert got == [100.0, 150.0, 337.5, 1139.1, 5766.5, 43789.4]


@pytest.mark.parametrize("text,ok", [
    ("2023-11-05T08:30:00Z", True), ("2021-02-14T10:00:00+02:00", True), ("2021-02-14T10:00:00.5Z", True),
    ("2021-02-14T10:00:00", False), ("2021-02-14 10:00:00Z", False), ("garbage", False),
])
def test_parse_offset_ts(spark, text, ok):
    assert (one(spark, C.parse_offset_ts(F.lit(text))) is not None) == ok


def test_offset_num(spark):
    df = spark.createDataFrame([("BEGIN",), ("0",), ("41",), ("x",)], "o string")
    assert [r.n for r in df.select(C.offset_num("o").alias("n")).collect()] == [-1, 0, 41, None]


def test_mask_token(spark):
    assert one(spark, C.mask_token(F.lit("Authorization: Bearer abc.def"))) == "Authorization: Bearer <secret>"
    assert one(spark, C.mask_token(F.lit("Bearer abc"), enabled=False)) == "Bearer abc"


def test_uuid_and_enum(spark):
    assert one(spark, C.is_uuid(F.lit("6f1d2c3b-5a47-4e89-9b10-2d7c8e4f0a61"))) is True
    assert one(spark, C.is_uuid(F.lit("6f1d2c3b-5a47-4e89-9b10"))) is False
    assert one(spark, C.is_enum(F.lit("S"), ["C", "U", "D", "S"])) is True


def test_offset_ts_string(spark):
    assert one(spark, C.offset_ts_string(F.lit("2023-11-05 08:30:00").cast("timestamp"))) == "2023-11-05T08:30:00Z"
    assert one(spark, C.offset_ts_string(F.lit("2023-11-05 08:30:00.5").cast("timestamp"))) == "2023-11-05T08:30:00.5Z"


def test_seconds_between_truncates(spark):
    a = F.lit("2024-01-01 00:00:00").cast("timestamp")
    b = F.lit("2024-01-01 00:01:01.999").cast("timestamp")
    assert one(spark, C.seconds_between(a, b)) == 61


def test_seconds_of_interval(spark):
    assert one(spark, C.seconds(F.expr("INTERVAL '1 00:00:01.9' DAY TO SECOND"))) == 86401


def test_cluster_conf_sizes_partitions():
    from tidelog.session import cluster_conf

    c = cluster_conf(100 * (1 << 40), executors=1000, cores_per_executor=4)
    assert int(c["spark.sql.shuffle.partitions"]) == 100 * (1 << 40) // (256 << 20)
    assert cluster_conf(1 << 30)["spark.sql.shuffle.partitions"] == str(2 * 1000 * 4)
    assert c["spark.sql.adaptive.enabled"] == "true"
