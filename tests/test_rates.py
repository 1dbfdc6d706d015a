from pyspark.sql import functions as F

from learnstream.functions.scalar import half_even_percent, ip_to_long, two_decimals


def test_percent_and_two_decimals(spark):
    df = spark.createDataFrame([(0, 0), (1, 8), (3, 8), (3, 2), (1, 3), (2, 3), (5, 0)], "a long, b long")
    got = df.select(half_even_percent(F.col("a"), F.col("b")).alias("p"),
                    two_decimals(F.col("a"), F.col("b")).alias("d")).collect()
    assert [r.p for r in got] == ["0%", "12%", "38%", "150%", "33%", "67%", "0%"]
    assert [r.d for r in got] == [None, 0.13, 0.38, 1.5, 0.33, 0.67, None]


def test_ip_to_long(spark):
    df = spark.createDataFrame([("10.1.2.3",), ("1.2.3",), ("a.b.c.d",), ("1.2.3.300",), ("",)], "ip string")
    got = [r[0] for r in df.select(ip_to_long(F.col("ip"))).collect()]
    assert got == [10 * 16777216 + 65536 + 2 * 256 + 3, None, None, None, None]
