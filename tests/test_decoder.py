"""16-bit numbers of binary values, a batch at once."""

from pyspark.sql import functions as F

from bedside.sources import monitors


def test_each_value_is_decoded_once(spark):
    rows = [(0, b"\x01\x00\xff\xff\x00\x80"), (1, b""), (2, None), (3, b"\x05\x00\x07"), (4, b"\x09"), (5, b"\xff\x7f" * 20_000)]
    df = spark.createDataFrame(rows, "i int, data binary").coalesce(1)
    out = df.where("i > 0 OR i = 0").select("i", monitors.little_endian_16(F.col("data")).alias("x"))
    got = {r.i: r.x for r in out.collect()}
    assert got == {0: [1.0, -1.0, -32768.0], 1: [], 2: [], 3: [5.0], 4: [], 5: [32767.0] * 20_000}
    # Higher-order functions would work out their binary value anew for each sample.
    assert "lambdafunction" not in out._jdf.queryExecution().optimizedPlan().toString()
