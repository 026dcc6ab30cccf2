"""Text of whole numbers, as float columns print them: right values, and no failed cast a value."""

import time

from pyspark.sql import functions as F

from lakeviews.functions.coerce import coerce_float, coerce_int

CASES = {"17": 17, "17.0": 17, " +17.00 ": 17, "\x0117\x7f": 17, "\x0117.0": None, "17.": 17, "-0.0": 0, ".0": 0, "1e2": 100, "17.5": None, "17 .0": None,
         "17.0 ": None, "9223372036854775807.0": 2**63 - 1, "9223372036854775808.0": None, "9223372036854775808": None, "00017.0": 17, "1.0d": None,
         "": None, "abc": None, None: None, "99999999999999999999.0": None, "1" * 30: None, "5." + "0" * 18: 5}


def test_whole_numbers_keep_their_values(spark):
    rows = spark.createDataFrame([(k,) for k in CASES], "v string").select("v", coerce_int(F.col("v")).alias("n")).collect()
    assert {r.v: r.n for r in rows} == CASES


def test_whole_numbers_cost_about_what_floats_do(spark):
    text = spark.range(0, 2_000_000, 1, 8).select(F.concat(F.col("id").cast("string"), F.lit(".0")).alias("v"), F.concat(F.lit("w"), F.col("id")).alias("w"))

    def seconds(column):
        took = []
        for _ in range(2):
            start = time.monotonic()
            text.select(column.alias("n")).write.format("noop").mode("overwrite").save()
            took.append(time.monotonic() - start)
        return min(took)

    most = 4 * seconds(coerce_float(F.col("v"))) + 0.5
    assert seconds(coerce_int(F.col("v"))) < most and seconds(coerce_int(F.col("w"))) < most
