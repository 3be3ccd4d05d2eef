"""S-1..S-5 and the classifier limits (FIXTURES 13-16)."""
import datetime as dt

from pyspark.sql import functions as F

from gamelake.functions import (balance_rating, bucket, churn_segment, datediff_boundary, item_category,
                                ltv_bucket, mmr_segment, safe_ratio, to_array)


def test_datediff_counts_boundaries(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 59), dt.datetime(2024, 1, 1, 0, 1, 1)),
                                (dt.datetime(2024, 1, 1, 23, 59, 59), dt.datetime(2024, 1, 2, 0, 0, 0))], "a timestamp_ntz, b timestamp_ntz")
    r = df.select(datediff_boundary("minute", "a", "b").alias("m"), datediff_boundary("second", "a", "b").alias("s"),
                  datediff_boundary("day", "a", "b").alias("d")).collect()
    assert [(x.m, x.s, x.d) for x in r] == [(1, 2, 0), (1, 1, 1)]


def test_safe_ratio_guards_zero(spark):
    df = spark.createDataFrame([(1, 0), (1, 3), (None, 2)], "a int, b int")
    r = df.select(safe_ratio("a", "b", 4).alias("r"), safe_ratio("a", "b", 4, True).alias("z")).collect()
    assert [(x.r, x.z) for x in r] == [(None, 0.0), (0.3333, 0.3333), (None, 0.0)]


def test_to_array_wraps_non_arrays(spark):
    df = spark.sql("""select parse_json(j) v from values ('[1,2]'), ('{"a":1}'), ('"x,y"'), ('null'), ('[]') as t(j)""")
    got = [r.n for r in df.select(F.size(to_array("v")).alias("n")).collect()]
    assert got == [2, 1, 1, None, 0]  # JSON null stays NULL (size of NULL is NULL under ANSI)
    missing = spark.sql("select parse_json('{}') v").select(to_array(F.variant_get("v", "$.nope", "variant")).alias("a"))
    assert missing.collect()[0].a is None


def test_churn_limits(spark):
    df = spark.createDataFrame([(d,) for d in [7, 8, 14, 15, 30, 31, None]], "d int")
    assert [r.s for r in df.select(churn_segment("d").alias("s")).collect()] == [
        "active", "at_risk", "at_risk", "dormant", "dormant", "churned", "churned"]


def test_mmr_segment_null_modes(spark):
    vals = [None, 0, 499, 500, 999, 1000, 1499, 1500, 2200]
    df = spark.createDataFrame([(v,) for v in vals], "m int")
    r = df.select(mmr_segment("m").alias("top"), mmr_segment("m", 0).alias("zero"), bucket("m").alias("b")).collect()
    assert [x.top for x in r] == ["hardcore", "new", "new", "casual", "casual", "core", "core", "hardcore", "hardcore"]
    assert [x.zero for x in r][:2] == ["new", "new"]
    assert [x.b for x in r] == [None, 0, 400, 500, 900, 1000, 1400, 1500, 2200]


def test_balance_limits(spark):
    df = spark.createDataFrame([(x,) for x in [0.39, 0.40, 0.50, 0.60, 0.70, 0.71]], "r double")
    assert [r.b for r in df.select(balance_rating("r").alias("b")).collect()] == [
        "strongly_survivor_sided", "survivor_sided", "balanced", "balanced", "killer_sided", "strongly_killer_sided"]


def test_item_category_map(spark):
    vals = ["cosmetic_x", "dlc_x", "rift_pass", "auric_x", "bundle", "charm", None, "unknown"]
    df = spark.createDataFrame([(v,) for v in vals], "t string")
    assert [r.c for r in df.select(item_category("t").alias("c")).collect()] == [
        "cosmetic", "dlc", "rift_pass", "auric_cells", "cosmetic", "cosmetic", "other", "other"]


def test_ltv_bucket(spark):
    df = spark.createDataFrame([(x,) for x in [0.0, 9.99, 10.0, 99.99, 100.0]], "x double")
    assert [r.b for r in df.select(ltv_bucket("x").alias("b")).collect()] == [
        "$0 (Free)", "$1 - $9", "$10 - $49", "$50 - $99", "$100+"]
