"""Profiling jobs under skew: a duplicate key holding a third of the rows."""

from pyspark.sql import functions as F

from lakeshore.operators import profile


def _skewed(spark):
    n = 30000
    hot = F.col("id") % 3 == 0
    return spark.range(n).select(
        F.when(hot, F.lit(7)).otherwise(F.col("id") % 15000).alias("a"),
        F.when(hot, F.lit("hot")).otherwise((F.col("id") % 15000).cast("string")).alias("b"),
        F.when(F.col("id") % 5 == 0, F.lit(None)).otherwise(F.lit(1)).alias("c"))


def test_duplicate_groups_equal_brute_force_with_hot_key(spark):
    df = _skewed(spark)
    keys = ["a", "b", "c"]
    got = profile.duplicate_groups(df, keys)
    want = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).filter("count > 1")
    assert got.columns == want.columns
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert got.filter("a = 7 AND b = 'hot'").agg(F.sum("count")).first()[0] == 10000


def test_duplicate_regroup_is_combined_after_a_shuffled_join(spark):
    # With broadcasting off the semi-join shuffles on the hash; the exact
    # regroup must still get its own partial aggregate and exchange, so a hot
    # key is combined per task (and AQE may split the skewed join side).
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        got = profile.duplicate_groups(_skewed(spark), ["a", "b", "c"])
        plan = got._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert "LeftSemi" in plan
    above_join = plan[:plan.index("LeftSemi")]
    assert "partial_count" in above_join and "Exchange hashpartitioning(a" in above_join


def test_only_rows_of_marked_hashes_are_shuffled_whole(spark):
    # Few of many rows are duplicates; nulls and equal texts of another column stay apart.
    df = spark.range(60000).select((F.col("id") % 59000).alias("a"), F.when(F.col("id") % 7 > 0, F.col("id") % 59000).cast("string").alias("b"))
    keys = ["a", "b"]
    keyed = df.select(F.xxhash64(*keys).alias("_h"), *keys)
    hot = keyed.groupBy("_h").count().filter("count > 1").select("_h")
    left = profile._marked(keyed, hot)
    assert left.columns == keyed.columns
    n_hot = keyed.join(hot, "_h", "left_semi").count()
    assert n_hot > 0 and left.join(hot, "_h", "left_semi").count() == n_hot  # no row of a hot hash is lost
    assert left.count() < 1.01 * n_hot + 10
    want = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).filter("count > 1")
    got = profile.duplicate_groups(df, keys)
    assert got.count() == want.count() and got.exceptAll(want).count() == 0
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join LeftSemi") < plan.index("Join Inner")  # the marks are tested first, below the semi-join
    assert profile._marked(keyed, hot.limit(0)).count() == 0
