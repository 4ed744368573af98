import contextlib
import io

from pyspark.sql import functions as F

from fleetlake.operators.joins import join_dimension


def test_hot_key_join_is_split_when_dimension_is_too_large(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        # a third of the fact rows belong to user 0
        fact = spark.range(30000).select((F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")))
                                         .alias("user_id"), F.col("id").alias("tx"))
        users = spark.range(30000).select(F.col("id").alias("user_id"), (F.col("id") % 7).alias("region"))
        j = join_dimension(fact, users, "user_id", "inner")
        assert len(j.collect()) == 30000     # runs this plan: explain() now shows the final plan
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            j.explain()
        plan = buf.getvalue()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
        assert "skew=true" in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_one_instant_with_a_third_of_all_rows_is_not_ranked_in_one_task(spark):
    """Ties of a key's first instant are ranked by key and salt first."""
    from pyspark.sql import functions as F

    from fleetlake.operators.dedup import split_duplicates
    df = spark.range(0, 9000, numPartitions=6).selectExpr(
        "if(id % 3 = 0, 'hot', concat('k', id)) as k", "if(id % 3 = 0, 0, id) as t", "id as v", "cast(null as string) as z")
    kept, rest = split_duplicates(df, ["k"], ["t"])
    windows = [x for x in kept._jdf.queryExecution().executedPlan().toString().splitlines() if "Window [" in x]
    assert len(windows) == 2 and sum("_salt" in x.split("row_number()")[1] for x in windows) == 1
    assert kept.where("k = 'hot'").first().v == 0 and kept.count() == 6001 and rest.count() == 2999
    assert kept.unionByName(rest).exceptAll(df).count() == 0 and rest.where("v = 0").count() == 0
    copies = df.where("k = 'hot'").withColumn("v", F.lit(1)).limit(50)
    kept, rest = split_duplicates(copies, ["k"], ["t"])
    assert kept.count() == 1 and rest.count() == 49
