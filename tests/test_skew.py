"""A part that holds most line items must not end up in one task."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.plans import silver
from tidewater.schemas import STAGING

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
    "spark.sql.shuffle.partitions": "8",
}


def lines(spark, count):
    hot = F.when(F.col("id") % 3 != 0, 1).otherwise(F.col("id") % 50)
    have = {
        "l_orderkey": F.col("id"),
        "l_linenumber": F.lit(1),
        "l_partkey": hot,
        "l_suppkey": F.col("id") % 7,
        "l_extendedprice": F.lit(10),
        "l_discount": F.lit(0.1),
        "l_tax": F.lit(0.0),
        "l_comment": F.md5(F.col("id").cast("string")),
    }
    return spark.range(0, count, 1, 4).select(
        *[have.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
          for f in STAGING["lineitem"].read_schema]
    )


def test_hot_part_is_split(spark):
    part = spark.range(50).selectExpr("id p_partkey", "concat('p', id) p_name", "'t' p_type")
    supplier = spark.range(7).selectExpr("id s_suppkey", "concat('s', id) s_name")
    before = {k: spark.conf.get(k, None) for k in SMALL}
    for key, value in SMALL.items():
        spark.conf.set(key, value)
    try:
        df = silver.lineitem_silver(lines(spark, 20000), part, supplier)
        query = df.select("l_orderkey", "l_partkey", "l_part_name", "l_supplier_name", "l_comment")
        got = query.collect()
        plan = query._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    assert len(got) == 20000
    assert all(r.l_part_name == f"p{r.l_partkey}" for r in got)
    assert "skew=true" in plan


def test_one_key_with_most_versions(spark):
    """Every version of one order: one row is left, and no more than one per map task is shuffled."""
    versions = (
        lines(spark, 20000)
        .withColumn("l_tax", (F.col("l_orderkey") % 9).cast("decimal(12,2)"))
        .withColumn("l_orderkey", F.col("l_orderkey") % 1 + 5)
    )
    df = silver._latest(versions, "lineitem")
    assert df.count() == 1
    metrics = []
    plan = df._jdf.queryExecution().executedPlan()
    df.collect()

    def walk(node):
        if "Exchange" in node.nodeName():
            metrics.append(node.metrics().get("shuffleRecordsWritten").get().value())
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            walk(node.executedPlan())
        elif name.endswith("QueryStage"):
            walk(node.plan())
        else:
            for i in range(node.children().size()):
                walk(node.children().apply(i))

    walk(plan)
    assert metrics and max(metrics) <= 8
