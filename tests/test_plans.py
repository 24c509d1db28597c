"""Physical-plan properties the design relies on at scale."""

import datetime as dt

from pyspark.sql import functions as F

from fixture_paths import SF_SMALL
from lakeledger import oracle as O
from lakeledger.operators import maintenance as M
from lakeledger.operators import reports as R
from lakeledger.registry import QUERIES
from lakeledger.sources import tables


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_gold_product_shuffles_only_for_its_three_aggregates(spark):
    p = plan(QUERIES["gold_product"](spark, SF_SMALL))
    # One hash exchange per aggregate; the joins re-use that partitioning.
    assert p.count("Exchange hashpartitioning") == 3
    assert "rangepartitioning" not in p
    assert p.count("functions=[partial_") == 3


def test_preview_is_a_top_k_not_a_full_sort(spark):
    p = plan(QUERIES["gold_product_top5"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in p
    assert "rangepartitioning" not in p


def test_upsert_shuffles_the_target_once(spark):
    p = plan(QUERIES["upsert"](spark, SF_SMALL))
    assert p.count("LeftOuter") == 1
    assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p


def test_range_scan_reads_only_folders_in_range(spark, tmp_path):
    path = str(tmp_path / "t")
    d1, d2, d3 = dt.date(2025, 1, 1), dt.date(2025, 1, 2), dt.date(2025, 1, 3)
    df = spark.createDataFrame([("a", 1, d1), ("b", 2, d2), ("c", 3, d3)], "k string, v int, d date")
    tables.create_table(spark, path, df, "d")
    scan = tables.scan_table(spark, path, d2, d2)
    assert scan.inputFiles() and all("d=2025-01-02" in f for f in scan.inputFiles())
    assert [tuple(r) for r in scan.collect()] == [("b", 2, d2)]
    assert tables.scan_table(spark, path, dt.date(2030, 1, 1)).count() == 0


def test_report_filters_reach_the_stored_gold_scan(spark, tmp_path):
    path = str(tmp_path / "gold")
    tables.create_table(spark, path, QUERIES["gold_taxes"](spark, SF_SMALL), "CodigoData")
    series = R.report_series(tables.scan_table(spark, path), R.REPORTS["impostos"],
                             branches=O.BRANCHES, date_from=O.DATE_FROM, date_to=O.DATE_TO)
    p = plan(series)
    assert "PartitionFilters: [isnotnull(CodigoData" in p
    assert "In(FilialId" in p
    # Only the columns the report needs are read.
    assert "ReadSchema: struct<FilialId:string,TotalImpostoPago:double>" in p


def test_hot_keys_of_an_upsert_are_split(spark):
    """A third of either side on one key: every join of the upsert is split when it runs."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id").cast("string")))
        base = spark.range(0, 300_000, 1, 8).select(key.alias("k"), F.col("id").alias("v"))
        rows = base.filter("k <> 'hot'").unionByName(spark.createDataFrame([("hot", -1)], base.schema))
        for target, source in ((base, rows), (base.filter("k <> 'hot'"), base)):
            df = M.upsert(target, source, "k")
            df.write.format("noop").mode("overwrite").save()
            df.count()
            got = df.agg(F.count("*")).collect()[0][0]
            assert got == 300_000
            collected = df.select(F.max("v"))
            collected.collect()
            assert "skew=true" in plan(df_run(df))
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def df_run(df):
    """``df``, run to its end so that its adaptive plan is the one that ran."""
    df._jdf.queryExecution().executedPlan().execute().count()
    return df


def test_bucketed_summary_has_no_exchange(spark):
    df = QUERIES["gold_product_bucketed"](spark, SF_SMALL)
    p = plan(df)
    assert "Exchange" not in p and "Bucketed: true" in p
    assert df.count() == QUERIES["gold_product"](spark, SF_SMALL).count()
