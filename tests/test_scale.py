"""Plans and hot keys: what must hold when the data is a hundred million times larger."""

import re

import pytest
from pyspark.sql import functions as F

from millrace.operators import joins, project, sets
from millrace.operators.quality import relationships
from millrace.plans.bindings import project as shop_of
from millrace.plans.bindings import table
from millrace.queries import QUERIES
from millrace.sources import jdbc

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def small_thresholds(spark):
    """Make tiny data look big: no broadcasts, and partitions count as skewed from a few kilobytes."""
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k) for k in changed}
    for key, value in changed.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


@pytest.fixture(scope="module")
def hot_lines(spark, tmp_path_factory):
    """A third of all lines belong to one order; several files, so that a hot key has several sources."""
    path = str(tmp_path_factory.mktemp("hot") / "lines")
    lines = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000).cast("bigint").alias("order_guid"),
        F.col("id").alias("line"),
    )
    lines.repartition(12).write.parquet(path)
    return spark.read.parquet(path)


def test_hot_order_is_split_in_the_line_join(spark, hot_lines, small_thresholds):
    orders = spark.range(1200).withColumnRenamed("id", "order_guid").withColumn("total", F.col("order_guid") * 2)
    joined = joins.left_join_lines(orders, hot_lines, "order_guid")
    rows = joined.collect()
    assert len(rows) == 30_000 + 200  # every line, and every order without one
    assert sum(r["line"] is None for r in rows) == 200
    assert "skew=true" in plan(joined)
    expected = orders.join(hot_lines, "order_guid", "left")
    assert joined.exceptAll(expected).isEmpty() and expected.exceptAll(joined).isEmpty()


def test_line_join_keeps_null_and_repeated_left_keys(spark):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (2, "c"), (None, "d"), (None, "e")], "k int, v string")
    lines = spark.createDataFrame([(1, 10), (1, 10), (None, 20), (3, 30)], "k int, n int")
    joined, expected = joins.left_join_lines(left, lines, "k"), left.join(lines, "k", "left")
    assert joined.columns == expected.columns
    assert sorted(map(tuple, joined.collect()), key=repr) == sorted(map(tuple, expected.collect()), key=repr)


def test_hot_left_key_is_split_in_left_and_anti_joins(spark, hot_lines, small_thresholds):
    names = spark.range(500).select(F.col("id").alias("order_guid"), F.lit("n").alias("name"))
    joined = hot_lines.join(names, "order_guid", "left")
    assert joined.count() == 30_000 and joined.collect() and "skew=true" in plan(joined)
    orphans = relationships(hot_lines, "order_guid", names.filter("order_guid > 7"), "order_guid")
    orphans.collect()
    assert "skew=true" in plan(orphans)


def test_difference_moves_combined_rows_once(spark, hot_lines):
    changed = sets.two_way_difference(hot_lines, hot_lines.filter("order_guid != 7"), ["order_guid"])
    assert [tuple(r) for r in changed.collect()] == [(7, "removed")]
    text = plan(sets.except_rows(hot_lines, hot_lines.limit(0)))
    assert text.split("Initial Plan")[0].count("Exchange hashpartitioning") == 1
    assert "partial_bool_or" in text or "partial_max" in text


def test_top_per_group_limits_before_the_shuffle(spark, hot_lines):
    text = plan(project.top_per_group(hot_lines, "order_guid", [F.desc("line")], 3))
    assert re.search(r"WindowGroupLimit.*Partial", text)


@pytest.mark.parametrize(
    ("name", "pushed"),
    [
        ("filter_equal", "EqualTo(o_orderstatus,P)"),
        ("filter_prefix", "StringStartsWith(p_name,red)"),
        ("filter_in", "In(c_mktsegment, [BUILDING,MACHINERY])"),
        ("filter_month_year", "GreaterThanOrEqual(o_orderdate,1998-02-01T00:00)"),
        ("date_slice", "LessThan(o_orderdate,1998-02-11T00:00)"),
        ("high_water_incremental", "GreaterThan(o_orderdate,"),
    ],
)
def test_filters_reach_the_scan(spark, name, pushed):
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    assert pushed in plan(QUERIES[name](spark, SF))


def test_scans_read_only_what_is_used(spark):
    text = plan(shop_of(spark, SF).ref("fct_orders").select("order_guid", "product_name"))
    assert "o_totalprice" not in text and "c_name" not in text
    masked = plan(QUERIES["masked_users"](spark, SF))
    assert "c_name" not in masked.split("FileScan")[1].split("Batched")[0]


def test_no_python_and_no_cross_join_in_native_queries(spark):
    python = {"batch_topk", "similarity_rows", "lsh_topk", "embed_text", "store_vectors", "rag_context"}
    writing = {n for n, q in QUERIES.items() if n.startswith(("stream_", "lake_", "csv_", "json_", "xml_", "orc_"))}
    writing |= {"daily_ingest", "day_partition_replace", "load_audit", "landed_day", "layered_load", "partitioned_load"}
    for name in sorted(set(QUERIES) - python - writing):
        text = plan(QUERIES[name](spark, SF))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name
        assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text, name


def test_top_k_keeps_k_rows_per_task(spark):
    assert "TakeOrderedAndProject" in plan(QUERIES["euclid_topk"](spark, SF))
    assert "TakeOrderedAndProject" in plan(QUERIES["bounded_fetch"](spark, SF))


def test_suite_scans_each_table_once_for_row_checks(spark):
    from millrace.operators.quality import Check, run_suite

    checks = [Check("t", c, "not_null") for c in ("l_orderkey", "l_partkey", "l_quantity")]
    text = plan(run_suite({"t": table(spark, SF, "lineitem")}, checks))
    assert text.split("Initial Plan")[0].count("FileScan") == 1


def test_increment_is_a_plain_comparison(spark):
    orders = table(spark, SF, "orders")
    text = plan(jdbc.increment(orders, orders.filter("o_orderkey < 10"), "o_orderdate"))
    assert "ScalarSubquery" not in text and "PushedFilters: [IsNotNull(o_orderdate), GreaterThan" in text
