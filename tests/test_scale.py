"""Plans have the shape they are meant to have, and hot keys do not change results."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from tallybook.catalog import queries
from tallybook.functions.dates import in_days
from tallybook.operators import latest, match
from tallybook.operators.rules import LEDGER_RULES
from tallybook.operators.summary import match_summary

NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1"}


@pytest.fixture
def conf(spark):
    changed = {}

    def set_conf(**values):
        for key, value in values.items():
            changed.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield set_conf
    for key, value in changed.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def hot(spark, n, key, value):
    """``n`` rows; every third has the same key."""
    k = F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("K"), F.col("id")))
    return spark.range(n).select(k.alias(key), F.col("id").alias(value))


@pytest.mark.parametrize("kind", ["inner", "anti", "flag"])
def test_hot_key_join_is_split(spark, conf, kind):
    conf(
        **NO_BROADCAST,
        **{
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "500kb",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "500kb",
            "spark.sql.shuffle.partitions": "12",
        },
    )
    # the payload keeps the hot partition from being compressed away
    left = hot(spark, 300_000, "k", "id").withColumn("a", F.sha2(F.col("id").cast("string"), 256))
    right = spark.range(999).select(F.concat(F.lit("K"), F.col("id")).alias("r"))
    if kind == "anti":
        df, n = match.missing_from(left, right, "k", "r"), 300_000 - 666
    else:
        right = right.unionByName(spark.range(1).select(F.lit("HOT").alias("r")))
        if kind == "inner":
            df, n = match.inner_match(left, right, "k", "r"), 100_000 + 666
        else:
            df, n = match.flag_present(left, right, "k", "r", "HIT"), 300_000
    ran = df.agg(F.count("*"), F.max("a"))
    assert ran.collect()[0][0] == n
    assert "skew=true" in plan(ran)


def test_hot_parent_is_split(spark, conf):
    from tallybook.plans.ledger_commission import children

    conf(
        **NO_BROADCAST,
        **{
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "500kb",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "500kb",
            "spark.sql.shuffle.partitions": "12",
        },
    )
    ids = spark.range(999).select(F.concat(F.lit("K"), F.col("id")).alias("LDG_TID"))
    ids = ids.unionByName(spark.range(1).select(F.lit("HOT").alias("LDG_TID")))
    statement = ids.withColumnRenamed("LDG_TID", "STMT_TID")
    parents = match.inner_match(ids, statement, "LDG_TID", "STMT_TID", match.exact)
    parents = parents.withColumn("COMM_AMT", F.lit(0))
    rows = hot(spark, 300_000, "PARENT_TID", "id").select(
        F.sha2(F.col("id").cast("string"), 256).alias("LDG_TID"), "PARENT_TID", F.col("id").alias("COMM_AMT")
    )
    ran = children(parents, rows).agg(F.count("*"), F.max("COMMISSION_TID"))
    assert ran.collect()[0][0] == 100_666
    assert "skew=true" in plan(ran)


def test_summary_shuffles_each_side_once(spark, source, conf):
    conf(**NO_BROADCAST)
    hub = spark.range(1000).selectExpr(
        "concat('K', id) VENDOR_REFERENCE", "'success' IHUB_MASTER_STATUS", "'Yes' IHUB_LEDGER_STATUS"
    )
    vendor = spark.range(1000).selectExpr("concat('K', id) REFID", "'success' VENDOR_STATUS")
    text = plan(match_summary(hub, vendor, LEDGER_RULES))
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 2
    # both sides are reduced before they are shuffled
    assert text.count("partial_count") >= 2


def test_summary_is_exact_for_hot_keys(spark):
    hub = hot(spark, 3000, "VENDOR_REFERENCE", "id").select(
        "VENDOR_REFERENCE",
        F.when(F.col("id") % 2 == 0, "success").otherwise("failed").alias("IHUB_MASTER_STATUS"),
        F.lit("Yes").alias("IHUB_LEDGER_STATUS"),
    )
    vendor = hot(spark, 3000, "REFID", "id").select("REFID", F.lit("success").alias("VENDOR_STATUS"))
    got = {r["metric"]: r["value"] for r in match_summary(hub, vendor, LEDGER_RULES).collect()}
    assert got["matched"] == 1000 * 1000 + 2000
    assert got["VEND_IHUB_SUC"] == 500 * 1000 + 1000
    assert got["VEND_SUC_IHUB_FAIL"] == 500 * 1000 + 1000


def test_match_and_missing_rows_share_the_shuffle(spark, conf):
    from tallybook.plans.hub_recon import buckets
    from tallybook.sources.staging import staged

    conf(**NO_BROADCAST)
    hub = staged(
        hot(spark, 3000, "VENDOR_REFERENCE", "IHUB_REFERENCE").selectExpr(
            "*", "'success' IHUB_MASTER_STATUS", "'Yes' IHUB_LEDGER_STATUS"
        )
    )
    vendor = staged(spark.range(500).selectExpr("concat('K', id) REFID", "'success' VENDOR_STATUS"))
    columns = [
        "IHUB_REFERENCE", "REFID", "IHUB_MASTER_STATUS", "IHUB_LEDGER_STATUS", "VENDOR_STATUS",
    ]
    ran = buckets(hub, vendor, columns)
    assert rows_of(ran.groupBy("CATEGORY").count()) == [("NOT_IN_PORTAL", 167), ("NOT_IN_VENDOR", 2667), ("VEND_IHUB_SUC", 333)]
    ran.collect()
    assert plan(ran).split("Initial Plan")[0].count("ReusedExchange") >= 2


def test_one_row_per_key_is_reduced_before_the_shuffle(spark):
    text = plan(latest.keep_first(hot(spark, 1000, "k", "v"), "k", "v"))
    assert "partial_min_by" in text
    assert "Window" not in text


def test_window_reaches_the_scan(source):
    rows = source["orders"].where(in_days("o_orderdate", "1996-01-01", "1997-01-01")).select("o_orderkey")
    text = plan(rows)
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in text


def test_flag_chain_shuffles_the_left_side_once(spark, source, conf):
    conf(**NO_BROADCAST)
    rows = source["master"].select("Id", "TransactionRefNum")
    for ledger, name in (("hub_ledger", "A"), ("tenant_ledger", "B")):
        rows = match.flag_present(rows, source[ledger], "TransactionRefNum", "IHubReferenceId", name)
    text = plan(rows)
    assert text.count("Exchange hashpartitioning(TransactionRefNum") == 1
    # each key set is shuffled to be reduced and again, reduced, to be joined
    assert text.count("Exchange hashpartitioning") == 5


@pytest.mark.parametrize("name", ["recon_rows", "upi_buckets", "settlement_reconcile", "up_buckets_sultanpursca"])
def test_no_cross_product_and_no_python(spark, sf_dir, name):
    text = plan(queries()[name](spark, sf_dir))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert word not in text


def test_results_do_not_depend_on_partitions(spark, sf_dir, conf):
    want = rows_of(queries()["recon_buckets"](spark, sf_dir))
    conf(**NO_BROADCAST, **{"spark.sql.shuffle.partitions": "37", "spark.sql.adaptive.enabled": "false"})
    assert rows_of(queries()["recon_buckets"](spark, sf_dir)) == want


def test_wallet_flags_are_hashed(spark, sf_dir):
    """Flags are folded as booleans; only the largest text reference still sorts (two steps)."""
    for name, sorts in (("wallet_group_three_keys", 0), ("wallet_flags_two_link", 2)):
        text = queries()[name](spark, sf_dir)._jdf.queryExecution().sparkPlan().toString()
        assert text.count("SortAggregate") == sorts
        assert "HashAggregate" in text
