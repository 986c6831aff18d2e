"""Physical-plan properties: pushdown, pruning, no Python, hash aggregation, join choices."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from paths import SF_SMALL
from ledgerlens import fixture as fx
from ledgerlens.operators import group_lookup, member_filter
from ledgerlens.plans import afo01_supplier_advances, bin02_split_notes, car04_individual_billing
from ledgerlens.sources import testdata_view as derived_view


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


REFERENCE = [k for k in entry.queries() if not re.match(r"op\d+_|pipeline$", k)]


@pytest.mark.parametrize("name", REFERENCE)
def test_no_python_in_any_plan(spark, name):
    plan = _plan(entry.queries()[name](spark, SF_SMALL))
    assert not re.search(r"BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas|PythonUDF", plan)


def test_date_scope_reaches_parquet_scan(spark):
    view = derived_view(spark, SF_SMALL, "supplier_transactions")
    plan = _plan(afo01_supplier_advances(view, **fx.PARAMS["afo01_supplier_advances"]))
    assert re.search(r"PushedFilters: \[[^\]]*LessThan\(l_shipdate,1999-01-01", plan)


def test_afo01_aggregates_raw_rows_by_hash(spark):
    view = derived_view(spark, SF_SMALL, "supplier_transactions")
    df = afo01_supplier_advances(view, **fx.PARAMS["afo01_supplier_advances"], ordered=False)
    plan = df._jdf.queryExecution().sparkPlan().toString()
    # The aggregate right above the scan/join is a hash aggregate; string MAX runs after it.
    aggs = re.findall(r"(HashAggregate|SortAggregate|ObjectHashAggregate)\(", plan)
    assert aggs[-1] == "HashAggregate" and aggs[-2] == "HashAggregate"


def test_column_pruning_reads_only_needed_columns(spark):
    view = derived_view(spark, SF_SMALL, "sales_orders")
    plan = _plan(car04_individual_billing(view, **fx.PARAMS["car04_individual_billing"]))
    li = re.search(r"lineitem.parquet\].*?ReadSchema: struct<([^>]*)>", plan, re.S)
    assert li and "l_tax" not in li.group(1) and "l_discount" not in li.group(1)


def test_group_lookup_dict_has_no_join(spark):
    df = spark.createDataFrame([("R351",), ("R999",)], "cod_estabelecimento string")
    out = group_lookup(df, "cod_estabelecimento", {"AVANÇAR": ["R351"]}, default="CADASTRAR")
    assert "Join" not in _plan(out)
    assert [r.grupo for r in out.collect()] == ["AVANÇAR", "CADASTRAR"]


def test_group_lookup_dataframe_is_joined_as_the_planner_chooses(spark):
    df = spark.createDataFrame([("R351",), ("R999",)], "cod_estabelecimento string")
    dim = spark.createDataFrame([("R351", "AVANÇAR"), ("R351", "AVANÇAR")], "cod_estabelecimento string, grupo string")
    out = group_lookup(df, "cod_estabelecimento", dim, default="CADASTRAR")
    assert sorted((r.cod_estabelecimento, r.grupo) for r in out.collect()) == [
        ("R351", "AVANÇAR"), ("R999", "CADASTRAR")]
    assert "ResolvedHint" not in out._jdf.queryExecution().analyzed().toString()


def _shape(df) -> list[str]:
    """Operator names of the initial plan, without join strategies (those follow measured bytes)."""
    names = re.findall(r"[-+:* ]*([A-Z][A-Za-z]+)", df._jdf.queryExecution().optimizedPlan().toString())
    return [n for n in names if n in ("Join", "Aggregate", "RepartitionByExpression", "Repartition", "Relation",
                                      "Window", "Sort", "Union", "Filter", "ResolvedHint")]


@pytest.mark.parametrize("name", ["bin06_no_finance_moves", "bin01_note_detail", "rec07_weekend_holiday_billing"])
def test_same_plan_at_every_size(spark, name):
    small, large = (entry.queries()[name](spark, f"/root/testdata/{sf}") for sf in ("sf0.001", "sf0.1"))
    assert _shape(small) == _shape(large)
    assert "Repartition " not in large._jdf.queryExecution().optimizedPlan().toString()


def test_no_job_runs_while_a_check_is_planned(spark):
    sc = spark.sparkContext
    sc.setJobGroup("planning", "planning")
    try:
        for name in ("bin01_note_detail", "car04_individual_billing", "group_lookup", "semi_join_back"):
            entry.queries()[name](spark, SF_SMALL)
        # reading a Parquet table's schema is a job of its own; nothing else may run
        jobs = sc.statusTracker().getJobIdsForGroup("planning")
        stages = [s for j in jobs for s in sc.statusTracker().getJobInfo(j).stageIds]
        assert len(stages) == len(jobs)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_long_keys_keep_all_their_digits(spark):
    from ledgerlens.sources.testdata import _code, _tax_id

    keys = [123_456, 1_234_567, 999, 1_000, 1_999, 2_000_000]
    rows = spark.createDataFrame([(k, 5) for k in keys], "k long, n int").select(
        _code("C", "k").alias("code"), _tax_id(F.col("k"), "n").alias("tax")).collect()
    assert [r.code for r in rows] == ["C123456", "C1234567", "C000999", "C001000", "C001999", "C2000000"]
    assert len({r.tax for r in rows}) == len(keys)


def test_member_filter_table_is_semi_join(spark):
    df = spark.createDataFrame([("5.102",), ("5.949",)], "cfop string")
    cfops = spark.createDataFrame([("5.102",)], "cfop string")
    out = member_filter(df, "cfop", cfops)
    assert "LeftSemi" in _plan(out) and [r.cfop for r in out.collect()] == ["5.102"]


def _run_plan(df):
    """The adaptive plan after a run."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_counts_read_and_exchange_the_rows_once(spark):
    """Each base table is scanned once; the second reader of the rows' exchange reuses it."""
    view = derived_view(spark, SF_SMALL, "closed_transactions")
    plan = _run_plan(bin02_split_notes(view, **fx.PARAMS["bin02_split_notes"], ordered=False))
    assert plan.count("FileScan parquet") == 3 and "ReusedExchange" in plan
    plan = _run_plan(entry.queries()["car10_multiple_advances"](spark, SF_SMALL))
    assert plan.count("FileScan parquet") == 2 and "ReusedExchange" in plan


def test_hot_key_is_counted_by_many_tasks(spark):
    from pyspark.sql import Window

    from ledgerlens.operators import count_over, count_rows_over

    df = spark.range(40_000).select(
        F.when(F.col("id") % 3 != 0, F.lit(0)).when(F.col("id") % 7 == 0, F.lit(None)).otherwise(
            F.col("id") % 500).alias("k"), F.when(F.col("id") % 5 > 0, F.col("id")).alias("v"))
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        out = count_over(df, "k", "v", name="n")
        tasks = out.filter("k = 0").select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
        assert len(tasks) > 4 and max(t["count"] for t in tasks) < 26_667 / 2
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    by = Window.partitionBy("k")
    assert sorted(map(tuple, out.collect()), key=str) == sorted(
        map(tuple, df.withColumn("n", F.count("v").over(by)).collect()), key=str)
    got = count_rows_over(df, "k", name="n", more_than=30, salts=8)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        map(tuple, df.withColumn("n", F.count(F.lit(1)).over(by)).filter("n > 30").collect()), key=str)


def test_semi_join_filters_the_detail_before_its_shuffle(spark):
    from ledgerlens.operators import semi_join_back

    detail = spark.range(5000).select((F.col("id") % 700).alias("k"), F.col("id").alias("v"))
    keys = spark.range(40).select(F.when(F.col("id") > 2, F.col("id")).alias("k"))
    out = semi_join_back(detail, keys, "k")
    plan = _plan(out)
    assert plan.count("LeftSemi") == 2 and "__bucket" in plan
    assert sorted(r.k for r in out.collect()) == sorted(k % 700 for k in range(5000) if 2 < k % 700 < 40)
    few = semi_join_back(detail, keys, "k", buckets=2)  # a full filter lets all through; the join is exact
    assert few.count() == out.count()
    plan = _run_plan(entry.queries()["bin01_note_detail"](spark, SF_SMALL))
    assert plan.count("FileScan parquet") <= 6 and "ReusedExchange" in plan


def test_suite_writes_only_the_columns_that_count(spark):
    from ledgerlens.plans import suite

    views = entry._views(spark, SF_SMALL)
    shared = suite.share_views(list(fx.PARAMS), views, fx.PARAMS)
    for name, df in shared.items():
        readers = [c for c in suite.CATALOG.values() if c.view == name]
        assert df.columns == views[name].columns
        if len(readers) > 1:
            stored = re.search(r"Relation \[(.*?)\]", df._jdf.queryExecution().optimizedPlan().toString()).group(1)
            assert {c.split("#")[0] for c in stored.split(",")} == {c for r in readers for c in r.needs}
    got = {r.check: r.rows_found for r in suite.audit_suite(list(fx.PARAMS), views, fx.PARAMS).collect()}
    alone = {k: entry.queries()[k](spark, SF_SMALL).count() for k in fx.PARAMS}
    assert got == alone


def test_count_over_hot_key_without_broadcasts(spark):
    """One key holds two thirds of the rows: salted, they are many tasks' (the window it replaces
    could not be split), with no broadcast either, and the counts still equal the window function's."""
    from pyspark.sql import Window

    from ledgerlens.operators import count_over

    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1024",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4096",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = spark.range(120_000).select(
            F.when(F.col("id") % 3 != 0, F.lit(0)).otherwise(F.col("id") % 500).alias("k"), F.col("id").alias("v"))
        out = count_over(df, "k", "v", name="n")
        got = sorted(tuple(r) for r in out.collect())
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Window" in plan and plan.split("== Initial Plan ==")[0].count("ReusedExchange") == 1
        want = sorted(tuple(r) for r in df.withColumn("n", F.count("v").over(Window.partitionBy("k"))).collect())
        assert got == want
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_positions_of_the_ordered_output_need_no_window_over_all_rows(spark):
    rows = entry.q_ordered_output(spark, SF_SMALL)
    plan = _plan(rows)
    assert not re.search(r"row_number\(\)", plan)
    found = sorted((r.posicao, r.valor_aberto) for r in rows.collect())
    values = sorted((v for _, v in found), reverse=True)
    assert found == sorted((values.index(v) + 1, v) for v in values)
