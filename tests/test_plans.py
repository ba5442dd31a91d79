"""Physical-plan properties the design relies on."""

import re

import __spark_entry__ as entry


def _plan(spark, sf_dir, name):
    df = entry.queries()[name](spark, sf_dir)
    return df._jdf.queryExecution().executedPlan().toString()


def test_poll_predicate_reaches_the_parquet_scan(spark, sf_dir):
    plan = _plan(spark, sf_dir, "table_poll")
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(o_orderstatus,F\)", plan)


def test_column_pruning_on_scan(spark, sf_dir):
    plan = _plan(spark, sf_dir, "metric_instant")
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert "props" not in schema and "event_id" not in schema


def test_latest_sample_is_a_partial_aggregate(spark, sf_dir):
    plan = _plan(spark, sf_dir, "metric_instant")
    assert "partial_max_by" in plan and "Window" not in plan


def test_numbering_stays_in_the_jvm_and_inside_chunks(spark, sf_dir):
    for name in ("seq_size_aggregate", "count_aggregate", "priority_order", "queue_depth", "asof_gate", "late_discard"):
        plan = _plan(spark, sf_dir, name)
        assert "Pandas" not in plan and "Arrow" not in plan, name
        for spec in re.findall(r"row_number\(\) windowspecdefinition\(([^)]*)", plan):
            assert "__chunk" in spec, (name, spec)


def test_numbered_tables_are_pruned(spark, sf_dir):
    for name, unused in (("seq_size_aggregate", "l_comment|l_shipmode"), ("count_aggregate", "props|value"),
                         ("queue_depth", "props|value"), ("attempt_number", "props|value"), ("group_timeout", "props|value")):
        plan = _plan(spark, sf_dir, name)
        assert not re.search(rf"ReadSchema: struct<[^>]*\b({unused})\b", plan), name


def test_both_sides_of_a_claim_come_from_one_join(spark, sf_dir):
    assert len(re.findall("FileScan parquet", _plan(spark, sf_dir, "semi_anti_claim"))) == 2
    assert len(re.findall("FileScan parquet", _plan(spark, sf_dir, "table_diff"))) == 2


def test_a_cluster_needs_a_shared_folder():
    import pytest

    from flowframe.session import require_local_master

    for master in ("local", "local[4]", "local[*]"):
        require_local_master(master)
    for master in ("yarn", "spark://host:7077", "k8s://host", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            require_local_master(master)


def test_no_forced_broadcast_of_data_tables(spark, sf_dir):
    # the keyed upsert's changes grow with the data: the planner decides by size,
    # no broadcast hint is placed on them
    df = entry.queries()["keyed_upsert"](spark, sf_dir)
    assert "broadcast" not in df._jdf.queryExecution().logical().toString().lower()
