"""Gazetteer spans of the registered queries: how they meet the gazetteer, and that E2 reads them written."""

from slotloom.plans.catalog import inputs

FOLDER = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_measured_gazetteer_is_broadcast_and_meets_names_only(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(inputs.spans(spark, FOLDER))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert inputs.NAME in plan


def test_document_entities_are_made_once(spark):
    plan = _plan(inputs.document_entities(spark, FOLDER))
    assert "Join" not in plan and "Exchange" not in plan
