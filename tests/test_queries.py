"""Every query against its SQL on DuckDB, the shape of its plan, and the driver's entry points."""

import pytest

import __spark_entry__ as contract
from shipment_checks.catalog import ORACLE, QUERIES
from shipment_checks.compare import connect, difference
from tests.conftest import SF_DIR
from tests.helpers import count_of, plan

MODELS = {"gbt_predictions", "gbt_tuned", "stacked_predictions", "split_counts", "gain_importances", "training_report"}
# A global aggregate ends in one task, after each task has reduced its rows to one; the calendar holds distinct dates.
ONE_TASK = {"dataset_profile": 1, "shipping_calendar": 1}
ROW_PYTHON = ("BatchEvalPython", "ArrowEvalPython")


@pytest.fixture(scope="module")
def sql():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, sql, name):
    df = QUERIES[name](spark, SF_DIR)
    text = plan(df)
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text
    if name != "single_split_predictions":  # the trees themselves are scored by MLlib's own function
        assert not any(node in text for node in ROW_PYTHON)
    assert count_of(text, "Exchange SinglePartition") == ONE_TASK.get(name, 0)
    found = df.toPandas()
    assert difference(found, sql.execute(ORACLE[name]).df()) is None
    assert len(found) > 0


def test_only_models_have_no_sql():
    assert set(QUERIES) - set(ORACLE) == MODELS
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", ["stacked_predictions", "split_counts"])
def test_models_give_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() > 0 and len(df.columns) == len(set(df.columns))
