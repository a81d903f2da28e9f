"""Every registered question next to its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.compare import connect, difference
from tests.conftest import plan

SF = "/root/testdata/sf0.001"
SLOW = {"forecast_metrics", "engagement_model_metrics", "engagement_baselines"}


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["day_of_week", "hour_of_day", "post_count"] and df.count() > 0


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_as_sql(spark, duck, name):
    assert difference(entry.queries()[name](spark, SF), duck, entry.oracle_sql()[name]) is None


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql()) - SLOW))
def test_runs(spark, name):
    assert entry.queries()[name](spark, SF).count() > 0


@pytest.mark.parametrize("name", ["emotion_density_matched", "stemmed_text", "style_features", "lexical_features"])
def test_text_questions_stay_out_of_python(spark, name):
    assert "Python" not in plan(entry.queries()[name](spark, SF))


def test_narrow_scan(spark):
    shown = plan(entry.queries()["weekday_hour_counts"](spark, SF))
    assert "ReadSchema: struct<ts:timestamp_ntz>" in shown
