"""Every registered query against its SQL twin on the smallest tables."""

import pytest

import __spark_entry__ as entry_points
from compare import compare

SF_DIR = "/root/testdata/sf0.001"
SLOW = {"tstr_gbt", "tuned_gbt", "ablation", "credit_training", "learning_curve", "early_stopping", "tree_attribution", "attribution_sample", "monotone_scorecard"}
SQLS = entry_points.oracle_sql()


@pytest.mark.parametrize("name", sorted(set(entry_points.queries()) - SLOW))
def test_query_equals_sql(spark, name):
    text, _, good = compare(spark, SF_DIR, name, entry_points.queries()[name], SQLS.get(name))
    assert good, text


def test_every_twin_has_a_query():
    assert set(SQLS) <= set(entry_points.queries())


def test_entry(spark):
    result = entry_points.entry(spark)
    assert result.columns == ["feature", "iv", "interpretation", "iv_rank"]
    assert result.count() == 6
