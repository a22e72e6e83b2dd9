"""Queries over the largest tables deal their rows to as many tasks as the rows ask for."""

import pytest

from lodestack.plans import registry


@pytest.mark.parametrize("name", ["package_completeness", "replacement_credit"])
def test_tasks_grow_in_number_not_in_size(spark, sf_dir, monkeypatch, name):
    monkeypatch.setattr(registry, "TASK_ROWS", 1000)
    plan = registry.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    n = registry.table(spark, sf_dir, "lineitem").count() // 1000
    assert "REPARTITION_BY_NUM" in plan and n >= 5 and "Broadcast" not in plan
