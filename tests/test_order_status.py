"""The rows that the order-status model is fitted on come from one checkpoint."""

import pytest

from ledgerlens import registry  # noqa: F401 - first: it loads the others
from ledgerlens import registry_models


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_order_status_rows_are_made_once(spark, monkeypatch):
    seen = []

    def stop(df, *a):
        seen.append(plan(df))
        raise KeyError("seen")
    monkeypatch.setattr(registry_models, "bounded", stop)
    monkeypatch.setattr(registry_models, "_FITTED", {})
    with pytest.raises(KeyError):
        registry_models._order_status_model(spark, "/root/testdata/sf0.001")
    assert "Join" not in seen[0] and "ExistingRDD" in seen[0]
