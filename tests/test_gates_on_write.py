"""Gates audited on the one staged write of a batch."""

import json
from datetime import datetime

import pytest

from martworks.operators.quality import DataQualityError
from martworks.operators.transform import SchemaError
from martworks.plans import jobs
from martworks.sinks import merge_writers

AS_OF = datetime(2025, 2, 1, 6)
GOOD = [
    {"search_id": f"s{i}", "user_id": "u", "query": "q" * i, "timestamp": "2025-02-01T10:00:00Z"}
    for i in range(5)
]


def _load(spark, tmp_path, docs, target="t"):
    path = tmp_path / "searches.jsonl"
    path.write_text("".join(json.dumps(d) + "\n" for d in docs))
    raw = jobs.read_collections(spark, {"search_queries": str(path)})
    return jobs.replicate_collections_into(
        spark, raw, {"search_queries": str(tmp_path / target)}, AS_OF
    )


def _stored(spark, tmp_path, target="t"):
    return sorted(r["search_id"] for r in spark.read.parquet(str(tmp_path / target)).collect())


def test_a_failed_gate_leaves_the_target(spark, tmp_path):
    counts = _load(spark, tmp_path, GOOD[:3])
    assert counts["search_queries"]["inserted"] == 3
    for bad, error in (({"search_id": None}, DataQualityError), ({"search_id": "x", "odd": 1}, SchemaError)):
        with pytest.raises(error):
            _load(spark, tmp_path, [*GOOD, bad])
        assert _stored(spark, tmp_path) == ["s0", "s1", "s2"]
    _load(spark, tmp_path, GOOD)
    assert _stored(spark, tmp_path) == [f"s{i}" for i in range(5)]


def test_the_export_is_parsed_once(spark, tmp_path, monkeypatch):
    """The only plan that holds the parse is that of the staged batch; no pass before it."""
    plans = []
    table = merge_writers.Staging.table

    def staged(self, df, name):
        out = table(self, df, name)
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return out

    def no_pass(*_):
        raise AssertionError("the gates have a pass of their own")

    monkeypatch.setattr(merge_writers.Staging, "table", staged)
    monkeypatch.setattr(jobs, "_gate", no_pass)
    _load(spark, tmp_path, GOOD)
    assert [name for name, _ in plans] == ["reload-day"]
    assert plans[0][1].count("Scan text") == 1 and "CollectMetrics" in plans[0][1]


def test_an_empty_export_changes_nothing(spark, tmp_path):
    _load(spark, tmp_path, GOOD)
    _load(spark, tmp_path, [])
    assert _stored(spark, tmp_path) == [f"s{i}" for i in range(5)]
