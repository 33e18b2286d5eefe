"""Plan guard: no job that any catalogue query runs — including the internal jobs of the
iterative operators — may plan a nested-loop join or a Cartesian product, and the
final plans must read only the columns they use."""

from __future__ import annotations

import contextlib
import io
import os

import pytest
from pyspark.sql.classic.dataframe import DataFrame

from dispersa.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("NestedLoopJoin", "CartesianProduct")


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_no_query_plans_a_cross_join(spark, monkeypatch):
    seen: list[tuple[str, str]] = []
    current = {"key": ""}
    for name in ("collect", "count"):
        orig = getattr(DataFrame, name)

        def spy(self, *a, _orig=orig, **kw):
            seen.append((current["key"], _plan(self)))
            return _orig(self, *a, **kw)

        monkeypatch.setattr(DataFrame, name, spy)
    for key, fn in QUERIES.items():
        current["key"] = key
        df = fn(spark, SF)
        seen.append((key, _plan(df)))
        df.collect()
    bad = sorted({key for key, plan in seen if any(f in plan for f in FORBIDDEN)})
    assert not bad, f"cross-join style plans in: {bad}"
    assert len({k for k, _ in seen}) == len(QUERIES)


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_scans_are_pruned(spark):
    plans = {key: _plan(fn(spark, SF)) for key, fn in QUERIES.items()
             if key in ("word_count", "class_count_modulo", "sampled_diameter")}
    assert "ReadSchema: struct<text:string>" in plans["word_count"]
    assert "ReadSchema: struct<event_id:bigint,event_type:string>" in plans["class_count_modulo"]
    assert "ReadSchema: struct<vec_id:bigint,embedding:array<float>>" in plans["sampled_diameter"]
