"""The build of derived tables: concurrent, written aside, resumable, and equal to the queries."""
import os

import pytest

import __spark_entry__ as E
from chartwise.plans import registry
from chartwise.plans.registry import Context, build, dependencies
from chartwise.sources import Sources

from .conftest import SF_SMALL
from .helpers import table_rows

TARGETS = ["kdigo_stages", "sofa", "first_day_lab"]


def stamps(sink):
    return {n: os.stat(f"{sink}/{n}/_SUCCESS").st_mtime_ns for n in os.listdir(sink) if not n.startswith("_")}


def test_build_writes_every_node_with_the_rows_of_its_query(spark, tmp_path):
    src = Sources.from_events(spark, SF_SMALL)
    out = build(src, TARGETS, sink=f"file://{tmp_path}", workers=4)
    assert set(out) == set(dependencies(TARGETS)) == set(stamps(tmp_path))
    assert not [n for n in os.listdir(tmp_path) if n.startswith("_")]
    queries = E.queries()
    for name in [*TARGETS, "weight_durations", "bg", "ventilation"]:
        assert table_rows(E._normalize(out[name]).toPandas()) == table_rows(queries[name](spark, SF_SMALL).toPandas()), name


def test_a_broken_build_goes_on_where_it_stopped(spark, tmp_path, monkeypatch):
    src, sink = Sources.from_events(spark, SF_SMALL), f"file://{tmp_path}"
    registry._load_all()
    whole = registry.REGISTRY["kdigo_stages"]

    def lost(icustays, kdigo_creatinine, kdigo_uo, crrt):
        raise RuntimeError("lost")
    monkeypatch.setitem(registry.REGISTRY, "kdigo_stages", registry.ConceptDef(whole.name, lost, whole.inputs, whole.group))
    with pytest.raises(RuntimeError, match="lost"):
        build(src, ["kdigo_stages"], sink=sink, resume="monday")
    before = stamps(tmp_path)
    assert set(before) == set(dependencies(["kdigo_stages"])) - {"kdigo_stages"}
    monkeypatch.setitem(registry.REGISTRY, "kdigo_stages", whole)
    out = build(src, ["kdigo_stages"], sink=sink, resume="monday")
    after = stamps(tmp_path)
    assert {n for n in after if after[n] != before.get(n)} == {"kdigo_stages"}       # one node was written, none again
    assert out["kdigo_stages"].count() == Context(src).table("kdigo_stages").count()
    build(src, ["kdigo_creatinine"], sink=sink, resume="tuesday")
    assert {n for n, t in stamps(tmp_path).items() if t != after[n]} == {"kdigo_creatinine"}       # another run derives its nodes anew


def test_build_without_a_sink_checkpoints_shared_nodes(spark):
    out = build(Sources.from_events(spark, SF_SMALL), ["vitalsign", "first_day_vitalsign"])
    assert set(out) == {"vitalsign", "first_day_vitalsign"}
    assert "ExistingRDD" in out["vitalsign"]._jdf.queryExecution().executedPlan().toString()
