"""Numbered commits and metrics of micro-batches, each exactly once."""

from __future__ import annotations

import os
import signal
import subprocess
import sys
import textwrap
import time
from concurrent.futures import ThreadPoolExecutor
from types import SimpleNamespace

import pytest
import rows

from wellops.plans.registry import Registry
from wellops.sinks import commits, datasets
from wellops.sinks.landing import land_csv, land_json
from wellops.streaming import metrics
from wellops.streaming import pipeline as streaming

AS_OF = "2024-01-29"
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_a_number_is_taken_once(spark, layout):
    folder = f"{layout.root}/c"
    assert commits.newest(spark, folder) == -1 and commits.versions(spark, folder) == []
    assert commits.commit_at(spark, folder, 0, {"a": "é"})
    assert not commits.commit_at(spark, folder, 0, {"a": "other"})
    assert commits.read(spark, folder, 0) == {"a": "é", "version": 0}
    assert commits.commit_at(spark, folder, 2500, {})
    assert commits.commit_next(spark, folder, {}) == 2501
    assert commits.versions(spark, folder) == [0, 2500, 2501]


def test_concurrent_writers_get_a_version_each(spark, layout):
    def write(k):
        return datasets.publish(spark, layout, "gold_x", spark.range(k + 1))

    with ThreadPoolExecutor(8) as pool:
        list(pool.map(write, range(8)))
    history = datasets.history(spark, layout).collect()
    assert sorted(r["version"] for r in history) == list(range(8))
    assert sorted(int(r["operation_metrics"]["kept"]) for r in history) == list(range(1, 9))
    last = max(history, key=lambda r: r["version"])
    assert datasets.read(spark, layout, "gold_x").count() == int(last["operation_metrics"]["kept"])


def test_concurrent_registration(spark, layout):
    registry = Registry(spark, layout)
    runs = [registry.log_run("r", {}, {"mae": float(k)}) for k in range(2)]
    with ThreadPoolExecutor(8) as pool:
        versions = list(pool.map(lambda k: registry.register("m", runs[k % 2]), range(8)))
        assert sorted(versions) == list(range(1, 9))
        list(pool.map(lambda v: registry.set_alias("m", "champion", v), versions))
    seqs = [r["seq"] for r in registry.table("model_aliases").collect()]
    assert sorted(seqs) == list(range(1, 9))
    assert registry.register("other/name", runs[0]) == 1


def _land(spark, layout, n):
    for k in range(n):
        changes = [{"well_id": 10 * k + j, "oil_bbl": -1 if j == 0 else 5} for j in range(k + 1)]
        land_csv(rows.readings(spark, *changes).coalesce(1), layout.landing("production_csv"), mode="append")


def _recorded(spark, layout, name):
    return sorted((r["version"], r["operation_metrics"]["rows"]) for r in datasets.history(spark, layout).filter(f"dataset = '{name}'").collect())


def test_batches_without_metrics_are_run_again(spark, layout):
    """As after a lost driver: batches are committed, their records are not there. Rules and state count as they did."""
    _land(spark, layout, 3)
    for k in range(3):
        land_csv(rows.wells(spark, {"well_id": k, "sap_code": f"c{k % 2}"}).coalesce(1), layout.landing("wells_csv"), mode="append")
    names = ["bronze_production", "silver_production", "bronze_wells", "silver_wells"]
    streaming.run_available(spark, layout, names, as_of=AS_OF, options={"maxFilesPerTrigger": "1"})
    before = {(r["dataset"], r["version"]): (r["operation_metrics"], r["writer"]) for r in datasets.history(spark, layout).collect()}
    assert len({w for _, w in before.values()}) == 4
    lost = [("bronze_production", 1), ("silver_production", 0), ("silver_wells", 0)]
    for name, version in lost:
        os.unlink(commits._file(layout.history(name), version))
    for name in names:
        again = metrics.reconcile(spark, layout, name, lambda name=name: streaming.build(spark, layout, name, as_of=AS_OF))
        assert again == [v for n, v in lost if n == name]
    after = {(r["dataset"], r["version"]): (r["operation_metrics"], r["writer"]) for r in datasets.history(spark, layout).collect()}
    assert after == before
    streaming.run_available(spark, layout, names, as_of=AS_OF)
    assert datasets.read(spark, layout, "bronze_production").count() == 6


def test_reports_of_idle_triggers_are_no_batches(spark, layout):
    land_json(rows.orders(spark, {}), layout.landing("orders_json"))
    _run = streaming.start(spark, layout, "bronze_orders")
    _run.awaitTermination()
    recorder, name = metrics.Recorder(), f"bronze_orders@{layout.root}"
    seen = SimpleNamespace(asDict=lambda: {"rows": 1})
    for batch, observed in ((1, {}), (1, None), (1, {metrics.METRICS: seen}), (1, {metrics.METRICS: seen})):
        recorder.onQueryProgress(SimpleNamespace(progress=SimpleNamespace(name=name, batchId=batch, observedMetrics=observed)))
    streaming.record(spark, layout, "bronze_orders")
    assert _recorded(spark, layout, "bronze_orders") == [(0, "1"), (1, "1")]


def test_a_batch_whose_offsets_are_gone_is_an_error(spark, layout):
    _land(spark, layout, 1)
    streaming.run_available(spark, layout, ["bronze_production"])
    os.unlink(commits._file(layout.history("bronze_production"), 0))
    os.unlink(f"{layout.checkpoint('bronze_production')}/offsets/0")
    with pytest.raises(RuntimeError, match="offsets"):
        streaming.record(spark, layout, "bronze_production")


def test_driver_killed_between_batches(spark, layout):
    """A driver of its own is killed while it works; the next one finds every batch once in table and history."""
    _land(spark, layout, 8)
    script = textwrap.dedent(f"""
        import sys
        sys.path.insert(0, {ROOT!r})
        from wellops.session import build_session
        from wellops.sinks.layout import Layout
        from wellops.streaming import pipeline as streaming
        spark = build_session("killed", master="local[2]", shuffle_partitions=2)
        spark.sparkContext.setLogLevel("OFF")
        streaming.run_available(spark, Layout({layout.root!r}), ["bronze_production"], options={{"maxFilesPerTrigger": "1"}})
    """)
    driver = subprocess.Popen([sys.executable, "-c", script], start_new_session=True, stdout=subprocess.DEVNULL, stderr=subprocess.DEVNULL)
    commits_of = f"{layout.checkpoint('bronze_production')}/commits"
    end = time.monotonic() + 90
    while time.monotonic() < end and driver.poll() is None and not os.path.exists(f"{commits_of}/2"):
        time.sleep(0.01)
    os.killpg(driver.pid, signal.SIGKILL)
    driver.wait()
    assert os.path.exists(f"{commits_of}/2")
    streaming.run_available(spark, layout, ["bronze_production"], options={"maxFilesPerTrigger": "1"})
    found = _recorded(spark, layout, "bronze_production")
    assert [v for v, _ in found] == list(range(8))
    assert sorted(int(n) for _, n in found) == list(range(1, 9))
    assert datasets.read(spark, layout, "bronze_production").count() == 36
