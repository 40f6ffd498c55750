"""A driver that stops, and one that takes up its work."""

import pytest

from sessile.config import Settings
from sessile.plans import analysis, ledger
from sessile.storage import materialize
from test_frames import scene, table

CFG = Settings(fps_experiment=10.0, skips=(4, 2), trim_right=600, trim_left=100, mask_high=255, angle_trials=100, height_trials=100)


def test_a_stopped_analysis_goes_on_at_its_stage(spark, tmp_path, monkeypatch):
    shots = {("a", n): scene(90, 250 + 2 * n, 1.0) for n in range(5)} | {("b", n): scene(80, 300 + 3 * n) for n in range(5)}
    raw, root = materialize(table(spark, shots), "raw"), str(tmp_path / "state")
    calls, real = [], {n: getattr(analysis, n) for n in ("surfaces", "looked_at", "drop_ranges", "crops_measured")}

    def recorded(name):
        def run(frames, *more, **options):
            calls.append((name, sorted(r.run_id for r in frames.select("run_id").distinct().collect())))
            return real[name](frames, *more, **options)

        return run

    for name in real:
        monkeypatch.setattr(analysis, name, recorded(name))

    def stopped(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(analysis, "drop_ranges", stopped)
    with pytest.raises(KeyboardInterrupt):
        ledger.resumed(raw, root, CFG)
    assert [c for c, _ in calls] == ["surfaces", "looked_at"]
    monkeypatch.setattr(analysis, "drop_ranges", recorded("drop_ranges"))
    calls.clear()
    series, rows = ledger.resumed(raw, root, CFG)
    assert calls == [("drop_ranges", ["a", "b"]), ("crops_measured", ["a", "b"])]
    whole, _ = analysis.analysed(raw, CFG)
    columns = sorted(whole.columns)
    assert sorted(map(tuple, series.select(columns).collect())) == sorted(map(tuple, whole.select(columns).collect()))
    book = {(r.run_id, r.stage, r.attempt, r.status) for r in ledger.Ledger(spark, f"{root}/ledger").rows().collect()}
    assert {x for x in book if x[1] == "used"} == {(r, "used", n, s) for r in "ab" for n, s in ((1, "begun"), (2, "begun"), (2, "done"))}
    # Nothing is left to do; a run that comes later goes through its own stages alone.
    calls.clear()
    assert ledger.resumed(raw, root, CFG)[1].count() == rows.count() and calls == []
    more = materialize(table(spark, shots | {("c", n): scene(100, 260 + 2 * n) for n in range(5)}), "raw")
    again = ledger.resumed(more, root, CFG)[1]
    assert [c for _, c in calls] == [["c"]] * 4 and {r.run_id for r in again.select("run_id").distinct().collect()} == {"a", "b", "c"}


def test_half_a_write_is_replaced(spark, tmp_path):
    """Rows that an attempt wrote before it failed aren't there twice."""
    runs, root, tries = spark.createDataFrame([("a",), ("b",)], "run_id string"), str(tmp_path / "s"), []

    def stage(t):
        tries.append(1)
        rows = t["raw"].selectExpr("run_id", f"{len(tries)} as v")
        if len(tries) == 1:
            rows.filter("run_id = 'a'").write.mode("overwrite").partitionBy("run_id").parquet(f"{root}/one")
            raise RuntimeError
        return rows

    with pytest.raises(RuntimeError):
        ledger.staged({"raw": runs}, runs, [("one", stage)], root)
    out = ledger.staged({"raw": runs}, runs, [("one", stage)], root)["one"]
    assert sorted(map(tuple, out.select("run_id", "v").collect())) == [("a", 2), ("b", 2)]
