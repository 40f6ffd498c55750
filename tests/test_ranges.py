"""Ranges of frames against plain lists, and that frames stay where they are."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sessile.operators import arrow, prune, ranges
from sessile.plans import analysis
from sessile.config import Settings
from sessile.storage import materialize
from test_frames import scene, table


def numbers(rows):
    return sorted((r.run_id, r.frame_no) for r in rows.select("run_id", "frame_no").collect())


def runs(seed):
    """Frame numbers of runs with gaps, starting anywhere, some beyond a block's border."""
    rng = np.random.default_rng(seed)
    out = {}
    for run in "abcd":
        start = int(rng.integers(0, 9000))
        keep = rng.random(200) > (0.05 if run != "d" else 0.5)
        out[run] = [start + k for k in range(200) if keep[k]]
    return out | {"e": [4095, 4096, 4097], "f": [7]}


def plain_prune(frames, skip, found):
    """``frames`` by run without the whole chunks whose ends show nothing."""
    out = {}
    for run, numbers_ in frames.items():
        chunks = [numbers_[k : k + skip] for k in range(0, len(numbers_), skip)]
        out[run] = [n for c in chunks for n in c if len(c) < skip or (run, c[0]) in found or (run, c[-1]) in found]
    return out


def frames_of(spark, frames):
    rows = [(run, n, bytearray(b"0123")) for run, ns in frames.items() for n in ns]
    return spark.createDataFrame(rows, "run_id string, frame_no int, px binary").withColumns({"height": F.lit(2), "width": F.lit(2)}).repartition(5)


def test_stretches_and_places(spark):
    frames = runs(1)
    df = frames_of(spark, frames)
    found = ranges.stretches(df.union(df.limit(20)))
    got = {run: [] for run in frames}
    for r in found.collect():
        got[r.run_id] += range(r.low, r.high + 1)
    assert {run: sorted(ns) for run, ns in got.items()} == frames
    places = {(r.run_id, r.frame_no): (r._n, r._all) for r in ranges.with_places(df, materialize(found, "r")).collect()}
    assert places == {(run, n): (k, len(ns)) for run, ns in frames.items() for k, n in enumerate(ns)}
    assert ranges.stretches(df.limit(0)).collect() == []


@pytest.mark.parametrize("most", [0, 10**6])
def test_ranges_that_are_too_many_are_merged(spark, most):
    df = frames_of(spark, runs(2))
    some = spark.createDataFrame([("a", 0, 20_000, 1), ("e", 4096, 4096, 2)], "run_id string, low long, high long, mark int")
    got = {(r.run_id, r.frame_no, r.mark) for r in ranges.within(df, some, "mark", most=most).collect()}
    assert got == {("a", n, 1) for n in runs(2)["a"]} | {("e", 4096, 2)}
    kept = ranges.within(df, some, "mark", how="left", most=most)
    assert kept.count() == df.count() and kept.filter("mark is null").count() == df.count() - len(got)


@pytest.mark.parametrize("seed", [3, 4])
def test_pruning_and_trimming(spark, seed):
    frames, rng = runs(seed), np.random.default_rng(seed)
    df = frames_of(spark, frames)
    found = {(run, n) for run, ns in frames.items() for n in ns if rng.random() < 0.06}
    expected = plain_prune(plain_prune(frames, 8, found), 3, found)
    marked = df.join(spark.createDataFrame(sorted(found), "run_id string, frame_no int").withColumn("found", F.lit(True)), arrow.KEY, "left").withColumn("found", F.coalesce("found", F.lit(False)))
    assert numbers(prune.coarse_to_fine(marked, (8, 3), ["frame_no"])) == sorted((run, n) for run, ns in expected.items() for n in ns)
    seen = []

    def detect(part):
        seen.append(part.count())
        return part.select("run_id", "frame_no", "found")

    once = plain_prune(frames, 8, found)
    assert numbers(prune.prune_detecting(marked, 8, detect)) == sorted((run, n) for run, ns in once.items() for n in ns)
    assert seen == [2 * sum(len(ns) // 8 for ns in frames.values())]
    moving = marked.withColumns({"x1": F.col("frame_no") % 50, "x2": F.col("frame_no") % 50 + 9})
    both = {run: [n for n in ns if (run, n) in found] for run, ns in frames.items()}
    ends = {run: ([n for n in ns if n % 50 + 9 < 40], [n for n in ns if n % 50 > 5]) for run, ns in both.items()}
    left = sorted((run, n) for run, ns in frames.items() if all(ends[run]) for n in ns if ends[run][0][0] <= n <= ends[run][1][-1])
    assert numbers(prune.trim(moving, ["frame_no"], 40, 5)) == left


def test_frames_are_not_shuffled(spark):
    df = materialize(frames_of(spark, runs(5)), "frames")
    kept = materialize(ranges.stretches(df.select(*arrow.KEY)).filter("run_id < 'd'"), "kept")
    plans = [
        ranges.within(df, kept), ranges.with_places(df, kept), prune.trim(df.withColumns({"found": F.lit(True), "x1": F.lit(99), "x2": F.lit(99)}), ["frame_no"]),
        analysis.of_runs(df, materialize(spark.createDataFrame([("a", False, 0.0, 3)], "run_id string, rejected boolean, angle double, baseline int"), "runs")),
    ]
    for plan in plans:
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text and "Exchange rangepartitioning" not in text, text


def test_pixels_are_read_three_times(spark, monkeypatch):
    cfg = Settings(fps_experiment=10.0, skips=(4, 2), trim_right=600, trim_left=100, mask_high=255, angle_trials=100, height_trials=100)
    raw = materialize(table(spark, {("a", n): scene(90, 250 + 2 * n, 1.0) for n in range(6)}), "raw")
    kernels, real = [], analysis.with_kernel

    def counted(frames, *more, **keep):
        text = frames._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in text and "Exchange rangepartitioning" not in text
        kernels.append(text)
        return real(frames, *more, **keep)

    monkeypatch.setattr(analysis, "with_kernel", counted)
    monkeypatch.setattr("sessile.operators.detect.with_kernel", lambda *a, **k: pytest.fail("another look at the pixels"))
    series, _ = analysis.analysed(raw, cfg)
    assert series.count() == 5 and len(kernels) == 3


def test_neighbours_across_blocks(spark):
    """Each frame with the run's previous and next one, whatever the gaps; pixels go through one exchange."""
    frames = runs(6)
    rows = [(run, n, bytearray(f"{run}{n:05d}".encode()), k % 7 == 0) for run, ns in frames.items() for k, n in enumerate(ns)]
    df = materialize(spark.createDataFrame(rows, "run_id string, frame_no int, px binary, odd boolean").withColumns({"height": F.lit(1), "width": F.lit(6)}).repartition(5), "frames")

    def kernel(row, before, after, odd):
        return None if odd else tuple(None if x is None else bytes(x[0]).decode() for x in (before, row, after))

    def expected(ahead):
        name = lambda run, ns, k: f"{run}{ns[k]:05d}" if 0 <= k < len(ns) else None
        return sorted((run, n, name(run, ns, k - 1), name(run, ns, k), name(run, ns, k + 1) if ahead else None) for run, ns in frames.items() for k, n in enumerate(ns) if k % 7)

    for block, most in ((64, 10**6), (1, 10**6), (3, 0), (10**6, 10**6)):
        out = arrow.with_neighbours(df, kernel, "before string, own string, after string", "odd", keep=arrow.KEY, ahead=True, block=block, most=most)
        assert sorted(map(tuple, out.collect()), key=repr) == sorted(expected(True), key=repr)
    back, plan = (arrow.with_neighbours(df, lambda row, before, after, odd: kernel(row, before, None, odd), "before string, own string, after string", "odd", keep=arrow.KEY) for _ in range(2))
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(expected(False), key=repr)
    assert plan._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
