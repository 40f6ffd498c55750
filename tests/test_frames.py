"""Kernels against plain loops; drops of known shape; files; streams."""

import math
import os
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sessile.config import Settings, load_settings
from sessile.functions import kernels
from sessile.functions import network
from sessile.functions.columns import fit_window, middle_angle
from sessile.operators import arrow, centers, detect, edges, fit, images, prune, scan
from sessile.operators.detect import left_step, right_step
from sessile.plans import sinks
from sessile.plans.analysis import analysed, levelled_runs
from sessile.plans.ingest import ingested
from sessile.sources import files
from sessile.streaming.fold import found_per_window, stream_bounds


def cap(theta, radius=30, height=70, width=120, x=60, bright=False):
    """A spherical cap of a contact angle, standing on the lowest row; ``bright`` on dark as in a crop."""
    j, i = np.mgrid[:height, :width]
    j = height - 1 - j
    inside = (i - x) ** 2 + (j + radius * math.cos(math.radians(theta))) ** 2 <= radius**2
    return np.where(inside == bright, 250, 2).astype(np.uint8)


def table(spark, images_):
    rows = [(r, n, int(a.shape[0]), int(a.shape[1]), bytearray(a.astype(np.uint8).tobytes())) for (r, n), a in images_.items()]
    return spark.createDataFrame(rows, "run_id string, frame_no int, height int, width int, px binary")


def picture(row):
    return np.frombuffer(bytes(row.px), np.uint8).reshape(row.height, row.width)


def png(path, a):
    raw = b"".join(b"\0" + row.tobytes() for row in a)
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    with open(path, "wb") as f:
        f.write(b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", a.shape[1], a.shape[0], 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b""))


@pytest.mark.parametrize("shape", [(1, 1), (5, 7), (20, 16)])
def test_morphology_against_loops(shape):
    a = np.random.default_rng(0).integers(0, 256, shape).astype(np.uint8)
    holes = np.array([[1, 0, 1], [0, 1, 0], [0, 1, 1]], dtype=bool)
    for mask in (kernels.ellipse(5), kernels.ellipse(13), holes, np.ones((3, 3), dtype=bool)):
        r = mask.shape[0] // 2
        near = lambda y, x: [a[y + dy, x + dx] for dy in range(-r, r + 1) for dx in range(-r, r + 1) if mask[dy + r, dx + r] and 0 <= y + dy < shape[0] and 0 <= x + dx < shape[1]]  # noqa: B023, E731
        assert all(kernels.dilate(a, mask)[y, x] == max(near(y, x)) and kernels.erode(a, mask)[y, x] == min(near(y, x)) for y in range(shape[0]) for x in range(shape[1]))
    assert (kernels.close(a, mask) >= a).all() and (kernels.opened(a, mask) <= a).all()


def test_components_and_edges():
    mask = np.zeros((9, 9), dtype=bool)
    mask[0:3, 0:3] = mask[5:9, 4:9] = mask[3, 3] = True
    labels = kernels.components(mask)
    assert len(np.unique(labels[mask])) == 2 and kernels.largest_component(mask).sum() == 20
    assert not kernels.largest_component(mask, 21).any()
    step = np.where(np.arange(20)[None, :] < 10, 20, 220).repeat(12, axis=0).reshape(12, 20).astype(np.uint8)
    found = kernels.edges(step)
    assert found.any(axis=1).all() and set(np.nonzero(found)[1]) <= {9, 10}
    assert not kernels.edges(np.full((8, 8), 7, np.uint8)).any()


def test_line_through_noise():
    rng = np.random.default_rng(2)
    x = np.arange(60.0)
    y = 0.1 * x + 5
    y[::6] += rng.uniform(10, 30, 10)
    slope, shift = kernels.ransac_line(y, x, 1)
    assert abs(slope - 0.1) < 1e-6 and abs(shift - 5) < 1e-6 and kernels.ransac_line(y[:1], x[:1], 1) is None


def test_levelling(spark):
    surface = np.where(np.mgrid[:80, :120][0] - 0.05 * np.mgrid[:80, :120][1] > 60, 10, 200).astype(np.uint8)
    found = images.surface_line(table(spark, {("a", 0): surface, ("a", 1): np.full((80, 120), 200, np.uint8)})).orderBy("frame_no")
    flat, empty = found.collect()
    assert abs(flat.angle - math.degrees(math.atan(0.05))) < 0.3 and empty.angle is None
    again = images.surface_line(images.levelled(found.filter("frame_no = 0"))).first()
    assert abs(again.angle) < 0.4


@pytest.mark.parametrize("theta", [45, 60, 90, 105, 120, 135])
def test_angles_of_known_drops(spark, theta):
    drop = table(spark, {("a", 0): cap(theta, 200, 420, 460, 230, bright=True)})
    points = edges.edge_points(drop, 100).persist()
    got = fit.two_pass(points).first()
    most = 6 if theta <= 60 else 3  # a shallow rim is a staircase of few rows
    assert abs(got.adv - theta) < most and abs(got.rec - theta) < most
    assert abs((got.right_point - got.left_point) - 2 * 200 * math.sin(math.radians(theta))) < (100 if theta <= 60 else 5)
    both = centers.horizontal_center(points).join(centers.vertical_center(points), ["run_id", "frame_no"])
    assert abs(both.first().h_center - 230) < 2 and 0 < both.first().v_center < 420
    size = fit.extent(points, both).first()
    assert abs(size.drop_height - 200 * (1 - math.cos(math.radians(theta)))) < 3


def test_two_pass_takes_points_and_degree_by_the_first_angle():
    """Against fits of NumPy on points sorted in Python."""
    rng = np.random.default_rng(8)
    for theta in (40, 80, 120, 150):
        i, j = kernels.outline(cap(theta, 90, 190, 240, 120, bright=True), 100)
        keep = rng.permutation(len(i))
        expected = []
        for left, start in ((True, (64, 3)), (False, (65, 2))):
            n, degree = start
            for _ in range(2):
                ox = min(i) if left else max(i)
                near = sorted(zip(i, j, strict=True), key=lambda p: ((p[0] - ox) ** 2 + p[1] ** 2, p[0], p[1]))[:n]  # noqa: B023
                x, y = np.array([p[1] for p in near], float), np.array([p[0] for p in near], float)
                xs = np.linspace(x.min(), x.max(), n)
                ys = np.polynomial.Polynomial.fit(x, y, degree)(xs)
                angle = 90 + (-1 if left else 1) * math.degrees(math.atan((ys[1] - ys[0]) / (xs[1] - xs[0])))
                n, degree = next((p, d) for limit, p, d in fit.WINDOWS if limit is None or angle <= limit)
            expected.append((angle, ys[0]))
        got = fit.measure(i[keep].astype(float), j[keep].astype(float))
        assert np.allclose(got, [expected[0][0], expected[1][0], expected[0][1], expected[1][1]], atol=1e-6)
    assert np.isnan(fit.measure(np.array([]), np.array([]))).all() and np.isnan(fit.measure(np.ones(3), np.ones(3))).all()


def scene(theta, x, tilt=0.0, height=130, width=700, radius=60, line=105):
    """A dark cap on a dark surface, both turned by ``tilt`` degrees, before a bright background; black rows at the foot."""
    y, i = np.mgrid[:height, :width].astype(float)
    t = math.radians(tilt)
    u, v = (i - width / 2) * math.cos(t) + (y - line) * math.sin(t), -(i - width / 2) * math.sin(t) + (y - line) * math.cos(t)
    inside = (u - (x - width / 2)) ** 2 + (-v + radius * math.cos(math.radians(theta))) ** 2 <= radius**2
    return np.where((v >= 0) | inside, 20, 250).astype(np.uint8)


def test_the_whole_plan(spark):
    """Moving caps of known angle on a tilted surface: levelled, pruned, trimmed, cropped and measured; a run out of view goes."""
    cfg = Settings(fps_experiment=10.0, skips=(4, 2), trim_right=600, trim_left=100, mask_high=255, angle_trials=300, height_trials=300)
    shots = {("tilted", n): scene(100, 250 + 2 * (n - 4), 1.5) for n in range(4, 12)} | {("tilted", n): scene(100, -500, 1.5) for n in range(4)}
    shots |= {("flat", n): scene(80, 300 + 3 * n) for n in range(6)} | {("bright", n): np.full((130, 700), 200, np.uint8) for n in range(5)}
    series, rows = analysed(table(spark, shots), cfg)
    out = {(r.run_id, r.frame_no): r for r in series.collect()}
    assert {r for r, _ in out} == {"tilted", "flat"} and {n for r, n in out if r == "tilted"} == set(range(4, 11)) and {n for r, n in out if r == "flat"} == set(range(5))
    unit = cfg.cm_on_pixel_ratio / 3
    for (run, _), r in out.items():
        theta, move = (100, 2) if run == "tilted" else (80, 3)
        assert abs(r.adv - theta) < 5 and abs(r.rec - theta) < 5, (run, r.adv, r.rec)
        assert abs(r.contact_line_length / unit / 3 - 120 * math.sin(math.radians(theta))) < 5
        assert abs(-r.velocity / unit / 3 / 10 - move) < 1 and not r.gap
    assert np.mean([abs(r.adv - (100 if run == "tilted" else 80)) for (run, _), r in out.items()]) < 3
    assert rows.filter("error_class is not null").count() == 0


def test_a_gap_and_a_frame_without_a_drop(spark):
    cfg = Settings(fps_experiment=10.0, skips=(), trim_right=10_000, trim_left=0, mask_high=255)
    shots = {("a", n): scene(90, 300 + n) for n in (0, 1, 5)} | {("a", 2): np.full((130, 700), 20, np.uint8)}
    series, rows = analysed(table(spark, shots), cfg, level=False)
    assert [(r.frame_no, r.gap) for r in series.orderBy("frame_no").collect()] == [(0, False), (1, True)]
    bad = sinks.errors(rows, "measure").collect()
    assert [(r.frame_no, r.error_class, r.message) for r in bad] == [(2, "NoEdge", "no pixel above the threshold")] and bad[0].ts is not None
    assert [(r.status, r.failed) for r in sinks.run_status(rows).collect()] == [("done_with_errors", 1)]


@pytest.mark.parametrize("tilt", [-2.0, 1.0])
def test_runs_are_levelled(spark, tilt):
    out = levelled_runs(table(spark, {("a", n): scene(90, 350, tilt) for n in range(4)}), Settings(angle_trials=300, height_trials=300)).collect()
    for r in out:
        a = picture(r)
        assert a.shape == (134, 700) and not a[-5:].any()
        # The lowest row above the black ones is bright left and right of the drop.
        row = a[-12]
        assert row[60:150].min() > 150 and row[550:640].min() > 150 and row[350] < 60


def naive_fold(rows, width, growth):
    out = []
    for near, far, end in rows:
        endpoint = far if None not in (near, end) and end - near > width else near
        out.append((endpoint, end, width))
        if None not in (endpoint, end):
            width = math.floor(growth * (end - endpoint))
    return out


def test_guards_fold_in_stretches(spark):
    rng, rows, expected = np.random.default_rng(4), [], set()
    for run in range(6):
        maybe = lambda v: None if rng.random() < 0.3 else int(v)
        frames = [(maybe(rng.integers(0, 60)), maybe(rng.integers(0, 90)), maybe(rng.integers(60, 200))) for _ in range(200)]
        numbers = np.cumsum(rng.integers(1, 4, 200))
        rows += [(run, int(n), *f) for n, f in zip(numbers, frames, strict=True)]
        expected |= {(run, int(n), *f) for n, f in zip(numbers, naive_fold(frames, 100, 1.13), strict=True)}
    df = spark.createDataFrame(rows, "run_id int, frame_no int, near int, far int, end int").repartition(5)
    for chunk in (1, 16, 10_000):
        assert {tuple(r) for r in detect.carried_bounds(df, 100, 1.13, chunk).collect()} == expected


def test_a_long_run_folds_in_linear_time(spark):
    import time

    df = spark.range(120_000).selectExpr("0 run_id", "id frame_no", "int(20 + id % 7) near", "int(40 + id % 11) far", "int(200 + id % 13) end")
    detect.carried_bounds(df.limit(10)).collect()
    start = time.perf_counter()
    assert detect.carried_bounds(df).selectExpr("sum(width) s").first().s > 0
    assert time.perf_counter() - start < 20


def test_network_enlarges(spark):
    rng = np.random.default_rng(0)
    weight, bias = rng.normal(size=(2, 3, 3, 3)), rng.normal(size=2)
    x = rng.normal(size=(3, 5, 4))
    padded = np.pad(x, ((0, 0), (1, 1), (1, 1)))
    plain = np.array([[[(padded[:, y : y + 3, z : z + 3] * weight[o]).sum() + bias[o] for z in range(4)] for y in range(5)] for o in range(2)])
    assert np.allclose(network.convolved(x, weight, bias), plain)
    assert [tuple(r) for r in network.shuffled(np.arange(4.0).reshape(4, 1, 1), 2)] == [(0.0, 1.0), (2.0, 3.0)]
    a = rng.integers(0, 256, (6, 7)).astype(np.uint8)
    a[0, :2] = 0, 255
    big = images.enlarged(a, network.network(network.plain()), smooth=False)
    assert abs(big.astype(int) - a.repeat(3, axis=0).repeat(3, axis=1)).max() <= 1
    assert [w.shape for w, _ in network.plain()] == [(64, 1, 5, 5), (64, 64, 3, 3), (32, 64, 3, 3), (9, 32, 3, 3)]
    out = images.upscaled(table(spark, {("a", 0): a}), 3, lambda: network.network(network.plain()), "plain").first()
    assert (out.height, out.width, out.sr_model) == (18, 21, "plain")
    gray = np.stack([a] * 3, axis=-1)
    assert abs(images.enlarged_colour(gray, images.linear()).astype(int) - images.enlarged(a, images.linear())).max() <= 1
    y, cr, cb = kernels.luma_chroma(rng.integers(0, 256, (9, 9, 3)).astype(np.uint8))
    assert abs(np.stack(kernels.luma_chroma(kernels.from_luma_chroma(y, cr, cb))).astype(int)[0] - y).max() <= 60 and (kernels.cubic(a, 6, 7) == a).all()


def test_frames_that_do_not_fill_are_null(spark):
    df = spark.createDataFrame([("a", 0, 2, 2, bytearray(b"123")), ("a", 1, 2, 2, None), ("a", 2, None, 2, bytearray(b"1234")), ("a", 3, 1, 4, bytearray(b"1234"))], "run_id string, frame_no int, height int, width int, px binary")
    out = {r.frame_no: r for r in images.totals(images.closed(df, 3)).collect()}
    assert [out[n].total is None for n in range(4)] == [True, True, True, False]
    assert detect.edge_guard(df).filter("clear is null").count() == 3 and edges.edge_points(df, 1).select("frame_no").distinct().count() == 1
    assert arrow.pixels(b"", 0, 0) is None and scan.surface_check(df).count() == 1


def test_detector_and_fusion(spark):
    class Fixed:
        def detect(self, image):
            return [(3.0, 0.0, 9.0, 5.0, 0.9), (1.0, 0.0, 4.0, 5.0, 0.95)] if image.max() > 0 else []

    df = table(spark, {("a", 0): cap(90, 20, 40, 100, 50), ("a", 1): np.zeros((40, 100), np.uint8)})
    found = detect.boxes(df, Fixed).collect()
    assert len(found) == 2 and {r.conf for r in found} == {0.9, 0.95}
    both = {r.frame_no: r for r in detect.found_drops(df, Fixed, sx=1).collect()}
    assert both[0].x1 == 1 and both[0].x2 > 60 and both[0].found and not both[1].found


def test_edge_rules(spark):
    a = np.zeros((4, 5), np.uint8)
    a[1, 1:4], a[3, 2] = 50, 200
    got = {(r.i, r.j) for r in edges.edge_points(table(spark, {("a", 0): a}), 40).collect()}
    assert got == {(1, 2), (3, 2), (2, 2), (2, 0)}
    signed = {(r.i, r.j) for r in edges.edge_points(table(spark, {("a", 0): a}), 40, 127).collect()}
    assert (2, 0) not in signed
    assert edges.edge_points(table(spark, {("a", 0): np.zeros((3, 3), np.uint8)}), 40).count() == 0


def test_steps_at_their_limits(spark):
    def one(at, n=40):
        v = [0.0] * n
        for k in range(at, n):
            v[k] = 5.0
        return spark.createDataFrame([(v,)], "v array<double>").select(left_step(F.col("v"), 1.0), right_step(F.col("v"), 1.0)).first()

    assert tuple(one(10)) == (9, None) and tuple(one(9)) == (None, None) and tuple(one(11)) == (10, 11)
    assert tuple(one(29)) == (28, 29) and tuple(one(30)) == (None, 30) and tuple(one(31)) == (None, None)
    assert tuple(one(5, 10)) == (None, None)


def test_chunks_and_trimming(spark):
    rows = [("a", n, n in (8, 20), n, n) for n in range(25)] + [("b", n, False, 0, 0) for n in range(3)]
    df = spark.createDataFrame(rows, "run_id string, frame_no int, found boolean, x1 int, x2 int")
    kept = {(r.run_id, r.frame_no) for r in prune.prune_chunks(df, 8, ["frame_no"]).collect()}
    assert kept == {("a", n) for n in [*range(8, 16), 24]} | {("b", n) for n in range(3)}
    trimmed = [r.frame_no for r in prune.trim(df, ["frame_no"], 1200, 10).orderBy("frame_no").collect()]
    assert trimmed == list(range(8, 21))


def test_angle_helpers(spark):
    angles = [None, float("nan"), 60.0, 60.1, 105.0, 135.0, 135.1]
    out = [r[0] for r in spark.createDataFrame([(a,) for a in angles], "a double").select(fit_window(F.col("a"))).collect()]
    assert [o and tuple(o) for o in out] == [None, None, (60, 2), (85, 2), (85, 2), (125, 3), (145, 4)]
    row = spark.range(1).select(middle_angle(F.lit(1.0), F.lit(-1.0)), middle_angle(F.lit(1.0), F.lit(1.0)), middle_angle(F.lit(1.0), F.lit(0.0)), middle_angle(F.lit(0.0), F.lit(0.0))).first()
    assert tuple(row) == (45.0, 225.0, 180.0, None)


def test_path_is_greedy(spark):
    pts = spark.createDataFrame([("a", 0, i, j) for i, j in [(5, 5), (0, 0), (1, 0), (5, 4), (1, 2)]], "run_id string, frame_no int, i int, j int")
    assert [(r.i, r.j) for r in edges.nearest_path(pts).orderBy("ord").collect()] == [(0, 0), (1, 0), (1, 2), (5, 4), (5, 5)]


def test_files_and_sinks(spark, tmp_path):
    for run in ("r1", "r2"):
        os.makedirs(tmp_path / run / "frames")
        for n in (1, 2):
            png(tmp_path / run / "frames" / f"frame_{n:06d}.png", cap(90) if n == 1 else cap(60))
    (tmp_path / "r2" / "frames" / "frame_000003.png").write_bytes(b"no image")
    (tmp_path / "r1" / "film.mp4").write_bytes(b"0")
    out = files.read_frames(spark, str(tmp_path)).orderBy("run_id", "frame_no").collect()
    assert [(r.run_id, r.frame_no) for r in out] == [("r1", 1), ("r1", 2), ("r2", 1), ("r2", 2)]
    assert np.array_equal(picture(out[0]), cap(90))
    assert [tuple(r) for r in files.broken_frames(spark, str(tmp_path)).collect()] == [("r2", 3)]
    assert files.list_frames(spark, str(tmp_path)).count() == 5 and files.list_videos(spark, str(tmp_path)).first().run_id == "r1"
    found = spark.createDataFrame([("r1", 1, 3, 9), ("r2", 1, 4, 8)], "run_id string, frame_no int, endpoint int, beginning int")
    for _ in range(2):
        sinks.write_detections(found, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2
    table_, problems = ingested(spark, str(tmp_path), height=90)
    assert table_.count() == 0, "the lowest rows are bright"
    assert {tuple(r) for r in problems.collect()} == {("r2", 3, "no image"), ("r1", None, "surface in the lowest row"), ("r2", None, "surface in the lowest row")}
    png(tmp_path / "r2" / "frames" / "frame_000005.png", np.vstack([cap(60), np.zeros((3, 120), np.uint8)]))
    for n in (1, 2):
        png(tmp_path / "r2" / "frames" / f"frame_{n:06d}.png", np.vstack([cap(60), np.zeros((3, 120), np.uint8)]))
    table_, problems = ingested(spark, str(tmp_path), height=90)
    assert sorted((r.run_id, r.frame_no, r.height) for r in table_.collect()) == [("r2", 1, 90), ("r2", 2, 90), ("r2", 5, 90)]
    assert {tuple(r) for r in problems.collect()} == {("r2", 3, "no image"), ("r2", 5, "missing before: 2"), ("r1", None, "surface in the lowest row")}
    points = edges.ordered_edges(table_.withColumn("endpoint", F.lit(20)).withColumn("beginning", F.lit(100)))
    for _ in range(2):
        sinks.write_points(points, str(tmp_path / "points"))
    assert spark.read.parquet(str(tmp_path / "points")).count() == points.count() > 100
    series = spark.createDataFrame([("r1", 1, *[float(k) for k in range(8)])], "run_id string, frame_no int, time_s double, x_center double, adv double, rec double, contact_line_length double, y_center double, middle_angle_degree double, velocity double")
    for _ in range(2):
        sinks.write_results(series, str(tmp_path / "results"))
    back = spark.read.option("header", True).csv(str(tmp_path / "results"))
    assert back.count() == 1 and set(sinks.RESULT_NAMES.values()) <= set(back.columns)
    sinks.wipe(found, str(tmp_path / "out"))
    sinks.wipe(found.filter("run_id = 'r1'"), str(tmp_path / "out"))
    assert [r.run_id for r in spark.read.parquet(str(tmp_path / "out")).collect()] == ["r1"]
    (tmp_path / "detections.csv").write_text("image,endpoint,beginning\nframe_000007.png,5,90\n")
    assert tuple(files.read_detections(spark, str(tmp_path / "detections.csv")).first()) == ("frame_000007.png", 5, 90, 7)
    (tmp_path / "config.yaml").write_text("frame_rate: 30\nyolo_conf: 0.5\n")
    assert load_settings(str(tmp_path / "config.yaml")) == Settings(frame_rate=30, yolo_conf=0.5)


def test_runs_of_another_extension(spark, tmp_path, monkeypatch):
    """A run without files of the first pattern gives those of the other; files are read by one listing."""
    for run, names in {"r1": ["frame_000001.png", "other_000009.gif"], "r2": ["shot_000004.gif", "shot_000006.gif"]}.items():
        os.makedirs(tmp_path / run / "frames")
        for name in names:
            png(tmp_path / run / "frames" / name, np.vstack([cap(60), np.zeros((3, 120), np.uint8)]))
    (tmp_path / "r2" / "frames" / "shot_000007.gif").write_bytes(b"no image")
    out = files.read_frames(spark, str(tmp_path), other="*.gif")
    assert sorted((r.run_id, r.frame_no) for r in out.collect()) == [("r1", 1), ("r2", 4), ("r2", 6)]
    listings, real = [], files.files_as_frames
    monkeypatch.setattr(files, "files_as_frames", lambda *a: listings.append(a) or real(*a))
    for name in ("read_frames", "broken_frames", "list_frames"):
        monkeypatch.setattr(files, name, lambda *a: pytest.fail("another listing"))
    table_, problems = ingested(spark, str(tmp_path), height=70, other="*.gif")
    assert sorted((r.run_id, r.frame_no) for r in table_.collect()) == [("r1", 1), ("r2", 4), ("r2", 6)] and len(listings) == 1
    assert {tuple(r) for r in problems.collect()} == {("r2", 7, "no image"), ("r2", 6, "missing before: 1")}


def test_streams_equal_batches(spark, sf, tmp_path):
    from sessile.sources.standins import frames, track

    source = frames(spark, sf).filter("frame_no < 120")
    for k, part in enumerate((source.filter("frame_no < 50"), source.filter("frame_no >= 50"))):
        part.coalesce(1).write.parquet(str(tmp_path / "in" / f"part{k}"))
    stream = spark.readStream.schema(source.schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    q = stream_bounds(stream, "v", 60, 90, 30, 1.13).writeStream.format("memory").queryName("bounds").option("checkpointLocation", str(tmp_path / "c1")).start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    batch = detect.adaptive_bounds(source, "v", 60, 90, 30, 1.13)
    assert sorted(map(tuple, spark.table("bounds").collect()), key=repr) == sorted(map(tuple, batch.collect()), key=repr)

    events = track(spark, sf).select("run_id", "ts", "found")
    events.coalesce(1).write.parquet(str(tmp_path / "ev"))
    s = spark.readStream.schema(events.schema).parquet(str(tmp_path / "ev"))
    q = found_per_window(s).writeStream.format("memory").queryName("windows").outputMode("complete").option("checkpointLocation", str(tmp_path / "c2")).start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert spark.table("windows").agg(F.sum("frames")).first()[0] == events.count()
