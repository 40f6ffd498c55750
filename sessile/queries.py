"""Queries over the test tables and, where SQL can say it, the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessile.functions import columns as C
from sessile.functions import kernels, network
from sessile.operators import centers, detect, edges, fit, images, kinematics, prune, scan
from sessile.operators.arrow import rows_of, with_kernel
from sessile.plans import sinks
from sessile.plans.analysis import measured
from sessile.sources.standins import frames, table, track

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}

#: The stand-ins of sources.standins, as SQL.
FRAMES_SQL = """
f AS (
  SELECT label AS run_id, vec_id AS frame_no, list_transform(embedding, lambda e:
    CAST(least(255, greatest(0, floor((CAST(e AS DOUBLE) + 0.5) * 255))) AS INTEGER)) AS px
  FROM embeddings
), p AS (
  SELECT run_id, frame_no, k AS x, px[k + 1] AS v FROM (SELECT run_id, frame_no, px, unnest(range(64)) AS k FROM f)
), g AS (
  SELECT run_id, frame_no, CAST(x % 8 AS INTEGER) AS x, CAST(x // 8 AS INTEGER) AS y, v FROM p
)"""
TRACK_SQL = """
t AS (
  SELECT user_id AS run_id, ts, event_id, event_type IN ('click', 'purchase') AS found, value AS x_center,
    CAST(floor(value * 10) AS BIGINT) AS x1, CAST(floor(value * 10) + event_id % 700 AS BIGINT) AS x2
  FROM events
)"""
POINTS_SQL = """
hits AS (SELECT * FROM g WHERE v > {low} AND v <= {high}), e AS (
  SELECT run_id, frame_no, min(x) AS i, 7 - y AS j FROM hits GROUP BY run_id, frame_no, y
  UNION SELECT run_id, frame_no, max(x), 7 - y FROM hits GROUP BY run_id, frame_no, y
  UNION SELECT run_id, frame_no, x, 7 - min(y) FROM hits GROUP BY run_id, frame_no, x
)"""
POINTS = POINTS_SQL.format(low=110, high=255)


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return register


def typed(df: DataFrame, schema: str) -> DataFrame:
    """``df`` with the columns and types of ``schema``, so that engines agree on widths."""
    pairs = [c.strip().split(" ") for c in schema.split(",")]
    return df.select(*[F.col(n).cast(t).alias(n) for n, t in pairs])


def values(out: DataFrame) -> DataFrame:
    """A row for each pixel: run_id, frame_no, place k, value v."""
    return rows_of(out, lambda a: (np.arange(a.size), a.ravel()), "k bigint, v bigint")


# Scans and checks


@query("SELECT run_id FROM (SELECT run_id, row_number() OVER (ORDER BY run_id) AS rn FROM (SELECT DISTINCT user_id AS run_id FROM events)) WHERE (rn - 1) % 5 = 0")
def s1_run_scan(spark: SparkSession, sf: str) -> DataFrame:
    return scan.every_nth_run(track(spark, sf).select("run_id").distinct())


@query("SELECT DISTINCT o_custkey AS run_id FROM orders WHERE o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def s2_worklist(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select(F.col("o_custkey").alias("run_id"), F.when(F.col("o_orderstatus") == "F", "done").otherwise("open").alias("status"))
    return scan.work_list(orders.select("run_id").distinct(), orders)


@query("SELECT page_id, CAST(len(string_split(regexp_extract(url, '^https?://[^/?#]+/?([^?#]*)', 1), '/')) - 1 AS INTEGER) AS depth FROM pages WHERE len(string_split(regexp_extract(url, '^https?://[^/?#]+/?([^?#]*)', 1), '/')) - 1 <= 1")
def s3_depth_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = F.concat(F.lit("/runs/"), F.regexp_extract("url", "^https?://[^/?#]+/?([^?#]*)", 1))
    found = scan.within_depth(table(spark, sf, "pages").withColumn("path", path), "/runs", 1)
    return found.select("page_id", (F.size(F.split("path", "/")) - 3).alias("depth"))


@query("SELECT l_orderkey AS run_id, count(*) AS videos, count(*) = 1 AS ok FROM lineitem GROUP BY l_orderkey")
def s4_single_video(spark: SparkSession, sf: str) -> DataFrame:
    return scan.single_video(table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("run_id")))


@query("SELECT p_partkey AS video, p_size AS width, CAST(length(p_brand) AS INTEGER) AS height FROM part WHERE p_size <> 10 OR length(p_brand) <> 8")
def s6_dimensions(spark: SparkSession, sf: str) -> DataFrame:
    videos = table(spark, sf, "part").select(F.col("p_partkey").alias("video"), F.col("p_size").alias("width"), F.length("p_brand").alias("height"))
    return scan.odd_dimensions(videos, 10, 8)


@query(f"WITH {FRAMES_SQL} SELECT run_id, frame_no, CAST(x AS BIGINT) AS x, CAST(floor(0.299::DOUBLE * px[x + 3] + 0.587::DOUBLE * px[x + 2] + 0.114::DOUBLE * px[x + 1] + 0.5::DOUBLE) AS BIGINT) AS gray FROM f JOIN p USING (run_id, frame_no) WHERE x % 3 = 0 AND x < 63")
def s12_gray(spark: SparkSession, sf: str) -> DataFrame:
    at = F.explode(F.sequence(F.lit(0), F.lit(60), F.lit(3))).alias("x")
    bgr = [F.get("v", F.col("x") + k) for k in range(3)]
    return typed(frames(spark, sf).select("run_id", "frame_no", "v", at).withColumn("gray", C.luma(bgr[2], bgr[1], bgr[0])), "run_id int, frame_no bigint, x bigint, gray bigint")


@query(f"""WITH {FRAMES_SQL}, n AS (
  SELECT run_id, frame_no, px, lag(px) OVER w AS a, lead(px) OVER w AS b FROM f WINDOW w AS (PARTITION BY run_id ORDER BY frame_no)
) SELECT run_id, frame_no, CAST(k AS BIGINT) AS x, CAST(floor((a[k + 1] + b[k + 1]) / 2.0) AS BIGINT) AS v
FROM (SELECT *, unnest(range(64)) AS k FROM n WHERE frame_no % 7 = 3 AND a IS NOT NULL AND b IS NOT NULL)""")
def s15_neighbor_blend(spark: SparkSession, sf: str) -> DataFrame:
    broken = F.col("frame_no") % 7 == 3
    out = scan.repaired(frames(spark, sf), broken).filter(broken & F.col("px").isNotNull())
    return typed(values(out).withColumnRenamed("k", "x"), "run_id int, frame_no bigint, x bigint, v bigint")


@query(f"""WITH {FRAMES_SQL}, n AS (SELECT run_id, frame_no, row_number() OVER (PARTITION BY run_id ORDER BY frame_no) - 1 AS pos FROM f),
m AS (SELECT run_id, frame_no, avg(v) AS mean FROM g WHERE y = 7 GROUP BY ALL)
SELECT run_id, count(*) AS checked, max(mean > 150) AS rejected FROM n JOIN m USING (run_id, frame_no) WHERE pos % 4 = 0 GROUP BY run_id""")
def s16_surface_check(spark: SparkSession, sf: str) -> DataFrame:
    return scan.surface_check(frames(spark, sf), bright=150)


@query("SELECT * FROM (SELECT user_id AS run_id, event_id, lag(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS previous, event_id - lag(event_id) OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS missing FROM events) WHERE missing > 0")
def s17_index_gaps(spark: SparkSession, sf: str) -> DataFrame:
    return scan.index_gaps(track(spark, sf), "event_id")


@query("SELECT p.doc_id, CAST(d.endpoint AS BIGINT) AS endpoint FROM documents p JOIN (SELECT doc_id, max(quality) AS endpoint FROM labels GROUP BY doc_id) d ON p.doc_id = d.doc_id WHERE length(p.text) > 500")
def s19_detections_read(spark: SparkSession, sf: str) -> DataFrame:
    detections = table(spark, sf, "labels").select("doc_id", F.col("quality").alias("endpoint"), F.lit(0).alias("beginning"))
    docs = table(spark, sf, "documents").filter(F.length("text") > 500).select("doc_id")
    return typed(fit.lookup_bounds(docs, detections.groupBy("doc_id").agg(F.max("endpoint").alias("endpoint"), F.max("beginning").alias("beginning")), ["doc_id"]).filter("not missing"), "doc_id bigint, endpoint bigint")


@query("""WITH b AS (SELECT doc_id, regexp_replace(coalesce(replace(replace(text, ', ', ' \"\"\" '), '. ', chr(10) || '# '), ''), '\\n$', '') AS body FROM documents),
l AS (SELECT doc_id, n, s, ((length(s) - length(replace(s, '\"\"\"', ''))) // 3 + (length(s) - length(replace(s, '''''''', ''))) // 3) AS q
  FROM (SELECT doc_id, unnest(string_split(body, chr(10))) AS s, unnest(range(len(string_split(body, chr(10))))) AS n FROM b WHERE body <> '')),
w AS (SELECT *, coalesce(sum(q) OVER (PARTITION BY doc_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) % 2 AS inside FROM l)
SELECT doc_id, count(*) AS lines, count(*) FILTER (q = 0 AND inside = 0 AND trim(s) <> '' AND NOT starts_with(trim(s), '#')) AS code_lines FROM w GROUP BY doc_id""")
def s21_line_count(spark: SparkSession, sf: str) -> DataFrame:
    text = F.replace(F.replace(F.col("text"), F.lit(", "), F.lit(' """ ')), F.lit(". "), F.lit("\n# "))
    docs = table(spark, sf, "documents").select("doc_id", text.alias("text")).filter(F.coalesce("text", F.lit("")) != "")
    return scan.count_lines(docs).select("doc_id", "lines", "code_lines")


# Baseline


@query(f"""WITH {FRAMES_SQL}, low AS (SELECT run_id, frame_no, x, max(y) AS y FROM g WHERE v > 120 GROUP BY ALL)
SELECT run_id, frame_no, round(degrees(atan(regr_slope(y, x))), 4) + 0.0 AS angle FROM low GROUP BY run_id, frame_no HAVING count(*) > 1""")
def b1_line_angle(spark: SparkSession, sf: str) -> DataFrame:
    low = edges_of_columns(frames(spark, sf), 120)
    line = fit.line_fit(low, "x", "y").filter("n > 1")
    return line.select("run_id", "frame_no", (F.round(F.degrees(F.atan("slope")), 4) + 0.0).alias("angle"))


def edges_of_columns(found: DataFrame, low: int) -> DataFrame:
    """Lowest pixel above ``low`` of every column."""
    y = lambda x: F.array_max(F.filter(F.sequence(F.lit(0), F.col("height") - 1), lambda y: F.get("v", y * F.col("width") + x) > low))
    points = F.filter(F.transform(F.sequence(F.lit(0), F.col("width") - 1), lambda x: F.struct(x.alias("x"), y(x).alias("y"))), lambda p: p["y"].isNotNull())
    return found.select("run_id", "frame_no", F.inline(points))


@query(f"""WITH {FRAMES_SQL}, h AS (SELECT run_id, frame_no, max(y) AS line_height FROM g WHERE v > 140 GROUP BY ALL),
b AS (SELECT run_id, CAST(trunc(avg(line_height)) AS INTEGER) AS baseline FROM h GROUP BY run_id)
SELECT run_id, frame_no, CAST(line_height AS INTEGER) AS line_height, baseline, baseline + 10 AS cut FROM h JOIN b USING (run_id)""")
def b4_run_baseline(spark: SparkSession, sf: str) -> DataFrame:
    heights = edges_of_columns(frames(spark, sf), 140).groupBy("run_id", "frame_no").agg(F.max("y").alias("line_height"))
    return images.run_baseline(heights).select("run_id", "frame_no", "line_height", "baseline", "cut")


@query(f"""WITH {FRAMES_SQL}, s AS (SELECT run_id, frame_no, y, sum(v) FILTER (x % 4 = 0) AS s FROM g GROUP BY ALL)
SELECT run_id, frame_no, CAST(coalesce(max(y) FILTER (s > 300 AND y >= 1), 1) - 1 AS INTEGER) AS bottom FROM s GROUP BY ALL""")
def b6_bottom_row(spark: SparkSession, sf: str) -> DataFrame:
    return images.bottom_row(frames(spark, sf), every=4, least=300)


# Detection


@query(f"""WITH {FRAMES_SQL}, s AS (SELECT run_id, frame_no, x, sum(v) AS s FROM g GROUP BY ALL)
SELECT run_id, frame_no, CAST(x AS BIGINT) AS x, round(s / avg(s) OVER (PARTITION BY run_id, frame_no), 6) AS vv FROM s""")
def t1_profile(spark: SparkSession, sf: str) -> DataFrame:
    out = detect.column_profile(frames(spark, sf)).select("run_id", "frame_no", F.posexplode("vv").alias("x", "v"))
    return typed(out.withColumn("vv", F.round("v", 6)), "run_id int, frame_no bigint, x bigint, vv double")


CLOSE_SQL = """
r1 AS (SELECT run_id, frame_no, x, y, max(v) OVER (PARTITION BY run_id, frame_no, y ORDER BY x ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS v FROM g),
r2 AS (SELECT run_id, frame_no, x, y, max(v) OVER (PARTITION BY run_id, frame_no, x ORDER BY y ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS v FROM r1),
r3 AS (SELECT run_id, frame_no, x, y, min(v) OVER (PARTITION BY run_id, frame_no, y ORDER BY x ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS v FROM r2),
r4 AS (SELECT run_id, frame_no, x, y, min(v) OVER (PARTITION BY run_id, frame_no, x ORDER BY y ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS v FROM r3)"""
SQUARE = np.ones((3, 3), dtype=bool)


@query(f"""WITH {FRAMES_SQL}, {CLOSE_SQL}, s AS (SELECT g.run_id, g.frame_no, g.x, sum(g.v) AS s, sum(r4.v) AS t FROM g JOIN r4 USING (run_id, frame_no, x, y) GROUP BY ALL)
SELECT run_id, frame_no, CAST(x AS BIGINT) AS x, round(s / avg(s) OVER w, 6) AS vv, round(t / avg(t) OVER w, 6) AS vv_mor FROM s WINDOW w AS (PARTITION BY run_id, frame_no)""")
def t1_two_profiles(spark: SparkSession, sf: str) -> DataFrame:
    out = detect.column_profile(frames(spark, sf), mask=SQUARE).select("run_id", "frame_no", F.posexplode(F.arrays_zip("vv", "vv_mor")).alias("x", "p"))
    return typed(out.select("run_id", "frame_no", "x", F.round("p.vv", 6).alias("vv"), F.round("p.vv_mor", 6).alias("vv_mor")), "run_id int, frame_no bigint, x bigint, vv double, vv_mor double")


@query(f"""WITH {FRAMES_SQL}, h AS (SELECT run_id, frame_no, x, y // 2 AS y, floor(avg(v) + 0.5) AS v FROM g GROUP BY run_id, frame_no, x, y // 2),
{CLOSE_SQL.replace("FROM g)", "FROM h)")}, s AS (SELECT run_id, frame_no, x, sum(v) AS s FROM r4 GROUP BY ALL)
SELECT run_id, frame_no, CAST(x AS BIGINT) AS x, round(s / avg(s) OVER (PARTITION BY run_id, frame_no), 6) AS vv FROM s""")
def t2_closed_profile(spark: SparkSession, sf: str) -> DataFrame:
    out = detect.closed_profile(frames(spark, sf), 1, 2, SQUARE).select("run_id", "frame_no", F.posexplode("vv").alias("x", "v"))
    return typed(out.withColumn("vv", F.round("v", 6)), "run_id int, frame_no bigint, x bigint, vv double")


STEPS_SQL = """
d AS (SELECT run_id, frame_no, x, abs(v - lag(v) OVER (PARTITION BY run_id, frame_no ORDER BY x)) AS dv FROM p),
b AS (
  SELECT run_id, frame_no, CAST(min(x - 1) FILTER (dv > 60 AND x BETWEEN 10 AND 53) AS INTEGER) AS near,
    CAST(min(x - 1) FILTER (dv > 90 AND x BETWEEN 10 AND 53) AS INTEGER) AS far,
    CAST(max(x) FILTER (dv > 60 AND x BETWEEN 11 AND 54) AS INTEGER) AS stop
  FROM d GROUP BY ALL
)"""


@query(f"WITH {FRAMES_SQL}, {STEPS_SQL} SELECT run_id, frame_no, near AS endpoint, stop AS beginning FROM b")
def t3_t4_bounds(spark: SparkSession, sf: str) -> DataFrame:
    return detect.steps(frames(spark, sf), "v", "v", 60, 90).select("run_id", "frame_no", F.col("near").alias("endpoint"), F.col("end").alias("beginning"))


@query(f"""WITH {FRAMES_SQL}, {STEPS_SQL}, {STEPS_SQL.replace("d AS", "d2 AS").replace("b AS", "b2 AS").replace("FROM p)", "FROM (SELECT run_id, frame_no, 63 - x AS x, v FROM p))").replace("FROM d ", "FROM d2 ")}
SELECT run_id, frame_no, CASE WHEN b2.stop - b.near > 30 THEN b.far ELSE b.near END AS endpoint, b2.stop AS beginning FROM b JOIN b2 USING (run_id, frame_no)""")
def t5_width_guard(spark: SparkSession, sf: str) -> DataFrame:
    found = detect.steps(frames(spark, sf).withColumn("turned", F.reverse("v")), "v", "turned", 60, 90)
    return found.select("run_id", "frame_no", detect.guarded(30).alias("b")).select("run_id", "frame_no", "b.*")


@query(f"""WITH {FRAMES_SQL}, d AS (SELECT run_id, frame_no, x, abs(v - lag(v) OVER (PARTITION BY run_id, frame_no ORDER BY x)) AS dv
  FROM (SELECT run_id, frame_no, x // 2 AS x, floor((sum(v) + 1) / 2) AS v FROM p GROUP BY run_id, frame_no, x // 2))
SELECT run_id, frame_no, CAST(2 * min(x - 1) FILTER (dv > 60 AND x BETWEEN 10 AND 21) AS INTEGER) AS near, CAST(2 * min(x - 1) FILTER (dv > 90 AND x BETWEEN 10 AND 21) AS INTEGER) AS far,
  CAST(2 * max(x) FILTER (dv > 60 AND x BETWEEN 11 AND 22) AS INTEGER) AS end FROM d GROUP BY run_id, frame_no""")
def t6_scaled_steps(spark: SparkSession, sf: str) -> DataFrame:
    """Steps of profiles shrunk by two, in pixels of the frame."""
    wide = frames(spark, sf).withColumns({"height": F.lit(1), "width": F.lit(64)})
    small = values(images.map_pixels(wide, lambda a: kernels.resized(a, 1, 32))).groupBy("run_id", "frame_no").agg(F.sort_array(F.collect_list(F.struct("k", "v"))).alias("kv"))
    return detect.steps(small.withColumn("v", F.col("kv.v")), "v", "v", 60, 90, 2).select("run_id", "frame_no", "near", "far", "end")


@query(f"""WITH RECURSIVE {FRAMES_SQL}, {STEPS_SQL}, o AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY frame_no) AS rn FROM b),
r AS (
  SELECT run_id, rn, frame_no, CASE WHEN stop - near > 30 THEN far ELSE near END AS endpoint, stop AS beginning, 30 AS width FROM o WHERE rn = 1
  UNION ALL
  SELECT o.run_id, o.rn, o.frame_no, CASE WHEN o.stop - o.near > w.width THEN o.far ELSE o.near END, o.stop, w.width
  FROM (SELECT run_id, rn, coalesce(CAST(floor(1.13::DOUBLE * (beginning - endpoint)) AS INTEGER), width) AS width FROM r) w
  JOIN o ON o.run_id = w.run_id AND o.rn = w.rn + 1
) SELECT run_id, frame_no, endpoint, beginning, width FROM r""")
def t7_adaptive_fold(spark: SparkSession, sf: str) -> DataFrame:
    return detect.adaptive_bounds(frames(spark, sf), "v", 60, 90, 30, 1.13)


@query(f"""WITH {FRAMES_SQL} SELECT run_id, frame_no,
  avg(v) FILTER (y BETWEEN 4 AND 6 AND x < 2) >= 120 AND avg(v) FILTER (y BETWEEN 4 AND 6 AND x BETWEEN 5 AND 6) >= 120 AS clear
FROM g GROUP BY run_id, frame_no""")
def t8_edge_guard(spark: SparkSession, sf: str) -> DataFrame:
    return detect.edge_guard(frames(spark, sf), (-4, -1), (0, 2), (-3, -1), 120).select("run_id", "frame_no", "clear")


BOXES_SQL = """
boxes AS (SELECT user_id AS run_id, event_id // 5 AS frame_no, event_id AS x1, event_id + 30 AS x2, (event_id * 37 % 100) / 100.0::DOUBLE AS conf FROM events),
best AS (
  SELECT run_id, frame_no, x1, x2, conf FROM (SELECT *, row_number() OVER (PARTITION BY run_id, frame_no ORDER BY conf DESC, x1, x2) AS rn FROM boxes WHERE conf >= 0.5)
  WHERE rn = 1
)"""


def boxes(spark: SparkSession, sf: str) -> DataFrame:
    e = F.col("event_id")
    return table(spark, sf, "events").select(F.col("user_id").alias("run_id"), F.floor(e / 5).alias("frame_no"), e.alias("x1"), (e + 30).alias("x2"), (e * 37 % 100 / 100.0).alias("conf"))


@query(f"WITH {BOXES_SQL} SELECT * FROM best")
def t9_best_box(spark: SparkSession, sf: str) -> DataFrame:
    return detect.best_box(boxes(spark, sf), 0.5)


@query(f"""WITH {BOXES_SQL}, c AS (SELECT user_id AS run_id, event_id // 5 AS frame_no, max(value) > 20 AS clear,
  min(event_id) FILTER (event_type = 'view') AS s1, max(event_id + 25) FILTER (event_type = 'view') AS s2 FROM events GROUP BY ALL)
SELECT c.run_id, c.frame_no, coalesce(x1, s1) AS x1, greatest(x2, s2) AS x2, coalesce(x1, s1) IS NOT NULL AND clear AS found
FROM c LEFT JOIN best USING (run_id, frame_no)""")
def t10_fusion(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").withColumns({"run_id": F.col("user_id"), "frame_no": F.floor(F.col("event_id") / 5)})
    clear = e.groupBy("run_id", "frame_no").agg((F.max("value") > 20).alias("clear"))
    sums = e.filter("event_type = 'view'").groupBy("run_id", "frame_no").agg(F.min("event_id").alias("x1"), F.max(F.col("event_id") + 25).alias("x2"))
    return detect.fused(detect.best_box(boxes(spark, sf), 0.5), sums, clear)


@query(f"""WITH {FRAMES_SQL}, o AS (SELECT *, lag(frame_no) OVER (PARTITION BY run_id ORDER BY frame_no) AS before FROM f),
m AS (SELECT o.run_id, o.frame_no, g.x, g.y FROM o JOIN g USING (run_id, frame_no) JOIN g h ON h.run_id = o.run_id AND h.frame_no = o.before AND h.x = g.x AND h.y = g.y WHERE abs(g.v - h.v) > 40)
SELECT o.run_id, o.frame_no, CAST(count(m.x) AS INTEGER) AS changed, min(m.x) AS x1, max(m.x) AS x2, min(m.y) AS y1, max(m.y) AS y2
FROM o LEFT JOIN m USING (run_id, frame_no) WHERE before IS NOT NULL GROUP BY o.run_id, o.frame_no""")
def t11_frame_diff(spark: SparkSession, sf: str) -> DataFrame:
    return detect.difference_box(frames(spark, sf), 40)


@query(f"WITH {FRAMES_SQL} SELECT run_id, frame_no, count(*) AS n, CAST(sum(k * px[k // 2 + 1]) AS BIGINT) AS weighted FROM (SELECT *, unnest(range(128)) AS k FROM f) GROUP BY run_id, frame_no")
def t15_stretch(spark: SparkSession, sf: str) -> DataFrame:
    out = frames(spark, sf).withColumn("s", C.stretched(F.col("v"), 130))
    weighted = F.aggregate(F.transform("s", lambda v, k: (v * k).cast("long")), F.lit(0).cast("long"), lambda a, v: a + v)
    return out.select("run_id", "frame_no", F.size("s").cast("long").alias("n"), weighted.alias("weighted"))


@query(f"""WITH {FRAMES_SQL}, {STEPS_SQL} SELECT run_id, frame_no, count(*) AS n, CAST(sum(255 - v) AS BIGINT) AS total
FROM b JOIN p USING (run_id, frame_no) WHERE near < stop AND x >= greatest(0, near - 15) AND x < least(64, stop + 15) GROUP BY run_id, frame_no""")
def k2_crop(spark: SparkSession, sf: str) -> DataFrame:
    wide = frames(spark, sf).withColumns({"height": F.lit(1), "width": F.lit(64)})
    found = detect.steps(wide, "v", "v", 60, 90).withColumns({"endpoint": F.col("near"), "beginning": F.col("end")})
    return typed(images.totals(images.cropped(found, 15)).select("run_id", "frame_no", F.col("pixels").alias("n"), "total").filter("n is not null"), "run_id int, frame_no bigint, n bigint, total bigint")


# Pruning


@query(f"""WITH {TRACK_SQL}, n AS (SELECT *, (row_number() OVER (PARTITION BY run_id ORDER BY ts, event_id) - 1) AS n FROM t),
c AS (SELECT *, max(found AND n % 8 IN (0, 7)) OVER w AS hit, count(*) OVER w AS size FROM n WINDOW w AS (PARTITION BY run_id, n // 8))
SELECT run_id, event_id FROM c WHERE size < 8 OR hit""")
def p1_chunk_prune(spark: SparkSession, sf: str) -> DataFrame:
    return prune.prune_chunks(track(spark, sf).select("run_id", "ts", "event_id", "found"), 8, ["ts", "event_id"]).select("run_id", "event_id")


@query(f"""WITH {TRACK_SQL}, n AS (SELECT *, (row_number() OVER (PARTITION BY run_id ORDER BY ts, event_id) - 1) AS n FROM t),
c AS (SELECT *, max(found AND n % 8 IN (0, 7)) OVER w AS hit, count(*) OVER w AS size FROM n WINDOW w AS (PARTITION BY run_id, n // 8)),
n2 AS (SELECT run_id, ts, event_id, found, (row_number() OVER (PARTITION BY run_id ORDER BY ts, event_id) - 1) AS n FROM c WHERE size < 8 OR hit),
c2 AS (SELECT *, max(found AND n % 3 IN (0, 2)) OVER w AS hit, count(*) OVER w AS size FROM n2 WINDOW w AS (PARTITION BY run_id, n // 3))
SELECT run_id, event_id FROM c2 WHERE size < 3 OR hit""")
def p2_coarse_fine(spark: SparkSession, sf: str) -> DataFrame:
    return prune.coarse_to_fine(track(spark, sf).select("run_id", "ts", "event_id", "found"), (8, 3), ["ts", "event_id"]).select("run_id", "event_id")


@query(f"""WITH {TRACK_SQL}, n AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY ts, event_id) AS n FROM t),
b AS (SELECT run_id, min(n) FILTER (found AND x2 < 900) AS a, max(n) FILTER (found AND x1 > 300) AS z FROM n GROUP BY run_id)
SELECT run_id, event_id FROM n JOIN b USING (run_id) WHERE n BETWEEN a AND z""")
def p3_p4_trim(spark: SparkSession, sf: str) -> DataFrame:
    return prune.trim(track(spark, sf), ["ts", "event_id"], 900, 300).select("run_id", "event_id")


# Kernels


def pixels(out: DataFrame) -> DataFrame:
    return typed(values(out), "run_id int, frame_no bigint, k bigint, v bigint")


@query(f"""WITH {FRAMES_SQL} SELECT run_id, frame_no, CAST(y // 2 * 8 + x AS BIGINT) AS k, CAST(floor(avg(v) + 0.5) AS BIGINT) AS v
FROM g GROUP BY run_id, frame_no, x, y // 2""")
def i1_resize(spark: SparkSession, sf: str) -> DataFrame:
    return pixels(images.map_pixels(frames(spark, sf), lambda a: kernels.resized(a, a.shape[0] // 2, a.shape[1])))


@query(f"WITH {FRAMES_SQL}, {CLOSE_SQL} SELECT run_id, frame_no, CAST(y * 8 + x AS BIGINT) AS k, CAST(v AS BIGINT) AS v FROM r4")
def i4_rect_close(spark: SparkSession, sf: str) -> DataFrame:
    return pixels(images.closed(frames(spark, sf), 3, "rectangle"))


@query(f"WITH {FRAMES_SQL}, {CLOSE_SQL.replace('max(', 'M(').replace('min(', 'max(').replace('M(', 'min(')} SELECT run_id, frame_no, CAST(y * 8 + x AS BIGINT) AS k, CAST(v AS BIGINT) AS v FROM r4")
def i5_open(spark: SparkSession, sf: str) -> DataFrame:
    return pixels(images.map_pixels(frames(spark, sf), lambda a: kernels.opened(a, SQUARE)))


@query(f"WITH {FRAMES_SQL}, {CLOSE_SQL} SELECT run_id, frame_no, CAST(y * 8 + x AS BIGINT) AS k, CAST(v AS BIGINT) AS v FROM r2")
def i6_dilate(spark: SparkSession, sf: str) -> DataFrame:
    return pixels(images.map_pixels(frames(spark, sf), lambda a: kernels.dilate(a, SQUARE)))


@query(f"""WITH {FRAMES_SQL}, o AS (SELECT unnest([-1, 0, 1]) AS d), b AS (
  SELECT g.run_id, g.frame_no, g.x, g.y, sum((2 - abs(a.d)) * (2 - abs(c.d)) * h.v) AS s
  FROM g CROSS JOIN o a CROSS JOIN o c JOIN g h ON h.run_id = g.run_id AND h.frame_no = g.frame_no
    AND h.x = least(7, greatest(0, g.x + a.d)) AND h.y = least(7, greatest(0, g.y + c.d)) GROUP BY ALL)
SELECT run_id, frame_no, CAST(y * 8 + x AS BIGINT) AS k, CAST(floor(s / 16.0 + 0.5) AS BIGINT) AS v FROM b""")
def i7_blur(spark: SparkSession, sf: str) -> DataFrame:
    return pixels(images.map_pixels(frames(spark, sf), lambda a: kernels.blur(a, 3)))


@query(f"WITH {FRAMES_SQL} SELECT run_id, frame_no, CAST(y * 8 + x AS BIGINT) AS k, CAST(CASE WHEN 255 - v > 120 THEN 0 ELSE 250 END AS BIGINT) AS v FROM g")
def i9_i11_threshold(spark: SparkSession, sf: str) -> DataFrame:
    return pixels(images.map_pixels(frames(spark, sf), lambda a: kernels.threshold(255 - a, 120, 250, inverse=True)))


@query(f"WITH {FRAMES_SQL} SELECT run_id, frame_no, CAST(y * 8 + x AS BIGINT) AS k, CAST(g2.v AS BIGINT) AS v FROM (SELECT run_id, frame_no, 7 - x AS x, 7 - y AS y, v FROM g) g2")
def i13_half_turn(spark: SparkSession, sf: str) -> DataFrame:
    return pixels(images.map_pixels(frames(spark, sf), lambda a: kernels.rotated(a, 180.0, (3.5, 3.5))))


@query(f"""WITH {FRAMES_SQL}, b AS (SELECT run_id, frame_no, coalesce(max(y) FILTER (s > 300 AND y >= 1), 1) - 1 AS bottom FROM (SELECT run_id, frame_no, y, sum(v) FILTER (x % 4 = 0) AS s FROM g GROUP BY ALL) GROUP BY ALL),
k AS (SELECT run_id, frame_no, greatest(0, bottom - 1) AS keep FROM b),
o AS (SELECT k.*, c FROM k, unnest(range(14)) AS u(c))
SELECT o.run_id, o.frame_no, CAST(c AS BIGINT) AS y, CAST(CASE WHEN c < 9 - keep THEN 255 * 8 WHEN c >= 9 THEN 0 ELSE s END AS BIGINT) AS total
FROM o LEFT JOIN (SELECT run_id, frame_no, y, sum(v) AS s FROM g GROUP BY ALL) r ON r.run_id = o.run_id AND r.frame_no = o.frame_no AND r.y = c - (9 - keep)""")
def i14_b6_unified(spark: SparkSession, sf: str) -> DataFrame:
    found = frames(spark, sf).join(images.bottom_row(frames(spark, sf), every=4, least=300), ["run_id", "frame_no"])
    out = values(images.unified(found, 10))
    out = out.groupBy("run_id", "frame_no", F.floor(F.col("k") / 8).alias("y")).agg(F.sum("v").alias("total"))
    return typed(out, "run_id int, frame_no bigint, y bigint, total bigint")


@query(f"""WITH {FRAMES_SQL} SELECT run_id, frame_no, CAST(y * 8 + x AS BIGINT) AS k,
  round((v - min(v) OVER w) / CAST(max(v) OVER w - min(v) OVER w AS DOUBLE), 6) AS v FROM g WINDOW w AS (PARTITION BY run_id, frame_no)""")
def i16_minmax(spark: SparkSession, sf: str) -> DataFrame:
    stretched = rows_of(frames(spark, sf), lambda a: (np.arange(a.size), kernels.min_max(a).ravel()), "k bigint, v double")
    return typed(stretched.withColumn("v", F.round("v", 6)), "run_id int, frame_no bigint, k bigint, v double")


def parts_sql(mask: str, least: int = 1) -> str:
    """SQL that needs WITH RECURSIVE: ``part``, the pixels of each frame's largest 8-connected part of the relation ``m``."""
    return f"""m AS ({mask}), reach AS (
  SELECT run_id, frame_no, x, y, y * 8 + x AS l FROM m
  UNION SELECT m.run_id, m.frame_no, m.x, m.y, r.l FROM reach r JOIN m ON m.run_id = r.run_id AND m.frame_no = r.frame_no AND abs(m.x - r.x) <= 1 AND abs(m.y - r.y) <= 1
), comp AS (SELECT run_id, frame_no, x, y, max(l) AS c FROM reach GROUP BY ALL),
large AS (SELECT run_id, frame_no, arg_max(c, n * 100 + c) AS c FROM (SELECT run_id, frame_no, c, count(*) AS n FROM comp GROUP BY ALL) WHERE n >= {least} GROUP BY ALL),
part AS (SELECT comp.* FROM comp JOIN large USING (run_id, frame_no, c))"""


def window_sql(steps: str, source: str, around: int) -> str:
    """SQL of erosions (e) and dilations (d) by a square, one after another: w1, w2, ... from ``source``."""
    out = []
    for k, step in enumerate(steps):
        f, before, now = ("min" if step == "e" else "max"), (f"w{k}" if k else source), f"w{k + 1}"
        for across, part, order, name in ((before, "y", "x", f"{now}x"), (f"{now}x", "x", "y", now)):
            out.append(f"{name} AS (SELECT run_id, frame_no, x, y, {f}(v) OVER (PARTITION BY run_id, frame_no, {part} ORDER BY {order} ROWS BETWEEN {around} PRECEDING AND {around} FOLLOWING) AS v FROM {across})")
    return ", ".join(out)


BLUR_SQL = """off AS (SELECT unnest([-1, 0, 1]) AS d), dim AS (
  SELECT g.run_id, g.frame_no, g.x, g.y, floor(sum((2 - abs(a.d)) * (2 - abs(c.d)) * (255 - h.v)) / 16.0 + 0.5) AS v
  FROM g CROSS JOIN off a CROSS JOIN off c JOIN g h ON h.run_id = g.run_id AND h.frame_no = g.frame_no
    AND h.x = least(7, greatest(0, g.x + a.d)) AND h.y = least(7, greatest(0, g.y + c.d)) GROUP BY ALL)"""
CHANGE_SQL = """old AS (SELECT run_id, frame_no, lag(frame_no) OVER (PARTITION BY run_id ORDER BY frame_no) AS before FROM f), apart AS (
  SELECT g.run_id, g.frame_no, g.x, g.y, CASE WHEN abs(g.v - h.v) > 40 THEN 255 ELSE 0 END AS v
  FROM g JOIN old USING (run_id, frame_no) JOIN g h ON h.run_id = old.run_id AND h.frame_no = old.before AND h.x = g.x AND h.y = g.y)"""


@query(f"""WITH RECURSIVE {FRAMES_SQL}, {CHANGE_SQL}, {window_sql("eddd", "apart", 1)}, {parts_sql("SELECT run_id, frame_no, x, y FROM w4 WHERE v > 0", 5)}
SELECT old.run_id, old.frame_no, min(x) AS x1, max(x) AS x2 FROM old LEFT JOIN part USING (run_id, frame_no) WHERE before IS NOT NULL GROUP BY ALL""")
def i12_t11_largest_change(spark: SparkSession, sf: str) -> DataFrame:
    return detect.largest_change(frames(spark, sf), 40, 5, 3)


@query()
def b1_surface_line(spark: SparkSession, sf: str) -> DataFrame:
    return images.surface_line(frames(spark, sf), 1.0, trials=500).select("run_id", "frame_no", "angle", "line_y")


@query()
def b2_b3_line_heights(spark: SparkSession, sf: str) -> DataFrame:
    return images.line_heights(images.surface_line(frames(spark, sf), 1.0, trials=500), above=0)


@query(f"WITH {FRAMES_SQL}, o AS (SELECT run_id, frame_no, unnest(range(10)) AS y FROM f) SELECT run_id, frame_no, CAST(o.y AS BIGINT) AS y, CAST(coalesce(sum(v), 255 * 8) AS BIGINT) AS total FROM o LEFT JOIN (SELECT run_id, frame_no, y + 2 AS y, v FROM g) USING (run_id, frame_no, y) GROUP BY run_id, frame_no, o.y")
def s7_pad_top(spark: SparkSession, sf: str) -> DataFrame:
    out = values(images.padded_top(frames(spark, sf), 10)).groupBy("run_id", "frame_no", F.floor(F.col("k") / 8).alias("y")).agg(F.sum("v").alias("total"))
    return typed(out, "run_id int, frame_no bigint, y bigint, total bigint")


#: Weights of four neighbours at both places between pixels that an enlargement by two asks for.
CUBIC_SQL = """w AS (SELECT * FROM (VALUES (0, -2, -0.03515625::DOUBLE), (0, -1, 0.26171875), (0, 0, 0.87890625), (0, 1, -0.10546875), (1, -1, -0.10546875), (1, 0, 0.87890625), (1, 1, 0.26171875), (1, 2, -0.03515625)) AS t(half, step, weight))"""


@query(f"""WITH {FRAMES_SQL}, {CUBIC_SQL}, c AS (SELECT g.run_id, g.frame_no, 2 * g.x + a.half AS x, 2 * g.y + b.half AS y, sum(a.weight * b.weight * h.v) AS s
  FROM g CROSS JOIN w a CROSS JOIN w b JOIN g h ON h.run_id = g.run_id AND h.frame_no = g.frame_no AND h.x = least(7, greatest(0, g.x + a.step)) AND h.y = least(7, greatest(0, g.y + b.step)) GROUP BY ALL)
SELECT run_id, frame_no, CAST(y * 16 + x AS BIGINT) AS k, CAST(least(255, greatest(0, floor(s + 0.5))) AS BIGINT) AS v FROM c""")
def i2_cubic(spark: SparkSession, sf: str) -> DataFrame:
    return pixels(images.map_pixels(frames(spark, sf), lambda a: kernels.cubic(a, 16, 16)))


@query(f"""WITH {FRAMES_SQL}, c AS (SELECT run_id, frame_no, CAST(k AS BIGINT) AS k, px[3 * k + 1] AS r, px[3 * k + 2] AS gr, px[3 * k + 3] AS b FROM (SELECT *, unnest(range(21)) AS k FROM f)),
y AS (SELECT *, 0.299::DOUBLE * r + 0.587::DOUBLE * gr + 0.114::DOUBLE * b AS y FROM c)
SELECT run_id, frame_no, k, CAST(floor(y + 0.5) AS BIGINT) AS y, CAST(least(255, greatest(0, floor((r - y) * 0.713::DOUBLE + 128 + 0.5))) AS BIGINT) AS cr, CAST(least(255, greatest(0, floor((b - y) * 0.564::DOUBLE + 128 + 0.5))) AS BIGINT) AS cb FROM y""")
def i15_luma_chroma(spark: SparkSession, sf: str) -> DataFrame:
    return rows_of(frames(spark, sf), lambda a: (np.arange(21), *(c.ravel() for c in kernels.luma_chroma(a.ravel()[:63].reshape(1, 21, 3)))), "k bigint, y bigint, cr bigint, cb bigint")


@query(f"""WITH {FRAMES_SQL}, m AS (SELECT *, min(v) OVER w AS low, max(v) OVER w AS high FROM g WINDOW w AS (PARTITION BY run_id, frame_no))
SELECT run_id, frame_no, 24 AS height, 24 AS width, CAST(sum(9 * v) AS BIGINT) AS total FROM (SELECT run_id, frame_no, floor(CAST(CAST(CAST(v - low AS DOUBLE) / (high - low) AS FLOAT) AS DOUBLE) * 255.0::DOUBLE) AS v FROM m) GROUP BY run_id, frame_no""")
def r1_r2_network(spark: SparkSession, sf: str) -> DataFrame:
    """The network under weights that repeat each pixel: three times as high and wide, nine times the sum."""
    model = images._Once(lambda: network.network(network.plain()))
    out = images.totals(images.map_pixels(frames(spark, sf), lambda a: images.enlarged(a, lambda x: model(x).astype(float), smooth=False)))
    return typed(out, "run_id int, frame_no bigint, height int, width int, total bigint")


@query()
def r3_upscale(spark: SparkSession, sf: str) -> DataFrame:
    return typed(images.totals(images.upscaled(frames(spark, sf))), "run_id int, frame_no bigint, height int, width int, total bigint, sr_model string")


class Brightest:
    """Stands in for a model: a box around the first of the brightest pixels, surer the brighter it is."""

    def detect(self, image: np.ndarray) -> list[tuple[float, float, float, float, float]]:
        y, x = divmod(int(image.argmax()), image.shape[1])
        return [(x, y, x + 1, y + 1, float(image.max()) / 255)]


@query(f"""WITH {FRAMES_SQL}, b AS (SELECT run_id, frame_no, arg_min(x, y * 8 + x) AS x, arg_min(y, y * 8 + x) AS y, any_value(v) AS v FROM (SELECT *, max(v) OVER (PARTITION BY run_id, frame_no) AS m FROM g) WHERE v = m GROUP BY run_id, frame_no)
SELECT run_id, frame_no, CAST(x AS DOUBLE) AS x1, CAST(y AS DOUBLE) AS y1, x + 1.0::DOUBLE AS x2, y + 1.0::DOUBLE AS y2, round(v / 255.0::DOUBLE, 6) AS conf FROM b""")
def t12_detector(spark: SparkSession, sf: str) -> DataFrame:
    return detect.boxes(frames(spark, sf), Brightest).withColumn("conf", F.round("conf", 6))


class Sums:
    """Emits the sum of the pixels between the bounds, and nothing at the end."""

    def forward(self, key: tuple, image: np.ndarray, endpoint: int, beginning: int) -> list[tuple]:
        return [(*key, int(image[:, endpoint:beginning].sum()))]

    def finish(self) -> list[tuple]:
        return []


@query(f"WITH {FRAMES_SQL} SELECT run_id, frame_no, CAST(sum(v) AS BIGINT) AS total FROM g WHERE x BETWEEN 2 AND 5 AND frame_no % 3 = 0 GROUP BY run_id, frame_no")
def t14_emitter(spark: SparkSession, sf: str) -> DataFrame:
    bounded = frames(spark, sf).withColumns({"endpoint": F.when(F.col("frame_no") % 3 == 0, 2), "beginning": F.lit(6)})
    return sinks.emitted(bounded, Sums, "run_id int, frame_no bigint, total bigint")


@query()
def k3_ordered_edges(spark: SparkSession, sf: str) -> DataFrame:
    return edges.ordered_edges(frames(spark, sf).withColumns({"endpoint": F.lit(1), "beginning": F.lit(7)}), 1, 120, 3)


@query(f"""WITH RECURSIVE {FRAMES_SQL}, {window_sql("ed", "g", 2)}, {parts_sql("SELECT run_id, frame_no, x, y FROM w2 WHERE v <= 120")}
SELECT f.run_id, f.frame_no, CAST(count(x) AS INTEGER) AS masked FROM f LEFT JOIN part USING (run_id, frame_no) GROUP BY f.run_id, f.frame_no""")
def e6_reflection_mask(spark: SparkSession, sf: str) -> DataFrame:
    return blanks(images.reflection_mask(frames(spark, sf), dark=120), "masked")


@query(f"""WITH RECURSIVE {FRAMES_SQL}, {BLUR_SQL}, {parts_sql("SELECT run_id, frame_no, x, y FROM dim WHERE v > 125")}
SELECT g.run_id, g.frame_no, CAST(count(*) FILTER (g.v = 0 OR part.x IS NOT NULL) AS INTEGER) AS blanked
FROM g LEFT JOIN part ON part.run_id = g.run_id AND part.frame_no = g.frame_no AND part.x = g.x AND part.y = g.y GROUP BY g.run_id, g.frame_no""")
def e7_boundary_mask(spark: SparkSession, sf: str) -> DataFrame:
    return blanks(images.boundary_mask(frames(spark, sf), 130), "blanked")


def blanks(out: DataFrame, name: str) -> DataFrame:
    return with_kernel(out, lambda a: (int((a == 0).sum()),), f"{name} int", keep=["run_id", "frame_no"])


# Edges, fits and angles


def points(spark: SparkSession, sf: str, low: int = 110, high: int = 255) -> DataFrame:
    return edges.edge_points(frames(spark, sf), low, high)


@query(f"WITH {FRAMES_SQL}, {POINTS_SQL.format(low=150, high=255)} SELECT run_id, frame_no, i, j FROM e")
def e1_edges(spark: SparkSession, sf: str) -> DataFrame:
    return points(spark, sf, 150)


@query(f"WITH {FRAMES_SQL}, {POINTS_SQL.format(low=110, high=127)} SELECT run_id, frame_no, i, j FROM e")
def e1_edges_int8(spark: SparkSession, sf: str) -> DataFrame:
    return points(spark, sf, 110, 127)


NEAR_SQL = "o AS (SELECT *, {f}(i) OVER (PARTITION BY run_id, frame_no) AS oi FROM e), n AS (SELECT run_id, frame_no, i, j, CAST((i - oi) * (i - oi) + j * j AS BIGINT) AS d2 FROM o), {name} AS (SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY run_id, frame_no ORDER BY d2, i, j) AS INTEGER) AS rank FROM n) WHERE rank <= 6)"


@query(f"WITH {FRAMES_SQL}, {POINTS}, {NEAR_SQL.format(f='min', name='a')} SELECT * FROM a")
def e2_advancing(spark: SparkSession, sf: str) -> DataFrame:
    return edges.nearest(points(spark, sf), 6, "advancing")


@query(f"WITH {FRAMES_SQL}, {POINTS}, {NEAR_SQL.format(f='max', name='a')} SELECT * FROM a")
def e3_receding(spark: SparkSession, sf: str) -> DataFrame:
    return edges.nearest(points(spark, sf), 6, "receding")


@query(f"WITH {FRAMES_SQL}, {POINTS} SELECT run_id, frame_no, i, j, CAST(i * i + j * j AS BIGINT) AS d2, CAST(row_number() OVER (PARTITION BY run_id, frame_no ORDER BY i * i + j * j, i, j) - 1 AS INTEGER) AS ord FROM e")
def e4_distance_sort(spark: SparkSession, sf: str) -> DataFrame:
    return edges.by_distance(points(spark, sf))


@query(f"""WITH RECURSIVE {FRAMES_SQL}, {POINTS}, s AS (SELECT run_id, frame_no, list({{'j': j, 'i': i}}) AS pts FROM e GROUP BY run_id, frame_no), r AS (
  SELECT run_id, frame_no, 0 AS ord, list_min(pts).i AS i, list_min(pts).j AS j, list_filter(pts, lambda p: p <> list_min(pts)) AS rest FROM s
  UNION ALL
  SELECT run_id, frame_no, ord + 1, n.i, n.j, list_filter(rest, lambda p: p.i <> n.i OR p.j <> n.j)
  FROM (SELECT run_id, frame_no, ord, rest, list_min(list_transform(rest, lambda p: {{'d': (p.i - i) * (p.i - i) + (p.j - j) * (p.j - j), 'j': p.j, 'i': p.i}})) AS n FROM r WHERE len(rest) > 0)
) SELECT run_id, frame_no, ord, i, j FROM r""")
def e5_nn_path(spark: SparkSession, sf: str) -> DataFrame:
    return edges.nearest_path(points(spark, sf))


@query(f"WITH {FRAMES_SQL} SELECT run_id, frame_no, count(*) AS n, round(regr_slope(v, x), 6) AS slope, round(regr_intercept(v, x), 6) AS intercept FROM p GROUP BY run_id, frame_no")
def m1_fit1(spark: SparkSession, sf: str) -> DataFrame:
    out = fit.line_fit(frames(spark, sf).select("run_id", "frame_no", F.posexplode("v").alias("x", "v")), "x", "v")
    return out.select("run_id", "frame_no", "n", F.round("slope", 6).alias("slope"), F.round("intercept", 6).alias("intercept"))


@query(f"""WITH {FRAMES_SQL}, c AS (SELECT run_id, frame_no, x - avg(x) OVER (PARTITION BY run_id, frame_no) AS u, v FROM p),
s AS (SELECT run_id, frame_no, CAST(count(*) AS DOUBLE) AS n, sum(u*u) AS s2, sum(u*u*u) AS s3, sum(u*u*u*u) AS s4, sum(v) AS t0, sum(v*u) AS t1, sum(v*u*u) AS t2 FROM c GROUP BY ALL),
q AS (SELECT *, n*s2*s4 - n*s3*s3 - s2*s2*s2 AS det FROM s)
SELECT run_id, frame_no, round((t0*(s2*s4 - s3*s3) + t1*s2*s3 - t2*s2*s2) / det, 6) AS c0,
  round((t0*s2*s3 + t1*(n*s4 - s2*s2) - t2*n*s3) / det, 6) AS c1, round((t2*n*s2 - t0*s2*s2 - t1*n*s3) / det, 6) AS c2 FROM q""")
def m1_fit2(spark: SparkSession, sf: str) -> DataFrame:
    out = fit.parabola_fit(frames(spark, sf).select("run_id", "frame_no", F.posexplode("v").alias("x", "v")), "x", "v")
    return out.select("run_id", "frame_no", *[F.round(c, 6).alias(c) for c in ("c0", "c1", "c2")])


@query(f"""WITH {FRAMES_SQL}, c AS (SELECT run_id, frame_no, x - 31.5::DOUBLE AS u, v FROM p),
s AS (SELECT run_id, frame_no, 64.0::DOUBLE AS n, sum(u * u) AS s2, sum(u * u * u * u) AS s4, sum(u * u * u * u * u * u) AS s6, sum(v) AS t0, sum(v * u) AS t1, sum(v * u * u) AS t2, sum(v * u * u * u) AS t3 FROM c GROUP BY ALL),
q AS (SELECT *, (n * t2 - s2 * t0) / (n * s4 - s2 * s2) AS c2, (s2 * t3 - s4 * t1) / (s2 * s6 - s4 * s4) AS c3 FROM s)
SELECT run_id, frame_no, CAST(k AS INTEGER) AS k, round((t0 - c2 * s2) / n + (t1 - c3 * s4) / s2 * (7 * k - 31.5::DOUBLE) + c2 * (7 * k - 31.5::DOUBLE) ** 2 + c3 * (7 * k - 31.5::DOUBLE) ** 3, 6) AS y FROM (SELECT *, unnest(range(10)) AS k FROM q)""")
def m1_fit3_sampled(spark: SparkSession, sf: str) -> DataFrame:
    out = fit.polynomial_fit(frames(spark, sf).select("run_id", "frame_no", F.posexplode("v").alias("x", "v")), "x", "v", 3, 10)
    return out.select("run_id", "frame_no", F.posexplode("ys").alias("k", "y")).select("run_id", "frame_no", "k", F.round("y", 6).alias("y"))


ANGLES_SQL = f"""{FRAMES_SQL}, {POINTS}, {NEAR_SQL.format(f='min', name='a')},
{NEAR_SQL.format(f='max', name='r').replace('o AS', 'o2 AS').replace('FROM o)', 'FROM o2)').replace(', n AS', ', n2 AS').replace('FROM n)', 'FROM n2)')},
la AS (SELECT run_id, frame_no, CASE WHEN var_pop(j) > 0 THEN regr_slope(i, j) END AS s, CASE WHEN var_pop(j) > 0 THEN regr_intercept(i, j) END AS c FROM a GROUP BY ALL),
lr AS (SELECT run_id, frame_no, CASE WHEN var_pop(j) > 0 THEN regr_slope(i, j) END AS s, CASE WHEN var_pop(j) > 0 THEN regr_intercept(i, j) END AS c FROM r GROUP BY ALL),
angles AS (SELECT la.run_id, la.frame_no, 90 - degrees(atan(la.s)) AS adv, 90 + degrees(atan(lr.s)) AS rec, la.c AS left_point, lr.c AS right_point FROM la JOIN lr USING (run_id, frame_no))"""


@query(f"WITH {ANGLES_SQL} SELECT run_id, frame_no, round(adv, 4) AS adv, round(rec, 4) AS rec, round(left_point, 4) + 0.0 AS left_point, round(right_point, 4) + 0.0 AS right_point FROM angles")
def m2_m3_angles(spark: SparkSession, sf: str) -> DataFrame:
    out = fit.contact_angles(points(spark, sf), 6)
    return out.select("run_id", "frame_no", F.round("adv", 4).alias("adv"), F.round("rec", 4).alias("rec"), *[(F.round(c, 4) + 0.0).alias(c) for c in ("left_point", "right_point")])


@query("""SELECT event_id, CASE WHEN value <= 60 THEN 60 WHEN value <= 105 THEN 85 WHEN value <= 135 THEN 125 ELSE 145 END AS pixels,
CASE WHEN value <= 105 THEN 2 WHEN value <= 135 THEN 3 ELSE 4 END AS degree FROM events WHERE value IS NOT NULL""")
def m5_order(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", C.fit_window(F.col("value")).alias("w")).filter("w is not null").select("event_id", "w.pixels", "w.degree")


@query("SELECT d.doc_id, min(l.quality) AS endpoint, min(l.quality) IS NULL AS missing FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY d.doc_id")
def m7_lookup(spark: SparkSession, sf: str) -> DataFrame:
    detections = table(spark, sf, "labels").select("doc_id", F.col("quality").alias("endpoint"), F.col("toxic").alias("beginning"))
    return fit.lookup_bounds(table(spark, sf, "documents").select("doc_id"), detections, ["doc_id"]).select("doc_id", "endpoint", "missing")


SIDES_SQL = """
tops AS (SELECT run_id, frame_no, max(j) AS top FROM e GROUP BY ALL),
mids AS (SELECT run_id, frame_no, floor(avg(i)) AS mid FROM e JOIN tops USING (run_id, frame_no) WHERE j = top GROUP BY ALL),
sided AS (SELECT e.*, i <= mid AS is_left FROM e JOIN mids USING (run_id, frame_no))"""


def extreme_sql(name: str, source: str, where: str, line: str, value: str, start: str, beyond: int) -> str:
    """SQL of ``centers._extreme``: where the values of a line that follow its start without a hole end."""
    sign, order = ("-", "DESC") if start == "max" else ("+", "ASC")
    return f"""{name} AS (
  SELECT run_id, frame_no, {line}, CAST(coalesce(first {sign} (min(k) FILTER ({value} <> first {sign} k)) + {beyond}, first) AS DOUBLE) AS {name}_v FROM (
    SELECT run_id, frame_no, {line}, {value}, row_number() OVER (PARTITION BY run_id, frame_no, {line} ORDER BY {value} {order}) - 1 AS k,
      {start}({value}) OVER (PARTITION BY run_id, frame_no, {line}) AS first
    FROM (SELECT DISTINCT run_id, frame_no, {line}, {value} FROM {source} WHERE {where})) GROUP BY run_id, frame_no, {line}, first)"""


H_SQL = f"""{SIDES_SQL}, {extreme_sql('hl', 'sided', 'is_left', 'j', 'i', 'max', -1)}, {extreme_sql('hr', 'sided', 'NOT is_left', 'j', 'i', 'min', 1)},
lasts AS (SELECT run_id, frame_no, max(j) - 1 AS last FROM sided WHERE is_left GROUP BY ALL),
hw AS (SELECT run_id, frame_no, sum(abs(hr_v - hl_v)) AS w, sum(abs(hr_v - hl_v) * (hr_v + hl_v) / 2) AS s
  FROM hl JOIN hr USING (run_id, frame_no, j) JOIN lasts USING (run_id, frame_no) WHERE j BETWEEN 0 AND last GROUP BY ALL),
hc AS (SELECT run_id, frame_no, CASE WHEN w > 0 THEN s / w ELSE 0.0 END AS h_center FROM (SELECT DISTINCT run_id, frame_no FROM e) LEFT JOIN hw USING (run_id, frame_no))"""

V_SQL = f"""outs AS (SELECT run_id, frame_no, min(i) FILTER (is_left) AS il, max(i) FILTER (NOT is_left) AS ir FROM sided GROUP BY ALL),
turns AS (SELECT run_id, frame_no, is_left, floor(avg(j)) AS m FROM sided JOIN outs USING (run_id, frame_no) WHERE (is_left AND i = il) OR (NOT is_left AND i = ir) GROUP BY ALL),
parts AS (SELECT sided.*, j > m AS up FROM sided JOIN turns USING (run_id, frame_no, is_left)),
ends AS (SELECT run_id, frame_no, min(i) FILTER (is_left AND NOT up) AS min_ld, max(i) FILTER (is_left AND NOT up) AS max_ld, max(i) FILTER (is_left AND up) AS max_lu,
  min(i) FILTER (NOT is_left AND NOT up) AS min_rd, max(i) FILTER (NOT is_left AND NOT up) AS max_rd, min(i) FILTER (NOT is_left AND up) AS min_ru FROM parts GROUP BY ALL),
{extreme_sql('lu', 'parts', 'is_left AND up', 'i', 'j', 'min', -1)}, {extreme_sql('ld', 'parts', 'is_left AND NOT up', 'i', 'j', 'max', 1)},
{extreme_sql('ru', 'parts', 'NOT is_left AND up', 'i', 'j', 'min', -1)}, {extreme_sql('rd', 'parts', 'NOT is_left AND NOT up', 'i', 'j', 'max', 1)},
vr AS (
  SELECT run_id, frame_no, lu_v AS a, ld_v AS b FROM lu JOIN ld USING (run_id, frame_no, i) JOIN ends USING (run_id, frame_no) WHERE i >= min_ld + 1 AND i < max_ld
  UNION ALL SELECT run_id, frame_no, lu_v, 0 FROM lu JOIN ends USING (run_id, frame_no) WHERE i >= max_ld AND i < max_lu
  UNION ALL SELECT run_id, frame_no, ru_v, rd_v FROM ru JOIN rd USING (run_id, frame_no, i) JOIN ends USING (run_id, frame_no) WHERE i >= min_rd AND i < max_rd - 1
  UNION ALL SELECT run_id, frame_no, ru_v, 0 FROM ru JOIN ends USING (run_id, frame_no) WHERE i >= min_ru AND i < min_rd),
vw AS (SELECT run_id, frame_no, sum(abs(a - b)) AS w, sum(abs(a - b) * (a + b) / 2) AS s FROM vr GROUP BY ALL),
vc AS (SELECT run_id, frame_no, CASE WHEN w > 0 THEN s / w ELSE 0.0 END AS v_center FROM (SELECT DISTINCT run_id, frame_no FROM e) LEFT JOIN vw USING (run_id, frame_no))"""


@query(f"WITH {FRAMES_SQL}, {POINTS}, {H_SQL} SELECT run_id, frame_no, round(h_center, 4) AS h_center FROM hc")
def m8_hcenter(spark: SparkSession, sf: str) -> DataFrame:
    return centers.frame_centers(frames(spark, sf), 110, 255, 1).filter("h_center is not null").select("run_id", "frame_no", F.round("h_center", 4).alias("h_center"))


@query(f"WITH {FRAMES_SQL}, {POINTS}, {SIDES_SQL}, {V_SQL} SELECT run_id, frame_no, round(v_center, 4) AS v_center FROM vc")
def m9_vcenter(spark: SparkSession, sf: str) -> DataFrame:
    return centers.frame_centers(frames(spark, sf), 110, 255, 1).filter("v_center is not null").select("run_id", "frame_no", F.round("v_center", 4).alias("v_center"))


@query(f"""WITH {TRACK_SQL}, c AS (SELECT event_id, x1, CAST(x1 AS DOUBLE) AS left_point, CAST(x2 AS DOUBLE) AS right_point, x_center AS h_center, x_center / 2 AS v_center, 0.0039062::DOUBLE / 3 AS u FROM t)
SELECT event_id, round((right_point - left_point) * u, 6) AS contact_line_length, round((3744 - left_point - x1 * 3) * u, 6) AS left_point_cm,
  round((3744 - right_point - x1 * 3) * u, 6) AS right_point_cm, round((3744 - h_center) * u, 6) AS x_center, round(v_center * u, 6) AS y_center FROM c""")
def m10_m13_to_cm(spark: SparkSession, sf: str) -> DataFrame:
    x = F.col("x_center")
    px = track(spark, sf).select("event_id", "x1", F.col("x1").cast("double").alias("left_point"), F.col("x2").cast("double").alias("right_point"), x.alias("h_center"), (x / 2).alias("v_center"))
    return kinematics.to_cm(px).select("event_id", *[F.round(c, 6).alias(c) for c in ("contact_line_length", "left_point_cm", "right_point_cm", "x_center", "y_center")])


@query(f"""WITH {FRAMES_SQL}, {POINTS}, {H_SQL}, {V_SQL},
k AS (SELECT e.*, h_center, v_center, row_number() OVER (PARTITION BY run_id, frame_no ORDER BY abs(i - floor(h_center)), i, j) AS rn FROM e JOIN hc USING (run_id, frame_no) JOIN vc USING (run_id, frame_no))
SELECT run_id, frame_no, abs(min(j) - min(j) FILTER (rn = 1)) AS drop_height, max(i) FILTER (j = floor(v_center)) - min(i) FILTER (j = floor(v_center)) AS drop_length FROM k GROUP BY run_id, frame_no""")
def m14_m15_extent(spark: SparkSession, sf: str) -> DataFrame:
    found = points(spark, sf)
    both = centers.horizontal_center(found, 1).join(centers.vertical_center(found, 1), ["run_id", "frame_no"])
    return fit.extent(found, both)


@query(f"""WITH {FRAMES_SQL}, {POINTS}, m AS (SELECT run_id, frame_no, j, (min(i) + max(i)) / 2.0 AS mean_i FROM e GROUP BY ALL),
l AS (SELECT run_id, frame_no, CASE WHEN var_pop(mean_i) > 0 THEN regr_slope(j, mean_i) END AS slope FROM m GROUP BY ALL)
SELECT run_id, frame_no, round(-degrees(atan(slope)), 4) + 0.0 AS middle_angle_degree FROM l""")
def m16_middle_angle(spark: SparkSession, sf: str) -> DataFrame:
    return fit.middle_line(points(spark, sf)).select("run_id", "frame_no", (F.round("middle_angle_degree", 4) + 0.0).alias("middle_angle_degree"))


@query(f"""WITH {TRACK_SQL}, o AS (SELECT *, row_number() OVER w AS n, lead(x_center) OVER w AS nx, lead(event_id) OVER w AS ne FROM t WINDOW w AS (PARTITION BY run_id ORDER BY ts, event_id))
SELECT run_id, event_id, (n - 1) / 4000.0::DOUBLE AS time_s, ne - event_id > 1 AS gap, round((nx - x_center) * 4000, 6) AS velocity FROM o WHERE ne IS NOT NULL""")
def m18_kinematics(spark: SparkSession, sf: str) -> DataFrame:
    out = kinematics.kinematics(track(spark, sf).select("run_id", "ts", "event_id", "x_center"), ["ts", "event_id"], 4000.0, index=F.col("event_id"))
    return out.select("run_id", "event_id", "time_s", "gap", F.round("velocity", 6).alias("velocity"))


# Whole plans and sinks


#: Straight lines in both passes, for SQL: six points at first, then by the first angle.
LINES = fit.TwoPass((6, 1), (6, 1), ((60.0, 4, 1), (105.0, 5, 1), (135.0, 6, 1), (None, 7, 1)))


def _pass_sql(name: str, side: str, count: str, source: str) -> str:
    f = "min" if side == "left" else "max"
    return f"""{name} AS (SELECT run_id, frame_no, CASE WHEN count(DISTINCT j) > 1 THEN regr_slope(i, j) END AS s, CASE WHEN count(DISTINCT j) > 1 THEN regr_intercept(i, j) + regr_slope(i, j) * min(j) END AS c
  FROM (SELECT *, row_number() OVER (PARTITION BY run_id, frame_no ORDER BY (i - oi) * (i - oi) + j * j, i, j) AS rank FROM (SELECT *, {f}(i) OVER (PARTITION BY run_id, frame_no) AS oi FROM e)) {source} WHERE rank <= {count} GROUP BY run_id, frame_no)"""


def _two_pass_sql() -> str:
    sides = []
    for side, sign in (("left", "-"), ("right", "+")):
        angle = f"90 {sign} degrees(atan(s))"
        sides.append(_pass_sql(f"{side}1", side, "6", ""))
        sides.append(f"{side}n AS (SELECT run_id, frame_no, CASE WHEN {angle} <= 60 THEN 4 WHEN {angle} <= 105 THEN 5 WHEN {angle} <= 135 THEN 6 ELSE 7 END AS n FROM {side}1 WHERE s IS NOT NULL)")
        sides.append(_pass_sql(f"{side}2", side, "n", f"JOIN {side}n USING (run_id, frame_no)"))
    return ", ".join(sides) + """, angles AS (SELECT run_id, frame_no, 90 - degrees(atan(left2.s)) AS adv, 90 + degrees(atan(right2.s)) AS rec, left2.c AS left_point, right2.c AS right_point
  FROM (SELECT DISTINCT run_id, frame_no FROM e) LEFT JOIN left2 USING (run_id, frame_no) LEFT JOIN right2 USING (run_id, frame_no))"""


@query(f"WITH {FRAMES_SQL}, {POINTS}, {_two_pass_sql()} SELECT run_id, frame_no, round(adv, 4) AS adv, round(rec, 4) AS rec, round(left_point, 4) + 0.0 AS left_point, round(right_point, 4) + 0.0 AS right_point FROM angles")
def m6_two_pass(spark: SparkSession, sf: str) -> DataFrame:
    out = fit.frame_angles(frames(spark, sf), 110, 255, LINES)
    return out.select("run_id", "frame_no", *[(F.round(c, 4) + 0.0).alias(c) for c in ("adv", "rec", "left_point", "right_point")])


@query(f"""WITH {FRAMES_SQL}, {POINTS}, {_two_pass_sql()}, {H_SQL}, {V_SQL},
x AS (SELECT a.run_id, a.frame_no, adv, rec, (right_point - left_point) * (0.0039062::DOUBLE / 3) AS contact_line_length, (3744 - h_center) * (0.0039062::DOUBLE / 3) AS x_center,
  v_center * (0.0039062::DOUBLE / 3) AS y_center FROM angles a JOIN hc USING (run_id, frame_no) JOIN vc USING (run_id, frame_no)
  WHERE adv IS NOT NULL AND rec IS NOT NULL),
series AS (SELECT *, row_number() OVER w AS n, lead(x_center) OVER w AS nx, lead(frame_no) OVER w AS nf FROM x WINDOW w AS (PARTITION BY run_id ORDER BY frame_no))
SELECT run_id, frame_no, (n - 1) / 4000.0::DOUBLE AS time_s, round(x_center, 5) AS x_center, round(adv, 4) AS adv, round(rec, 4) AS rec, round(contact_line_length, 5) + 0.0 AS contact_line_length,
  round(y_center, 5) AS y_center, nf - frame_no > 1 AS gap, round((nx - x_center) * 4000, 4) + 0.0 AS velocity FROM series WHERE nx IS NOT NULL""")
def v1_analysis(spark: SparkSession, sf: str) -> DataFrame:
    rows = measured(frames(spark, sf).withColumn("x1", F.lit(0)), 110, 255, 1, fits=LINES)
    out = kinematics.kinematics(rows.filter("error_class is null"), ["frame_no"], 4000.0, index=F.col("frame_no"))
    digits = {"x_center": 5, "adv": 4, "rec": 4, "contact_line_length": 5, "y_center": 5, "velocity": 4}
    return out.select("run_id", "frame_no", "time_s", "gap", *[(F.round(c, n) + (0.0 if c in ("contact_line_length", "velocity") else F.lit(0.0))).alias(c) for c, n in digits.items()])


@query("SELECT doc_id AS frame_no, 'lookup' AS stage, 'MissingDetection' AS error_class, 'no detection of document ' || doc_id AS message FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def k10_error_rows(spark: SparkSession, sf: str) -> DataFrame:
    found = m7_lookup(spark, sf).withColumn("error_class", F.when(F.col("missing"), "MissingDetection"))
    message = F.concat(F.lit("no detection of document "), F.col("doc_id")).alias("message")
    return sinks.errors(found.select(F.lit(0).alias("run_id"), F.col("doc_id").alias("frame_no"), "error_class", message), "lookup").select("frame_no", "stage", "error_class", "message")


@query("""SELECT o_custkey AS run_id, CASE WHEN count(*) FILTER (o_orderstatus = 'F') = count(*) THEN 'failed' WHEN count(*) FILTER (o_orderstatus = 'F') > 0 THEN 'done_with_errors' ELSE 'done' END AS status
FROM orders GROUP BY o_custkey""")
def k11_run_status(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "orders").select(F.col("o_custkey").alias("run_id"), F.when(F.col("o_orderstatus") == "F", "F").alias("error_class"))
    return sinks.run_status(rows).select("run_id", "status")


@query("SELECT user_id AS run_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS INTEGER) AS ord, printf('frame_%06d.png', event_id) AS file FROM events")
def k6_manifest(spark: SparkSession, sf: str) -> DataFrame:
    named = track(spark, sf).withColumn("file", F.format_string("frame_%06d.png", "event_id"))
    return sinks.manifest(named, ["ts", "event_id"]).select("run_id", "ord", "file")


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
