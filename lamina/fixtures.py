"""Meshes, layouts and images derived from the driver's tables, as Spark frames and as SQL for the check.

Images: every 64 embeddings are one image of 64 columns, a channel a value. Height fields: the same values as
vertices. Layout: a 5 x 5 lattice of cells from the nations, some reversed, one collapsed, one shifted copy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.session import table

#: Resolutions of the test rasters.
RES = 64
VIEW_RES = 32


def pixels(spark: SparkSession, d: str) -> DataFrame:
    """(img, y, x, r, g, b, e); on even images a black hole."""
    e = table(spark, d, "embeddings").select(F.floor(F.col("vec_id") / 64).alias("img"), F.pmod("vec_id", F.lit(64)).cast("int").alias("y"), F.posexplode("embedding").alias("x", "e"))
    hole = (F.pmod("img", F.lit(2)) == 0) & F.col("x").between(44, 52) & F.col("y").between(20, 30)
    c = F.least(F.greatest(F.rint((F.col("e").cast("double") * 2 + 0.4) * 255), F.lit(0.0)), F.lit(255.0)).cast("int")
    v = e.withColumn("c", F.when(hole, 0).otherwise(c))
    return v.select("img", "y", "x", F.col("c").alias("r"), F.greatest(F.col("c") - 5, F.lit(0)).alias("g"), F.greatest(F.col("c") - 9, F.lit(0)).alias("b"))


def valid(p: DataFrame) -> DataFrame:
    """(img, y, x, valid): two islands."""
    disc = (F.col("x") - 20) * (F.col("x") - 20) + (F.col("y") - 32) * (F.col("y") - 32) <= 196
    return p.select("img", "y", "x", (disc | (F.col("x").between(40, 58) & F.col("y").between(12, 50))).alias("valid"))


PX = """px AS (SELECT img, y, x, c AS r, greatest(c - 5, 0) AS g, greatest(c - 9, 0) AS b FROM (
  SELECT img, y, x, CASE WHEN img % 2 = 0 AND x BETWEEN 44 AND 52 AND y BETWEEN 20 AND 30 THEN 0 ELSE CAST(least(greatest(round_even((CAST(e AS double) * 2 + CAST(0.4 AS double)) * 255, 0), 0), 255) AS integer) END AS c
  FROM (SELECT CAST(floor(vec_id / 64) AS bigint) AS img, CAST(vec_id % 64 AS integer) AS y, CAST(unnest(range(len(embedding))) AS integer) AS x, unnest(embedding) AS e FROM embeddings))),
vm AS (SELECT img, y, x, (x - 20) * (x - 20) + (y - 32) * (y - 32) <= 196 OR (x BETWEEN 40 AND 58 AND y BETWEEN 12 AND 50) AS valid FROM px)"""


def lattice(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """(uv_vertices, uv_faces) of two layouts: plain, and overlap with a shifted copy of cell 7."""
    n = table(spark, d, "nation").select(F.col("n_nationkey").alias("n"))
    cell = n.select(F.lit("plain").alias("uid"), "n", F.col("n").alias("c"), F.lit(0.0).alias("s")).unionByName(n.select(F.lit("overlap").alias("uid"), "n", F.col("n").alias("c"), F.lit(0.0).alias("s"))).unionByName(n.filter("n = 7").select(F.lit("overlap").alias("uid"), F.lit(25).alias("n"), F.col("n").alias("c"), F.lit(0.05).alias("s")))
    i, j = F.pmod("c", F.lit(5)), F.floor(F.col("c") / 5)
    flat = F.col("n") == 24
    corner = [(0, 0), (1, 0), (1, 1), (0, 1)]
    pts = F.array(*[F.struct(((i + F.when(flat, 0).otherwise(a)) / 5.0 + F.col("s")).alias("u"), ((j + F.when(flat, 0).otherwise(b)) / 5.0 + F.col("s")).alias("v")) for a, b in corner])
    v = cell.select("uid", "n", F.posexplode(pts).alias("k", "p")).select("uid", (F.col("n") * 4 + F.col("k")).cast("long").alias("tid"), "p.u", "p.v")
    rev = F.pmod("n", F.lit(3)) == 0
    f = cell.select("uid", "n", F.explode(F.array(F.lit(0), F.lit(1))).alias("h"))
    base = F.col("n") * 4
    second, third = base + 1 + F.col("h"), base + 2 + F.col("h")
    f = f.select("uid", (F.col("n") * 2 + F.col("h")).cast("long").alias("fid"), base.cast("long").alias("ta"), F.when(rev, third).otherwise(second).cast("long").alias("tb"), F.when(rev, second).otherwise(third).cast("long").alias("tc"))
    return v, f


LATTICE = """cell AS (SELECT 'plain' AS uid, n_nationkey AS n, n_nationkey AS c, CAST(0 AS double) AS s FROM nation UNION ALL SELECT 'overlap', n_nationkey, n_nationkey, 0 FROM nation UNION ALL SELECT 'overlap', 25, 7, CAST(0.05 AS double) FROM nation WHERE n_nationkey = 7),
uvv AS (SELECT uid, CAST(n * 4 + k AS bigint) AS tid, (c % 5 + CASE WHEN n = 24 THEN 0 ELSE a END) / CAST(5 AS double) + s AS u, (floor(c / 5) + CASE WHEN n = 24 THEN 0 ELSE b END) / CAST(5 AS double) + s AS v
  FROM cell CROSS JOIN (VALUES (0, 0, 0), (1, 1, 0), (2, 1, 1), (3, 0, 1)) t(k, a, b)),
uvf AS (SELECT uid, CAST(n * 2 + h AS bigint) AS fid, CAST(n * 4 AS bigint) AS ta, CAST(n * 4 + CASE WHEN n % 3 = 0 THEN 2 + h ELSE 1 + h END AS bigint) AS tb, CAST(n * 4 + CASE WHEN n % 3 = 0 THEN 1 + h ELSE 2 + h END AS bigint) AS tc FROM cell CROSS JOIN (VALUES (0), (1)) t(h))"""


def tri_sql(res: int) -> str:
    """Triangles of the lattice in texels."""
    r = f"CAST({res} AS double)"
    cols = ", ".join(f"{a}.u * {r} AS px{k}, {a}.v * {r} AS py{k}" for k, a in enumerate("abc"))
    return f"tri AS (SELECT f.uid, f.fid, {cols} FROM uvf f JOIN uvv a ON a.uid = f.uid AND a.tid = f.ta JOIN uvv b ON b.uid = f.uid AND b.tid = f.tb JOIN uvv c ON c.uid = f.uid AND c.tid = f.tc)"


def cells_sql(res: int, keys: list[str], shared: bool, carry: str = "") -> str:
    """CTEs from `tri` to `frag`: cells inside the triangles with their weights."""
    k = ", ".join(keys)
    n = f"{res} - 1"
    margin = f" AND greatest(tx0, tx1, tx2) >= 0 AND least(tx0, tx1, tx2) <= {res} AND greatest(ty0, ty1, ty2) >= 0 AND least(ty0, ty1, ty2) <= {res}" if shared else ""

    def edge(a: int, b: int) -> str:
        return f"(tx{b} - tx{a}) * (cy - ty{a}) - (ty{b} - ty{a}) * (cx - tx{a})"

    def own(e: str, a: int, b: int) -> str:
        return f"{e} >= 0" if shared else f"({e} > 0 OR ({e} = 0 AND (ty{b} - ty{a} < 0 OR (ty{b} - ty{a} = 0 AND tx{b} - tx{a} > 0))))"

    sw = ", ".join(f"CASE WHEN area < 0 THEN p{c}{(0, 2, 1)[i]} ELSE p{c}{i} END AS t{c}{i}" for i in range(3) for c in "xy")
    box = ", ".join(f"CAST(least(greatest({f}({g}(t{c}0, t{c}1, t{c}2) - CAST(0.5 AS double)), 0), {n}) AS integer) AS {c}{i}" for c in "xy" for i, f, g in ((0, "ceil", "least"), (1, "floor", "greatest")))
    return f"""ar AS (SELECT *, (px1 - px0) * (py2 - py0) - (py1 - py0) * (px2 - px0) AS area FROM tri),
    sw AS (SELECT {k}, fid, area < 0 AS swap, {sw}{carry} FROM ar WHERE area <> 0),
    bx AS (SELECT *, {box} FROM sw WHERE true{margin}),
    xs AS (SELECT *, unnest(range(x0, x1 + 1)) AS x FROM bx WHERE x0 <= x1 AND y0 <= y1),
    ys AS (SELECT *, unnest(range(y0, y1 + 1)) AS y FROM xs),
    ct AS (SELECT *, x + CAST(0.5 AS double) AS cx, y + CAST(0.5 AS double) AS cy FROM ys),
    ed AS (SELECT *, {edge(1, 2)} AS e0, {edge(2, 0)} AS e1, {edge(0, 1)} AS e2 FROM ct),
    frag AS (SELECT {k}, fid, CAST(y AS integer) AS y, CAST(x AS integer) AS x, e0 / (e0 + e1 + e2) AS b0, CASE WHEN swap THEN e2 ELSE e1 END / (e0 + e1 + e2) AS b1, CASE WHEN swap THEN e1 ELSE e2 END / (e0 + e1 + e2) AS b2{carry}
      FROM ed WHERE {own('e0', 1, 2)} AND {own('e1', 2, 0)} AND {own('e2', 0, 1)})"""


def height_field(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(vertices, faces, uv_vertices, uv_faces) of one mesh per image: a vertex a value, two triangles a cell."""
    e = table(spark, d, "embeddings").select(F.floor(F.col("vec_id") / 64).alias("uid"), F.pmod("vec_id", F.lit(64)).cast("long").alias("y"), F.posexplode("embedding").alias("x", "e"))
    e = e.withColumn("h", F.col("e").cast("double"))
    vid = (F.col("y") * 64 + F.col("x")).cast("long")
    v = e.select("uid", vid.alias("vid"), (F.col("x") / 63.0).alias("px"), "h", (F.col("y") / 63.0).alias("pz")).select("uid", "vid", F.col("px").alias("x"), F.col("h").alias("y"), F.col("pz").alias("z"))
    uv = e.select("uid", vid.alias("tid"), ((F.col("x") + 0.5) / 64.0).alias("u"), ((F.col("y") + 0.5) / 64.0).alias("v"))
    rows = e.groupBy("uid").agg(F.max("y").alias("last"))
    c = e.join(rows, "uid").filter("y < last and x < 63").select("uid", vid.alias("p"), F.explode(F.array(F.lit(0), F.lit(1))).alias("t"))
    f = c.select("uid", (F.col("p") * 2 + F.col("t")).alias("fid"), F.col("p").alias("a"), (F.col("p") + F.when(F.col("t") == 0, 1).otherwise(65)).cast("long").alias("b"), (F.col("p") + F.when(F.col("t") == 0, 65).otherwise(64)).cast("long").alias("c"))
    return v, f, uv, f.select("uid", "fid", F.col("a").alias("ta"), F.col("b").alias("tb"), F.col("c").alias("tc"))


FIELD = """hf AS (SELECT CAST(floor(vec_id / 64) AS bigint) AS uid, CAST(vec_id % 64 AS bigint) AS y, CAST(unnest(range(len(embedding))) AS bigint) AS x, CAST(unnest(embedding) AS double) AS h FROM embeddings),
mv AS (SELECT uid, y * 64 + x AS vid, x / CAST(63 AS double) AS x, h AS y, y / CAST(63 AS double) AS z FROM hf),
mt AS (SELECT uid, y * 64 + x AS tid, (x + CAST(0.5 AS double)) / 64 AS u, (y + CAST(0.5 AS double)) / 64 AS v FROM hf),
mf AS (SELECT h.uid, (h.y * 64 + h.x) * 2 + t AS fid, h.y * 64 + h.x AS a, h.y * 64 + h.x + CASE WHEN t = 0 THEN 1 ELSE 65 END AS b, h.y * 64 + h.x + CASE WHEN t = 0 THEN 65 ELSE 64 END AS c
  FROM hf h JOIN (SELECT uid, max(y) AS last FROM hf GROUP BY uid) l ON l.uid = h.uid CROSS JOIN (VALUES (0), (1)) t(t) WHERE h.y < l.last AND h.x < 63)"""


def normalized_sql(fit: str = "box") -> str:
    span = "greatest(hx - lx, hy - ly, hz - lz)" if fit == "box" else "2 * r"
    return f"""bb AS (SELECT uid, min(x) AS lx, max(x) AS hx, min(y) AS ly, max(y) AS hy, min(z) AS lz, max(z) AS hz FROM mv GROUP BY uid),
    ce AS (SELECT *, (lx + hx) / 2 AS mx, (ly + hy) / 2 AS my, (lz + hz) / 2 AS mz FROM bb),
    ra AS (SELECT v.uid, max(sqrt((v.x - mx) * (v.x - mx) + (v.y - my) * (v.y - my) + (v.z - mz) * (v.z - mz))) AS r FROM mv v JOIN ce USING (uid) GROUP BY v.uid),
    nv AS (SELECT v.uid, v.vid, (v.x - mx) / ({span} / CAST(1.9 AS double)) AS x, (v.y - my) / ({span} / CAST(1.9 AS double)) AS y, (v.z - mz) / ({span} / CAST(1.9 AS double)) AS z FROM mv v JOIN ce USING (uid) JOIN ra USING (uid))"""


def cameras_sql(rows: list[tuple]) -> str:
    from lamina.operators.view import CAMERA_COLUMNS

    vals = ", ".join("(" + ", ".join([str(r[0]), *[f"CAST('{x!r}' AS double)" for x in r[1:]]]) + ")" for r in rows)
    return f"cam({', '.join(CAMERA_COLUMNS)}) AS (VALUES {vals})"


def fragments_sql(res: int) -> str:
    """CTEs from nv, mf and cam to zb: the nearest fragment of every pixel."""
    dot = lambda a: f"({a}x * (x - ox) + {a}y * (y - oy) + {a}z * (z - oz))"
    r = f"CAST({res} AS double)"
    return f"""pj AS MATERIALIZED (SELECT uid, view, vid, ({dot('r')} * CAST(0.5 AS double) + CAST(0.5 AS double)) * {r} AS px, (1 - ({dot('u')} * CAST(0.5 AS double) + CAST(0.5 AS double))) * {r} AS py, -{dot('k')} AS depth FROM nv CROSS JOIN cam),
    t0 AS MATERIALIZED (SELECT f.*, p.view, p.px AS px0, p.py AS py0, p.depth AS depth0 FROM mf f JOIN pj p ON p.uid = f.uid AND p.vid = f.a),
    t1 AS MATERIALIZED (SELECT f.*, p.px AS px1, p.py AS py1, p.depth AS depth1 FROM t0 f JOIN pj p ON p.uid = f.uid AND p.vid = f.b AND p.view = f.view),
    tri AS MATERIALIZED (SELECT f.uid, f.view, f.fid, px0, py0, px1, py1, p.px AS px2, p.py AS py2, depth0, depth1, p.depth AS depth2 FROM t1 f JOIN pj p ON p.uid = f.uid AND p.vid = f.c AND p.view = f.view),
    {cells_sql(res, ['uid', 'view'], True, ', depth0, depth1, depth2')},
    zf AS (SELECT *, round(depth0 * b0 + depth1 * b1 + depth2 * b2, 9) AS z FROM frag),
    zb AS (SELECT uid, view, y, x, fid, b0, b1, b2, z FROM (SELECT *, row_number() OVER (PARTITION BY uid, view, y, x ORDER BY z, fid) AS n FROM zf) WHERE n = 1)"""
