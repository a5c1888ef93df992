"""Colour transforms on part-derived colours, LAB grids and the colour-word lookup."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.colour import COLOUR_RGB, RGB_TO_XYZ, WHITE_D65, XYZ_TO_RGB, lab_to_rgb, rgb_to_hsv, rgb_to_lab
from ..session import table
from .registry import register

P = 6  # decimals kept in both engines


def part_colours(spark, sf_dir):
    """part → (p_partkey, p_type, R, G, B) bytes."""
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", "p_type",
                    (F.col("p_partkey") % 256).cast("int").alias("R"),
                    (F.col("p_partkey") * 7 % 256).cast("int").alias("G"),
                    (F.col("p_size") * 5 % 256).cast("int").alias("B"))


PART_RGB_SQL = """
rgb AS (SELECT p_partkey, p_type, CAST(p_partkey % 256 AS INTEGER) AS R,
               CAST(p_partkey * 7 % 256 AS INTEGER) AS G, CAST(p_size * 5 % 256 AS INTEGER) AS B FROM part)"""


def _sql_lab(src: str) -> str:
    """DuckDB text of the LAB conversion over a relation with R, G, B bytes."""
    lin = {c: f"CASE WHEN {c}/255.0 > 0.04045 THEN pow(({c}/255.0 + 0.055) / 1.055, 2.4) ELSE {c}/255.0 / 12.92 END"
           for c in "RGB"}
    xyz = []
    for row, w in zip(RGB_TO_XYZ, WHITE_D65):
        xyz.append(f"(({float(row[0])!r} * lin_r + {float(row[1])!r} * lin_g + {float(row[2])!r} * lin_b) / {float(w)!r})")
    f = {n: f"CASE WHEN {t} > 0.008856 THEN pow({t}, 1.0 / 3.0) ELSE 7.787 * {t} + 16.0 / 116.0 END"
         for n, t in zip(("fx", "fy", "fz"), xyz)}
    return f"""
lin AS (SELECT *, {lin['R']} AS lin_r, {lin['G']} AS lin_g, {lin['B']} AS lin_b FROM {src}),
lab AS (SELECT *, {f['fx']} AS fx, {f['fy']} AS fy, {f['fz']} AS fz FROM lin)"""


@register("rgb_to_lab", f"""
WITH {PART_RGB_SQL},{_sql_lab('rgb')}
SELECT p_partkey, R, G, B, round(116 * fy - 16, {P}) AS labL, round(500 * (fx - fy), {P}) AS labA,
       round(200 * (fy - fz), {P}) AS labB
FROM lab
""")
def rgb_to_lab_q(spark, sf_dir):
    c = part_colours(spark, sf_dir)
    l, a, b = rgb_to_lab(F.col("R"), F.col("G"), F.col("B"))
    return c.select("p_partkey", "R", "G", "B", F.round(l, P).alias("labL"),
                    F.round(a, P).alias("labA"), F.round(b, P).alias("labB"))


@register("rgb_to_hsv", f"""
WITH {PART_RGB_SQL},
ends AS (SELECT *, list_max([R, G, B]) AS hi, list_max([R, G, B]) - list_min([R, G, B]) AS width FROM rgb),
turns AS (SELECT *, CASE hi WHEN R THEN G - B WHEN G THEN 2 * width + B - R ELSE 4 * width + R - G END AS turn FROM ends)
SELECT p_partkey, R, G, B,
       round(CASE WHEN width > 0 THEN CAST((turn + 6 * width) % (6 * width) AS DOUBLE) / (6 * width) ELSE 0 END, {P}) AS H,
       round(CASE WHEN hi > 0 THEN CAST(width AS DOUBLE) / hi ELSE 0 END, {P}) AS S,
       round(CAST(hi AS DOUBLE) / 255, {P}) AS V
FROM turns
""")
def rgb_to_hsv_q(spark, sf_dir):
    c = part_colours(spark, sf_dir)
    h, s, v = rgb_to_hsv(F.col("R"), F.col("G"), F.col("B"))
    return c.select("p_partkey", "R", "G", "B", F.round(h, P).alias("H"), F.round(s, P).alias("S"),
                    F.round(v, P).alias("V"))


GRID_RES = 16


def _sql_lab_to_rgb() -> str:
    fy = "((lum + 16.0) / 116.0)"
    fx = f"(a / 500.0 + {fy})"
    fz = f"greatest({fy} - b / 200.0, 0.0)"

    def finv(t):
        return f"(CASE WHEN {t} > 6.0 / 29.0 THEN pow({t}, 3.0) ELSE ({t} - 16.0 / 116.0) / 7.787 END)"

    xyz = [f"({finv(t)} * {w!r})" for t, w in zip((fx, fy, fz), WHITE_D65)]
    out = []
    for row, name in zip(XYZ_TO_RGB, "RGB"):
        lin = f"({float(row[0])!r} * {xyz[0]} + {float(row[1])!r} * {xyz[1]} + {float(row[2])!r} * {xyz[2]})"
        g = f"(CASE WHEN {lin} > 0.0031308 THEN 1.055 * pow({lin}, 1.0 / 2.4) - 0.055 ELSE 12.92 * {lin} END)"
        out.append(f"round(least(greatest({g}, 0.0), 1.0) * 255, 4) AS {name}")
    return ", ".join(out)


@register("grid_points", f"""
WITH {PART_RGB_SQL},{_sql_lab('rgb')},
levels AS (SELECT DISTINCT CAST(round((116 * fy - 16) / 10) * 10 AS INTEGER) AS lum FROM lab),
pts AS (SELECT lum, CAST(k % {GRID_RES} AS INTEGER) AS i, CAST(k // {GRID_RES} AS INTEGER) AS j,
               -100.0 + 200.0 * (k % {GRID_RES}) / {GRID_RES - 1} AS a,
               -100.0 + 200.0 * (k // {GRID_RES}) / {GRID_RES - 1} AS b
        FROM levels, range(0, {GRID_RES * GRID_RES}) t(k))
SELECT lum, i, j, {_sql_lab_to_rgb()}, 'black' AS word FROM pts
""")
def grid_points(spark, sf_dir):
    """A res × res slice of LAB space (a, b in [-100, 100]) at each luminance level
    present in the part colours (L rounded to tens), converted to sRGB bytes,
    with a filler label. Points come from ``sequence`` per level, no cross join."""
    c = part_colours(spark, sf_dir)
    l, _, _ = rgb_to_lab(F.col("R"), F.col("G"), F.col("B"))
    levels = c.select((F.round(l / 10) * 10).cast("int").alias("lum")).distinct()
    n = GRID_RES
    pts = levels.select("lum", F.explode(F.sequence(F.lit(0), F.lit(n * n - 1))).alias("k")).select(
        "lum", (F.col("k") % n).cast("int").alias("i"), (F.col("k") / n).cast("int").alias("j"))
    pts = pts.select("lum", "i", "j",
                     (-100.0 + 200.0 * F.col("i") / (n - 1)).alias("a"),
                     (-100.0 + 200.0 * F.col("j") / (n - 1)).alias("b"))
    r, g, b = lab_to_rgb(F.col("lum").cast("double"), F.col("a"), F.col("b"))
    return pts.select("lum", "i", "j", F.round(r * 255, 4).alias("R"), F.round(g * 255, 4).alias("G"),
                      F.round(b * 255, 4).alias("B"), F.lit("black").alias("word"))


def colour_table(spark):
    """The fixed colour-word table as a DataFrame (11 rows)."""
    rows = [(w, *rgb) for w, rgb in COLOUR_RGB.items()]
    return spark.createDataFrame(rows, "word string, R int, G int, B int")


COLOUR_VALUES_SQL = ", ".join(f"('{w}', {r}, {g}, {b})" for w, (r, g, b) in COLOUR_RGB.items())


@register("label_to_rgb", f"""
WITH colours(word, R, G, B) AS (VALUES {COLOUR_VALUES_SQL})
SELECT p.p_partkey, split_part(p.p_name, ' ', 1) AS word,
       CAST(c.R AS DOUBLE) AS R, CAST(c.G AS DOUBLE) AS G, CAST(c.B AS DOUBLE) AS B
FROM part p LEFT JOIN colours c ON split_part(p.p_name, ' ', 1) = c.word
""")
def label_to_rgb(spark, sf_dir):
    """Colour word → representative RGB by a join with the fixed 11-row table
    (broadcast: its size is fixed); unknown words get NULL colours (as doubles,
    so NULL-able output columns have one type in every client)."""
    p = table(spark, sf_dir, "part").select("p_partkey", F.split("p_name", " ")[0].alias("word"))
    out = p.join(F.broadcast(colour_table(spark)), "word", "left")
    return out.select("p_partkey", "word", *[F.col(c).cast("double").alias(c) for c in "RGB"])
