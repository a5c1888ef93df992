"""Star-schema SQL jobs: outer-join chains, IN-subquery flags, exact medians, JSON paths."""

from __future__ import annotations

import zlib

from pyspark.sql import functions as F

from ..operators.aggregates import first_days_average
from ..operators.joins import null_safe_on
from ..operators.quantiles import exact_median
from ..session import materialize, table
from .registry import register

R = 4


@register("avg_having", f"""
SELECT round(avg(o.o_totalprice), {R}) AS avg_amount, n.n_name AS province, o.o_orderpriority AS mtype
FROM orders o
LEFT JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
GROUP BY n.n_name, o.o_orderpriority
HAVING n.n_name = 'NATION_1'
""")
def avg_having(spark, sf_dir):
    """Average by (province, method) over fact ⟕ dims, HAVING on a group key.

    The dimension chain is joined first (customer ⟕ nation; the nation
    join only references customer columns, so this equals the left-deep
    chain). The HAVING predicate is on a grouping column of the
    null-supplying side, so Catalyst turns the outer joins inner and pushes
    it into the nation scan: only that nation's customers meet the fact
    table, a side small enough for AQE to broadcast at run time.
    """
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    dims = c.join(n, c.c_nationkey == n.n_nationkey, "left")
    j = o.join(dims, o.o_custkey == dims.c_custkey, "left")
    g = j.groupBy(F.col("n_name").alias("province"), F.col("o_orderpriority").alias("mtype")) \
         .agg(F.round(F.avg("o_totalprice"), R).alias("avg_amount"))
    return g.where(F.col("province") == "NATION_1")


PREFIX_VIEW_SQL = """
SELECT c.c_custkey AS custid,
       CASE WHEN c.c_mktsegment IS NOT NULL THEN CAST(EXISTS (
         FROM customer near_by WHERE near_by.c_nationkey < 3 AND near_by.c_mktsegment <> 'MACHINERY'
         AND left(near_by.c_mktsegment, 3) = left(c.c_mktsegment, 3)) AS INTEGER) END AS known_prefix
FROM customer c
"""


def register_prefix_view(spark, sf_dir, name: str | None = None):
    """``custid, known_prefix``: 1/0 whether the code prefix is in a distinct prefix set.

    ``x IN (subquery)`` as a value is a left join to the distinct, non-NULL
    prefix set; a NULL probe stays NULL. The view belongs to the catalog, not
    to the session, under the caller's name (by default one for each data
    folder, so that two of them don't replace each other). It keeps its SQL
    text, not a plan or rows: it lists and reads the files each time it is queried.
    """
    name = name or f"customer_prefix_flags_{zlib.crc32(str(sf_dir).encode()):08x}"
    files = f"parquet.`{sf_dir}/customer.parquet`"
    spark.sql(f"""
        CREATE OR REPLACE VIEW {name} AS
        SELECT c_custkey AS custid,
               IF(c_mktsegment IS NULL, NULL, CAST(prefix IS NOT NULL AS INT)) AS known_prefix
        FROM {files} LEFT JOIN (
          SELECT DISTINCT substring(c_mktsegment, 1, 3) AS prefix FROM {files}
          WHERE c_nationkey < 3 AND c_mktsegment <> 'MACHINERY')
        ON prefix = substring(c_mktsegment, 1, 3)""")
    return spark.table(name)


@register("prefix_flag_view", PREFIX_VIEW_SQL)
def prefix_flag_view(spark, sf_dir):
    return register_prefix_view(spark, sf_dir)


@register("spend_by_region", f"""
WITH flags AS ({PREFIX_VIEW_SQL}),
people AS (SELECT c_custkey, known_prefix, CAST(c_nationkey = 1 AND known_prefix = 0 AS INTEGER) AS other_prefix
           FROM customer JOIN flags ON custid = c_custkey)
SELECT known_prefix, other_prefix, count(o_orderkey) AS counts, round(avg(o_totalprice), {R}) AS average,
       round(median(o_totalprice), {R}) AS median
FROM orders LEFT JOIN people ON c_custkey = o_custkey
GROUP BY ALL
""")
def spend_by_region(spark, sf_dir):
    """Count, mean and exact median of order totals by two region flags.

    Both flags belong to the customer: they are computed once in a
    materialised dimension, and the fact table meets it in a single join,
    where AQE can split a hot customer.
    """
    view = register_prefix_view(spark, sf_dir)
    c = table(spark, sf_dir, "customer")
    people = materialize(c.join(view, view.custid == c.c_custkey, "left").select(
        "c_custkey", "known_prefix",
        ((F.col("c_nationkey") == 1) & (F.col("known_prefix") == 0)).cast("int").alias("other_prefix")))
    o = table(spark, sf_dir, "orders")
    keys = ["known_prefix", "other_prefix"]
    # the join runs once: both the count/avg and the median read this narrow table
    flagged = materialize(o.join(people, o.o_custkey == people.c_custkey, "left").select(
        *keys, "o_orderkey", "o_totalprice"))
    stats = flagged.groupBy(*keys).agg(
        F.count("o_orderkey").alias("counts"), F.round(F.avg("o_totalprice"), R).alias("average"))
    med = exact_median(flagged, keys, "o_totalprice", "median")
    out = stats.join(med, null_safe_on(stats, med, keys), "left")
    return out.select(*[stats[k] for k in keys], "counts", "average",
                      F.round(med.median, R).alias("median")).orderBy("median", *keys)


@register("semi_join_in", f"""
SELECT p_brand, round(avg(l_quantity), {R}) AS avg_quantity, count(*) AS n
FROM lineitem JOIN part ON p_partkey = l_partkey
WHERE EXISTS (FROM part chosen WHERE chosen.p_partkey = l_partkey AND chosen.p_type = 'PROMO'
              AND (lower(chosen.p_name) LIKE '%ring%' OR lower(chosen.p_name) LIKE '%bolt%'))
GROUP BY p_brand
""")
def semi_join_in(spark, sf_dir):
    """``WHERE key IN (subquery)`` as a left-semi join, case-insensitive pattern list.

    The semi join prunes the dimension; the fact table meets the (materialised)
    rest in a single join, where AQE can split a hot key.
    """
    li = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part")
    chosen = part.where((F.col("p_type") == "PROMO")
                        & (F.col("p_name").ilike("%RING%") | F.col("p_name").ilike("%bolt%"))) \
                 .select(F.col("p_partkey").alias("k"))
    brands = materialize(part.join(chosen, part.p_partkey == chosen.k, "left_semi").select("p_partkey", "p_brand"))
    j = li.join(brands, li.l_partkey == brands.p_partkey)
    return j.groupBy("p_brand").agg(F.round(F.avg("l_quantity"), R).alias("avg_quantity"),
                                    F.count(F.lit(1)).alias("n"))


@register("json_path_group", """
SELECT json_extract_string(props, '$.k') AS k, count(*) AS n FROM events
WHERE json_extract_string(props, '$.k') IS NOT NULL
GROUP BY 1
""")
def json_path_group(spark, sf_dir):
    """Group by a path inside a semi-structured JSON column; missing path → dropped."""
    ev = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k")
    return ev.select(k.alias("k")).where(F.col("k").isNotNull()).groupBy("k").agg(F.count(F.lit(1)).alias("n"))


@register("first_days_avg", f"""
SELECT strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS pdate, round(avg(o_totalprice), {R}) AS avg
FROM orders
WHERE date_part('month', o_orderdate) = 8 AND date_part('day', o_orderdate) < 6
GROUP BY 1
""")
def first_days_avg(spark, sf_dir):
    """Average per calendar day for days 1-5 of August of any year.

    Grouping is on the day (the cast expression), not the raw timestamp.
    """
    o = table(spark, sf_dir, "orders")
    daily = first_days_average(o, "o_orderdate", "o_totalprice")
    return daily.select("pdate", F.round("avg", R).alias("avg")).orderBy("pdate")
