"""Typed articles built from the star schema, for operators that need dates and author genders.

One article per order: outlet = market segment, people = suppliers of its lines, sources = those
with a final line, author gender by customer key. ``SQL`` says the same for the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from newsweft.sources.tables import table

GENDER = "CASE WHEN {k} % 10 <= 5 THEN 'male' WHEN {k} % 10 <= 8 THEN 'female' ELSE 'unknown' END"


def order_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """_id, publishedAt, outlet, body, annotated, people/sources by gender with counts, author counts."""
    orders, customers = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    lines, suppliers = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "supplier")
    names = suppliers.select("s_suppkey", F.expr(GENDER.format(k="s_suppkey")).alias("g"), "s_name")
    per = lines.select("l_orderkey", "l_suppkey", F.when(F.col("l_linestatus") == "F", 1).otherwise(0).alias("f")).groupBy("l_orderkey", "l_suppkey").agg(F.sum("f").alias("f"))
    per = per.join(names, F.col("l_suppkey") == F.col("s_suppkey"))
    pick = lambda g, src: F.array_sort(F.collect_list(F.when((F.col("g") == g) & ((F.col("f") > 0) if src else F.lit(True)), F.col("s_name"))))
    cols = [pick(g, s).alias(f"{kind}{g.capitalize()}") for kind, s in (("people", False), ("sources", True)) for g in ("female", "male", "unknown")]
    agg = per.groupBy("l_orderkey").agg(F.sum("f").alias("quoteCount"), *cols)
    none = F.array().cast("array<string>")
    out = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).join(agg, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    annotated = F.col("o_orderstatus") != "P"
    lists = [c for k in ("people", "sources") for c in (f"{k}Female", f"{k}Male", f"{k}Unknown")]
    out = out.select(
        F.col("o_orderkey").alias("_id"),
        F.col("o_orderdate").alias("publishedAt"),
        F.col("c_mktsegment").alias("outlet"),
        F.when(F.col("o_orderkey") % 17 == 0, "").otherwise("text").alias("body"),
        annotated.alias("annotated"),
        F.when(annotated, F.coalesce("quoteCount", F.lit(0))).alias("quoteCount"),
        F.col("o_custkey"),
        *[F.when(annotated, F.coalesce(c, none)).alias(c) for c in lists],
    )
    g1 = F.col("o_custkey") % 5
    g2 = F.when(F.col("_id") % 3 == 0, (F.col("o_custkey") + 1) % 5)
    n = lambda low, high: g1.between(low, high).cast("int") + F.coalesce(g2.between(low, high).cast("int"), F.lit(0))
    authors = {"Male": n(0, 1), "Female": n(2, 3), "Unknown": n(4, 4)}
    return out.select("*", *[F.size(c).alias(f"{c}Count") for c in lists], *[F.when(F.col("annotated"), v).alias(f"authors{k}Count") for k, v in authors.items()])


SQL = f"""
per AS (SELECT l_orderkey, l_suppkey, sum(CASE WHEN l_linestatus='F' THEN 1 ELSE 0 END) AS f FROM lineitem GROUP BY 1,2),
pers AS (SELECT per.*, s_name, {GENDER.format(k="s_suppkey")} AS g FROM per JOIN supplier ON l_suppkey = s_suppkey),
agg AS (SELECT l_orderkey, sum(f) AS q,
  count(*) FILTER (g='female') AS pf, count(*) FILTER (g='male') AS pm, count(*) FILTER (g='unknown') AS pu,
  count(*) FILTER (g='female' AND f>0) AS sf, count(*) FILTER (g='male' AND f>0) AS sm, count(*) FILTER (g='unknown' AND f>0) AS su
  FROM pers GROUP BY 1),
art AS (SELECT o_orderkey AS _id, o_orderdate AS publishedAt, c_mktsegment AS outlet, CASE WHEN o_orderkey % 17 = 0 THEN '' ELSE 'text' END AS body,
  o_orderstatus <> 'P' AS annotated, o_custkey,
  CASE WHEN o_orderstatus <> 'P' THEN coalesce(q,0) END AS quoteCount,
  CASE WHEN o_orderstatus <> 'P' THEN coalesce(pf,0) END AS pf, CASE WHEN o_orderstatus <> 'P' THEN coalesce(pm,0) END AS pm, CASE WHEN o_orderstatus <> 'P' THEN coalesce(pu,0) END AS pu,
  CASE WHEN o_orderstatus <> 'P' THEN coalesce(sf,0) END AS sf, CASE WHEN o_orderstatus <> 'P' THEN coalesce(sm,0) END AS sm, CASE WHEN o_orderstatus <> 'P' THEN coalesce(su,0) END AS su,
  CASE WHEN o_orderstatus <> 'P' THEN (CASE WHEN o_custkey%5 IN (0,1) THEN 1 ELSE 0 END) + (CASE WHEN o_orderkey%3=0 AND (o_custkey+1)%5 IN (0,1) THEN 1 ELSE 0 END) END AS am,
  CASE WHEN o_orderstatus <> 'P' THEN (CASE WHEN o_custkey%5 IN (2,3) THEN 1 ELSE 0 END) + (CASE WHEN o_orderkey%3=0 AND (o_custkey+1)%5 IN (2,3) THEN 1 ELSE 0 END) END AS af,
  CASE WHEN o_orderstatus <> 'P' THEN (CASE WHEN o_custkey%5 = 4 THEN 1 ELSE 0 END) + (CASE WHEN o_orderkey%3=0 AND (o_custkey+1)%5 = 4 THEN 1 ELSE 0 END) END AS au
  FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN agg ON o_orderkey = agg.l_orderkey)
"""
