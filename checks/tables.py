"""Site-by-day readings made from the supplied tables, in Spark and in SQL.

An order is a reading, its customer the site. One in four readings is a scoring row without outcome.
Only the columns a query needs are computed: order-line measures cost a join, so ask for them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    return customer.select(
        F.col("c_name").alias("SOT"),
        F.expr("18 + (c_custkey * 37 % 350) / 10D").alias("LAT"),
        F.expr("73 + (c_custkey * 61 % 620) / 10D").alias("LON"),
        F.col("c_acctbal").alias("V_5"),
        F.col("c_nationkey").cast("double").alias("V_13"),
        "c_custkey",
    )


def readings(spark: SparkSession, sf_dir: str, lines: bool = True) -> DataFrame:
    """``lines=False`` leaves out the measures that come from order lines."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("ID"),
        "o_custkey",
        F.col("o_orderdate").cast("date").alias("DATE"),
        F.when(F.col("o_orderkey") % 4 != 0, F.col("o_totalprice") / 1000).alias("POWER"),
        F.when(F.col("o_orderkey") % 4 == 0, "test").otherwise("train").alias("dataset"),
    )
    where = sites(spark, sf_dir)
    base = orders.join(where, orders["o_custkey"] == where["c_custkey"]).withColumn("V_8", F.col("V_5") / 1000)
    names = [f"V_{i}" for i in range(1, 14)]
    if lines:
        measures = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
            F.avg("l_quantity").alias("V_1"),
            F.avg("l_discount").alias("V_2"),
            F.avg("l_tax").alias("V_3"),
            (F.max("l_extendedprice") / 1000).alias("V_4"),
            F.count(F.lit(1)).cast("double").alias("V_6"),
            F.min("l_discount").alias("V_7"),
            F.sum("l_quantity").alias("V_9"),
            (F.min("l_extendedprice") / 1000).alias("V_10"),
            F.max("l_tax").alias("V_11"),
            F.max("l_quantity").alias("V_12"),
        )
        base = base.join(measures, F.col("ID") == measures["l_orderkey"], "left")
    else:
        names = ["V_5", "V_8", "V_13"]
    return base.select("ID", "SOT", "DATE", "LAT", "LON", *names, "POWER", "dataset")


def train(spark: SparkSession, sf_dir: str, lines: bool = True) -> DataFrame:
    return readings(spark, sf_dir, lines).where("dataset = 'train'").drop("dataset")


def test(spark: SparkSession, sf_dir: str, lines: bool = True) -> DataFrame:
    return readings(spark, sf_dir, lines).where("dataset = 'test'").drop("dataset", "POWER")


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored predictions: truth, an estimate that is a fixed expression of it, and a fold."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("ID"),
        F.col("o_orderdate").cast("date").alias("DATE"),
        (F.col("o_totalprice") / 1000).alias("POWER"),
        F.expr("o_totalprice / 1000 * (0.9D + (o_orderkey % 7) / 30D) + (o_orderkey % 5) - 2").alias("pred"),
        (F.col("o_orderkey") % 5).cast("int").alias("fold"),
        F.concat(F.lit("wf_"), F.col("o_orderkey") % 3).alias("wflow_id"),
    )


READINGS_SQL = """
sites AS (
  SELECT c_name AS SOT, 18 + (c_custkey * 37 % 350) / 10.0::DOUBLE AS LAT,
         73 + (c_custkey * 61 % 620) / 10.0::DOUBLE AS LON,
         c_acctbal AS V_5, CAST(c_nationkey AS DOUBLE) AS V_13, c_custkey
  FROM customer),
measures AS (
  SELECT l_orderkey, avg(l_quantity) AS V_1, avg(l_discount) AS V_2, avg(l_tax) AS V_3,
         max(l_extendedprice) / 1000 AS V_4, CAST(count(*) AS DOUBLE) AS V_6, min(l_discount) AS V_7,
         sum(l_quantity) AS V_9, min(l_extendedprice) / 1000 AS V_10, max(l_tax) AS V_11,
         max(l_quantity) AS V_12
  FROM lineitem GROUP BY l_orderkey),
readings AS (
  SELECT o_orderkey AS ID, SOT, CAST(o_orderdate AS DATE) AS DATE, LAT, LON,
         V_1, V_2, V_3, V_4, V_5, V_6, V_7, V_5 / 1000 AS V_8, V_9, V_10, V_11, V_12, V_13,
         CASE WHEN o_orderkey % 4 <> 0 THEN o_totalprice / 1000 END AS POWER,
         CASE WHEN o_orderkey % 4 = 0 THEN 'test' ELSE 'train' END AS dataset
  FROM orders JOIN sites ON o_custkey = c_custkey LEFT JOIN measures ON o_orderkey = l_orderkey),
train AS (SELECT * EXCLUDE (dataset) FROM readings WHERE dataset = 'train'),
test AS (SELECT * EXCLUDE (dataset, POWER) FROM readings WHERE dataset = 'test')
"""

PREDICTIONS_SQL = """
predictions AS (
  SELECT o_orderkey AS ID, CAST(o_orderdate AS DATE) AS DATE, o_totalprice / 1000 AS POWER,
         o_totalprice / 1000 * (0.9::DOUBLE + (o_orderkey % 7) / 30::DOUBLE) + (o_orderkey % 5) - 2 AS pred,
         CAST(o_orderkey % 5 AS INTEGER) AS fold, 'wf_' || (o_orderkey % 3) AS wflow_id
  FROM orders)
"""


def with_readings(body: str, *ctes: str) -> str:
    return "WITH " + ",".join([READINGS_SQL, *ctes]) + body


def with_predictions(body: str, *ctes: str) -> str:
    return "WITH " + ",".join([PREDICTIONS_SQL, *ctes]) + body


def rounded(df: DataFrame, digits: int = 6, keep: tuple[str, ...] = (), nudge: float = 1e-9) -> DataFrame:
    """Round every floating column, for comparison with another engine's summation order.

    ``nudge`` moves exact decimal ties off the rounding boundary (the SQL side adds the same).
    """
    return df.selectExpr(*[
        f"round(`{name}` + {nudge!r}D, {digits}) AS `{name}`" if kind in ("double", "float") and name not in keep
        else f"`{name}`"
        for name, kind in df.dtypes
    ])


def sql_rounded(cols: list[str], digits: int = 6) -> str:
    return ", ".join(f'round({name} + 1e-9, {digits}) AS {name}' for name in cols)


def ward_sql(body: str, places: str, *ctes: str, k: int = 10) -> str:
    """``body`` over ``groups`` (LAT, LON, Geo_Group), Ward's groups of the rows of ``places``.

    Groups that are each other's nearest merge in rounds; costs are compared at nine digits, equal ones by a mixed
    order of the positions. The k - 1 dearest merges are undone.
    """
    return "WITH RECURSIVE " + ",".join([READINGS_SQL, f"""
spots AS MATERIALIZED (SELECT LAT, LON, row_number() OVER (ORDER BY LAT, LON) - 1 AS place FROM (SELECT DISTINCT LAT, LON FROM {places})),
points AS MATERIALIZED (SELECT *, (place + 1) * 1103515245 % 2147483647 AS id, round(LAT * 10000000)::bigint AS sx, round(LON * 10000000)::bigint AS sy FROM spots),
tree AS (
 SELECT id, 1::bigint AS n, sx, sy, NULL::bigint AS gone_to, NULL::double AS cost FROM points
 UNION ALL
 (WITH alive AS (SELECT id, n, sx, sy, sx::double / n AS x, sy::double / n AS y, n::double AS w FROM tree WHERE gone_to IS NULL),
  gaps AS (SELECT a.id, b.id AS other, ((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) * (a.w * b.w / (a.w + b.w)) AS c
           FROM alive a JOIN alive b ON a.id <> b.id),
  exact AS (SELECT id, other, CASE WHEN c = 0 THEN 0 ELSE round(c / power(2, floor(log2(c)) + 1) * 1073741824) / 1073741824
            * power(2, floor(log2(c)) + 1) END AS c FROM gaps),
  best AS (SELECT id, min(struct_pack(c := c, lo := least(id, other), hi := greatest(id, other))) AS e FROM exact GROUP BY id),
  pairs AS (SELECT e.lo AS a, e.hi AS b, e.c AS c FROM best GROUP BY ALL HAVING count(*) = 2)
  SELECT s.id, (s.n + coalesce(t.n, 0))::bigint, (s.sx + coalesce(t.sx, 0))::bigint, (s.sy + coalesce(t.sy, 0))::bigint, g.a, g.c
  FROM alive s LEFT JOIN pairs p ON p.a = s.id LEFT JOIN alive t ON t.id = p.b LEFT JOIN pairs g ON g.b = s.id
  WHERE (SELECT count(*) FROM alive) > 1)),
kept AS MATERIALIZED (SELECT id, gone_to FROM tree WHERE gone_to IS NOT NULL ORDER BY cost DESC, gone_to DESC, id DESC OFFSET {k - 1}),
follow AS (
 SELECT place, id AS top FROM points
 UNION ALL
 SELECT place, gone_to FROM follow JOIN kept ON kept.id = top),
ends AS (SELECT place, top FROM follow WHERE top NOT IN (SELECT id FROM kept)),
numbers AS (SELECT top, row_number() OVER (ORDER BY min(place)) AS g FROM ends GROUP BY top),
groups AS MATERIALIZED (SELECT LAT, LON, g::int AS Geo_Group FROM ends JOIN numbers USING (top) JOIN spots USING (place))""", *ctes]) + body


def single_link_sql(places: str, k: int = 10, name: str = "cluster") -> str:
    """Groups of single linkage: every group takes its shortest edge out, round by round, until one is left; then the
    k - 1 longest edges go and labels spread along the rest."""
    return "WITH RECURSIVE " + READINGS_SQL + f""",
spots AS MATERIALIZED (SELECT LAT, LON, row_number() OVER (ORDER BY LAT, LON) - 1 AS id, round(LAT * 10000000) AS x, round(LON * 10000000) AS y
  FROM (SELECT DISTINCT LAT, LON FROM {places})),
grow AS (
 SELECT id, x, y, id AS part, NULL::bigint AS a, NULL::bigint AS b, NULL::double AS c FROM spots
 UNION ALL
 (WITH nodes AS (SELECT id, x, y, part FROM grow WHERE a IS NULL),
  best AS (SELECT p.part, min(struct_pack(c := (p.x - q.x) * (p.x - q.x) + (p.y - q.y) * (p.y - q.y), a := least(p.id, q.id), b := greatest(p.id, q.id),
           o := q.part)) AS e FROM nodes p JOIN nodes q ON p.part <> q.part GROUP BY p.part),
  lower AS (SELECT part, min(o) AS o FROM (SELECT part, e.o AS o FROM best UNION ALL SELECT e.o, part FROM best) GROUP BY part)
  SELECT id, x, y, least(n.part, o), NULL, NULL, NULL FROM nodes n JOIN lower USING (part)
  UNION ALL SELECT DISTINCT NULL, NULL, NULL, NULL, e.a, e.b, e.c FROM best)),
edges AS MATERIALIZED (SELECT DISTINCT a, b, c FROM grow WHERE a IS NOT NULL),
kept AS MATERIALIZED (SELECT a, b FROM edges ORDER BY c DESC, a DESC, b DESC OFFSET {k - 1}),
both_ways AS MATERIALIZED (SELECT a, b FROM kept UNION ALL SELECT b, a FROM kept),
spread AS (
 SELECT id, id AS label, true AS moved, 0 AS step FROM spots
 UNION ALL
 (WITH near AS (SELECT w.a AS id, min(s.label) AS label FROM both_ways w JOIN spread s ON s.id = w.b GROUP BY w.a)
  SELECT s.id, least(s.label, coalesce(near.label, s.label)), coalesce(near.label < s.label, false), step + 1 FROM spread s LEFT JOIN near USING (id)
  WHERE (SELECT bool_or(moved) FROM spread))),
labels AS (SELECT id, arg_max(label, step) AS label FROM spread GROUP BY id)
SELECT LAT, LON, dense_rank() OVER (ORDER BY label)::int AS {name} FROM labels JOIN spots USING (id)"""
