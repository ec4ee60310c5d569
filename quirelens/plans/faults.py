"""Queries: damaged records, and what is left of them."""

from __future__ import annotations

from pyspark.sql import functions as F

from quirelens.operators import explode as X
from quirelens.plans import sql as Q
from quirelens.plans import tables as T
from quirelens.plans.registry import query
from quirelens.plans.unfold import ZONE_ROWS
from quirelens.sources import records

DAMAGED = ", dmg AS (SELECT *, (len(ks) + page_index) % 11 AS kind FROM ix)"


@query(
    "record_faults",
    "WITH " + Q.pages_cte() + DAMAGED + """ SELECT volume_id AS key, page_index,
 CASE kind WHEN 2 THEN 'body' WHEN 3 THEN 'body.tokenPosCount' WHEN 4 THEN 'body.tokenPosCount.damaged token'
  WHEN 5 THEN 'body.tokenPosCount.odd count.NN' WHEN 6 THEN 'body.beginCharCounts.x' END AS path,
 CASE WHEN kind < 5 THEN 'not an object' ELSE 'not a whole number' END AS reason FROM dmg WHERE kind < 7""",
)
def record_faults(spark, d):
    return records.record_faults(T.damaged_volumes(spark, d))


@query(
    "salvaged_tokens",
    Q.tokens() + DAMAGED + """, n AS (SELECT page_id, count(*) AS n_tokens, sum(len(tags)) AS n_tags FROM tokt GROUP BY page_id)
 SELECT page_id, n_tokens + CASE WHEN kind IN (4, 5) THEN 1 ELSE 0 END AS n_tokens, n_tags + CASE kind WHEN 5 THEN 1 ELSE 0 END AS n_tags
 FROM dmg JOIN n USING (page_id) WHERE kind > 3""",
)
def salvaged_tokens(spark, d):
    good, _ = records.parse_volumes(T.damaged_volumes(spark, d))
    tokens = X.explode_tokens(X.explode_pages(good))
    return tokens.groupBy("page_id").agg(F.count(F.lit(1)).alias("n_tokens"), F.sum(F.size("pos_tags")).alias("n_tags"))


@query("explode_zones_parsed", Q.tokens() + ZONE_ROWS + " SELECT zone, count_map, key, count(*) AS n_pages, sum(n) AS total FROM zone GROUP BY ALL")
def explode_zones_parsed(spark, d):
    good, _ = records.parse_volumes(T.raw_volumes(spark, d, zones=True))
    rows = X.explode_zones(X.explode_pages(good))
    return rows.groupBy("zone", "count_map", "key").agg(F.count(F.lit(1)).alias("n_pages"), F.sum("n").alias("total"))
