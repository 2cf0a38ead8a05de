"""Category tree.

The adjacency list is walked level by level with ``depth - 1`` joins:
every node of level k is replaced by its children (a node with children
is not emitted itself), carrying the deepest non-NULL industry down.  The
planner broadcasts the adjacency frame if it is small, and shuffles it if not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F



def category_tree(category: DataFrame, industries: DataFrame, depth: int = 6) -> DataFrame:
    cat = category.select("id", "parent_id", "industry_id", "name")
    kids = (cat)
    level = cat.filter(F.col("parent_id").isNull()).select(
        F.col("id").alias("node_id"), F.col("industry_id").alias("node_industry"), F.col("name").alias("cat1")
    )
    for k in range(2, depth + 1):
        ch = kids.select(
            F.col("parent_id").alias("_p"),
            F.col("id").alias("_id"),
            F.col("industry_id").alias("_ind"),
            F.col("name").alias(f"cat{k}"),
        )
        j = level.join(ch, level["node_id"] == ch["_p"], "left")
        level = j.select(
            *[c for c in level.columns if c not in ("node_id", "node_industry")],
            f"cat{k}",
            F.coalesce("_id", "node_id").alias("node_id"),
            F.coalesce("_ind", "node_industry").alias("node_industry"),
        )
    cats = [f"cat{k}" for k in range(1, depth + 1)]
    ind = (industries.select(F.col("id").alias("_vid"), F.col("name").alias("vertical")))
    out = level.join(ind, level["node_industry"] == ind["_vid"], "left")
    return out.select(
        "vertical",
        *cats,
        F.col("node_id").alias("category_id"),
        F.coalesce(*[F.col(c) for c in reversed(cats)]).alias("deepest_category"),
    )
