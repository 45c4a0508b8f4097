"""Post -> comment rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def flatten_posts(posts: DataFrame, outer: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per comment with the post columns repeated.

    ``outer=True`` keeps a post without comments (NULL or empty array) as one
    row with NULL comment columns. ``keep`` names further post columns to repeat.
    Row-local: the explode never shuffles.
    """
    gen = F.explode_outer if outer else F.explode
    return (posts.select("id", "created_time", "message",
                         F.col("likes.summary.total_count").alias("total_count"),
                         *keep, gen("comments.data").alias("c"))
            .select("id", "created_time", "message", "total_count", *keep,
                    F.col("c.id").alias("comment_id"),
                    F.col("c.created_time").alias("comment_created_time"),
                    F.col("c.message").alias("comment_message"),
                    F.col("c.like_count").alias("comment_likes")))
