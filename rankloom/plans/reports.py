"""Dashboard aggregates over the mart. All combine on the map side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def team_performance(mart: DataFrame) -> DataFrame:
    """Per country; players are counted over (country, player) first."""
    return mart.groupBy("country").agg(
        F.count("*").alias("n_rankings"),
        F.count_distinct("player_id").alias("n_players"),
        F.min("rank").alias("best_rank"),
        F.max("rating").alias("top_rating"),
        F.avg("rating").alias("avg_rating"),
    )


def score_distribution(mart: DataFrame, width: int = 50) -> DataFrame:
    """Rankings per rating band of `width` points."""
    band = (F.floor(F.col("rating") / width) * width).cast("bigint").alias("rating_from")
    return mart.groupBy(band).agg(F.count("*").alias("n_rankings"))


def trend_by_month(mart: DataFrame) -> DataFrame:
    """Rankings and mean rating per month and direction."""
    return mart.groupBy("year", "month", "trend").agg(
        F.count("*").alias("n_rankings"), F.avg("rating").alias("avg_rating")
    )
