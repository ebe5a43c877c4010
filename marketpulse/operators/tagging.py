"""Company tagging (J3, P9, P12): attach keyword and sector by search key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketpulse.functions.columns import case_map
from marketpulse.sources.company import SECTOR_CASE_ARMS, SECTOR_CASE_DEFAULT


def tag_company(posts: DataFrame, dim: DataFrame, key_col: str = "ticker",
                company_col: str = "company", sector_col: str = "CompanySector") -> DataFrame:
    """Inner join of posts to the company dimension on the search key.

    The dimension is a literal table whose size Spark knows, so it is broadcast
    while it is small and the large side is not shuffled; posts with an unknown key are dropped (a fetch
    only ever happens for dictionary keys).
    """
    d = dim.select(
        F.col("ticker").alias("_dim_key"),
        F.col("keyword").alias(company_col),
        F.col("sector").alias(sector_col),
    )
    return (posts.join(d, F.col(key_col) == F.col("_dim_key"), "inner")
            .drop("_dim_key"))


def with_sector_case(df: DataFrame, key_col: str = "key_flag", out_col: str = "sector",
                     arms=SECTOR_CASE_ARMS, default: str = SECTOR_CASE_DEFAULT) -> DataFrame:
    """``select *, CASE key ... ELSE 'na' END AS sector``."""
    return df.select("*", case_map(key_col, arms, default).alias(out_col))
