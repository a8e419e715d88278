"""Catalogue API pages as JSON files (A3).

One document per line, as the API answers: ``playlistId``, ``page``,
``nextPageToken`` and ``items[]``.  The schema is fixed, nothing is inferred.  A
page whose body is no such document is not lost: it stays a row with its text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PAGE_SCHEMA = ("playlistId string, page long, nextPageToken string, "
               "items array<struct<contentDetails:struct<videoId:string>>>, _corrupt string")


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """playlist_id, page, next_token, items, state and raw of every page under
    ``path``.  ``state``: ok; no_items (the field is missing or null) and
    empty_items, which both stand for no items; broken (``raw`` holds the body)."""
    read = spark.read.schema(PAGE_SCHEMA).option("columnNameOfCorruptRecord", "_corrupt").json(path)
    state = (F.when(F.col("_corrupt").isNotNull(), "broken").when(F.col("items").isNull(), "no_items")
             .when(F.size("items") == 0, "empty_items").otherwise("ok"))
    return read.select(F.col("playlistId").alias("playlist_id"), "page", F.col("nextPageToken").alias("next_token"), "items",
                       state.alias("state"), F.col("_corrupt").alias("raw"))
