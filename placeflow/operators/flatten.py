"""Nested reviews to flat rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeflow.functions.text import json_array
from placeflow.operators.joins import first_match
from placeflow.schemas import FLAT_REVIEW


def flat_reviews(bundles: DataFrame, facilities: DataFrame, order: list[str] | None = None) -> DataFrame:
    """A row for each review of bundles (place_id and the bundle's fields), one of nulls for a place without reviews.

    The facility's name is that of its first row in `order` (default: name), or 'Unknown'.
    """
    one = F.explode_outer(F.when(F.col("has_reviews"), F.col("reviews")))
    rows = first_match(bundles, facilities.select("place_id", "name", *[c for c in order or [] if c not in ("place_id", "name")]), "place_id", "name", order or ["name"])
    rows = rows.select("place_id", F.col("name").alias("facility_name"), "scraped_at", one.alias("r"))
    there = F.col("r").isNotNull()
    flat = {
        "place_id": F.col("place_id"),
        "facility_name": F.col("facility_name"),
        "review_index": F.col("r.review_index"),
        "reviewer_name": F.col("r.reviewer_info.reviewer_name"),
        "review_text": F.col("r.review_text"),
        "visit_date": F.col("r.visit_info.visit_date"),
        "visit_count": F.col("r.visit_info.visit_count"),
        "verification_method": F.col("r.visit_info.verification_method"),
        "visit_keywords": F.when(there, json_array("r.visit_keywords")),
        "image_urls": F.when(there, json_array("r.images")),
        "image_count": F.when(there, F.size(F.coalesce(F.col("r.images"), F.array().cast("array<string>")))).otherwise(0),
        "has_owner_response": F.coalesce(F.col("r.owner_response").isNotNull(), F.lit(False)),
        "owner_response_text": F.col("r.owner_response.response_text"),
        "reaction_count": F.col("r.reactions.reaction_count"),
        "scraped_at": F.when(there, F.col("r.scraped_at")).otherwise(F.col("scraped_at")),
    }
    return rows.select(*[flat[f.name].cast(f.dataType).alias(f.name) for f in FLAT_REVIEW])


def records(maps: DataFrame, column: str, key: str = "place_id") -> DataFrame:
    """A row for each entry of a map of structs: the key and the struct's fields."""
    return maps.select(F.explode(column).alias(key, "_v")).select(key, "_v.*")
