"""Declared schemas. Nothing is inferred: a missing key is a null, an unknown one is ignored."""

from __future__ import annotations

from pyspark.sql import types as T

NOT_FOUND = "N/A"

# Texts of failures, which are data.
ERRORS = {
    "page": "Could not navigate to place",
    "timeout": "Page load timeout",
    "section": "Medical info section not found",
    "html": "Could not extract HTML",
    "tab": "Could not click review tab",
    "list": "Could not extract review HTML",
}


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


def _list_of(*names: str) -> T.ArrayType:
    return T.ArrayType(T.StructType(_strings(*names)))


FACILITY_KEYS = ["name", "category", "reviews", "address", "phone", "hours_status", "business_hours", "amenities", "website", "url", "place_id", "scraped_at", "error"]
SEARCH_KEYS = ["search_query", "search_location", "preview_name"]
PATH_KEYS = ["file_district", "file_dong", "file_keyword"]
FACILITY = T.StructType([*_strings(*FACILITY_KEYS, *SEARCH_KEYS), T.StructField("page_number", T.IntegerType()), T.StructField("position", T.IntegerType())])

PARSED = T.StructType([
    T.StructField("specialist_by_department", _list_of("department", "specialist_count")),
    T.StructField("medical_departments", T.ArrayType(T.StringType())),
    T.StructField("special_equipment", _list_of("equipment_name", "count")),
    T.StructField("excellent_institution_evaluation", _list_of("evaluation_item", "evaluation_info")),
    T.StructField("medical_staff_count", _list_of("staff_type", "count")),
    T.StructField("parking", T.ArrayType(T.StringType())),
    *_strings("parking_text", "copyright_info", "more_info_link", "more_info_text"),
])

ENRICHMENT = T.StructType([
    T.StructField("has_medical_info", T.BooleanType()),
    T.StructField("medical_info_raw", T.StringType()),
    T.StructField("medical_info_parsed", PARSED),
    T.StructField("parsing_success", T.BooleanType()),
    *_strings("enrichment_error", "enriched_at", "verified_place_id"),
])

REVIEW = T.StructType([
    *_strings("scraped_at"),
    T.StructField("reviewer_info", T.StructType([*_strings("reviewer_name"), T.StructField("reviewer_stats", T.ArrayType(T.StringType())), *_strings("profile_url")])),
    *_strings("review_text"),
    T.StructField("visit_info", T.StructType(_strings("visit_date", "visit_count", "verification_method"))),
    T.StructField("visit_keywords", T.ArrayType(T.StringType())),
    T.StructField("images", T.ArrayType(T.StringType())),
    T.StructField("owner_response", T.StructType(_strings("owner_name", "response_date", "response_text"))),
    T.StructField("reactions", T.StructType(_strings("reaction_count"))),
    T.StructField("review_index", T.IntegerType()),
])

BUNDLE = T.StructType([
    T.StructField("has_reviews", T.BooleanType()),
    T.StructField("review_count", T.IntegerType()),
    T.StructField("reviews", T.ArrayType(REVIEW)),
    *_strings("review_html", "scrape_error", "scraped_at"),
])

FLAT_REVIEW = T.StructType([
    *_strings("place_id", "facility_name"),
    T.StructField("review_index", T.IntegerType()),
    *_strings("reviewer_name", "review_text", "visit_date", "visit_count", "verification_method", "visit_keywords", "image_urls"),
    T.StructField("image_count", T.IntegerType()),
    T.StructField("has_owner_response", T.BooleanType()),
    *_strings("owner_response_text", "reaction_count", "scraped_at"),
])

SUMMARY = T.StructType([
    *_strings("gu", "dong"),
    T.StructField("completed_keywords", T.ArrayType(T.StringType())),
    T.StructField("failed_keywords", T.ArrayType(T.StringType())),
    T.StructField("total_facilities", T.LongType()),
    *_strings("start_time", "end_time", "error"),
])
