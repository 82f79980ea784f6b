"""Table schemas and column defaults."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _L, _I, _D, _B, _TS = (
    T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType(), T.TimestampType(),
)
_STRINGS = T.ArrayType(_S)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


URLS = _struct(
    ("id", _L), ("canonical_url", _S), ("url_hash", _S), ("scheme", _S), ("host", _S), ("etld1", _S), ("path", _S),
    ("query_norm", _S), ("source_type", _S), ("parent_url_hash", _S), ("depth", _I), ("priority", _D), ("state", _S),
    ("render_mode", _S), ("discovery_score", _D), ("entity_score", _D), ("host_risk_score", _D),
    ("freshness_score", _D), ("retry_count", _I), ("next_fetch_at", _TS), ("leased_until", _TS),
    ("last_fetched_at", _TS), ("http_status", _I), ("content_hash", _S), ("created_at", _TS), ("updated_at", _TS),
)
URL_DEFAULTS = {
    "depth": 0, "priority": 0.0, "discovery_score": 0.0, "entity_score": 0.0, "host_risk_score": 0.0,
    "freshness_score": 0.0, "retry_count": 0,
}

DOMAIN_STATE = _struct(
    ("host", _S), ("etld1", _S), ("robots_fetched_at", _TS), ("robots_etag", _S), ("crawl_delay_ms", _I),
    ("max_parallelism", _I), ("preferred_render_mode", _S), ("preferred_proxy_class", _S), ("success_rate", _D),
    ("challenge_rate", _D), ("avg_latency_ms", _D), ("ban_score", _D), ("last_blocked_at", _TS),
    ("session_required", _B), ("recrawl_interval_hours", _I), ("updated_at", _TS),
)
DOMAIN_STATE_DEFAULTS = {
    "crawl_delay_ms": 1000, "max_parallelism": 1, "preferred_render_mode": "http", "preferred_proxy_class": "direct",
    "success_rate": 1.0, "challenge_rate": 0.0, "avg_latency_ms": 0.0, "ban_score": 0.0, "session_required": False,
    "recrawl_interval_hours": 168,
}
# A host without any row of its own gets this budget instead.
UNKNOWN_HOST_BUDGET = {
    "crawl_delay_ms": 1000, "max_parallelism": 2, "preferred_render_mode": "http", "ban_score": 0.0,
    "challenge_rate": 0.0,
}

FETCH_RESULTS = _struct(
    ("id", _L), ("url_hash", _S), ("fetched_at", _TS), ("worker_type", _S), ("proxy_class", _S), ("status_code", _I),
    ("final_url", _S), ("content_type", _S), ("response_bytes", _L), ("latency_ms", _I), ("blocked", _B),
    ("block_reason", _S), ("html_object_key", _S), ("screenshot_object_key", _S), ("headers_json", _S),
    ("meta_json", _S),
)

OBSERVATIONS = _struct(
    ("id", _L), ("url_hash", _S), ("observed_at", _TS), ("company_name", _S), ("website", _S), ("email", _S),
    ("phone", _S), ("address", _S), ("city", _S), ("state_region", _S), ("country", _S), ("postal_code", _S),
    ("industry", _S), ("description", _S), ("social_links", _STRINGS), ("raw_fields", _S), ("confidence", _D),
    ("extractor_version", _S), ("evidence_object_key", _S), ("page_type", _S),
)

COMPANIES = _struct(
    ("id", _L), ("canonical_name", _S), ("primary_domain", _S), ("primary_email", _S), ("primary_phone", _S),
    ("primary_address", _S), ("city", _S), ("state_region", _S), ("country", _S), ("postal_code", _S),
    ("industry", _S), ("description", _S), ("confidence", _D), ("status", _S), ("first_seen_at", _TS),
    ("last_seen_at", _TS), ("updated_at", _TS), ("social_profiles", _STRINGS), ("source_urls", _STRINGS),
    ("confidence_details", _struct(
        ("last_observation_confidence", _D), ("weighted_confidence", _D), ("extractor_version", _S), ("page_type", _S),
    )),
)
COMPANY_DEFAULT_STATUS = "active"

COMPANY_OBSERVATION_LINKS = _struct(
    ("company_id", _L), ("observation_id", _L), ("match_score", _D), ("match_reason", _S), ("linked_at", _TS),
)

QUERY_TASKS = _struct(("query_id", _L), ("query", _S))
INPUT_COMPANIES = _struct(("matched_keyword", _S), ("raw_company_name", _S), ("search_company_name", _S))
RAW_PAGES = _struct(("html_object_key", _S), ("html", _S))
EVIDENCE = _struct(("evidence_object_key", _S), ("payload", _S))

BRAND_MAPPING = _struct(("company_name", _S), ("domain", _S), ("root_hint", _S))
BUSINESS = _struct(
    ("company_name", _S), ("headquarters_or_location_mentions", _STRINGS), ("emails", _STRINGS), ("phones", _STRINGS),
    ("social_profiles", _STRINGS), ("brand_domain_mapping", BRAND_MAPPING), ("classification", _S),
)
RESULT_ITEM = _struct(
    ("url", _S), ("title", _S),
    ("metadata", _struct(
        ("final_url", _S), ("domain", _S), ("description", _S), ("keywords", _S), ("canonical_url", _S),
        ("business", BUSINESS),
    )),
)
COMPANY_PROFILE = _struct(
    ("company_name", _S), ("company_summary", _S), ("official_website", _S), ("primary_domain", _S),
    ("all_domains", _STRINGS), ("headquarters_or_location_mentions", _STRINGS), ("emails", _STRINGS),
    ("phones", _STRINGS), ("social_profiles", _STRINGS), ("source_urls", _STRINGS),
    ("important_pages", T.MapType(_S, _S)),
)
QUERY_RECORD = _struct(
    ("query_id", _L), ("query", _S), ("status", _S), ("engine", _S), ("attempts", _I),
    ("results", T.ArrayType(RESULT_ITEM)), ("timestamp", _S), ("query_duration_seconds", _D), ("note", _S),
    ("error", _S), ("company_profile", COMPANY_PROFILE),
)

FETCH_EVENT = _struct(
    ("frontier_id", _L), ("canonical_url", _S), ("host", _S), ("depth", _I), ("final_url", _S),
    ("html_object_key", _S), ("status_code", _I), ("content_type", _S),
)

TABLES = {
    "urls": URLS,
    "domain_state": DOMAIN_STATE,
    "fetch_results": FETCH_RESULTS,
    "observations": OBSERVATIONS,
    "companies": COMPANIES,
    "company_observation_links": COMPANY_OBSERVATION_LINKS,
}
