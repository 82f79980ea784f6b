"""Which value of each field survives when observations of one company are merged in order.

Rows: company_id, id (the order, unique), weight, confidence and the fields.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from firmloom.functions.constants import PAGE_TYPE_WEIGHTS
from firmloom.functions.text import first_nonempty, nonempty
from firmloom.functions.urls import extract_host
from firmloom.skew import CHUNK_ROWS, best_before, previous_value

# Observation field -> company column.
FIELDS = {
    "email": "primary_email", "phone": "primary_phone", "address": "primary_address", "city": "city",
    "state_region": "state_region", "country": "country", "postal_code": "postal_code", "industry": "industry",
    "description": "description",
}


def page_type_weight(page_type: Column) -> Column:
    chain = F.lit(None).cast("double")
    for name, weight in PAGE_TYPE_WEIGHTS.items():
        chain = F.when(page_type == name, weight).otherwise(chain)
    return F.coalesce(chain, F.lit(PAGE_TYPE_WEIGHTS["generic"]))


def weighted_confidence(confidence: Column, page_type: Column) -> Column:
    return F.coalesce(confidence, F.lit(0.5)) * page_type_weight(page_type)


def with_resolution_columns(observations: DataFrame, empty_domain_is_key: bool = False) -> DataFrame:
    """Add primary_domain (host of the website), weight, and fallback_name of a company founded here.

    The host of a relative website is empty; it is no key unless asked for.
    """
    domain = extract_host(F.col("website"))
    if "primary_domain" not in observations.columns:
        observations = observations.withColumn("primary_domain", F.when(F.col("website") != "", domain))
    if not empty_domain_is_key:
        observations = observations.withColumn("primary_domain", F.nullif(F.col("primary_domain"), F.lit("")))
    return observations.withColumns(
        {
            "confidence": F.coalesce("confidence", F.lit(0.5)),
            "weight": weighted_confidence(F.col("confidence"), F.col("page_type")),
            "fallback_name": F.coalesce(first_nonempty(F.col("company_name"), F.col("website")), F.col("source_url")),
        }
    )


def merged_companies(assigned: DataFrame, variant: str = "staged", mode: str = "previous", chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """One row per company_id out of its observations.

    Default rule: a non-empty value replaces an older one only when its weight
    is above the weight of the observation just before it (``mode="previous"``)
    or above every earlier weight (``mode="best"``).  The last replacement wins,
    else the first non-empty value, else the first value.  ``starter``: the
    latest non-null value wins.

    Only the previous weight needs an order; it is found chunk by chunk, and
    everything else is an aggregate with map-side reduction.
    """
    seq, weight = F.col("id"), F.col("weight")
    find = best_before if mode == "best" else previous_value
    rows = find(assigned, "company_id", "id", "weight", "_prev", chunk_rows)
    opens = F.col("_prev").isNull()

    def at(value: Column, test: Column) -> Column:
        return F.max_by(value, F.when(test, seq))

    columns: dict[str, Column] = {}
    for field, name in FIELDS.items():
        value = F.col(field)
        if variant == "starter":
            columns[name] = at(value, value.isNotNull())
        else:
            beats = nonempty(value) & (weight > F.col("_prev"))
            earliest = F.min_by(value, F.when(nonempty(value), seq))
            columns[name] = F.coalesce(at(value, beats), earliest, F.min_by(value, seq))
    own = F.col("company_name")
    if variant == "starter":
        columns["canonical_name"] = at(F.when(opens, F.col("fallback_name")).otherwise(own), opens | own.isNotNull())
        columns["confidence"] = F.max("confidence")
    else:
        replaced = at(own, nonempty(own) & (weight > F.col("_prev")))
        columns["canonical_name"] = F.coalesce(replaced, F.min_by("fallback_name", seq))
        columns["confidence"] = F.max(F.when(opens, F.col("confidence")).otherwise(weight))
    columns["primary_domain"] = at(F.col("primary_domain"), F.col("primary_domain").isNotNull())
    columns["first_seen_at"] = F.min("observed_at")
    columns["last_seen_at"] = F.max("observed_at")
    details = F.struct(
        F.col("confidence").alias("last_observation_confidence"), weight.alias("weighted_confidence"),
        "extractor_version", "page_type",
    )
    columns["confidence_details"] = F.max_by(details, seq)
    columns["observation_count"] = F.count(F.lit(1))
    return rows.groupBy("company_id").agg(*[c.alias(n) for n, c in columns.items()])


def company_values(assigned: DataFrame) -> DataFrame:
    """Social profiles and source URLs in long form: (company_id, field, value, first_id, first_index).

    Non-empty values, the first of each kept; sorted by (first_id, first_index)
    they are the merged list.  The long form holds however many a company has.
    """

    def entries(field: str, values: Column) -> Column:
        return F.transform(values, lambda v, i: F.struct(F.lit(field).alias("field"), v.alias("value"), i.alias("index")))

    no_items = F.array().cast("array<string>")
    lists = F.concat(
        entries("social_profiles", F.coalesce("social_links", no_items)), entries("source_urls", F.array("source_url"))
    )
    long = assigned.select("company_id", "id", F.explode(lists).alias("e")).select("company_id", "id", "e.*")
    placed = long.where(nonempty(F.col("value"))).withColumns({"first_id": F.col("id").cast("bigint"), "first_index": F.col("index").cast("bigint")})
    return merged_values(placed)


def merged_values(values: DataFrame) -> DataFrame:
    """Long values of any number of batches as one: each value of a company and field at its first place."""
    firsts = values.groupBy("company_id", "field", "value").agg(F.min(F.struct("first_id", "first_index")).alias("_first"))
    return firsts.select("company_id", "field", "value", "_first.first_id", "_first.first_index")


def company_value_lists(values: DataFrame, part_ids: int = 1_000_000) -> DataFrame:
    """The long values as arrays, one row per company and stretch of ``part_ids`` observation ids."""
    item = F.struct("first_id", "first_index", "value")

    def gathered(field: str) -> Column:
        ordered = F.array_sort(F.collect_list(F.when(F.col("field") == field, item)))
        return F.transform(ordered, lambda s: s["value"]).alias(field)

    part = F.floor(F.col("first_id") / part_ids)
    return values.withColumn("part", part).groupBy("company_id", "part").agg(gathered("social_profiles"), gathered("source_urls"))
