"""From a raw company list to distinct names to search for."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from firmloom.functions.segments import derive_search_company_name, normalize_segment
from firmloom.functions.text import nonempty
from firmloom.operators.frontier import first_per_key


def matching_inputs(rows: DataFrame, limit: int | None = None) -> DataFrame:
    """Distinct (matched_keyword, company_name) whose keyword is blank or occurs in the name.

    ``limit`` cuts by name before anything else happens to the rows.
    """
    name, keyword = F.col("company_name"), F.col("matched_keyword")
    open_keyword = keyword.isNull() | (F.trim(keyword) == "")
    inside = F.like(F.lower(name), F.concat(F.lit("%"), F.lower(keyword), F.lit("%")))
    kept = rows.where(F.coalesce(F.trim(name) != "", F.lit(False)) & (open_keyword | inside))
    distinct = kept.select("matched_keyword", "company_name").distinct()
    return distinct if not limit else distinct.orderBy("company_name", "matched_keyword").limit(limit)


def search_inputs(
    rows: DataFrame, existing: DataFrame | None = None, limit: int | None = None
) -> DataFrame:
    """Search names of the matching inputs, the first row of each name, done ones left out.

    ``existing``: company_name of records already stored (resume).
    """
    derived = matching_inputs(rows, limit).withColumn(
        "search_company_name",
        normalize_segment(derive_search_company_name(F.col("company_name"), F.col("matched_keyword"))),
    )
    named = derived.where(F.col("search_company_name") != "")
    firsts = first_per_key(named, "search_company_name", ["company_name", "matched_keyword"])
    if existing is not None:
        done = existing.where(nonempty(F.col("company_name"))).select(
            normalize_segment(F.col("company_name")).alias("search_company_name")
        )
        firsts = firsts.join(done, "search_company_name", "left_anti")
    return firsts.select(
        F.when(nonempty(F.col("matched_keyword")), normalize_segment(F.col("matched_keyword"))).alias("matched_keyword"),
        normalize_segment(F.col("company_name")).alias("raw_company_name"),
        "search_company_name",
        F.col("company_name").alias("source_name"),
    )
