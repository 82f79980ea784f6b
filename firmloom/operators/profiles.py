"""One company profile per query out of its ordered results; repair of stored records.

Result rows: query_id, pos (unique per query), url, final_url, title,
description, company_name, and the lists emails, phones, social_profiles and
locations; ``domain`` is optional.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from firmloom import schemas
from firmloom.functions.constants import PROFILE_PAGE_HINTS
from firmloom.functions.names import (
    is_strong_company_name,
    normalize_company_name,
    pick_company_name,
    pick_company_summary,
    title_name_candidates,
)
from firmloom.functions.text import clean_text, contains_any, first_nonempty, nonempty
from firmloom.functions.urls import (
    brand_domain_mapping,
    classify_important_page,
    is_likely_official_url,
    url_authority,
    url_path,
)

PAGE_TYPES = tuple(PROFILE_PAGE_HINTS)
CLEANED_LISTS = {
    "emails": "emails", "phones": "phones", "social_profiles": "social_profiles",
    "headquarters_or_location_mentions": "locations",
}
LIST_FIELDS = ("all_domains", "headquarters_or_location_mentions", "emails", "phones", "social_profiles", "source_urls")
PART_ROWS = 100_000


def name_score(final_url: Column, name: Column, title: Column) -> Column:
    """How trustworthy a normalised name is, by the page it was found on; -1 if unusable."""
    page = classify_important_page(final_url)
    base = (
        F.when(url_path(final_url).isin("", "/"), 100)
        .when(page == "about", 90)
        .when(page == "contact", 85)
        .when(page == "leadership", 75)
        .when(page == "careers", 45)
        .otherwise(60)
    )
    score = (
        base
        + F.when(F.lower(clean_text(title)).contains(F.lower(name)), 20).otherwise(0)
        + F.when(F.length(name) <= 30, 5).otherwise(0)
        + F.when(contains_any(name, ("&", ".", "-")), 3).otherwise(0)
    )
    usable = is_likely_official_url(final_url) & is_strong_company_name(name)
    return F.when(usable, score).otherwise(-1)


def with_page_facts(results: DataFrame) -> DataFrame:
    """Add final (URL), domain, official, page_type, summary, name and name_score per result."""
    located = results.withColumn("final", F.coalesce(first_nonempty(F.col("final_url"), F.col("url")), F.lit("")))
    own = url_authority(F.col("final"))
    known = first_nonempty(F.col("domain"), own) if "domain" in results.columns else own
    facts = located.withColumns(
        {
            "domain": F.coalesce(known, F.lit("")),
            "official": is_likely_official_url(F.col("final")),
            "page_type": classify_important_page(F.col("final")),
            "summary": pick_company_summary(F.col("description")),
            "name": normalize_company_name(F.col("company_name")),
        }
    )
    scored = facts.withColumn("name_score", name_score(F.col("final"), F.col("name"), F.col("title")))
    return scored.withColumn("name", F.when(F.col("name_score") >= 0, F.col("name")))


def profile_scalars(facts: DataFrame, key: str = "query_id") -> DataFrame:
    """Single-valued profile fields: the best name, and the first official value of the rest.

    All are arg-min or arg-max aggregates, so a query with very many results is
    reduced on the map side.
    """
    pos, official = F.col("pos"), F.col("official")

    def first_where(value: str, test: Column) -> Column:
        return F.min_by(value, F.when(test, pos))

    return facts.groupBy(key).agg(
        F.max_by("name", F.when(F.col("name_score") >= 0, F.struct("name_score", -pos))).alias("company_name"),
        first_where("summary", official & F.col("summary").isNotNull()).alias("company_summary"),
        first_where("final", official & (F.col("final") != "")).alias("official_website"),
        first_where("domain", official & (F.col("domain") != "")).alias("primary_domain"),
        *[first_where("final", official & (F.col("page_type") == t)).alias(f"{t}_page") for t in PAGE_TYPES],
    )


def profile_values(facts: DataFrame, key: str = "query_id") -> DataFrame:
    """List-valued profile fields in long form: (key, field, value, first_pos, first_index).

    Duplicates collapse on the map side.  Sorting a field by (first_pos,
    first_index) gives the order of the list: first seen first.
    """

    def entries(field: str, values: Column) -> Column:
        return F.transform(values, lambda v, i: F.struct(F.lit(field).alias("field"), v.alias("value"), i.alias("index")))

    lists = [entries("source_urls", F.array("final")), entries("all_domains", F.filter(F.array("domain"), nonempty))]
    for field, column in CLEANED_LISTS.items():
        lists.append(entries(field, F.transform(F.col(column), clean_text)))
    long = facts.select(key, "pos", F.explode(F.concat(*lists)).alias("e")).select(key, "pos", "e.*")
    pos, index = F.col("pos").cast("bigint"), F.col("index").cast("bigint")
    # One number per place, so that the aggregate hashes and keeps no row; a struct would make it sort all of them.
    scaled = lambda p: p.cast("decimal(20,0)") * F.lit(1 << 31)
    firsts = long.where(F.col("value").isNotNull()).groupBy(key, "field", "value").agg(
        F.min(pos).alias("first_pos"), F.min(scaled(pos) + index).alias("_place")
    )
    first_index = (F.col("_place") - scaled(F.col("first_pos"))).cast("bigint").alias("first_index")
    return firsts.select(key, "field", "value", "first_pos", first_index)


def value_lists(values: DataFrame, key: str = "query_id", part_rows: int = PART_ROWS) -> DataFrame:
    """Long values gathered into one array column per field, in parts of bounded size.

    ``part`` counts stretches of ``part_rows`` result positions; an ordinary
    query has part 0 only, and the arrays of a huge one follow each other part
    by part.
    """
    part = F.floor(F.col("first_pos") / part_rows).cast("int")
    item = F.struct("first_pos", "first_index", "value")

    def gathered(field: str) -> Column:
        ordered = F.array_sort(F.collect_list(F.when(F.col("field") == field, item)))
        return F.transform(ordered, lambda s: s["value"]).alias(field)

    return values.withColumn("part", part).groupBy(key, "part").agg(*[gathered(f) for f in LIST_FIELDS])


def _profile_struct() -> Column:
    pairs = [F.struct(F.lit(t).alias("k"), F.col(f"{t}_page").alias("v")) for t in PAGE_TYPES]
    pages = F.map_from_entries(F.filter(F.array(*pairs), lambda p: p["v"].isNotNull()))
    no_items = F.array().cast("array<string>")
    return F.struct(
        *[F.col(c) for c in ("company_name", "company_summary", "official_website", "primary_domain")],
        *[F.coalesce(F.col(f), no_items).alias(f) for f in LIST_FIELDS],
        pages.alias("important_pages"),
    ).cast(schemas.COMPANY_PROFILE)


def company_profiles(results: DataFrame, tasks: DataFrame | None = None, part_rows: int = PART_ROWS) -> DataFrame:
    """(query_id, part, company_profile); with ``tasks``, also an empty profile for queries without results."""
    facts = with_page_facts(results)
    joined = profile_scalars(facts).join(value_lists(profile_values(facts), part_rows=part_rows), "query_id")
    if tasks is not None:
        joined = tasks.select("query_id").join(joined, "query_id", "left")
    return joined.select("query_id", F.coalesce("part", F.lit(0)).alias("part"), _profile_struct().alias("company_profile"))


def filled_profiles(tasks: DataFrame, scalars: DataFrame) -> DataFrame:
    """Every task with its profile scalars; null fields where it has no results."""
    return tasks.select("query_id").join(scalars, "query_id", "left")


def query_records(
    tasks: DataFrame, items: DataFrame, profiles: DataFrame | None = None, part_rows: int = PART_ROWS
) -> DataFrame:
    """Records: the task columns, its ``item`` structs as ``results``, its profile.

    ``items``: query_id, pos, item.  A query with more than ``part_rows``
    results gives several records, told apart by ``part``.
    """
    gathered = (
        items.withColumn("part", F.floor(F.col("pos") / part_rows).cast("int"))
        .groupBy("query_id", "part")
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "item"))), lambda s: s["item"]).alias("results"))
    )
    joined = tasks.join(gathered, "query_id", "left").withColumn("part", F.coalesce("part", F.lit(0)))
    empty = F.array().cast(joined.schema["results"].dataType)
    joined = joined.withColumn("results", F.coalesce("results", empty))
    return joined if profiles is None else joined.join(profiles, ["query_id", "part"], "left")


def repair_names(results: DataFrame) -> DataFrame:
    """Keep a strong name (normalised), else take the first strong part of the title.

    Adds ``repaired`` and the renewed ``brand_domain_mapping``; a result with
    neither keeps its old name and mapping.
    """
    kept = F.when(is_strong_company_name(F.col("company_name")), normalize_company_name(F.col("company_name")))
    from_title = pick_company_name(title_name_candidates(F.col("title")))
    fixed = results.withColumn("_better", F.coalesce(kept, from_title))
    final = F.coalesce(first_nonempty(F.col("final_url"), F.col("url")), F.lit(""))
    domain = first_nonempty(F.col("domain"), url_authority(final)) if "domain" in results.columns else url_authority(final)
    mapping = brand_domain_mapping(F.coalesce(domain, F.lit("")), F.col("_better"))
    if "brand_domain_mapping" in results.columns:
        mapping = F.when(F.col("_better").isNotNull(), mapping).otherwise(F.col("brand_domain_mapping"))
    return fixed.withColumns(
        {
            "repaired": F.col("_better").isNotNull(),
            "company_name": F.coalesce("_better", "company_name"),
            "brand_domain_mapping": mapping,
        }
    ).drop("_better")


def recompute_profiles(results: DataFrame, old_profiles: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(profile scalars, profile values) of stored results with repaired names.

    ``old_profiles`` (query_id, company_summary): an old summary survives only
    where the new one is empty.
    """
    facts = with_page_facts(repair_names(results))
    scalars = profile_scalars(facts)
    if old_profiles is not None:
        old = old_profiles.select("query_id", F.col("company_summary").alias("_old"))
        scalars = scalars.join(old, "query_id", "left").withColumn(
            "company_summary", first_nonempty(F.col("company_summary"), F.col("_old"))
        ).drop("_old")
    return scalars, profile_values(facts)


def results_of_records(records: DataFrame) -> DataFrame:
    """Flat result rows of stored records, positions from 1."""
    item = records.select("query_id", F.posexplode("results").alias("_i", "r"))
    business = "r.metadata.business"
    return item.select(
        "query_id", (F.col("_i") + 1).cast("bigint").alias("pos"), "r.url", "r.title",
        "r.metadata.final_url", "r.metadata.domain", "r.metadata.description",
        f"{business}.company_name", f"{business}.emails", f"{business}.phones", f"{business}.social_profiles",
        F.col(f"{business}.headquarters_or_location_mentions").alias("locations"),
        f"{business}.brand_domain_mapping",
    )


def repair_records(records: DataFrame) -> DataFrame:
    """Stored records with names and profiles derived anew; nothing is read back in place."""
    item_type = records.schema["results"].dataType.elementType

    def repaired(item: Column) -> Column:
        meta, business = item["metadata"], item["metadata"]["business"]
        old = business["company_name"]
        kept = F.when(is_strong_company_name(old), normalize_company_name(old))
        better = F.coalesce(kept, pick_company_name(title_name_candidates(item["title"])))
        final = F.coalesce(first_nonempty(meta["final_url"], item["url"]), F.lit(""))
        domain = F.coalesce(first_nonempty(meta["domain"], url_authority(final)), F.lit(""))
        new = business.withField("company_name", better).withField(
            "brand_domain_mapping", brand_domain_mapping(domain, better)
        )
        return F.when(better.isNull(), item).otherwise(item.withField("metadata", meta.withField("business", new))).cast(item_type)

    fixed = records.withColumn("results", F.transform("results", repaired))
    facts = with_page_facts(results_of_records(fixed))
    lists = value_lists(profile_values(facts), part_rows=1 << 31)
    fresh = profile_scalars(facts).join(lists, "query_id").withColumn("_new", _profile_struct()).select("query_id", "_new")
    joined = fixed.join(fresh, "query_id", "left")
    summary = first_nonempty(F.col("_new.company_summary"), F.col("company_profile.company_summary"))
    no_items = F.array().cast("array<string>")
    blank = F.struct(
        *[F.lit(None).cast("string").alias(c) for c in ("company_name", "company_summary", "official_website", "primary_domain")],
        *[no_items.alias(f) for f in LIST_FIELDS],
        F.create_map().cast("map<string,string>").alias("important_pages"),
    ).cast(schemas.COMPANY_PROFILE)
    profile = F.coalesce("_new", blank).withField("company_summary", summary)
    return joined.withColumn("company_profile", profile).drop("_new")
