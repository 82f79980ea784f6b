"""Entity resolution: which company every observation belongs to.

The rule is sequential.  An observation joins the oldest company that *now* has
its domain or its name, and may change both; else it founds a company.  Only
observations linked through shared keys can influence each other, so the work
splits by connected component, and inside one it follows the observation order.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from firmloom import schemas
from firmloom.functions.text import nonempty
from firmloom.functions.urls import hash_url
from firmloom.operators.components import connected_components
from firmloom.operators.frontier import absent_rows
from firmloom.operators.survivorship import (
    FIELDS,
    company_values,
    merged_companies,
    with_resolution_columns,
)
from firmloom.session import cut_lineage, map_frames
from firmloom.skew import HOT_KEY_ROWS, lookup_join, number_rows, running_totals

# Ranks order companies by age: existing ones by id, new ones after them by founding observation.
_NEW = 1 << 62
_FOLD_ROWS = "component long, kind int, id long, domain string, name string, fallback string, weight double"
MAX_FOLD_ROWS = 1_000_000


# --- appending observations and links ----------------------------------------
def observation_rows(parsed: DataFrame, source_url: str, evidence_key: Column | None = None) -> DataFrame:
    """Observation-table columns of parsed pages, defaults filled in."""
    key = F.lit(None).cast("string") if evidence_key is None else evidence_key
    return parsed.withColumns(
        {
            "url_hash": hash_url(F.col(source_url)),
            "source_url": F.col(source_url),
            "confidence": F.coalesce("confidence", F.lit(0.5)),
            "extractor_version": F.coalesce("extractor_version", F.lit("heuristic-v1")),
            "evidence_object_key": key,
        }
    )


def link_rows(assigned: DataFrame, existing: DataFrame | None = None, resolver: str = "starter-merge-v1") -> DataFrame:
    """Company-observation links that are not there yet."""
    links = assigned.select(
        "company_id", F.col("id").alias("observation_id"), F.col("confidence").alias("match_score"),
        F.to_json(F.struct(F.lit(resolver).alias("resolver"))).alias("match_reason"),
    ).dropDuplicates(["company_id", "observation_id"])
    return links if existing is None else absent_rows(existing, links, ["company_id", "observation_id"])


# --- lookup against a company table ------------------------------------------
def lookup_companies(
    observations: DataFrame, companies: DataFrame, key: str = "id", hot_rows: int = HOT_KEY_ROWS
) -> DataFrame:
    """Add ``matched_company_id``: the lowest id with the same domain or the same name.

    The OR is two lookups on the smallest id per domain and per name, each of
    them unique on its key, so no row multiplies and nothing is compared pairwise.
    """

    def smallest(column: str, out: str) -> DataFrame:
        known = companies.where(F.col(column).isNotNull())
        return known.groupBy(column).agg(F.min("id").alias(out))

    by_domain = smallest("primary_domain", "_domain_id")
    by_name = smallest("canonical_name", "_name_id").withColumnRenamed("canonical_name", "company_name")
    joined = lookup_join(observations, by_domain, "primary_domain", F.col(key), hot_rows)
    joined = lookup_join(joined, by_name, "company_name", F.col(key), hot_rows)
    return joined.withColumn("matched_company_id", F.least("_domain_id", "_name_id")).drop("_domain_id", "_name_id")


# --- components --------------------------------------------------------------
def _domain_key() -> Column:
    return F.concat(F.lit("d:"), F.col("primary_domain"))


def _name_key() -> Column:
    """Name by which the observation looks, or under which it would found a company."""
    return F.concat(F.lit("n:"), F.when(nonempty(F.col("company_name")), F.col("company_name")).otherwise(F.col("fallback_name")))


def observation_components(observations: DataFrame, hot_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """Add ``component``: observations linked through shared domains and names, exactly."""
    keyed = observations.withColumns({"_a": F.coalesce(_domain_key(), _name_key()), "_b": _name_key()})
    nodes = connected_components(keyed.select(F.col("_a").alias("a"), F.col("_b").alias("b")), hot_rows)
    labels = nodes.select(F.col("node").alias("_a"), "component")
    return lookup_join(keyed, labels, "_a", F.col("id"), hot_rows).drop("_a", "_b")


def resolve_by_component(observations: DataFrame, hot_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """Coarse assignment: one company per component, named after its first observation."""
    labelled = observation_components(with_resolution_columns(observations), hot_rows)
    firsts = labelled.groupBy("component").agg(F.min("id").alias("company_id"))
    return lookup_join(labelled, firsts, "component", F.col("id"), hot_rows).drop("component")


# --- the ordered fold --------------------------------------------------------
class _Companies:
    """Companies of one component, found by the domain or name they have at the moment."""

    def __init__(self, latest_name: bool = False) -> None:
        self.latest_name = latest_name
        self.rows: dict[int, list] = {}  # rank -> [domain, name, weight]
        self.index: tuple[dict, dict] = ({}, {})

    def put(self, rank: int, slot: int, key: str | None) -> None:
        self.rows[rank][slot] = key
        if key is not None:
            heapq.heappush(self.index[slot].setdefault(key, []), rank)

    def add(self, rank: int, domain: str | None, name: str | None, weight: float) -> None:
        self.rows[rank] = [None, None, weight]
        self.put(rank, 0, domain)
        self.put(rank, 1, name)

    def oldest(self, slot: int, key: str | None) -> int | None:
        heap = self.index[slot].get(key) if key is not None else None
        while heap and self.rows[heap[0]][slot] != key:
            heapq.heappop(heap)  # renamed or moved since it was entered
        return heap[0] if heap else None

    def observe(self, obs_id: int, domain: str | None, name: str | None, fallback: str, weight: float) -> int:
        found = [r for r in (self.oldest(0, domain), self.oldest(1, name)) if r is not None]
        if not found:
            rank = _NEW + obs_id
            self.add(rank, domain, fallback, weight)
            return rank
        rank = min(found)
        row = self.rows[rank]
        if domain is not None and domain != row[0]:
            self.put(rank, 0, domain)
        takes = name is not None if self.latest_name else bool(name) and (not row[1] or weight > row[2])
        if takes and name != row[1]:
            self.put(rank, 1, name)
        row[2] = weight
        return rank


def _fold(batches: Iterator[pd.DataFrame], latest_name: bool) -> Iterator[pd.DataFrame]:
    """Walk rows sorted by (component, kind, id); only the current component is in memory.

    Kind 0 rows are companies that exist already (id is their rank), kind 1 rows
    are observations.  Gives a rank per observation, and each component's
    companies as they stand at its end.
    """
    current, state = None, _Companies(latest_name)

    def closing() -> list[tuple]:
        return [(current, 0, rank, rank, d, n, w) for rank, (d, n, w) in state.rows.items()]

    columns = ["component", "kind", "id", "rank", "domain", "name", "weight"]
    for batch in batches:
        out = []
        for component, kind, row_id, domain, name, fallback, weight in zip(*(batch[c].tolist() for c in batch.columns)):
            if component != current:
                if current is not None:
                    out += closing()
                current, state = component, _Companies(latest_name)
            if kind == 0:
                state.add(row_id, domain, name, weight)
            else:
                rank = state.observe(row_id, domain, name, fallback, weight)
                out.append((component, 1, row_id, rank, None, None, None))
        yield pd.DataFrame(out, columns=columns)
    if current is not None:
        yield pd.DataFrame(closing(), columns=columns)


def _run_fold(rows: DataFrame, latest_name: bool) -> DataFrame:
    ordered = rows.repartition("component").sortWithinPartitions("component", "kind", "id")
    return map_frames(
        ordered, partial(_fold, latest_name=latest_name), "component long, kind int, id long, rank long, domain string, name string, weight double"
    )


def _fold_in_slices(rows: DataFrame, seeds: DataFrame, max_rows: int, latest_name: bool) -> DataFrame:
    """Ranks of components too large for one task, ``max_rows`` observations of each at a time.

    Every round folds the next slice of all such components, starting from the
    companies the rounds before left behind.  A slice only needs the companies
    that have one of its keys: no other company can be found, so none can change.
    """
    placed = running_totals(rows, "component", "id", {"_nth": F.lit(1)}, chunk_rows=max_rows)
    placed = cut_lineage(placed.withColumn("_slice", F.floor((F.col("_nth") - 1) / max_rows).cast("int")))
    rounds = placed.agg(F.max("_slice")).first()[0]
    names = [f.split()[0] for f in _FOLD_ROWS.split(", ")]
    state, done = seeds, None
    for number in range((rounds if rounds is not None else -1) + 1):
        part = placed.where(F.col("_slice") == number)
        keys = part.select("component", F.explode(F.array(
            F.concat(F.lit("d:"), "domain"), F.concat(F.lit("n:"), "name"))).alias("_key")).where("_key is not null").distinct()
        held = state.withColumn("_key", F.explode(F.array(F.concat(F.lit("d:"), "domain"), F.concat(F.lit("n:"), "name"))))
        touched = held.join(keys, ["component", "_key"], "left_semi").select("component", "id").distinct()
        active = state.join(touched, ["component", "id"], "left_semi")
        folded = cut_lineage(_run_fold(active.select(*names).unionByName(part.select(*names)), latest_name))
        ended = folded.where("kind = 0").select(
            "component", F.lit(0).alias("kind"), "id", "domain", "name", F.col("name").alias("fallback"), "weight"
        )
        untouched = state.join(touched, ["component", "id"], "left_anti")
        state = cut_lineage(untouched.unionByName(ended))
        ranks = folded.where("kind = 1").select("id", "rank")
        done = ranks if done is None else done.unionByName(ranks)
    return done if done is not None else rows.select("id", F.col("id").alias("rank")).limit(0)


def reachable_companies(narrow: DataFrame, companies: DataFrame) -> DataFrame:
    """Companies that have a domain or name of the batch; no other can be found or changed by it."""

    def tagged(*columns: str) -> Column:
        return F.explode(F.array(*[F.concat(F.lit("d:" if "domain" in c else "n:"), c) for c in columns]))

    keys = narrow.select(tagged("domain", "name", "fallback").alias("_key")).where("_key is not null").distinct()
    held = companies.select("id", tagged("primary_domain", "canonical_name").alias("_key"))
    hits = held.join(keys, "_key", "left_semi").select("id").distinct()
    return companies.join(hits, "id", "left_semi")


def assign_companies(
    observations: DataFrame, companies: DataFrame | None = None, max_fold_rows: int = MAX_FOLD_ROWS,
    hot_rows: int = HOT_KEY_ROWS, variant: str = "staged", empty_domain_is_key: bool = False,
) -> DataFrame:
    """Add ``company_id`` to every observation, exactly as if they came one by one in id order.

    * Components come from 64-bit key hashes; a collision only joins two
      components, which the fold keeps apart by their real keys.
    * A component whose rows all carry one domain is one company; so is one
      whose rows have no domain and one name.  They need no fold, however large.
    * Other components run through the ordered fold, streamed, next to each other.
    * Those above ``max_fold_rows`` rows advance slice by slice.

    Only id, domain, name, fallback name and weight enter the fold.  New ids
    follow the largest existing one in founding order.  With
    ``variant="starter"`` a company always takes the latest name, whatever its weight,
    also an empty one, which is then found like any other.
    """
    latest_name = variant == "starter"
    prepared = with_resolution_columns(observations, empty_domain_is_key)
    narrow = prepared.select(
        "id", F.col("primary_domain").alias("domain"), F.col("company_name").alias("name"),
        F.col("fallback_name").alias("fallback"), "weight",
        F.xxhash64(F.coalesce(_domain_key(), _name_key())).alias("_a"), F.xxhash64(_name_key()).alias("_b"),
    )
    pairs = narrow.select(F.col("_a").alias("a"), F.col("_b").alias("b"))
    if latest_name:
        pairs = pairs.unionByName(narrow.where("name = ''").select(F.col("_b").alias("a"), F.xxhash64(F.lit("n:")).alias("b")))
    seeds = None
    if companies is not None:
        seeds = reachable_companies(narrow, companies).select(
            F.lit(0).alias("kind"), "id", F.col("primary_domain").alias("domain"), F.col("canonical_name").alias("name"),
            F.col("canonical_name").alias("fallback"),
            F.coalesce("confidence_details.weighted_confidence", F.lit(0.0)).alias("weight"),
            F.xxhash64(F.coalesce(F.concat(F.lit("d:"), "primary_domain"), F.concat(F.lit("n:"), "canonical_name"))).alias("_a"),
            F.xxhash64(F.concat(F.lit("n:"), "canonical_name")).alias("_b"),
        )
        pairs = pairs.unionByName(seeds.select(F.col("_a").alias("a"), F.col("_b").alias("b")))
    labels = connected_components(pairs, hot_rows).select(F.col("node").alias("_a"), "component")
    # Counted per key first: only keys, not observations, are grouped by component.
    named = F.coalesce(F.nullif(F.col("name"), F.lit("")), F.lit(""))
    by_key = narrow.groupBy("_a").agg(
        F.count(F.lit(1)).alias("_rows"), F.count("domain").alias("_with_domain"), F.min("domain").alias("_d0"),
        F.max("domain").alias("_d1"), F.min(named).alias("_n0"), F.max(named).alias("_n1"), F.min("id").alias("_first"),
    )
    keys = cut_lineage(by_key.join(labels, "_a"))
    stats = keys.groupBy("component").agg(
        *[F.sum(c).alias(c) for c in ("_rows", "_with_domain")], *[F.min(c).alias(c) for c in ("_d0", "_n0", "_first")],
        *[F.max(c).alias(c) for c in ("_d1", "_n1")],
    )
    one_domain = (F.col("_with_domain") == F.col("_rows")) & (F.col("_d0") == F.col("_d1"))
    one_name = (F.col("_with_domain") == 0) & (F.col("_n0") != "") & (F.col("_n0") == F.col("_n1"))
    if seeds is not None:
        seeds = seeds.join(labels, "_a").drop("_a", "_b")
        seeded = seeds.groupBy("component").agg(F.count(F.lit(1)).alias("_seeds"))
        stats = stats.join(seeded, "component", "left")
        plain = (one_domain | one_name) & F.col("_seeds").isNull()
    else:
        plain = one_domain | one_name
    plan = stats.select(
        "component", "_first", plain.alias("_plain"), (F.col("_rows") > max_fold_rows).alias("_giant")
    )
    by_component = keys.groupBy("component").count()
    key_plan = lookup_join(keys.select("_a", "component"), plan, "component", F.col("_a"), hot_rows, by_component)
    counts = keys.select("_a", F.col("_rows").alias("count"))
    planned = cut_lineage(lookup_join(narrow.drop("_b"), key_plan, "_a", F.col("id"), hot_rows, counts).drop("_a"))
    rows = planned.where(~F.col("_plain")).withColumn("kind", F.lit(1))
    names = [f.split()[0] for f in _FOLD_ROWS.split(", ")]
    simple = planned.where("_plain").select("id", (F.col("_first") + F.lit(_NEW)).alias("rank"))
    small = rows.where(~F.col("_giant")).select(*names)
    giant = rows.where("_giant").select(*names)
    if seeds is None:
        carried = giant.where("kind = 0")
        ordinary = small
    else:
        kinds = plan.where(~F.col("_plain")).select("component", "_giant")
        held = seeds.join(kinds, "component")
        carried = held.where("_giant").select(*names)
        ordinary = small.unionByName(held.where(~F.col("_giant")).select(*names))
    ranks = simple.unionByName(_run_fold(ordinary, latest_name).where("kind = 1").select("id", "rank"))
    if not giant.isEmpty():
        ranks = ranks.unionByName(_fold_in_slices(giant, carried, max_fold_rows, latest_name))
    ranks = cut_lineage(ranks)
    founders = ranks.where(F.col("rank") >= _NEW).select("rank").distinct()
    founders = founders.withColumn("_position", F.col("rank") - F.lit(_NEW))
    numbered = number_rows(founders, "_position", [], "_number").select("rank", "_number")
    if companies is not None:
        top = F.coalesce(companies.agg(F.max("id")).scalar(), F.lit(0))
        numbered = numbered.select("rank", (top + F.col("_number")).alias("_number"))
    final = lookup_join(ranks, numbered, "rank", F.col("id"), hot_rows)
    ids = final.select("id", F.coalesce("_number", "rank").alias("company_id"))
    return prepared.join(ids, "id")


class Resolution(NamedTuple):
    companies: DataFrame
    values: DataFrame
    links: DataFrame


def _seed_observations(companies: DataFrame, like: DataFrame) -> DataFrame:
    """Existing companies as rows that come before every observation."""
    back = {column: field for field, column in FIELDS.items()}
    values = {back[c]: F.col(c) for c in back}
    values |= {
        "company_id": F.col("id"), "id": F.lit(-1).cast("bigint"), "company_name": F.col("canonical_name"),
        "fallback_name": F.col("canonical_name"), "primary_domain": F.col("primary_domain"),
        "confidence": F.col("confidence"), "weight": F.coalesce("confidence_details.weighted_confidence", F.lit(0.0)),
        "observed_at": F.col("first_seen_at"), "extractor_version": F.col("confidence_details.extractor_version"),
        "page_type": F.col("confidence_details.page_type"),
    }
    types = dict(like.dtypes)
    return companies.select(
        *[values.get(n, F.lit(None)).cast(types[n]).alias(n) for n in like.columns]
    )


def resolve_observations(
    observations: DataFrame, companies: DataFrame | None = None, links: DataFrame | None = None,
    variant: str = "staged", max_fold_rows: int = MAX_FOLD_ROWS, hot_rows: int = HOT_KEY_ROWS, empty_domain_is_key: bool = False,
    now: Column | None = None,
) -> Resolution:
    """Assign, merge and link a batch of observations against an optional company table.

    ``companies`` of the result holds every company, touched or not, with all
    columns of the given table; ``values`` the list entries this batch adds in
    long form; ``links`` the new links.  With ``now``, companies of the batch get
    it as ``updated_at``, and a ``status`` where they have none.
    """
    assigned = cut_lineage(assign_companies(observations, companies, max_fold_rows, hot_rows, variant, empty_domain_is_key))
    rows = assigned
    if companies is not None:
        hit = assigned.select(F.col("company_id").alias("id")).distinct()
        rows = rows.unionByName(_seed_observations(companies.join(hit, "id", "left_semi"), assigned))
    merged = merged_companies(rows, variant).withColumnRenamed("company_id", "id").drop("observation_count")
    if companies is not None:
        others = [c for c in companies.columns if c not in merged.columns]
        seen = F.col("last_seen_at") if "last_seen_at" in companies.columns else F.lit(None).cast("timestamp")
        stored = companies.select(F.col("id").alias("_id"), seen.alias("_seen"), *others)
        joined = merged.join(stored, F.col("id") == F.col("_id"), "left")
        merged = joined.withColumn("last_seen_at", F.greatest("last_seen_at", "_seen")).drop("_id", "_seen")
    if now is not None:
        status = F.col("status") if "status" in merged.columns else F.lit(None).cast("string")
        merged = merged.withColumns({"status": F.coalesce(status, F.lit(schemas.COMPANY_DEFAULT_STATUS)), "updated_at": now})
    if companies is not None:
        kept = companies.join(assigned.select(F.col("company_id").alias("id")), "id", "left_anti")
        merged = merged.unionByName(kept, allowMissingColumns=True)
    resolver = "starter-v1" if variant == "starter" else "starter-merge-v1"
    return Resolution(merged, company_values(assigned), link_rows(assigned, links, resolver))
