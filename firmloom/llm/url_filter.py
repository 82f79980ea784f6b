"""URL filter: character language models of accepted and rejected URLs.

Two smoothed variable-order Markov models, one of the hosts and paths that the
rules accept and one of those they reject, are counted over all URLs.  A URL's
score is the log-likelihood difference of the two per character; URLs whose
score stays under a threshold, calibrated on rule-judged URLs kept out of the
counts, are rejected.  Only column expressions are used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from firmloom.llm.common import ascii_lower, let, stored, table

ALLOW, BLOCK = "allow", "block"
# The given rules.
RULES = ((ALLOW, "com/"), (BLOCK, "example.com/en/"), (ALLOW, "www.example.com/en/"), (BLOCK, "net/es/"), (BLOCK, "net/fr/"))
#: Longest context in characters.
ORDER = 4
#: A context takes part in a model if the model has seen it this often; else a shorter one speaks alone.
MIN_CONTEXT = 3
#: Weight of the shorter context's estimate, in observations.
SMOOTHING = 2.0
ALPHABET = 256
#: One of so many rule-judged URLs (by hash) calibrates and is not counted.
HELD_OUT = 5
#: Weights are whole numbers of 1/UNIT nats: they add up alike in any order.
UNIT = 1_000_000
#: Scores are counted in steps of UNIT / STEPS to find the threshold, between -LIMIT and LIMIT nats.
STEPS, LIMIT = 50, 20
PAD = "\u0002"


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """struct(verdict, rule) of the longest rule that fits (of equally long ones the first), else null."""
    found = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        found = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))).otherwise(found)
    return found


def gram_list(text: Column, order: int) -> Column:
    """Every character with the ``order`` characters before it; the start is padded."""
    padded = F.concat(F.lit(PAD * order), text)
    return let(padded, lambda p: F.when(F.length(text) > 0, F.transform(F.sequence(F.lit(1), F.length(text)), lambda i: F.substr(p, i, F.lit(order + 1)))).otherwise(F.array().cast("array<string>")))


def gram_weights(texts: DataFrame, order: int = ORDER) -> DataFrame:
    """gram, weight: log-probability difference of the two models for each gram that occurs in ``texts`` (text, label, n, counted).

    From the empty context up: n(context, character) + SMOOTHING * shorter
    estimate, over n(context) + SMOOTHING, where the context is known well
    enough, else the shorter estimate.
    """
    occurring = texts.select(F.explode(gram_list(F.col("text"), order)).alias("g"), "label", "n", "counted")
    count = {v: F.sum(F.when(F.col("counted") & (F.col("label") == v), F.col("n")).otherwise(F.lit(0))).alias(v) for v in (ALLOW, BLOCK)}
    grams = stored(occurring.groupBy("g").agg(*count.values()))
    shorter = None
    for k in range(order + 1):
        sub = F.substr(F.col("g"), F.lit(order + 1 - k), F.lit(k + 1))
        seen = grams.groupBy(sub.alias("s")).agg(*[F.sum(v).alias(v) for v in (ALLOW, BLOCK)])
        seen = seen.withColumn("c", F.substr("s", F.lit(1), F.lit(k)))
        context = seen.groupBy("c").agg(*[F.sum(v).alias(f"{v}_c") for v in (ALLOW, BLOCK)])
        rows = seen.join(F.broadcast(context) if k == 0 else context, "c")  # the empty context is one row
        if shorter is None:
            rows = rows.withColumns({f"{v}_p": F.lit(1.0 / ALPHABET) for v in (ALLOW, BLOCK)})
        else:
            rows = rows.withColumn("t", F.substr("s", F.lit(2), F.lit(k))).join(shorter, "t")
        estimate = {
            f"{v}_q": F.when(F.col(f"{v}_c") >= MIN_CONTEXT, (F.col(v) + SMOOTHING * F.col(f"{v}_p")) / (F.col(f"{v}_c") + SMOOTHING)).otherwise(F.col(f"{v}_p"))
            for v in (ALLOW, BLOCK)
        }
        last = rows.withColumns(estimate)
        shorter = last.select(F.col("s").alias("t"), *[F.col(f"{v}_q").alias(f"{v}_p") for v in (ALLOW, BLOCK)])
    return last.select(F.col("s").alias("g"), F.round(UNIT * (F.log(f"{ALLOW}_q") - F.log(f"{BLOCK}_q"))).cast("long").alias("weight"))


def threshold(scored: DataFrame) -> DataFrame:
    """One row, ``least``: the score step with the most held-out URLs on their right side (per label; the lowest of equal ones).

    It lies halfway between the two scores that it parts.

    Null if either label has no held-out URL.  Scores are counted in at most
    2 * LIMIT * STEPS + 1 steps before they meet.
    """
    step = F.least(F.greatest(F.floor(F.col("score") * STEPS / UNIT), F.lit(-LIMIT * STEPS)), F.lit(LIMIT * STEPS))
    counts = scored.where(F.col("label").isNotNull() & ~F.col("counted")).groupBy(step.alias("step")).agg(
        *[F.sum(F.when(F.col("label") == v, F.col("n")).otherwise(F.lit(0))).alias(v) for v in (ALLOW, BLOCK)]
    )
    steps = F.sort_array(F.collect_list(F.struct("step", ALLOW, BLOCK)))
    one = counts.agg(steps.alias("s"), *[F.sum(v).alias(v) for v in (ALLOW, BLOCK)])
    start = F.struct(F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"), F.lit(-2).cast("decimal(38,0)").alias("best"), F.lit(None).cast("long").alias("least"), F.lit(None).cast("long").alias("last"))

    def walk(acc: Column, x: Column) -> Column:
        gain = (acc["b"].cast("decimal(18,0)") * F.col(ALLOW).cast("decimal(18,0)") - acc["a"].cast("decimal(18,0)") * F.col(BLOCK).cast("decimal(18,0)")).cast("decimal(38,0)")
        better = gain > acc["best"]
        return F.struct(
            (acc["a"] + x[ALLOW]).alias("a"), (acc["b"] + x[BLOCK]).alias("b"),
            F.when(better, gain).otherwise(acc["best"]).alias("best"),
            F.when(better, F.floor((x["step"] + F.coalesce(acc["last"], x["step"])) / 2)).otherwise(acc["least"]).alias("least"), x["step"].alias("last"),
        )

    return one.select(F.when((F.col(ALLOW) > 0) & (F.col(BLOCK) > 0), F.aggregate("s", start, walk)["least"]).alias("least"))


def filter_urls(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, url: str = "url", carry: Sequence[str] = ("page_id",)) -> DataFrame:
    """``carry`` columns, host, path, rule, verdict and score of every row.

    The longest fitting rule decides.  Else the models do: the URL is blocked if
    its score, log-likelihood difference per character of host and path, is
    under the calibrated threshold.  score is null where a rule decides and for
    a URL without host and path (null, or no ``://``), which is allowed; so is
    every URL when the rules accept or reject nothing to learn from.
    """
    rows = pages.select(*[F.col(c).alias(f"k_{i}") for i, c in enumerate(carry)], host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    rows = rows.withColumn("_m", matching_rule(F.col("host"), F.col("path"), rules))
    held = F.pmod(F.xxhash64("host", "path"), F.lit(HELD_OUT)) == 0
    texts = rows.groupBy("host", "path").agg(F.first("_m.verdict").alias("label"), F.count(F.lit(1)).alias("n"))
    texts = stored(texts.select("host", "path", F.concat("host", "path").alias("text"), "label", "n", (~held & F.col("label").isNotNull()).alias("counted")))
    to_score = texts.where(~F.col("counted") & (F.length("text") > 0))
    summed = (
        to_score.select("host", "path", "label", "n", "counted", F.explode(gram_list(F.col("text"), ORDER)).alias("g"))
        .hint("merge")  # the stored texts look small, what they explode into is not
        .join(gram_weights(texts), "g")
        .groupBy("host", "path", "label", "n", "counted").agg(F.sum("weight").alias("total"), F.count(F.lit(1)).alias("chars"))
    )
    scored = stored(summed.withColumn("score", F.floor(F.col("total") / F.col("chars")).cast("long")))
    (least,) = threshold(scored).first()  # one number
    low = F.lit(False) if least is None else F.col("score") < least * (UNIT // STEPS)
    judged = scored.where(F.col("label").isNull()).select(
        "host", "path", (F.col("score") / UNIT).alias("score"), F.when(low, F.lit(BLOCK)).otherwise(F.lit(ALLOW)).alias("modelled")
    )
    met = rows.join(judged, ["host", "path"], "left")
    verdict = F.coalesce(F.col("_m.verdict"), F.col("modelled"), F.lit(ALLOW))
    return met.select(*[F.col(f"k_{i}").alias(c) for i, c in enumerate(carry)], "host", "path", F.col("_m.rule").alias("rule"), verdict.alias("verdict"), "score")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"))
