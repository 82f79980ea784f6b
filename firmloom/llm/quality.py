"""Quality rules with distribution divergence.

Each document's character classes and common words are counted and compared
with the reference distribution of its language by Jensen-Shannon distance.
The references are measured over the corpus itself: every document that passes
the base rules and is long enough counts once, whatever its length; in a second
round only those that lie no further from the first reference than the mean.
Only column expressions are used; the text is read once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from firmloom.llm.common import SPACE_CLASS, hinted, let, stored, table

# Frequent function words of each language, most frequent first.
COMMON_WORDS = {
    "en": "the of and to in is that for with on be are was by this as at from or it a an he not".split(),
    "fr": "de la le et les des en un une du que qui dans pour par sur au est pas avec ne se ce il".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an er".split(),
    "es": "de la que el en y a los del se las por un para con no una su al lo como más o es".split(),
}
#: Name of the reference for documents whose language has none of its own: all documents together.
ALL = "*"
#: A language without a word list has a reference of its own from this many documents fit for one.
MIN_REFERENCE_DOCS = 50
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Documents with fewer code points or words are too short for the comparison.
MIN_CHARS = 200
MIN_COMMON_WORDS = 50
MAX_CHAR_DISTANCE = 0.13
MAX_WORD_DISTANCE = 0.5
#: Each document's share in a reference, in parts of this many: whole numbers add up alike in any order.
PARTS = 1_000_000
CLASSES = 5


def _dropped(text: Column, pattern: str) -> Column:
    return F.regexp_replace(text, pattern, "")


def char_classes(text: Column) -> Column:
    """classes: counts of lower-case letters and digits, spaces, upper-case letters, punctuation, all other code points; n_symbols.

    Letters without case and combining marks count as lower-case letters.
    Digits stand with the letters: numbers and keys in a text don't make it junk.
    Each step takes its class out, so the later ones see short remainders.
    """
    steps = [r"[\p{Ll}\p{Lo}\p{Lm}\p{M}\p{Nd}]+", f"[{SPACE_CLASS}]+", r"[\p{Lu}\p{Lt}]+", r"[.,;:!?'\"()\-]+"]

    def walk(left: Column, rest: list[str], counts: list[Column]) -> Column:
        if not rest:
            symbols = F.length(left) - F.length(_dropped(left, r"[#*$%&|<>]+"))
            return F.struct(F.array(*counts, F.length(left)).cast("array<bigint>").alias("classes"), symbols.cast("long").alias("n_symbols"))
        return let(_dropped(left, rest[0]), lambda less: walk(less, rest[1:], [*counts, F.length(left) - F.length(less)]))

    return walk(text, steps, [])


def common_word_counts(words: Column, lang: Column) -> Column:
    """How often each common word of the language stands among the words, then the number of all other words.

    Null for a language without a list.  Words count as they stand, in lower
    case and without punctuation, in documents and references alike.  Sorting
    puts equal words side by side, so a count is the distance of a word's first
    and last place.
    """
    lists = {name: F.array(*map(F.lit, listed)) for name, listed in COMMON_WORDS.items()}
    names = list(lists)
    vocabulary = reduce(lambda got, n: got.when(lang == n, lists[n]), names[1:], F.when(lang == names[0], lists[names[0]]))
    any_list = sorted({w for listed in COMMON_WORDS.values() for w in listed})

    def counted(listed: Column) -> Column:
        def places(up: Column, down: Column) -> Column:
            def count(w: Column) -> Column:
                first = F.array_position(up, w)
                return F.when(first == 0, F.lit(0)).otherwise(F.size(up) + 2 - first - F.array_position(down, w)).cast("long")

            return let(F.transform(listed, count), lambda c: F.concat(c, F.array(F.size(words) - total(c))))

        known = F.sort_array(F.filter(words, lambda w: w.isin(*any_list)))
        return let(known, lambda up: let(F.reverse(up), lambda down: places(up, down)))

    return F.when(vocabulary.isNotNull(), let(vocabulary, counted))


def repeated_words(words: Column) -> Column:
    """Words that lie in a window of three words found twice or more, the first occurrence included.

    Windows are compared by a 64-bit hash.  Sorted, equal ones stand side by
    side; their places, sorted again, each cover three words or as many as
    there are up to the next place.
    """
    hashes = F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
    )

    def covered(s: Column) -> Column:
        def equal(k: Column, x: Column) -> Column:
            return (F.get(s, k)["h"] == x["h"]).eqNullSafe(F.lit(True))

        again = F.filter(s, lambda x, k: equal(k - 1, x) | equal(k + 1, x))
        places = F.sort_array(F.transform(again, lambda x: x["i"]))
        spans = let(places, lambda p: F.transform(p, lambda i, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - i, F.lit(3)))))
        return F.aggregate(spans, F.lit(0), lambda a, b: a + b)

    def judged(h: Column) -> Column:
        placed = F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(F.sort_array(placed), covered))

    return F.when(F.size(words) < 3, F.lit(0)).otherwise(let(hashes, judged)).cast("long")


def measured(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """``docs`` with counts in a struct column ``_m``; a null text counts as empty."""
    whole = F.coalesce(F.col(text), F.lit(""))
    words = F.regexp_extract_all(whole, F.lit(f"[^{SPACE_CLASS}]+"), F.lit(0))
    lines = F.filter(F.split(whole, "\n"), lambda x: x.rlike(f"[^{SPACE_CLASS}]"))

    def counts(w: Column, chars: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            (total(chars["classes"]) - chars["classes"][1]).alias("word_chars"),
            chars["n_symbols"].alias("n_symbols"),
            let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            repeated_words(w).alias("n_repeat_words"),
            chars["classes"].alias("chars"),
            common_word_counts(w, F.col(lang)).alias("common"),
        )

    return docs.withColumn("_m", let(words, lambda w: let(char_classes(whole), lambda chars: counts(w, chars))))


def total(counts: Column) -> Column:
    return F.aggregate(counts, F.lit(0).cast("long"), lambda a, b: a + b)


def js_distance(counts: Column, reference: Column) -> Column:
    """Jensen-Shannon distance (square root, base 2) of two count vectors, to nine digits; null if one is empty."""

    def half(p: Column, m: Column) -> Column:
        return F.when(p > 0, p * F.log2(p / m)).otherwise(F.lit(0.0))

    def apart(n: Column, r: Column) -> Column:
        def term(a: Column, b: Column) -> Column:
            p, q = a / n, b / r
            return half(p, (p + q) / 2) + half(q, (p + q) / 2)

        summed = F.aggregate(F.zip_with(counts, reference, term), F.lit(0.0), lambda a, b: a + b)
        return F.round(F.sqrt(F.greatest(summed / 2, F.lit(0.0))), 9)

    return let(total(counts), lambda n: let(total(reference), lambda r: F.when((n > 0) & (r > 0), apart(n, r))))


def references(fit: DataFrame) -> DataFrame:
    """One row per language with a reference of its own and one for all documents: summed shares of character classes and common words.

    At most as many rows as COMMON_WORDS has languages, one for each MIN_REFERENCE_DOCS documents, and one more.
    """

    def shares(name: str) -> Column:
        return let(total(F.col(name)), lambda n: F.transform(F.col(name), lambda c: F.when(n > 0, F.floor(c * PARTS / n)).otherwise(F.lit(0))))

    rows = fit.select("_ref", shares("_m.chars").alias("c"), shares("_m.common").alias("w"))
    dims = {"c": CLASSES, "w": max(map(len, COMMON_WORDS.values())) + 1}
    names = [f"{v}{i}" for v, n in dims.items() for i in range(n)]
    sums = [F.sum(F.get(F.col(n[0]), F.lit(int(n[1:])))).alias(n) for n in names]
    per_language = rows.groupBy("_ref").agg(*sums)
    whole = per_language.groupBy(F.lit(ALL).alias("_ref")).agg(*[F.sum(n).alias(n) for n in names])
    both = per_language.where(F.col("_ref") != ALL).unionByName(whole)
    pack = [F.filter(F.array(*[F.col(f"{v}{i}") for i in range(n)]), lambda x: x.isNotNull()).alias(f"_{v}") for v, n in dims.items()]
    return hinted(stored(both.select("_ref", *pack)))


def central(fit: DataFrame) -> DataFrame:
    """The documents no further from their reference than the mean: junk, which stands apart, raises the mean and drops out."""
    apart = fit.join(references(fit), "_ref").withColumn("_d", F.floor(PARTS * js_distance(F.col("_m.chars"), F.col("_c"))))
    mean = apart.groupBy("_ref").agg((F.sum("_d") / F.count("_d")).alias("_mean"))
    return apart.join(hinted(stored(mean)), "_ref").where(F.col("_d") <= F.col("_mean")).select(*fit.columns)


def quality_rules(docs: DataFrame, text: str = "text", lang: str = "lang", carry: tuple[str, ...] | None = None) -> DataFrame:
    """Each row's counts, distances and verdict.

    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long),
    base_failed, char_distance, word_distance (null where not applied) and kept
    are added to the columns ``carry`` (all but the text by default; columns of
    those names are replaced).  A null or empty text has no words and fails the
    base rules.  A language without a word list is compared by characters and
    not by words, with its own documents, or with all documents if it is null
    or has too few.  Repeated rows are judged alike; with no
    document to learn a reference from, only the base rules hold.
    """
    made = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "char_distance", "word_distance", "kept"]
    keep = [c for c in (carry if carry is not None else [c for c in docs.columns if c != text]) if c not in made]
    rows = docs.select(*[F.col(c).alias(f"k_{i}") for i, c in enumerate(keep)], F.col(lang).alias("lang"), F.col(text).alias("text"))
    failed = (F.col("_m.n_words") < MIN_WORDS) | (100 * F.col("_m.n_repeat_words") > MAX_REPEAT_PERCENT * F.col("_m.n_words"))
    counted = stored(measured(rows).drop("text").withColumn("base_failed", failed))
    known = F.col("lang").isin(*COMMON_WORDS)
    long_enough = ~F.col("base_failed") & (total(F.col("_m.chars")) >= MIN_CHARS)
    others = counted.where(long_enough & ~known & (F.col("lang") != ALL)).groupBy("lang").count().where(F.col("count") >= MIN_REFERENCE_DOCS)
    own = hinted(stored(others.select(F.col("lang").alias("_own"))))
    counted = counted.join(own, F.col("lang") == F.col("_own"), "left")
    counted = counted.withColumn("_ref", F.when(known, F.col("lang")).otherwise(F.coalesce("_own", F.lit(ALL)))).drop("_own")
    fit = counted.where(long_enough)
    met = counted.join(references(central(fit)), "_ref", "left")
    judged = met.withColumn(
        "char_distance", F.when(total(F.col("_m.chars")) >= MIN_CHARS, js_distance(F.col("_m.chars"), F.col("_c")))
    ).withColumn(
        "word_distance", F.when(known & (F.col("_m.n_words") >= MIN_COMMON_WORDS), js_distance(F.col("_m.common"), F.col("_w")))
    )
    far = (F.coalesce("char_distance", F.lit(0.0)) > MAX_CHAR_DISTANCE) | (F.coalesce("word_distance", F.lit(0.0)) > MAX_WORD_DISTANCE)
    return judged.withColumn("kept", ~F.col("base_failed") & ~far).select(
        *[F.col(f"k_{i}").alias(c) for i, c in enumerate(keep)], *[F.col(f"_m.{c}") for c in made[:5]], *made[5:]
    )


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"), carry=("doc_id",))
