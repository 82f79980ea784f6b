"""Secret scan: candidate strings, then a random forest against false positives.

One pass finds candidates (assigned values, known key shapes, long bare
tokens) and describes each by its length, character transitions, dictionary
coverage, the document's path and the neighbouring words.  A forest trained on
a bounded sample of labelled findings judges all candidates.  Labels come with
the findings: by default from a seeded set of planted secrets and lookalikes.
"""

from __future__ import annotations

import base64
import hashlib
import math
import random
import re
import string
import uuid
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from firmloom.llm.common import hinted, stored, table, text_key
from firmloom.session import map_frames

#: Most labelled findings of each kind that the forest is trained on (those with the smallest hash).
TRAIN_ROWS = 5_000
TREES, DEPTH, SEED = 24, 8, 7
#: Planted findings of each label.
LESSONS = 3_000
LESSON_WORDS = (
    "summer garden river window yellow market simple correct horse battery staple village morning letter number report system account server network "
    "winter mountain bridge station paper silver orange kitchen doctor teacher student season forest island harbour castle pencil bottle hunter dragon"
).split()
LEAST = 0.5
MASK = "[SECRET]"
#: Characters kept on either side of a candidate to look for neighbouring words.
REACH = 60

SHAPES = (
    r"\b(?:AKIA|ASIA)[0-9A-Z]{16}\b|\bgh[pousr]_[A-Za-z0-9]{36,}|\bxox[abeprs]-[A-Za-z0-9\-]{10,}|\bsk[-_][A-Za-z0-9_\-]{20,}|\bAIza[0-9A-Za-z_\-]{35}"
    r"|\beyJ[A-Za-z0-9_\-]{8,}\.eyJ[A-Za-z0-9_\-]{8,}\.[A-Za-z0-9_\-]*"
)
KNOWN = re.compile(SHAPES)
NAME = r"[A-Za-z_][A-Za-z0-9_.\-]*+"
START = r"(?<![A-Za-z0-9_.\-])"
SIGN = r"[\"']?\s*+(?::=|=>|=|:)\s*+"
#: A key block: its head, fields, and runs of base64 with nothing else between them.  What follows a head that no
#: such run follows is not part of a key, and neither is anything behind the last run but the block's own end.
GAP = r"(?:\s|\\[nr])*+"
BLOCK = (
    rf"-----BEGIN [A-Z ]{{0,40}}PRIVATE KEY-----(?:{GAP}[A-Z][A-Za-z\-]+: [^\n\\]*+)*+"
    rf"(?:{GAP}[A-Za-z0-9+/]{{24,}}+={{0,2}}(?=\s|\\[nr]|-----END|[\"'`]|\Z))++"
    rf"(?:(?:{GAP}[A-Za-z0-9+/]{{1,23}}={{0,2}})?{GAP}-----END [A-Z ]{{0,40}}PRIVATE KEY-----)?"
)
CANDIDATE = re.compile(
    rf"(?P<block>{BLOCK})"
    rf"|(?P<known>{SHAPES})"
    rf"|{START}(?P<name>{NAME}){SIGN}(?P<quote>[\"']?)(?!-----BEGIN )(?P<value>[A-Za-z0-9+/_=.$!@#%^&*~\-]{{8,}})"
    r"|(?<![A-Za-z0-9+/_=\-])(?P<bare>[A-Za-z0-9+/_=\-]{20,})(?![A-Za-z0-9+/_=\-])"
)
#: Within a value: a name that is assigned what follows, and a name at its end that may be assigned what stands after it.
INNER = re.compile(rf"{START}(?P<name>{NAME})=(?=[A-Za-z0-9+/_.$!@#%^&*~\-]{{8}})")
LAST_NAME = re.compile(rf"{START}{NAME}(?==?\Z)")
ASSIGNED = re.compile(rf"(?P<name>{NAME}){SIGN}[\"']?[A-Za-z0-9+/_.$!@#%^&*~\-]{{8}}")
TOKEN_HEAD = re.compile(r"\beyJ")
LEAST_VALUE, LEAST_BARE = 8, 20
HINT = re.compile(r"[=:]|-----BEGIN|[A-Za-z0-9+/_=\-]{15}")
# Words that speak for or against a secret nearby.
CREDENTIAL = re.compile(r"token|secret|passw|pwd|passphrase|api[_\-]?key|access[_\-]?key|auth|bearer|credential|private|signature|client[_\-]?id|\bkey\b", re.IGNORECASE)
HARMLESS = re.compile(r"example|sample|dummy|placeholder|changeme|your[_\-]|xxxx|fake|mock|commit|sha-?\d|md5|checksum|uuid|revision|digest|integrity|http|www\.", re.IGNORECASE)
TEST_PATH = re.compile(r"test|example|sample|doc|fixture|mock|demo", re.IGNORECASE)
UUID = re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
FEATURES = (
    "length", "transitions", "digits", "upper", "symbols", "entropy", "dictionary", "is_known", "assigned", "quoted",
    "credential_name", "credential_near", "harmless_near", "harmless_value", "test_path",
)


@lru_cache(maxsize=2)
def load_dictionary(path: str) -> frozenset[str]:
    """Lower-case letter runs of four or more among the entries of a tokenizer's rank file."""
    with open(path, "rb") as lines:
        entries = (base64.b64decode(line.split()[0]).strip() for line in lines if line.strip())
        return frozenset(e.decode().lower() for e in entries if len(e) >= 4 and e.isascii() and e.isalpha())


def coverage(value: str, words: frozenset[str]) -> float:
    """Share of the characters that the longest dictionary words, taken from the left, cover."""
    text, at, covered = value.lower(), 0, 0
    while at < len(text) - 3:
        for size in range(min(14, len(text) - at), 3, -1):
            if text[at : at + size] in words:
                covered += size
                at += size
                break
        else:
            at += 1
    return covered / len(text)


def _class(c: str) -> int:
    return 0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3


def describe(value: str, kind: str, name: str, quoted: bool, before: str, after: str, path: str, words: frozenset[str]) -> list[float]:
    classes = [_class(c) for c in value]
    n = len(value)
    entropy = -sum(k / n * math.log2(k / n) for k in Counter(value).values())
    near = f"{before} {after}"
    return [
        float(n), sum(a != b for a, b in zip(classes, classes[1:], strict=False)) / max(n - 1, 1),
        classes.count(2) / n, classes.count(1) / n, classes.count(3) / n, entropy, coverage(value, words),
        float(kind in ("known", "block") or bool(KNOWN.search(value))), float(kind == "value"), float(quoted), float(bool(CREDENTIAL.search(name))),
        float(bool(CREDENTIAL.search(near))), float(bool(HARMLESS.search(f"{name} {near}"))), float(bool(HARMLESS.search(value))), float(bool(TEST_PATH.search(path))),
    ]


def plain_label(f: list[float], value: str) -> int | None:
    """1 or 0 where shape and name leave no doubt, else None."""
    x = dict(zip(FEATURES, f, strict=True))
    mixed = x["digits"] >= 0.1 and x["digits"] < 1
    if x["harmless_value"] or UUID.fullmatch(value) or x["dictionary"] >= 0.6 or x["digits"] == 0 and x["symbols"] == 0 and not x["is_known"]:
        return 0
    if x["is_known"] or (x["credential_name"] and x["assigned"] and x["length"] >= 16 and mixed and x["entropy"] >= 3 and x["dictionary"] < 0.3):
        return 1
    if x["digits"] == 1 or x["length"] < 12 and not x["credential_name"]:
        return 0
    return None


def before_block(text: str, end: int) -> int:
    """``end`` of a value, or the start of a key block whose first word the value took."""
    return end - len("-----BEGIN") if text.startswith("-----BEGIN ", end - len("-----BEGIN")) else end


def assignments(text: str, m: re.Match) -> tuple[list[tuple[str, int, int, int]], int]:
    """The assignments (name, its start, start and end of the value) in a match of name and value, and where to read on.

    A value that holds names and = signs is split at them, so each value has the
    last name before it.  Under a name that speaks of a credential only such
    names split: = may be a character of the secret.  A name at the end of the
    value that is itself assigned what follows is no value; = before white space
    or the closing quote is padding instead, unless the name speaks of a credential.
    """
    a, b = m.start("value"), before_block(text, m.end("value"))
    outer = bool(CREDENTIAL.search(m["name"]))
    out = []
    name, begin, at = m["name"], m.start("name"), a
    for inner in INNER.finditer(text, a, b):
        if outer and not CREDENTIAL.search(inner["name"]):
            continue
        out.append((name, begin, at, inner.start()))
        name, begin, at = inner["name"], inner.start(), inner.end()
    end = b
    tail = LAST_NAME.search(text, at, b)
    follows = ASSIGNED.match(text, tail.start()) if tail else None
    if follows:
        padding = text.startswith("=", tail.end()) and (text[tail.end() + 1 : tail.end() + 2].isspace() or bool(m["quote"]) and text.startswith(m["quote"], tail.end() + 1))
        if not padding or CREDENTIAL.search(follows["name"]):
            end = tail.start()
    out.append((name, begin, at, end))
    spans = [(n, s, x, x + len(text[x:y].rstrip("&"))) if y < b else (n, s, x, y) for n, s, x, y in out]
    return [o for o in spans if o[3] - o[2] >= LEAST_VALUE], end


def found_in(text: str) -> Iterator[tuple[str, int, int, str, bool, int, int]]:
    """Kind, start and end of each candidate, its name, whether it is quoted, and the bounds of what lies before and after it."""
    at = 0
    while m := CANDIDATE.search(text, at):
        kind = next(k for k in ("block", "known", "value", "bare") if m[k])
        a, b = m.span(kind)
        at = m.end()
        if kind == "value":
            if len(m["name"]) > LEAST_VALUE and (k := KNOWN.search(text, *m.span("name"))):
                yield "known", *k.span(), "", False, *k.span()
            spans, at = assignments(text, m)
            for name, begin, x, y in spans:
                yield kind, x, y, name, bool(m["quote"]) and x == a, begin, y
            continue
        if kind == "bare":
            at = b = before_block(text, b)
            if b - a < LEAST_BARE:
                continue
        if kind == "bare" and text.startswith(".eyJ", b):  # a web token goes on behind its dot
            head = TOKEN_HEAD.search(text, a, b)
            whole = KNOWN.match(text, head.start()) if head else None
            at = b = whole.end() if whole else b
        yield kind, a, b, "", False, m.start(), b


def candidates(docs: DataFrame, dictionary: str, text: str = "text", id_column: str = "doc_id", path: str = "source") -> DataFrame:
    """One row per candidate: id, _key, start, end (code points), kind, sha256 of the value, features, label (or null)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = load_dictionary(dictionary)
        for f in frames:
            rows = []
            for ident, key, whole, where in zip(f["id"], f["_key"], f["text"], f["path"], strict=True):
                if not isinstance(whole, str) or not HINT.search(whole):
                    continue
                for kind, a, b, name, quoted, begin, end in found_in(whole):
                    value = whole[a:b]
                    made = describe(value, kind, name, quoted, whole[max(begin - REACH, 0) : begin], whole[end : end + REACH], where or "", words)
                    rows.append((ident, key, a, b, kind, hashlib.sha256(value.encode()).hexdigest(), made, plain_label(made, value)))
            out = pd.DataFrame(rows, columns=["id", "_key", "start", "end", "kind", "value_sha256", "features", "label"])
            yield out.astype({"label": "Float64"})

    rows = docs.select(F.col(id_column).alias("id"), text_key(F.col(text)).alias("_key"), F.col(text).alias("text"), F.col(path).cast("string").alias("path"))
    kind = rows.schema["id"].dataType.simpleString()
    return map_frames(rows, run, f"id {kind}, _key long, start int, end int, kind string, value_sha256 string, features array<double>, label double")


def lessons(spark: SparkSession, count: int = LESSONS, seed: int = SEED) -> DataFrame:
    """doc_id, text, source, begin, stop, label, held_out: ``count`` planted findings of each label, one in a text.

    Secrets are drawn as people make them (tokens of several alphabets, keys of
    known shape, passwords, passphrases of run-together words), lookalikes too
    (UUIDs, digests, identifiers, words, long words of prose, placeholders, paths, numbers); the
    drawing knows which is which, no rule over the features does.  Every third
    is held out of the training.
    """
    rnd = random.Random(seed)
    upper, lower, digits = string.ascii_uppercase, string.ascii_lowercase, string.digits

    def drawn(alphabet: str, least: int, most: int) -> str:
        return "".join(rnd.choice(alphabet) for _ in range(rnd.randint(least, most)))

    def word() -> str:
        return rnd.choice(LESSON_WORDS)

    def part() -> str:
        return drawn("bcdfghklmnprstvwz", 1, 2) + drawn("aeiou", 1, 1) + drawn("nrst", 0, 1)

    secret = (
        lambda: drawn(upper + lower + digits, 16, 64), lambda: drawn("0123456789abcdef", 32, 64), lambda: drawn(upper + lower + digits + "+/", 20, 60) + rnd.choice(("", "=", "==")),
        lambda: drawn(upper + lower + digits + "!@#$%^&*", 8, 20), lambda: "".join(word().capitalize() for _ in range(rnd.randint(2, 4))),
        lambda: word() + str(rnd.randint(1, 999)) + word(), lambda: "AKIA" + drawn(upper + digits, 16, 16), lambda: "ghp_" + drawn(upper + lower + digits, 36, 36),
        lambda: "sk-" + drawn(upper + lower + digits, 24, 48), lambda: "xoxb-" + drawn(digits, 10, 12) + "-" + drawn(lower + upper + digits, 20, 24),
    )
    harmless = (
        lambda: str(uuid.UUID(int=rnd.getrandbits(128))), lambda: drawn("0123456789abcdef", 40, 40), lambda: drawn("0123456789abcdef", 32, 32), lambda: "_".join(word() for _ in range(rnd.randint(2, 5))),
        lambda: "".join(word() for _ in range(rnd.randint(2, 4))), lambda: rnd.choice(("your-api-key-here", "xxxxxxxxxxxxxxxx", "changeme-changeme", "example-token-value", "placeholder_value")),
        lambda: "/".join(word() for _ in range(rnd.randint(3, 6))), lambda: drawn(digits, 8, 24), lambda: rnd.choice((str.title, str.lower))("".join(part() for _ in range(rnd.randint(6, 10)))), lambda: f"{word()}.{word()}.{word()}()", lambda: f"{word()}-{word()}-{rnd.randint(1, 99)}",
    )
    credential = ("password", "passwd", "secret", "api_key", "apiKey", "token", "access_key", "auth_token", "client_secret", "DB_PASSWORD", "private_key", "bearer")
    neutral = ("id", "commit", "sha1", "checksum", "request_id", "uuid", "name", "path", "version", "label", "etag", "module", "file", "revision", "trace")
    forms = ("{n} = {v}", "{n}: {v}", '{n} = "{v}"', "{n}={v}", "'{n}': '{v}'")
    rows = []
    for label, kinds in ((1, secret), (0, harmless)):
        for i in range(count):
            kind = i % len(kinds)
            value = kinds[kind]()
            shaped = label == 1 and kind >= 6  # keys of known shape are secrets under any name, or none
            names = credential if label == 1 and (not shaped or rnd.random() < 0.5) else neutral if label == 0 and rnd.random() < 0.8 or shaped else credential
            if label == 0 and kind in (0, 1, 2, 4) and names is credential:
                names = neutral  # only the name tells such a value from a secret
            bare = kind == 8 or kind != 5 and rnd.random() < 0.3  # a long word of prose has no name
            line = value if (shaped or label == 0) and bare else rnd.choice(forms).format(n=rnd.choice(names), v=value)
            before, after = (" ".join(word() for _ in range(rnd.randint(0, 12))) for _ in range(2))
            text = f"{before} {line} {after}"
            begin = text.index(value, len(before))
            rows.append((len(rows), text, rnd.choice(("web", "code", "docs", "books", "")), begin, begin + len(value), float(label), i % 3 == 0))
    return spark.createDataFrame(rows, "doc_id long, text string, source string, begin int, stop int, lesson double, held_out boolean")


def labelled_lessons(spark: SparkSession, dictionary: str) -> DataFrame:
    """The candidates found in ``lessons`` at the planted places, with their labels and ``held_out``."""
    planted = lessons(spark)
    found = candidates(planted, dictionary).drop("label")
    places = planted.select(F.col("doc_id").alias("id"), "begin", "stop", F.col("lesson").alias("label"), "held_out")
    return stored(found.join(places, "id").where((F.col("start") < F.col("stop")) & (F.col("end") > F.col("begin"))).drop("begin", "stop"))


def train(labelled: DataFrame):
    """A random forest on labelled findings (features, label, and columns that put them in a fixed order), or None.

    At most TRAIN_ROWS of each label are used, those with the smallest hash of
    value and place.  None if one of the labels is missing.
    """
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.functions import array_to_vector

    order = F.xxhash64("value_sha256", "id", "start")
    sample = None
    for label in (0, 1):
        some = labelled.where(F.col("label") == label).orderBy(order, "value_sha256", "id", "start").limit(TRAIN_ROWS)
        sample = some if sample is None else sample.unionByName(some)
    sample = stored(sample.repartition(1).sortWithinPartitions("value_sha256", "id", "start").select(array_to_vector("features").alias("features"), "label"))
    if sample.select("label").distinct().count() < 2:
        return None
    return RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED).fit(sample)


def scan(docs: DataFrame, dictionary: str, text: str = "text", id_column: str = "doc_id", path: str = "source", labelled: DataFrame | None = None) -> DataFrame:
    """Every candidate with the forest's probability and verdict: id, _key, start, end, kind, value_sha256, probability, is_secret.

    ``labelled`` findings (as ``candidates`` gives them, with labels) may come
    from elsewhere; by default they are those of ``lessons`` that aren't held
    out.  If one label is missing there is nothing to learn, and a finding's
    probability is its plain label, 0.5 where that is open too.  Null and empty
    texts have no candidates; long texts are scanned whole; repeated rows give
    repeated findings.  Other columns play no part, whatever their names.
    """
    from pyspark.ml.functions import array_to_vector, vector_to_array

    found = stored(candidates(docs, dictionary, text, id_column, path))
    if labelled is None:
        labelled = labelled_lessons(docs.sparkSession, dictionary).where("NOT held_out")
    model = train(labelled.where("label IS NOT NULL"))
    if model is None:
        scored = found.withColumn("probability", F.coalesce("label", F.lit(0.5)))
    else:
        model.setFeaturesCol("vector")
        scored = model.transform(found.withColumn("vector", array_to_vector("features"))).withColumn("probability", vector_to_array("probability")[1])
    return scored.select(
        F.col("id").alias(id_column), "_key", "start", "end", "kind", "value_sha256", F.round("probability", 6).alias("probability"),
        (F.round("probability", 6) >= LEAST).alias("is_secret"),
    )


def redact(docs: DataFrame, findings: DataFrame, text: str = "text", id_column: str = "doc_id", mask: str = MASK) -> DataFrame:
    """``docs`` with every finding that is a secret replaced by ``mask``; all columns stay."""
    found = stored(findings.where("is_secret").select(F.col(id_column).alias("__fl_id"), F.col("_key").alias("__fl_at"), "start", "end").distinct())
    spans = found.groupBy("__fl_id", "__fl_at").agg(F.sort_array(F.collect_list(F.struct("start", "end")), asc=False).alias("__fl_spans"))
    spans = hinted(stored(spans), 100_000) if found.count() <= 1_000_000 else spans
    keyed = docs.withColumn("__fl_key", text_key(F.col(text)))
    met = keyed.join(spans, keyed[id_column].eqNullSafe(spans["__fl_id"]) & (keyed["__fl_key"] == spans["__fl_at"]), "left")
    masked = F.aggregate(
        "__fl_spans", F.col(text), lambda t, s: F.concat(F.substr(t, F.lit(1), s["start"]), F.lit(mask), F.substr(t, s["end"] + 1))
    )
    return met.withColumn(text, F.when(F.col("__fl_spans").isNull(), F.col(text)).otherwise(masked)).select(*docs.columns)


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as public

    return scan(table(spark, sf_dir, "documents"), public.path("byte_bpe_multi_50k.tiktoken")).drop("_key")
