"""DuckDB counterparts of the queries that SQL can express."""

from __future__ import annotations

from firmloom.llm import decontaminate, quality

_WS = r"\x20\x09-\x0D"


def _list(words) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


def quality_sql() -> str:
    q = quality
    lists = "MAP {" + ", ".join(f"'{n}': {_list(w)}" for n, w in q.COMMON_WORDS.items()) + "}"
    dims = {"c": q.CLASSES, "w": max(map(len, q.COMMON_WORDS.values())) + 1}

    def shares(name: str) -> str:
        return f"list_transform({name}, lambda x: CASE WHEN list_sum({name}) > 0 THEN (x * {q.PARTS}) // list_sum({name})::BIGINT ELSE 0 END)"

    def refs(name: str, source: str) -> str:
        sums = ", ".join(f"sum(({shares('chars' if v == 'c' else 'common')})[{i + 1}]) AS {v}{i}" for v, n in dims.items() for i in range(n))
        names = [f"{v}{i}" for v, n in dims.items() for i in range(n)]
        pack = ", ".join(f"list_filter([{', '.join(f'{v}{i}' for i in range(n))}], lambda x: x IS NOT NULL) AS {v}" for v, n in dims.items())
        return (
            f"{name}_l AS MATERIALIZED (SELECT ref, {sums} FROM {source} GROUP BY ref), "
            f"{name}_a AS (SELECT '{q.ALL}' AS ref, {', '.join(f'sum({x}) AS {x}' for x in names)} FROM {name}_l HAVING count(*) > 0), "
            f"{name} AS MATERIALIZED (SELECT ref, {pack} FROM (SELECT * FROM {name}_l WHERE ref <> '{q.ALL}' UNION ALL SELECT * FROM {name}_a))"
        )

    def distance(counts: str, ref: str) -> str:
        p, r = f"({counts}[i]::DOUBLE / list_sum({counts})::DOUBLE)", f"({ref}[i]::DOUBLE / list_sum({ref})::DOUBLE)"
        half = "CASE WHEN {x} > 0 THEN {x} * log2({x} / (({p} + {r}) / 2)) ELSE 0.0 END"
        term = f"{half.format(x=p, p=p, r=r)} + {half.format(x=r, p=p, r=r)}"
        return f"CASE WHEN list_sum({counts}) > 0 AND list_sum({ref}) > 0 THEN round(sqrt(greatest(list_sum(list_transform(range(1, len({counts}) + 1), lambda i: {term})) / 2, 0.0)), 9) END"

    steps = [r"[\p{Ll}\p{Nd}]+", f"[{_WS}]+", r"\p{Lu}+", r"[.,;:!?''" + '"' + r"()\-]+"]
    left = ["t"]
    for s in steps:
        left.append(f"regexp_replace({left[-1]}, '{s}', '', 'g')")
    classes = ", ".join(f"length({a}) - length({b})" for a, b in zip(left, left[1:], strict=False))
    return f"""
    WITH base AS (SELECT doc_id, lang, coalesce(text, '') AS t FROM documents),
    split AS (SELECT *, row_number() OVER () AS rid, regexp_extract_all(t, '[^{_WS}]+') AS w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^{_WS}]')) AS lines,
        [{classes}, length({left[-1]})] AS chars FROM base),
    windows AS (SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM split, unnest(range(1, len(w) - 1)) AS r(i)),
    twice AS (SELECT rid, i FROM windows QUALIFY count(*) OVER (PARTITION BY rid, g) > 1),
    spans AS (SELECT rid, least(3, coalesce(lead(i) OVER (PARTITION BY rid ORDER BY i) - i, 3)) AS n FROM twice),
    repeated AS (SELECT rid, sum(n)::BIGINT AS n FROM spans GROUP BY rid),
    counted AS MATERIALIZED (SELECT doc_id, lang, chars, len(w)::BIGINT AS n_words, (list_sum(chars) - chars[2])::BIGINT AS word_chars,
        (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
        coalesce(r.n, 0)::BIGINT AS n_repeat_words,
        CASE WHEN lang IN ({_list(q.COMMON_WORDS)[1:-1]}) THEN list_transform(({lists})[lang], lambda x: len(list_filter(w, lambda y: y = x))) END AS listed
        FROM split LEFT JOIN repeated r USING (rid)),
    vectors AS (SELECT *, list_append(listed, (n_words - list_sum(listed))::BIGINT) AS common, CASE WHEN listed IS NULL THEN '{q.ALL}' ELSE lang END AS ref,
        n_words < {q.MIN_WORDS} OR 100 * n_repeat_words > {q.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM counted),
    fit AS MATERIALIZED (SELECT * FROM vectors WHERE NOT base_failed AND list_sum(chars) >= {q.MIN_CHARS}),
    {refs("first", "fit")},
    apart AS MATERIALIZED (SELECT fit.*, floor({q.PARTS} * {distance("chars", "c")})::BIGINT AS d FROM fit JOIN first USING (ref)),
    near AS MATERIALIZED (SELECT apart.* FROM apart JOIN (SELECT ref, sum(d)::DOUBLE / count(d) AS mean FROM apart GROUP BY ref) m USING (ref) WHERE d <= mean),
    {refs("second", "near")},
    judged AS (SELECT v.*, CASE WHEN list_sum(chars) >= {q.MIN_CHARS} THEN {distance("chars", "c")} END AS char_distance,
        CASE WHEN listed IS NOT NULL AND n_words >= {q.MIN_COMMON_WORDS} THEN {distance("common", "s.w")} END AS word_distance FROM vectors v LEFT JOIN second s USING (ref))
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, char_distance, word_distance,
        NOT base_failed AND NOT (coalesce(char_distance, 0) > {q.MAX_CHAR_DISTANCE} OR coalesce(word_distance, 0) > {q.MAX_WORD_DISTANCE}) AS kept
    FROM judged
    """


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def decontamination_sql() -> str:
    word = decontaminate.WORD
    span = decontaminate.SPAN
    words = f"regexp_extract_all({_LOWER.format('coalesce(text, chr(32))')}, '{word}')"
    return f"""
    WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {words} AS w FROM documents),
    b AS (SELECT item_id, {words} AS w FROM benchmark WHERE item_id IS NOT NULL),
    tests AS MATERIALIZED (SELECT DISTINCT item_id, least(len(w), {span}) AS n, array_to_string(w[i:i + least(len(w), {span}) - 1], ' ') AS g
        FROM b, unnest(range(1, len(w) - least(len(w), {span}) + 2)) AS r(i) WHERE len(w) > 0),
    runs AS (SELECT rid, i, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM d, (SELECT DISTINCT n FROM tests) l, unnest(range(1, len(w) - n + 2)) AS r(i)),
    hits AS MATERIALIZED (SELECT rid, i, runs.n, runs.g FROM runs WHERE EXISTS (SELECT 1 FROM tests t WHERE t.n = runs.n AND t.g = runs.g)),
    covered AS (SELECT rid, count(DISTINCT i + j) AS n_hit FROM hits, unnest(range(0, n)) AS r(j) GROUP BY rid),
    items AS (SELECT rid, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
        FROM (SELECT DISTINCT rid, item_id FROM hits JOIN tests USING (n, g)) GROUP BY rid)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
        sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN covered USING (rid) LEFT JOIN items USING (rid)
    """


def warc_sql() -> str:
    digits = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'"
    value = "('0x' || substr(sha, 5 * q + 1, 5))::BIGINT"
    base32 = f"array_to_string(list_transform(range(0, 8), lambda q: array_to_string(list_transform([15, 10, 5, 0], lambda s: substr({digits}, ((({value}) >> s) & 31)::INT + 1, 1)), '')), '')"
    return f"""
    WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS sha FROM pages),
    f AS (SELECT *, min(page_id) OVER (PARTITION BY sha) AS first FROM p)
    SELECT page_id, payload_bytes, {base32} AS payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
        CASE WHEN page_id <> first THEN first END AS refers_to FROM f
    """


def jaccard_sql(words: int = 3, percent: int = 90) -> str:
    return f"""
    WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_split_to_array({_LOWER.format("coalesce(text, '')")}, '[{_WS}]+'), lambda x: x <> '') AS w FROM documents),
    g AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(w[i:i + {words} - 1], ' ') AS s FROM d, unnest(range(1, greatest(len(w) - {words} + 2, 2))) AS r(i) WHERE len(w) > 0),
    n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
    shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM g x JOIN g y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL),
    links AS MATERIALIZED (SELECT a, b FROM shared JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * k >= {percent} * (p.n + q.n - k)),
    both_ways AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
    reach(doc_id, near) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.doc_id, e.b FROM reach r JOIN both_ways e ON r.near = e.a)
    SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, r.c AS component_id
    FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(near) AS c FROM reach GROUP BY doc_id) r USING (doc_id)
    """


def bottom_k_sql() -> str:
    return f"SELECT *, doc_id = component_id AS kept FROM ({jaccard_sql(3, 85)})"


def hard_negatives_sql() -> str:
    return """
    WITH e AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    a AS (SELECT * FROM e WHERE vec_id % 100 = 0),
    scored AS MATERIALIZED (SELECT a.r AS ar, a.vec_id AS anchor_id, a.label = e.label AS same, e.r, e.vec_id,
        coalesce(list_sum(list_transform(range(1, least(len(a.v), len(e.v)) + 1), lambda i: a.v[i] * e.v[i])), 0)::BIGINT AS s FROM a JOIN e ON a.r <> e.r),
    pos AS (SELECT * FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY ar ORDER BY s DESC, vec_id, r) <= 5),
    ranked AS (SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.s AS positive_score, n.s AS negative_score,
        row_number() OVER (PARTITION BY p.ar, p.r ORDER BY n.s DESC, n.vec_id, n.r) AS rank
        FROM pos p JOIN scored n ON p.ar = n.ar AND NOT n.same AND 80 * p.s::HUGEINT <= 100 * n.s::HUGEINT AND n.s <= p.s)
    SELECT anchor_id, positive_id, rank::INT AS rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 5
    """


def collocations_sql() -> str:
    return rf"""
    WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER.format("text")}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents WHERE text IS NOT NULL),
    runs AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
    grams AS MATERIALIZED (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
        FROM runs, (VALUES (1), (2), (3), (4)) AS s(k), unnest(range(1, len(w) - k + 2)) AS r(i) GROUP BY ALL),
    totals AS (SELECT lang, sum(f)::BIGINT AS n FROM grams WHERE k = 1 GROUP BY lang),
    found AS MATERIALIZED (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM grams WHERE k > 1 AND f >= 30),
    cuts AS (SELECT c.lang, c.phrase, c.a, i, x.f AS l, y.f AS r, ((2000000::HUGEINT * c.a) // (x.f + y.f))::BIGINT AS score FROM found c, unnest(range(1, c.k)) AS u(i)
        JOIN grams x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:i], ' ') JOIN grams y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[i + 1:], ' ')),
    least AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, i) = 1),
    covered AS (SELECT s.lang, s.phrase FROM found s JOIN found b ON s.lang = b.lang AND b.k > s.k AND 100::HUGEINT * b.a >= 80::HUGEINT * s.a
        AND contains(' ' || b.phrase || ' ', ' ' || s.phrase || ' ')),
    ranked AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, score
        FROM least WHERE (lang, phrase) NOT IN (SELECT (lang, phrase) FROM covered))
    SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
    """
