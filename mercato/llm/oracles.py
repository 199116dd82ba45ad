"""DuckDB SQL for the operators' contracts, written from the definitions (not from the methods)."""

from __future__ import annotations

from mercato.llm.quality import (
    CLASSES,
    COMMON_WORDS,
    LANGUAGES,
    MAX_CLASS,
    MAX_CLASS_SHORT,
    MAX_WORDS,
    MIN_WORDS,
    REFINEMENTS,
)
from mercato.llm import spots
from mercato.llm.secret_scan import BASE_KINDS, CLOSE, OPEN, OTHER, RULES

WORDS = r"list_filter(string_split_regex({text}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"

SUBSTRINGS = f"""
WITH w AS (SELECT doc_id, {WORDS.format(text="coalesce(text, '')")} AS ws FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) AS k FROM w, unnest(range(1, len(ws) - 48)) t(i)),
held AS (SELECT k, min(doc_id) AS d FROM win GROUP BY k),
gone AS (SELECT DISTINCT doc_id, i + j AS p FROM win JOIN held USING (k), unnest(range(50)) t(j) WHERE d < doc_id),
cut AS (SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id)
SELECT doc_id, len(ws) AS n_words, coalesce(len(ps), 0) AS n_removed,
       sha256(array_to_string(list_filter(ws, lambda x, i: NOT coalesce(list_contains(ps, i), FALSE)), ' ')) AS kept_sha256
FROM w LEFT JOIN cut USING (doc_id)"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

NEAR_DUPLICATES = f"""
WITH RECURSIVE w AS (SELECT doc_id, {WORDS.format(text=_LOWER)} AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN []
        ELSE list_distinct(list_transform(range(1, greatest(1, len(ws) - 4) + 1), lambda i: array_to_string(ws[i:i + 4], ' ')))
        END AS shingles FROM w),
n AS (SELECT doc_id, len(shingles) AS n FROM s),
x AS (SELECT doc_id, unnest(shingles) AS h FROM s),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM x a JOIN x b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM common JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * k >= 85 * (p.n + q.n - k)),
way AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT doc_id, doc_id AS c FROM n UNION SELECT way.b, reach.c FROM reach JOIN way ON way.a = reach.doc_id)
SELECT doc_id, n.n AS n_shingles, min(c) AS component_id, min(c) = doc_id AS kept
FROM n JOIN reach USING (doc_id) GROUP BY doc_id, n.n"""


def _matches(order: int) -> str:
    rule = RULES[order]
    pattern = rule.pattern.replace("'", "''")
    text = f"translate(coalesce(text, ''), '{OPEN}{CLOSE}', '{OTHER}{OTHER}')"
    marked = f"regexp_replace({text}, '{pattern}', '{OPEN}\\0{CLOSE}', 'g')"
    return f"""
SELECT doc_id, '{rule.kind}' AS kind, {order} AS o, coalesce(list_sum(list_transform(parts[1:i - 1], lambda x: length(x))), 0) AS s,
       length(parts[i]) AS n
FROM (SELECT doc_id, string_split_regex({marked}, '[{OPEN}{CLOSE}]') AS parts FROM documents), unnest(range(2, len(parts) + 1, 2)) t(i)
WHERE length(regexp_extract(parts[i], '{pattern}', {rule.group})) >= {rule.min_chars}"""


_JOINED = "coalesce(string_agg(kind || ':' || CAST(s AS BIGINT) || ':' || CAST(s + n AS BIGINT), ',' ORDER BY s, o) {only}, '')"
SECRETS = f"""
WITH m AS ({" UNION ALL ".join(map(_matches, range(len(RULES))))})
SELECT documents.doc_id, {", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in BASE_KINDS)},
       sha256({_JOINED.format(only=f"FILTER (o < {len(BASE_KINDS)})")}) AS base_sha256,
       {_JOINED.format(only="FILTER (kind IS NOT NULL)")} AS spans
FROM documents LEFT JOIN m ON m.doc_id = documents.doc_id GROUP BY documents.doc_id"""


def _histogram_sums(source: str) -> str:
    """Per language the class and common-word shares of the rows of ``source``."""
    c = ", ".join(f"sum(classes[{i}])" for i in range(1, _CLASSES + 1))
    w = ", ".join(f"sum(own[{i}])" for i in range(1, _COMMON + 1))
    share = "list_transform([{0}], lambda x: x / greatest(1, list_sum([{0}])))"
    return f"SELECT lang, {share.format(c)} AS rc, {share.format(w)} AS rw FROM {source} GROUP BY lang"


def _divergence(counts: str, reference: str, n: int) -> str:
    total = f"greatest(1, list_sum({counts}))"
    terms = []
    for i in range(1, n + 1):
        p, q = f"({counts}[{i}] / {total})", f"{reference}[{i}]"
        for a in (p, q):
            terms.append(f"CASE WHEN {a} > 0 THEN {a} * log2({a} / (({p} + {q}) / 2)) ELSE 0 END")
    return f"(({' + '.join(terms)}) / 2)"


_CLASSES = len(CLASSES) + 3
_COMMON = max(len(w) for w in COMMON_WORDS.values()) + 1


def _counts(language: str) -> str:
    found = ", ".join(f"len(list_filter(ws, lambda w: w = '{w}'))" for w in COMMON_WORDS[language])
    return f"list_append([{found}], len(ws) - list_sum([{found}]))"


def _quality() -> str:
    other = {k: f"length(t) - length(regexp_replace(t, '{p.replace(chr(39), chr(39) * 2)}', '', 'g'))" for k, p in CLASSES.items()}
    lower = r"length(t) - length(regexp_replace(t, '\p{Ll}+', '', 'g'))"
    listed = [f"length(t) - length({_JOIN_WORDS})", lower, *other.values()]
    classes = f"[{', '.join(listed)}, length(t) - ({' + '.join(f'({x})' for x in listed)})]"
    near = f"min({_divergence('classes', 'rc', _CLASSES)})"
    common = "CASE refs.lang " + " ".join(f"WHEN '{k}' THEN w_{k}" for k in LANGUAGES) + " END"
    steps, last = [f"refs0 AS ({_histogram_sums('good')})"], "refs0"
    for k, limit in enumerate(REFINEMENTS, 1):
        steps.append(
            f"near{k} AS (SELECT doc_id FROM good, (SELECT rc FROM {last}) GROUP BY doc_id HAVING {near} <= {limit}),\n"
            f"refs{k} AS ({_histogram_sums(f'good SEMI JOIN near{k} USING (doc_id)')})"
        )
        last = f"refs{k}"
    return f"""
WITH w AS (SELECT doc_id, lang, coalesce(text, '') AS t, {WORDS.format(text="coalesce(text, '')")} AS ws FROM documents),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 7], ' ') AS k FROM w, unnest(range(1, len(ws) - 6)) t(i)),
twice AS (SELECT doc_id, k FROM win GROUP BY ALL HAVING count(*) > 1),
again AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM win SEMI JOIN twice USING (doc_id, k), unnest(range(8)) t(j) GROUP BY doc_id),
lines AS (SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM w),
f AS (SELECT doc_id, lang, len(ws) AS n_words, length({_JOIN_WORDS}) AS word_chars, {other['symbol']} AS n_symbols,
             len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(again.n, 0) AS n_repeat_words,
             len(ws) < 20 OR 100 * coalesce(again.n, 0) > 30 * len(ws) AS base_failed,
             {classes} AS classes, {", ".join(f"{_counts(k)} AS w_{k}" for k in LANGUAGES)}
      FROM w JOIN lines USING (doc_id) LEFT JOIN again USING (doc_id)),
good AS (SELECT *, CASE lang {" ".join(f"WHEN '{k}' THEN w_{k}" for k in LANGUAGES)} END AS own FROM f
         WHERE NOT base_failed AND lang IN ({", ".join(f"'{k}'" for k in LANGUAGES)})),
{(',' + chr(10)).join(steps)},
verdict AS (
  SELECT doc_id, {near} AS jc, min({_divergence('(' + common + ')', 'rw', _COMMON)}) AS jw FROM f, {last} AS refs GROUP BY doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND (coalesce(f.lang NOT IN (SELECT lang FROM {last}), TRUE)
         OR jc <= CASE WHEN n_words >= {MIN_WORDS} THEN {MAX_CLASS} ELSE {MAX_CLASS_SHORT} END
            AND (n_words < {MIN_WORDS} OR jw <= {MAX_WORDS})) AS kept
FROM f JOIN verdict USING (doc_id)"""


_JOIN_WORDS = "array_to_string(ws, '')"
QUALITY = _quality()


TERMS = r"regexp_extract_all({text}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')".format(text=_LOWER)

RANKED = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {TERMS} AS ts FROM documents),
s AS (SELECT count(*) FILTER (len(ts) > 0) AS n_docs, CAST(sum(len(ts)) AS BIGINT) AS length FROM d),
p AS (SELECT r, doc_id, t, CAST(len(ts) AS BIGINT) AS n, count(*) AS tf FROM d, unnest(ts) u(t) GROUP BY ALL),
w AS (SELECT t, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, s GROUP BY t, n_docs),
i AS (SELECT row_number() OVER () AS i, item_id, unnest(list_distinct({TERMS})) AS t FROM benchmark),
h AS (SELECT i, item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // length)))) AS BIGINT) AS score
      FROM i JOIN w USING (t) JOIN p USING (t), s GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM h WHERE score > 0 QUALIFY rank <= 50"""


def _listed(words: list[str]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def _spots(text: str) -> str:
    """The fingerprint of a text: a sorted list of hashes."""
    words = rf"list_filter(string_split_regex(lower({text}), '{spots.NOT_WORD}'), lambda x: x <> '')"
    content = f"list_filter(ws[i + 1:i + {spots.SPAN}], lambda x: NOT list_contains({_listed(spots.COMMON)}, x))"
    return f"""(
  SELECT list_sort(list_distinct(list_transform(CASE WHEN len(cs) = 0 AND len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE cs END, lambda c: substr(md5(c), 1, 16))))
  FROM (SELECT ws, list_filter(list_transform(list_filter(range(1, len(ws) + 1), lambda i: list_contains({_listed(spots.ANCHORS)}, ws[i])),
                 lambda i: array_to_string(list_prepend(ws[i], {content}[1:{spots.CHAIN}]), ' ')), lambda c: contains(c, ' ')) AS cs
        FROM (SELECT {words} AS ws)))"""


def _likeness(a: str, b: str) -> str:
    both = f"len(list_intersect({a}, {b}))"
    return f"CASE WHEN len({a}) + len({b}) = 0 THEN 1.0 ELSE CAST({both} AS DOUBLE) / (len({a}) + len({b}) - {both}) END"


SPOTS = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
n AS (SELECT doc_id, t, coalesce(lead(t) OVER o, first_value(t) OVER o) AS nt FROM d WINDOW o AS (ORDER BY doc_id DESC)),
e AS (SELECT doc_id, t, nt, left(t, length(t) - length(t) // 2) || left(nt, length(t) // 2) AS et FROM n),
f AS (SELECT doc_id, length(t) AS n_chars, et, {_spots("t")} AS f, {_spots("et")} AS ef, {_spots("nt")} AS nf FROM e)
SELECT doc_id, n_chars, sha256(et) AS edited_sha256, array_to_string(f, ' ') AS fingerprint, array_to_string(ef, ' ') AS edited_fingerprint,
       {_likeness("f", "ef")} AS near_edited, {_likeness("f", "nf")} AS near_next FROM f"""

AUDIT = f"""
WITH w AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, {WORDS.format(text="coalesce(text, '')")} AS ws FROM documents),
l AS (SELECT doc_id, max(CAST(quality = 1 AS INTEGER)) AS good, max(CAST(toxic = 1 AS INTEGER)) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, list_filter([
        CASE WHEN len(ws) < 100 THEN 'A' END, CASE WHEN 100 * len(list_distinct(ws)) < 80 * len(ws) THEN 'B' END,
        CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 10 * length(t) THEN 'C' END,
        CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' END,
        CASE WHEN w.doc_id > min(w.doc_id) OVER (PARTITION BY t) THEN 'E' END], lambda x: x IS NOT NULL) AS fails
      FROM w LEFT JOIN l USING (doc_id)),
k AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM k a, k b, k c, k d, k e WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT filter_order, step, filter_order[step] AS own, string_split(filter_order[1:step], '') AS up_to,
             CASE WHEN step = 1 THEN [] ELSE string_split(filter_order[1:step - 1], '') END AS before FROM o, unnest(range(1, 6)) t(step)),
r AS (SELECT part, filter_order, step, own, count(*) FILTER (NOT list_has_any(fails, up_to)) AS kept,
             count(*) FILTER (list_contains(fails, own) AND NOT list_has_any(fails, before)) AS removed,
             count(*) FILTER (list_contains(fails, own) AND list_has_any(fails, before)) AS redundant,
             count(*) FILTER (fails = [own]) AS unique_fails,
             count(*) FILTER (good = 1 AND list_contains(fails, own) AND NOT list_has_any(fails, before)) AS good_lost,
             count(*) FILTER (toxic = 1 AND list_contains(fails, own) AND NOT list_has_any(fails, before)) AS toxic_lost
      FROM f, s GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM r"""
