"""DuckDB SQL of the queries that SQL can express."""

from soleprint.llm.quality import BOILERPLATE, LineRules
from soleprint.llm.url_filter import LOWER, RULES, UPPER

_RULES = LineRules()
_WORD = r"[^\x20\x09-\x0D]+"
_CHARS = "length(regexp_replace({}, '[\\x20\\x09-\\x0D]+', '', 'g'))"

_LINE = f"""
    NOT regexp_matches(line, '{_WORD}') OR NOT (
        (length(line) < {_RULES.short_line}
            AND NOT regexp_matches(line, '[.!?…。:;]["'')\\]»”’]*[\\x20\\x09-\\x0D]*$'))
        OR (length(line) - length(regexp_replace(line, '[#*$%&<>]|[!?]{{2,}}', '', 'g'))) * 100
            > length(line) * {_RULES.mark_share}
        OR ((length(line) - length(regexp_replace(line, '[|»›·•]', '', 'g')))
                >= {_RULES.separators}
            AND (length(line) - length(regexp_replace(line, '[|»›·•]', '', 'g'))) * 100
                >= length(line) * {_RULES.separator_share})
        OR (length(line) < {_RULES.phrase_line} AND ({" OR ".join(
            f"contains(lower(line), '{phrase}')" for phrase in BOILERPLATE)})))
"""

LINE_QUALITY = f"""
WITH split AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
        regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w,
        string_split(coalesce(text, ''), chr(10)) AS lines
    FROM documents
), windows AS (
    SELECT r, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS win, i
    FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM split)
), repeated AS (
    SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, win) > 1
), covered AS (
    SELECT r, count(DISTINCT i + k) AS n
    FROM repeated CROSS JOIN range(3) AS t(k) GROUP BY r
), lines AS (
    SELECT r, count(line) FILTER (WHERE regexp_matches(line, '{_WORD}'))
            - count(DISTINCT line) FILTER (WHERE regexp_matches(line, '{_WORD}')) AS n_dup,
        sum({_CHARS.format("line")}) FILTER (WHERE {_LINE}) AS kept_chars
    FROM (SELECT r, unnest(lines) AS line FROM split) GROUP BY r
), figures AS (
    SELECT doc_id, len(w)::BIGINT AS n_words, {_CHARS.format("text")}::BIGINT AS word_chars,
        (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
        n_dup::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
        coalesce(kept_chars, 0) AS kept_chars
    FROM split JOIN lines USING (r) LEFT JOIN covered USING (r)
), judged AS (
    SELECT *, n_words < {_RULES.min_words}
        OR 100 * n_repeat_words > {_RULES.repeat_share} * n_words AS base_failed
    FROM figures
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND 100 * kept_chars >= {_RULES.kept_share} * word_chars AS kept
FROM judged
"""


def _rules(value) -> str:
    longest_first = sorted(RULES, key=lambda r: (len(r.name), r.verdict == "block"), reverse=True)
    return " ".join(
        f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}'))"
        f" AND starts_with(path, '{r.path}') THEN '{value(r)}'" for r in longest_first)


URL_CASCADE = f"""
WITH rest AS (
    SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, instr(url, '://') + 3) ELSE '' END
        AS rest
    FROM pages
), parts AS (
    SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM rest
)
SELECT page_id, host, path, CASE {_rules(lambda r: r.name)} END AS rule,
    CASE {_rules(lambda r: r.verdict)}
        WHEN substr(md5(host || path), 1, 1) IN ('0', '1', '2', '3') THEN 'block'
        ELSE 'allow' END AS verdict
FROM parts
"""

BOND_NEGATIVES = """
WITH rows AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
        CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
    FROM rows a JOIN rows b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positives AS (
    SELECT * FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT anchor_id, p.other_id AS positive_id, CAST(row_number() OVER (
        PARTITION BY anchor_id, p.other_id ORDER BY n.score DESC, n.other_id) AS INTEGER) AS rank,
    n.other_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scored n USING (anchor_id)
WHERE NOT n.same AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
QUALIFY rank <= 10
"""

_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = (f"regexp_extract_all({_LOWERED}, "
          r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")

SHARED_RANKING = f"""
WITH docs AS (
    SELECT doc_id, {_TERMS} AS terms FROM documents WHERE text IS NOT NULL
), sized AS (
    SELECT doc_id, terms, CAST(len(terms) AS BIGINT) AS n FROM docs WHERE len(terms) > 0
), corpus AS (
    SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM sized
), tf AS (
    SELECT doc_id, n, term, count(*) AS tf
    FROM (SELECT doc_id, n, unnest(terms) AS term FROM sized) GROUP BY ALL
), weights AS (
    SELECT term, CAST(floor(1000 * ln(
        CAST(2 * any_value(docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM tf CROSS JOIN corpus GROUP BY term
), parts AS (
    SELECT doc_id, term, w * ((1000000000 * tf)
        // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // total))) AS part
    FROM tf JOIN weights USING (term) CROSS JOIN corpus
), asked AS (
    SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark
)
SELECT item_id, CAST(row_number() OVER (
        PARTITION BY item_id ORDER BY sum(part) DESC, doc_id) AS INTEGER) AS rank,
    doc_id, CAST(sum(part) AS BIGINT) AS score
FROM asked JOIN parts USING (term) GROUP BY item_id, doc_id HAVING sum(part) > 0
QUALIFY rank <= 50
"""

PHRASE_AUTOMATA = f"""
WITH split AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents
), windows AS (
    SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS words
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM split)
), again AS (
    SELECT doc_id, i FROM windows
    QUALIFY row_number() OVER (PARTITION BY words ORDER BY doc_id, i) > 1
), gone AS (
    SELECT DISTINCT doc_id, i + k AS i FROM again CROSS JOIN range(20) AS t(k)
), removed AS (
    SELECT doc_id, count(*) AS n, list(i) AS gone FROM gone GROUP BY doc_id
), words AS (
    SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM split
), kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept
    FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed,
    CAST(len(w) AS BIGINT) - coalesce(n, 0) AS n_kept, sha256(coalesce(kept, '')) AS kept_sha256
FROM split LEFT JOIN removed USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

ORACLES = {
    "op6_url_cascade": URL_CASCADE,
    "op10_line_quality": LINE_QUALITY,
    "op11_bond_negatives": BOND_NEGATIVES,
    "op12_shared_ranking": SHARED_RANKING,
    "op13_phrase_automata": PHRASE_AUTOMATA,
}
