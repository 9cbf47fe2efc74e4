"""SQL that checks the queries of this subpackage, for those that SQL can express."""

from __future__ import annotations

#: op10: counts by windows over words, then rates by host under the same prior.
QUALITY_RULES = r"""
WITH texts AS (
    SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents
), words AS (
    SELECT r, doc_id, source, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM texts
), windows AS (
    SELECT r, i, array_to_string(w[i:i + 7], ' ') AS run
    FROM (SELECT r, w, unnest(generate_series(1, len(w) - 7)) AS i FROM words WHERE len(w) >= 8)
), repeated AS (
    SELECT r, count(DISTINCT place) AS n FROM (
        SELECT r, unnest(generate_series(i, i + 7)) AS place
        FROM (SELECT r, i, count(*) OVER (PARTITION BY r, run) AS often FROM windows) WHERE often > 1
    ) GROUP BY r
), lines AS (
    SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
    FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM texts)
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r
), counts AS (
    SELECT doc_id, source, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(n_lines, 0)::BIGINT AS n_lines,
        coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(repeated.n, 0)::BIGINT AS n_repeat_words
    FROM words LEFT JOIN lines USING (r) LEFT JOIN repeated USING (r)
), judged AS (
    SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
        n_words < 20 OR 100 * n_repeat_words > 30 * n_words OR 100 * n_symbols > 10 * n_words OR 100 * n_dup_lines > 30 * n_lines AS rule_failed
    FROM counts
), hosts AS (
    SELECT source, count(*) AS n, sum(rule_failed::INT) AS failures FROM judged WHERE source IS NOT NULL GROUP BY source
), prior AS (
    SELECT avg(failures / n) AS m, coalesce(var_samp(failures / n), 0) AS v, avg(1 / n) AS k FROM hosts
), weighed AS (
    SELECT m, CASE WHEN v - m * (1 - m) * k > 0
        THEN least(1e6, greatest(2, (m * (1 - m) - v) / (v - m * (1 - m) * k))) ELSE 1e6 END AS weight FROM prior
), rates AS (
    SELECT source, (failures + m * weight) / (n + weight) AS rate FROM hosts, weighed
)
SELECT doc_id, judged.source, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, base_failed, rule_failed,
    round(rate, 6) AS host_rate, NOT rule_failed AND coalesce(rate, 0) <= 0.5 AS kept
FROM judged LEFT JOIN rates ON judged.source = rates.source
"""

#: op5: exact numbers of sites; all columns of ``docs`` that are named here.
LINES_GONE = r"""
lines AS (
    SELECT doc_id, source, place, line FROM (
        SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS place FROM {docs}
    ) WHERE len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) >= 1
), boilerplate AS (
    SELECT line, min((doc_id, place)) AS first FROM lines GROUP BY line HAVING count(DISTINCT source) >= 10
), gone AS (
    SELECT doc_id, list(place) AS places FROM lines JOIN boilerplate USING (line) WHERE (doc_id, place) <> first GROUP BY doc_id
)"""
LINE_DEDUP = "WITH " + LINES_GONE.replace("{docs}", "documents") + r"""
SELECT doc_id, coalesce(len(places), 0)::INT AS n_removed, CASE WHEN places IS NULL THEN text ELSE array_to_string([
    line FOR line, i IN string_split(text, chr(10)) IF NOT list_contains(places, i - 1)], chr(10)) END AS text
FROM documents LEFT JOIN gone USING (doc_id)
"""

#: op3: exact containment of five-word shingles.
DECONTAMINATION = r"""
WITH held AS (
    SELECT doc_id, string_split(trim(regexp_replace(lower(text), '[^\p{L}\p{N}]+', ' ', 'g')), ' ') AS w FROM documents
), asked AS (
    SELECT item_id, string_split(trim(regexp_replace(lower(text), '[^\p{L}\p{N}]+', ' ', 'g')), ' ') AS w FROM benchmark
), runs AS (
    SELECT DISTINCT doc_id, array_to_string(w[k:k + 4], ' ') AS run
    FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 4)) AS k FROM held WHERE len(w) >= 5)
), tests AS (
    SELECT DISTINCT item_id, array_to_string(w[k:k + 4], ' ') AS run
    FROM (SELECT item_id, w, unnest(generate_series(1, len(w) - 4)) AS k FROM asked WHERE len(w) >= 5)
), sizes AS (SELECT item_id, count(*) AS n_item FROM tests GROUP BY item_id)
SELECT doc_id, item_id, count(*) AS n_shared, any_value(n_item) AS n_item
FROM runs JOIN tests USING (run) JOIN sizes USING (item_id)
GROUP BY doc_id, item_id HAVING 100 * count(*) >= 80 * any_value(n_item)
"""

#: crc32 of a short text, by its table of 256 entries.
CRC32 = """
crc_table AS (
    SELECT list_transform(range(256), lambda n: list_reduce(list_concat([n::BIGINT], range(8)),
        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
)"""
CRC32_OF = """xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split({}, ''), lambda x: ascii(x)::BIGINT)),
    lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295)"""

_FIELDS = " || ".join(f"coalesce(strlen({c}::VARCHAR) || ':' || {c}, '-')" for c in ("doc_id", "source", "lang", "n_chars", "text"))
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"



def _levels(nodes: str, folds: str, name: str, count: int) -> str:
    """CTEs of ``count`` levels above ``nodes`` (g, pos, h, n) and of the ways up of ``folds`` (r, g, pos, h, proof)."""
    text = f", {name}0 AS (SELECT g, pos, h, n FROM {nodes}), {name}_up0 AS (SELECT r, g, pos, h, proof FROM {folds})"
    for k in range(count):
        text += f""", {name}{k + 1} AS (
    SELECT g, pos // 16 AS pos, CASE WHEN any_value(n) > 1 THEN sha256(string_agg(h, '' ORDER BY pos)) ELSE any_value(h) END AS h,
        (any_value(n) + 15) // 16 AS n FROM {name}{k} GROUP BY g, pos // 16
), {name}_up{k + 1} AS (
    SELECT r, u.g, u.pos // 16 AS pos, any_value(proof) || coalesce(string_agg(CASE WHEN o.pos <> u.pos THEN o.h END, '' ORDER BY o.pos), '') AS proof,
        CASE WHEN any_value(n) > 1 THEN sha256(string_agg(CASE WHEN o.pos = u.pos THEN u.h ELSE o.h END, '' ORDER BY o.pos)) ELSE any_value(u.h) END AS h
    FROM {name}_up{k} u JOIN {name}{k} o ON o.g = u.g AND o.pos // 16 = u.pos // 16 GROUP BY r, u.g, u.pos
)"""
    return text


#: op11: six levels of leaves (16 million a source), then five of sources.
MERKLE = "WITH" + CRC32 + f""", lowered AS (
    SELECT *, CASE WHEN {CRC32_OF.format("doc_id::VARCHAR")} % 5 = 0 THEN translate(text, '{_UPPER}', '{_UPPER.lower()}') ELSE text END AS low
    FROM documents, crc_table
), leaves AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce('1' || source, '0') AS g, sha256({_FIELDS}) AS h, sha256({_FIELDS.replace("text", "low")}) AS new
    FROM lowered
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id, h) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n FROM leaves
), started AS (SELECT r, g, pos, new AS h, '' AS proof FROM placed)""" + _levels("placed", "started", "l", 6) + """, subroots AS (
    SELECT g AS s, h, 'top' AS g, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS n FROM l6
), risen AS (
    SELECT r, 'top' AS g, subroots.pos, l_up6.h, proof FROM l_up6 JOIN subroots ON l_up6.g = s
)""" + _levels("subroots", "risen", "t", 5) + """
SELECT doc_id, placed.h AS leaf, subroots.h AS subroot, t5.h AS root, sha256(t_up5.proof) AS proof_sha256, t_up5.h AS folded_root, t_up5.h = t5.h AS verified
FROM placed JOIN t_up5 USING (r) JOIN subroots ON s = placed.g, t5
"""

#: op12: phrases as texts; a phrase of k words is split at its spaces.
COLLOCATIONS = f"""
WITH lowered AS (
    SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}') AS t FROM documents
), pieces AS (
    SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w
    FROM (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM lowered)
), grams AS (
    SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS p
    FROM pieces, (SELECT unnest([1, 2, 3]) AS k) WHERE len(w) >= k
), f AS (
    SELECT lang, k, p, count(*) AS f, string_split(p, ' ') AS w FROM grams GROUP BY lang, k, p
), sums AS (
    SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang
), cuts AS (
    SELECT f.lang, f.k, f.p, f.f AS a, cut, l.f AS l, r.f AS r, (1000000::HUGEINT * f.f * f.f) // (l.f::HUGEINT * r.f) AS score
    FROM (SELECT *, unnest(range(1, k)) AS cut FROM f WHERE k > 1 AND f >= 10) f
    JOIN f l ON l.lang = f.lang AND l.p = array_to_string(f.w[:cut], ' ')
    JOIN f r ON r.lang = f.lang AND r.p = array_to_string(f.w[cut + 1:], ' ')
), weakest AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, cut) = 1
), inner_pairs AS (
    SELECT lang, p, max(f) AS longer FROM (
        SELECT lang, f, unnest([array_to_string(w[:2], ' '), array_to_string(w[2:], ' ')]) AS p FROM f WHERE k = 3 AND f >= 10
    ) GROUP BY lang, p
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, p) AS rank, p AS phrase, a, l, r, n, score::BIGINT AS score
FROM weakest JOIN sums USING (lang) LEFT JOIN inner_pairs USING (lang, p)
WHERE k = 3 OR longer IS NULL OR 100 * longer < 50 * a
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, p) <= 2000
"""
