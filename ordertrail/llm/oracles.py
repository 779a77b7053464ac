"""The queries that SQL can express, as SQL."""

from __future__ import annotations

from .decontaminate import BETWEEN, LOWER, SIZE, UPPER
from .licenses import TEMPLATES, THRESHOLD
from .warc import REVISIT_FROM


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


WARC = f"""
    WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS size, sha1(coalesce(html, '')) AS digest FROM pages),
         r AS (SELECT *, CASE WHEN size >= {REVISIT_FROM} THEN max(page_id) OVER (PARTITION BY digest) ELSE page_id END AS kept
               FROM p)
    SELECT page_id, size AS payload_bytes, digest AS payload_digest,
           CASE WHEN kept = page_id THEN 'response' ELSE 'revisit' END AS record_type,
           nullif(kept, page_id) AS refers_to, true AS valid
    FROM r"""


def chat(control: str) -> str:
    added = ", ".join(f"(-1, {turn}, '{role}', {_quoted(control)})" for turn, role in enumerate(["user", "assistant"]))
    return f"""
    WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
               UNION ALL SELECT * FROM (VALUES {added})),
         e AS (SELECT *, role || chr(10) || text || chr(10) AS said, CASE WHEN role = 'assistant' THEN text ELSE '' END AS learned,
                      regexp_replace(text, '<(\\\\*)\\|', '<\\\\\\1|', 'g') AS escaped FROM c)
    SELECT conv_id, count(*) AS n_turns, sha256(string_agg(said, '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
           CAST(sum(length(learned)) AS BIGINT) AS loss_chars,
           sha256(string_agg(learned, '' ORDER BY turn NULLS FIRST, role, text)) AS loss_sha256,
           CAST(sum(length('<|im_start|>') + length(role) + length(escaped) + length('<|im_end|>') + 2) AS BIGINT)
               AS formatted_chars
    FROM e GROUP BY conv_id"""


def _normal(text: str) -> str:
    return f"trim(regexp_replace(lower({text}), '[^a-z0-9]+', ' ', 'g'))"


def _bigrams(words: str) -> str:
    return f"list_distinct([{words}[i] || ' ' || {words}[i + 1] for i in range(1, len({words}))])"


LICENSES = f"""
    WITH templates(license, said) AS (VALUES {", ".join(f"({_quoted(n)}, {_quoted(t)})" for n, t in TEMPLATES)}),
         known AS (SELECT license, {_bigrams("words")} AS bigrams
                   FROM (SELECT license, string_split({_normal("said")}, ' ') AS words FROM templates)),
         given AS (SELECT doc_id, unnest([text] || string_split_regex(text, '\\n[\\x20\\t\\r]*\\n') || string_split(text, chr(10)))
                          AS unit FROM documents WHERE text IS NOT NULL),
         units AS (SELECT DISTINCT doc_id, {_normal("unit")} AS unit FROM given),
         paired AS (SELECT doc_id, unit, {_bigrams("words")} AS bigrams
                    FROM (SELECT *, string_split(unit, ' ') AS words FROM units) WHERE len(words) > 1),
         scored AS (SELECT doc_id, unit, license,
                           2.0 * len(list_intersect(p.bigrams, k.bigrams)) / (len(p.bigrams) + len(k.bigrams)) AS dice
                    FROM paired p, known k
                    WHERE least(len(p.bigrams), len(k.bigrams)) * 2.0 / (len(p.bigrams) + len(k.bigrams)) > {THRESHOLD} - 1e-9),
         best AS (SELECT doc_id, unit, license, dice FROM scored WHERE dice >= {THRESHOLD}
                  QUALIFY row_number() OVER (PARTITION BY doc_id, unit ORDER BY dice DESC, license) = 1),
         per_document AS (SELECT doc_id, count(*) AS n, string_agg(DISTINCT license, ',' ORDER BY license) AS licenses,
                                 max(dice) AS dice FROM best GROUP BY doc_id)
    SELECT doc_id, coalesce(n, 0) AS n_matches, coalesce(licenses, '') AS licenses, round(CAST(dice AS DOUBLE), 9) AS best_score
    FROM documents LEFT JOIN per_document USING (doc_id)"""


def _words(text: str) -> str:
    word = "[^" + BETWEEN[1:]
    return f"regexp_extract_all(translate(coalesce({text}, ''), '{UPPER}', '{LOWER}'), '{word}')"


DECONTAMINATION = f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_words("text")} AS w FROM documents),
         b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_words("text")} AS w FROM benchmark),
         g AS (SELECT DISTINCT item, size, array_to_string(w[i:i + size - 1], ' ') AS gram
               FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS i
                     FROM (SELECT *, least(len(w), {SIZE}) AS size FROM b WHERE len(w) > 0))),
         v AS (SELECT r, i, size, array_to_string(w[i:i + size - 1], ' ') AS gram
               FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS i FROM d, (SELECT DISTINCT size FROM g))),
         hit AS (SELECT r, i, size, item FROM v JOIN g USING (gram, size)),
         counted AS (SELECT r, count(*) AS n FROM (SELECT DISTINCT r, unnest(range(i, i + size)) AS at FROM hit) GROUP BY r),
         named AS (SELECT r, count(DISTINCT item) AS n, string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM hit GROUP BY r)
    SELECT doc_id, len(w) AS n_words, coalesce(counted.n, 0) AS n_hit, coalesce(named.n, 0) AS n_items,
           sha256(coalesce(ids, '')) AS items_sha256, coalesce(counted.n, 0) > 0 AS contaminated
    FROM d LEFT JOIN counted USING (r) LEFT JOIN named USING (r)"""


_SPLIT = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
AUDIT = f"""
    WITH RECURSIVE l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
                                max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
         d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS said, {_SPLIT} AS w FROM documents),
         marked AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, [
                           len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w),
                           100 * length(regexp_replace(said, '[^A-Z]', '', 'g')) > 3 * length(said),
                           regexp_matches(said, '[#$%&*|]'),
                           coalesce(doc_id > min(doc_id) OVER (PARTITION BY said), false)] AS fails
                    FROM d LEFT JOIN l USING (doc_id)),
         cells AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM marked GROUP BY part, fails),
         walk(so_far, step) AS (SELECT '', 0 UNION ALL SELECT so_far || f, step + 1
                                FROM walk, (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) t(f) WHERE NOT contains(so_far, f)),
         steps AS (SELECT so_far AS filter_order, unnest(range(1, 6)) AS step FROM walk WHERE step = 5),
         named AS (SELECT *, ascii(filter_order[step]) - 64 AS own,
                          [ascii(x) - 64 for x in string_split(filter_order[:step - 1], '') if x <> ''] AS earlier FROM steps),
         tested AS (SELECT part, filter_order, CAST(step AS INTEGER) AS step, own, n, good, toxic, fails[own] AS failing,
                           len([e for e in earlier if fails[e]]) > 0 AS gone, len([x for x in fails if x]) = 1 AS once
                    FROM named, cells),
         metrics AS (SELECT part, filter_order, step, own,
                            sum(n) FILTER (WHERE NOT failing AND NOT gone) AS kept, sum(n) FILTER (WHERE failing AND NOT gone) AS removed,
                            sum(n) FILTER (WHERE failing AND gone) AS redundant, sum(n) FILTER (WHERE failing AND once) AS unique_fails,
                            sum(good) FILTER (WHERE failing AND NOT gone) AS good_lost,
                            sum(toxic) FILTER (WHERE failing AND NOT gone) AS toxic_lost
                     FROM tested GROUP BY ALL)
    SELECT part, filter_order, step, {", ".join(f"CAST(coalesce({c}, 0) AS BIGINT) AS {c}" for c in (
        "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"))},
           CAST(coalesce(sum(removed) OVER (PARTITION BY part, own), 0) AS BIGINT) AS shapley
    FROM metrics"""
