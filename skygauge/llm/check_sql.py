"""DuckDB SQL that gives the rows of the operators that SQL can express, by the definitions and not by their methods."""

#: Every order of the five filters is applied to the counts of each mask of failed ones.
FILTER_AUDIT = r"""
WITH words AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
said AS (
    SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
    FROM labels GROUP BY doc_id),
failed AS (
    SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
        CASE WHEN len(words) < 200 THEN 1 ELSE 0 END AS a,
        CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 1 ELSE 0 END AS b,
        CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > 2 * length(text) THEN 1 ELSE 0 END AS c,
        CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 1 ELSE 0 END AS d,
        CASE WHEN w.doc_id > min(w.doc_id) OVER (PARTITION BY text) THEN 1 ELSE 0 END AS e
    FROM words w LEFT JOIN said s ON w.doc_id = s.doc_id),
cells AS (
    SELECT part, a, b, c, d, e, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic
    FROM failed GROUP BY part, a, b, c, d, e),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
orders AS (
    SELECT v.f || w.f || x.f || y.f || z.f AS filter_order
    FROM letters v, letters w, letters x, letters y, letters z
    WHERE v.f NOT IN (w.f, x.f, y.f, z.f) AND w.f NOT IN (x.f, y.f, z.f) AND x.f NOT IN (y.f, z.f) AND y.f <> z.f),
steps AS (
    SELECT filter_order, step, filter_order[step] AS filter
    FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step) s),
met AS (
    SELECT part, filter_order, step, filter, n, good, toxic,
        CASE filter WHEN 'A' THEN a WHEN 'B' THEN b WHEN 'C' THEN c WHEN 'D' THEN d ELSE e END AS fails,
        a + b + c + d + e AS failures,
        least(CASE WHEN a = 1 THEN instr(filter_order, 'A') ELSE 9 END, CASE WHEN b = 1 THEN instr(filter_order, 'B') ELSE 9 END,
              CASE WHEN c = 1 THEN instr(filter_order, 'C') ELSE 9 END, CASE WHEN d = 1 THEN instr(filter_order, 'D') ELSE 9 END,
              CASE WHEN e = 1 THEN instr(filter_order, 'E') ELSE 9 END) AS goes_at
    FROM steps, cells),
counted AS (
    SELECT part, filter_order, step, filter,
        sum(CASE WHEN goes_at > step THEN n ELSE 0 END) AS kept,
        sum(CASE WHEN goes_at = step THEN n ELSE 0 END) AS removed,
        sum(CASE WHEN fails = 1 AND goes_at < step THEN n ELSE 0 END) AS redundant,
        sum(CASE WHEN fails = 1 AND failures = 1 THEN n ELSE 0 END) AS unique_fails,
        sum(CASE WHEN goes_at = step THEN good ELSE 0 END) AS good_lost,
        sum(CASE WHEN goes_at = step THEN toxic ELSE 0 END) AS toxic_lost
    FROM met GROUP BY part, filter_order, step, filter),
shares AS (SELECT part, filter, sum(removed) AS shapley FROM counted GROUP BY part, filter)
SELECT c.part AS part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept,
    CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
    CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(shapley AS BIGINT) AS shapley
FROM counted c JOIN shares s ON c.part = s.part AND c.filter = s.filter"""

#: Turns and loss text are those of the table; the formatted length follows from the template's marks, and from a
#: backslash for each control string within a text or role.
CHAT_FORMAT = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
sized AS (
    SELECT *, length(text) + len(regexp_extract_all(text, '[<\[]\\*(?:/?s>|/?INST\]|/?ROLE\]|END\]|IMG\]|AUD\]|DOC\])')) AS body,
        length(role) + len(regexp_extract_all(role, '[<\[]\\*(?:/?s>|/?INST\]|/?ROLE\]|END\]|IMG\]|AUD\]|DOC\])')) AS head
    FROM turns)
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
    sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
    CAST(sum(body + CASE role WHEN 'user' THEN 13 WHEN 'assistant' THEN 7 ELSE head + 18 END) AS BIGINT) AS formatted_chars,
    CAST(0 AS BIGINT) AS expanded_tokens
FROM sized GROUP BY conv_id"""
