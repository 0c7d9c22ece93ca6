"""DuckDB SQL for the queries whose contracts SQL can state without the operator's own means."""

from __future__ import annotations

WARC = """
SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, sha1(h) AS payload_digest,
       CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN top END AS refers_to
FROM (SELECT *, strlen(h) >= 1000 AND n > 1 AND top IS NOT NULL AND page_id IS DISTINCT FROM top AS again
      FROM (SELECT page_id, h, count(*) OVER (PARTITION BY h) AS n, max(page_id) OVER (PARTITION BY h) AS top
            FROM (SELECT page_id, coalesce(html, '') AS h FROM pages)))
"""

QUALITY = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
             regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT r, i, w[i : i + 2] AS x FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, x) AS n FROM g) WHERE n > 1),
rep AS (SELECT r, count(DISTINCT p) AS n_rep FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM again) GROUP BY r),
m AS (SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
        coalesce(n_rep, 0) AS n_repeat_words, length(regexp_replace(t, '[^\p{Lu}]', '', 'g')) AS n_upper
      FROM d LEFT JOIN rep USING (r)),
b AS (SELECT *, len(lines) - len(list_distinct(lines)) AS n_dup_lines FROM m),
f AS (SELECT *, (n_words < 50)::INTEGER + 2 * (100 * n_repeat_words > 50 * n_words)::INTEGER + 4 * (10 * n_symbols > n_words)::INTEGER
        + 8 * (word_chars < 2 * n_words)::INTEGER + 16 * (word_chars > 20 * n_words)::INTEGER
        + 32 * (2 * n_dup_lines > len(lines))::INTEGER + 64 * (10 * n_upper > 4 * word_chars)::INTEGER
        + 128 * (n_words > 1000000)::INTEGER AS bits FROM b)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
       bits % 4 > 0 AS base_failed, bits % 128 = 0 AS kept, CAST(bits AS BIGINT) AS fail_bits, 2 AS policy
FROM f
"""

CHAT = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
e AS (SELECT *, contains(role, chr(10)) OR regexp_matches(role, '<\|(im_start|im_end|n)\|>|<\\+\|')
             OR regexp_matches(text, '<\|(im_start|im_end|n)\|>|<\\+\|') AS conflict FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(12 + length(role) + 1 + length(text) + 10 + 1
                + CASE WHEN conflict THEN len(regexp_extract_all(text, '<\\*\|')) + len(regexp_extract_all(role, '<\\*\|'))
                       + 4 * (length(role) - length(replace(role, chr(10), ''))) ELSE 0 END) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""


#: The ablations of both policies: what a policy keeps, and what it would keep without each of its rules.
ABLATIONS = f"""
WITH ledger AS (SELECT fail_bits FROM ({QUALITY})),
rules(rule, bit, policies) AS (VALUES ('few_words', 1, [1, 2]), ('repeated_words', 2, [1, 2]), ('symbols', 4, [1, 2]),
  ('short_words', 8, [2]), ('long_words', 16, [2]), ('duplicate_lines', 32, [2]), ('capitals', 64, [2])),
masks AS (SELECT p AS policy, CAST(sum(bit) AS BIGINT) AS mask FROM (SELECT unnest(policies) AS p, bit FROM rules) GROUP BY p),
each AS (SELECT policy, rule, bit, fail_bits & mask AS bits FROM masks JOIN rules ON list_contains(policies, policy), ledger)
SELECT CAST(policy AS INTEGER) AS policy, rule, count(*) FILTER (WHERE bits & bit <> 0) AS n_failed,
       count(*) FILTER (WHERE bits = bit) AS n_only, count(*) FILTER (WHERE bits = 0) AS n_kept,
       count(*) FILTER (WHERE bits = 0 OR bits = bit) AS n_kept_without
FROM each GROUP BY ALL
"""
