"""DuckDB SQL for the queries of this folder that SQL can express on whole tables."""

from __future__ import annotations

from emberline.llm.rules import POLICIES, RULES, mask_of

OP1 = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT doc_id, text, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words,
    [x FOR x IN string_split(text, chr(10)) IF regexp_matches(x, '[^\\x20\\x09-\\x0D]')] AS lines
  FROM d
),
g AS (
  SELECT doc_id, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS k, i
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w)
),
dup AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS n FROM g),
covered AS (
  SELECT doc_id, count(DISTINCT i + s) AS n FROM dup, (SELECT unnest([0, 1, 2]) AS s) AS steps WHERE n > 1 GROUP BY doc_id
),
m AS (
  SELECT w.doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words,
    len(lines) AS n_lines, length(regexp_replace(text, '[^\\p{{Lu}}]', '', 'g')) AS n_upper
  FROM w LEFT JOIN covered c ON w.doc_id = c.doc_id
),
b AS (
  SELECT *, {' + '.join(f'CASE WHEN {r.fails} THEN {1 << k} ELSE 0 END' for k, r in enumerate(RULES))} AS failed_bits FROM m
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words, (failed_bits & {mask_of(POLICIES['base'])}) <> 0 AS base_failed,
  (failed_bits & {mask_of(POLICIES['v1'])}) = 0 AS kept, CAST(failed_bits AS BIGINT) AS failed_bits
FROM b
"""

OP4 = r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents
),
g AS (
  SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
    row_number() OVER w AS place, sha256(norm) AS text_sha256
  FROM n WINDOW w AS (PARTITION BY norm ORDER BY chars DESC, doc_id NULLS LAST)
)
SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size, place = 1 AS kept, text_sha256 FROM g
"""



def op11_sql(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """Every vector against every entry, round by round."""
    steps = [
        "k AS MATERIALIZED (SELECT vec_id, label, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v, "
        f"len(embedding) // {parts} AS w FROM embeddings WHERE embedding IS NOT NULL "
        "AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0)",
        "p AS MATERIALIZED (SELECT vec_id, label, part, pos, v[part * w + pos + 1] AS x FROM "
        f"(SELECT vec_id, label, v, w, part, unnest(range(w)) AS pos FROM (SELECT *, unnest(range({parts})) AS part FROM k)))",
        f"i AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM k QUALIFY entry < {entries})",
        "b0 AS MATERIALIZED (SELECT part, entry, pos, x FROM p JOIN i USING (vec_id))",
    ]
    for r in range(rounds + 1):
        steps.append(
            f"a{r} AS MATERIALIZED (SELECT vec_id, label, part, arg_min(entry, d * {entries} + entry) AS entry, min(d) AS d FROM ("
            f"SELECT vec_id, label, part, entry, sum((p.x - b{r}.x) * (p.x - b{r}.x)) AS d FROM p JOIN b{r} USING (part, pos) "
            "GROUP BY ALL) GROUP BY ALL)"
        )
        if r < rounds:
            steps += [
                f"m{r} AS (SELECT part, entry, pos, sum(x) AS s, count(*) AS n FROM p JOIN a{r} USING (vec_id, part) GROUP BY ALL)",
                f"b{r + 1} AS MATERIALIZED (SELECT part, entry, pos, coalesce((s - ((s % n) + n) % n) // n, x) AS x "
                f"FROM b{r} LEFT JOIN m{r} USING (part, entry, pos))",
            ]
    return (
        f"WITH {', '.join(steps)}, c AS (SELECT vec_id, label, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, "
        f"CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY ALL) "
        "SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, "
        f"(SELECT sha256(string_agg(CAST(CAST(x AS BIGINT) AS VARCHAR), ',' ORDER BY part, entry, pos)) FROM b{rounds}) AS codebooks_sha256 FROM c"
    )


SQL: dict[str, str] = {"op1_quality_rules": OP1, "op4_exact_dedup": OP4, "op11_orchard_codes": op11_sql()}
