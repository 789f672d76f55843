"""The ledger's query in DuckDB SQL."""

WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t\n\x0B\f\r]+'), lambda w: w <> '')"

LEDGER = rf"""
WITH base AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, {WORDS} AS w FROM documents),
windows AS (
  SELECT rid, i, list_slice(w, i, i + 4) AS g FROM (SELECT rid, w, unnest(range(1, len(w) - 3)) AS i FROM base WHERE len(w) >= 5)),
repeated AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM windows) WHERE n > 1),
covered AS (
  SELECT rid, sum(least(5, coalesce(i - before, 5))) AS n
  FROM (SELECT rid, i, lag(i) OVER (PARTITION BY rid ORDER BY i) AS before FROM repeated) GROUP BY rid),
counts AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    len(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ \t\n\x0B\f\r]')))::BIGINT AS n_lines,
    (len(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ \t\n\x0B\f\r]')))
      - len(list_distinct(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ \t\n\x0B\f\r]')))))::BIGINT AS n_dup_lines,
    coalesce(c.n, 0)::BIGINT AS n_repeat_words
  FROM base LEFT JOIN covered c USING (rid))
"""


def sql(rules: tuple[tuple[str, str], ...], base: tuple[str, ...]) -> str:
    """The registered query; ``rules`` are the ledger's, in bit order."""
    bits = " + ".join(f"CASE WHEN {rule} THEN {1 << k} ELSE 0 END" for k, (_, rule) in enumerate(rules))
    failed = " OR ".join(f"({rule})" for name, rule in rules if name in base)
    return LEDGER + f"""SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
      ({failed}) AS base_failed, ({bits}) = 0 AS kept, n_lines, ({bits})::BIGINT AS fail_bits FROM counts"""
