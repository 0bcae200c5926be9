"""The queries that SQL can express, as DuckDB runs them on the same tables."""

from __future__ import annotations

from .chat import END, TEXT, TURN

WORD = r"[^\x20\x09-\x0D]+"


def _family(level: int, levels: list[str], weights: dict[tuple, int], budget: str) -> str:
    """Views that share the budgets of the parents of ``level`` among their children."""
    node, above = ", ".join(levels[:level]), ", ".join(levels[: level - 1])
    given = [(path, w) for path, w in weights.items() if len(path) == level]
    cases = " ".join(
        "WHEN "
        + " AND ".join(f"{c} = '{v}'" for c, v in zip(levels, path, strict=False))
        + f" THEN {weight}"
        for path, weight in given
    )
    weight = f"CASE {cases} ELSE 1 END" if cases else "1"
    family = f"PARTITION BY {above}" if above else ""
    order = f"{family} ORDER BY supply / weight, {levels[level - 1]}"
    before = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    joined = f"JOIN g{level - 1} USING ({above})" if above else ""
    same = " AND ".join(f"a.{c} = b.{c}" for c in levels[: level - 1]) or "true"
    grouped = f"GROUP BY {above}" if above else ""
    key = f"{above}, " if above else ""
    return f"""
n{level} AS (SELECT {node}, sum(tokens) * 2 AS supply, {weight} AS weight
  FROM leaves GROUP BY {node}),
s{level} AS (SELECT {node}, supply, weight,
    greatest({budget} - coalesce(sum(supply) OVER ({order} {before}), 0), 0) AS left_over,
    sum(weight) OVER ({family}) - coalesce(sum(weight) OVER ({order} {before}), 0) AS claims
  FROM n{level} {joined}),
f{level} AS (SELECT {key} arg_min({{'l': left_over, 'c': claims}}, {{'r': supply / weight, 'n': {levels[level - 1]}}}) AS lv
  FROM s{level} WHERE supply::HUGEINT * claims > left_over::HUGEINT * weight {grouped}),
g{level} AS (SELECT {", ".join(f"a.{c}" for c in levels[:level])},
    CASE WHEN a.supply::HUGEINT * a.claims <= a.left_over::HUGEINT * a.weight THEN a.supply
    ELSE (lv.l::HUGEINT * a.weight) // lv.c END AS granted
  FROM s{level} a LEFT JOIN f{level} b ON {same})"""


def mix_sql(levels: list[str], weights: dict[tuple, int], share: float, seed: int) -> str:
    """Budgets down the tree, then whole epochs and the prefix of one more; two epochs at most."""
    total = f"(SELECT cast(floor(sum(tokens) * {share}) AS BIGINT) FROM leaves)"
    families = [
        _family(level, levels, weights, total if level == 1 else "granted")
        for level in range(1, len(levels) + 1)
    ]
    leaf = ", ".join(levels)
    return f"""
WITH d AS (SELECT doc_id, 'd' || (cast(nullif(regexp_extract(source, '([0-9]+)$', 1), '') AS BIGINT) % 4)
    AS domain, lang, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS tokens
  FROM documents),
leaves AS (SELECT {leaf}, sum(tokens) AS tokens FROM d GROUP BY {leaf}),
{",".join(families)},
plan AS (SELECT {leaf}, coalesce(granted // nullif(tokens, 0), 0) AS whole,
    granted - coalesce(granted // nullif(tokens, 0), 0) * tokens AS rest
  FROM leaves JOIN g{len(levels)} USING ({leaf})),
o AS (SELECT d.*, whole, rest, sum(tokens) OVER (PARTITION BY {leaf}
    ORDER BY substr(md5('{seed}:' || whole || ':' || doc_id), 1, 13), cast(doc_id AS VARCHAR), tokens
    ROWS UNBOUNDED PRECEDING) AS after
  FROM d JOIN plan USING ({leaf}))
SELECT doc_id, {leaf}, cast(e AS INTEGER) AS epoch, cast(tokens AS BIGINT) AS n_tokens
FROM o, range(2) r(e)
WHERE e < whole OR (e = whole AND rest > 0 AND after <= rest)"""


WARC_SQL = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n,
    sha256(coalesce(html, '')) AS digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY digest) AS first_id FROM p)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
  CASE WHEN n >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM f"""


def _escaped_length(column: str) -> str:
    """Characters of a text with its backslashes and control strings escaped."""
    # What an escape is put into, one by one as they may overlap.
    patterns = (r"\\", r"<\|", r"\|>", r"</?s>", r"</?SYS>", r"\[/?INST\]")
    found = [f"len(regexp_extract_all({column}, '{p}'))" for p in patterns]
    return " + ".join([f"length({column})", *found])


CHAT_SQL = f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text))
    AS turns_sha256,
  cast(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text)
    FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  cast(sum({len(TURN + TEXT + END)} + {_escaped_length("role")} + {_escaped_length("text")})
    AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id"""

_TERMS = r"""unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))"""

SEARCH_SQL = f"""
WITH rows AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
words AS (SELECT r, doc_id, {_TERMS} AS term FROM rows),
posts AS (SELECT r, doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
lengths AS (SELECT r, sum(tf)::BIGINT AS n FROM posts GROUP BY r),
corpus AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM lengths),
weights AS (SELECT term, floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w
  FROM posts, corpus GROUP BY term),
asked AS (SELECT DISTINCT item_id, {_TERMS} AS term FROM benchmark),
scores AS (SELECT item_id, r, doc_id,
    sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms))))::BIGINT AS score
  FROM asked JOIN posts USING (term) JOIN weights USING (term) JOIN lengths USING (r), corpus
  GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER
    (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank
  FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""


def _trees_round(n: int) -> str:
    """Parts with the entry of codebook ``n`` that is nearest, and the codebook after."""
    return f"""
d{n} AS (SELECT r, p, e, x, list_sum(list_transform(range(1, len(x) + 1),
    lambda i: (x[i] - c[i]) * (x[i] - c[i])))::BIGINT AS d FROM parts JOIN c{n} USING (p)),
a{n} AS (SELECT r, p, any_value(x) AS x, arg_min({{'e': e, 'd': d}}, {{'d': d, 'e': e}}) AS o
  FROM d{n} GROUP BY r, p),
m{n} AS (SELECT p, o.e AS e, i, floor(sum(x[i])::DOUBLE / count(*))::BIGINT AS v
  FROM a{n}, (SELECT unnest(range(1, w + 1)) AS i FROM width) GROUP BY ALL),
l{n} AS (SELECT p, e, list(v ORDER BY i) AS c FROM m{n} GROUP BY p, e),
c{n + 1} AS (SELECT p, e, coalesce(l.c, b.c) AS c FROM c{n} b LEFT JOIN l{n} l USING (p, e)),"""


TREES_SQL = f"""
WITH kept AS (SELECT vec_id, label, row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(embedding) > 0),
width AS (SELECT max(len(v)) // 16 AS w FROM kept),
parts AS (SELECT r, p, v[p * w + 1 : (p + 1) * w] AS x
  FROM kept, width, (SELECT unnest(range(16)) AS p)),
c0 AS (SELECT p, r - 1 AS e, x AS c FROM parts WHERE r <= 64),
{_trees_round(0)}{_trees_round(1)}
d2 AS (SELECT r, p, e, list_sum(list_transform(range(1, len(x) + 1),
    lambda i: (x[i] - c[i]) * (x[i] - c[i])))::BIGINT AS d FROM parts JOIN c2 USING (p)),
a2 AS (SELECT r, p, arg_min({{'e': e, 'd': d}}, {{'d': d, 'e': e}}) AS o FROM d2 GROUP BY r, p),
codes AS (SELECT r, string_agg(printf('%02x', o.e), '' ORDER BY p) AS code, sum(o.d)::BIGINT AS error
  FROM a2 GROUP BY r),
books AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS digest FROM c2)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  digest AS codebooks_sha256
FROM kept JOIN codes USING (r), books
"""
