"""DuckDB SQL for the queries that SQL can express.

The others rest on fitted models, block codes, HTML parsing, XXH64 or seeded draws; they
are tested against plain versions instead (``tests/llm``).
"""

from __future__ import annotations

WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',"
    " 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)

CONTAMINATION = f"""
WITH docs AS (SELECT doc_id, {WORDS} AS words FROM documents),
items AS (SELECT item_id, {WORDS} AS words FROM benchmark),
item_windows AS (
    SELECT DISTINCT item_id, k, array_to_string(words[i:i + k - 1], ' ') AS gram
    FROM (SELECT *, least(10, len(words)) AS k FROM items WHERE len(words) > 0) x,
        unnest(range(1, len(words) - k + 2)) AS t(i)),
widths AS (SELECT DISTINCT k FROM item_windows),
doc_windows AS (
    SELECT doc_id, k, i, array_to_string(words[i:i + k - 1], ' ') AS gram
    FROM (SELECT * FROM docs, widths) x, unnest(range(1, len(words) - k + 2)) AS t(i)),
hits AS (SELECT doc_id, i, k, item_id FROM doc_windows JOIN item_windows USING (k, gram)),
covered AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit
    FROM (SELECT DISTINCT doc_id, i, k FROM hits) x, unnest(range(i, i + k)) AS t(p) GROUP BY doc_id),
named AS (
    SELECT doc_id, count(*) AS n_items, sha256(string_agg(name, ',' ORDER BY name)) AS items_sha256
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS name FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
    coalesce(items_sha256, sha256('')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM docs LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""




COLLOCATIONS = """
WITH texts AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
pieces AS (SELECT lang, regexp_extract_all(piece, '[^ \\t]+') AS ws
    FROM texts, unnest(regexp_split_to_array(text, '[.,;:!?\\n\\x0B\\x0C\\r]')) AS p(piece)),
words AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM pieces GROUP BY lang),
phrases AS (SELECT lang, ws[i:i + k - 1] AS ws, count(*) AS f
    FROM pieces, unnest([1, 2, 3]) AS s(k), unnest(range(1, len(ws) - k + 2)) AS t(i)
    GROUP BY ALL HAVING count(*) >= 10),
covered AS (SELECT DISTINCT s.lang, s.ws FROM phrases s JOIN phrases x ON s.lang = x.lang
    AND len(s.ws) = 2 AND len(x.ws) = 3 AND (s.ws = x.ws[1:2] OR s.ws = x.ws[2:3]) AND 100 * x.f >= 50 * s.f),
cuts AS (SELECT c.lang, c.ws, c.f AS a, k, x.f AS l, y.f AS r,
    (1000000 * c.f::HUGEINT * c.f::HUGEINT) // (x.f::HUGEINT * y.f::HUGEINT) AS score
    FROM (SELECT * FROM phrases ANTI JOIN covered USING (lang, ws) WHERE len(ws) > 1) c,
        unnest(range(1, len(c.ws))) AS t(k)
    JOIN phrases x ON x.lang = c.lang AND x.ws = c.ws[1:k]
    JOIN phrases y ON y.lang = c.lang AND y.ws = c.ws[k + 1:len(c.ws)]),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, ws ORDER BY score, k) = 1),
ranked AS (SELECT *, array_to_string(ws, ' ') AS phrase,
    row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(ws, ' ')) AS rank FROM best)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM ranked JOIN words USING (lang) WHERE rank <= 2000
"""


def vector_codes(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Integer k-means per part position, its rounds written out."""
    ctes = [f"""kept AS (SELECT row_number() OVER () AS r, vec_id, label,
    list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
            f"""pieces AS (SELECT r, vec_id, p, v[p * len(v) // {parts} + 1:(p + 1) * len(v) // {parts}] AS x
    FROM kept, unnest(range({parts})) AS t(p))""",
            f"""first_ids AS (SELECT DISTINCT vec_id FROM kept ORDER BY vec_id LIMIT {entries})""",
            """numbered AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM first_ids)""",
            """b0 AS (SELECT p, e, min(x) AS c FROM pieces JOIN numbered USING (vec_id) GROUP BY p, e)"""]
    for i in range(rounds + 1):
        ctes.append(f"""d{i} AS (SELECT r, pieces.p, e, x,
    list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
    FROM pieces JOIN b{i} ON pieces.p = b{i}.p)""")
        ctes.append(f"""a{i} AS (SELECT r, p, min(struct_pack(d := CAST(d AS BIGINT), e := e)) AS near, any_value(x) AS x
    FROM d{i} GROUP BY r, p)""")
        if i < rounds:
            ctes.append(f"""s{i} AS (SELECT p, near.e AS e, k, sum(x[k]) AS s, count(*) AS n
    FROM a{i}, unnest(range(1, len(x) + 1)) AS t(k) GROUP BY p, near.e, k)""")
            ctes.append(f"""m{i} AS (SELECT p, e, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY k) AS c
    FROM s{i} GROUP BY p, e)""")
            ctes.append(f"""b{i + 1} AS (SELECT p, e, coalesce(m{i}.c, b{i}.c) AS c
    FROM b{i} LEFT JOIN m{i} USING (p, e))""")
    ctes.append(f"""coded AS (SELECT r, string_agg(printf('%02x', near.e), '' ORDER BY p) AS code,
    CAST(sum(near.d) AS BIGINT) AS error FROM a{rounds} GROUP BY r)""")
    ctes.append(f"""books AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256
    FROM b{rounds})""")
    return "WITH " + ",\n".join(ctes) + """
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN coded USING (r), books"""


def oracle_sql() -> dict[str, str]:
    return {"op6_decontaminate": CONTAMINATION, "op11_code_bounds": vector_codes(),
            "op13_phrase_trie": COLLOCATIONS}
