"""SQL of the operators that SQL can express, for DuckDB.

Letters' edits and rounds of centroids are plain aggregates and joins; automata, trees,
alignments, archives and positions of matches are beyond it.
"""

from __future__ import annotations

# CRC-32 by its definition: a table of 256 remainders, then a fold over the bytes.
_REMAINDERS = """
remainders AS (
    SELECT list(list_reduce(range(8), lambda c, bit: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) ORDER BY i) AS t
    FROM range(256) AS r(i)
)"""


def _crc32(text: str, table: str) -> str:
    # Letters up to U+00FF and digits: one byte, or two as UTF-8 has it.
    codes = f"list_transform(string_split({text}, ''), lambda c: ord(c))"
    utf8 = f"flatten(list_transform({codes}, lambda o: CASE WHEN o < 128 THEN [o] ELSE [192 + (o >> 6), 128 + (o & 63)] END))"
    return f"xor(list_reduce({utf8}, lambda c, b: xor(c >> 8, {table}[1 + (xor(c, b) & 255)]), 4294967295), 4294967295)"


VARIANTS = f"""
WITH RECURSIVE {_REMAINDERS},
runs AS (
    SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, sum(times) AS times
    FROM (
        SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]{{6,}}')) AS run, 1 AS times FROM documents
    ) GROUP BY ALL
),
hashed AS (
    SELECT run, times, {_crc32("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run", "t")} AS h FROM runs, remainders
),
damaged AS (
    SELECT CASE WHEN h % 199 = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, times FROM hashed
),
words AS (
    SELECT word, CAST(sum(times) AS BIGINT) AS n FROM damaged WHERE length(word) >= 6 GROUP BY word HAVING sum(times) >= 5
),
holes AS (
    SELECT word, n, word[:i] AS before, word[i + 2:] AS behind FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)
),
pairs AS (
    SELECT a.word, b.word AS other, b.n FROM holes a JOIN holes b USING (before, behind) WHERE a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM words b JOIN holes a ON b.word = a.before || a.behind
    UNION SELECT b.word, a.word, a.n FROM words b JOIN holes a ON b.word = a.before || a.behind
),
near AS (
    SELECT word, count(*) AS n_near, first(other ORDER BY n DESC, other) AS other, max(n) AS most FROM pairs GROUP BY word
),
forms AS (
    SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 5 * w.n THEN other END AS form, CASE WHEN most >= 5 * w.n THEN most END AS form_n
    FROM words w LEFT JOIN near USING (word)
),
walks AS (
    SELECT word, word AS root FROM forms
    UNION ALL SELECT walks.word, forms.form FROM walks JOIN forms ON walks.root = forms.word WHERE forms.form IS NOT NULL
),
ends AS (SELECT walks.word, walks.root FROM walks JOIN forms ON walks.root = forms.word WHERE forms.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN ends USING (word)
"""

_DISTANCE = "list_sum(list_transform(list_zip(r.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"


def _round(number: int) -> str:
    """Assignment to the centroids c<number>, and the floored means c<number + 1>."""
    return f"""
a{number} AS MATERIALIZED (
    SELECT row, min(CAST({_DISTANCE} AS HUGEINT) * 64 + c.cluster) AS best FROM kept r, c{number} c GROUP BY row
),
m{number} AS (
    SELECT cluster, list(CAST((s - ((s % n + n) % n)) // n AS BIGINT) ORDER BY i) AS v FROM (
        SELECT best % 64 AS cluster, i, sum(x) AS s, count(*) AS n
        FROM (SELECT best, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{number} JOIN kept USING (row)) GROUP BY ALL
    ) GROUP BY cluster
),
c{number + 1} AS MATERIALIZED (
    SELECT c.cluster, coalesce(m.v, c.v) AS v FROM c{number} c LEFT JOIN m{number} m ON c.cluster = m.cluster
)"""


CENTROIDS = f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY vec_id) AS row, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: isfinite(x))) = 64
),
c0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY sha256('2:' || coalesce(CAST(vec_id AS VARCHAR), '')), v) - 1 AS cluster, v FROM kept
    ORDER BY cluster LIMIT 40
),
{",".join(_round(number) for number in range(5))},
last AS (SELECT row, min(CAST({_DISTANCE} AS HUGEINT) * 64 + c.cluster) AS best FROM kept r, c5 c GROUP BY row),
split AS (SELECT row, CAST(best % 64 AS INTEGER) AS cluster, CAST(best // 64 AS BIGINT) AS distance FROM last)
SELECT vec_id, s.cluster, distance, CAST(sum(distance) OVER (PARTITION BY s.cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c5.v, ',')) AS centroid_sha256
FROM split s JOIN kept USING (row) JOIN c5 ON c5.cluster = s.cluster
"""

ORACLES = {"op11_trie_pairs": VARIANTS, "op12_rotated_centroids": CENTROIDS}
