"""SQL of the operators that SQL can say, for DuckDB over the same tables."""

from __future__ import annotations

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def phrase_sql(min_count: int = 100, longest: int = 5, top: int = 2000) -> str:
    """All n-grams of all pieces, counted and cut in the plainest way."""
    grams = " UNION ALL ".join(
        f"SELECT lang, {k} AS size, array_to_string(list_slice(w, i + 1, i + {k}), ' ') AS phrase FROM (SELECT lang, w, unnest(range(len(w) - {k - 1})) AS i FROM words WHERE len(w) >= {k})" for k in range(1, longest + 1)
    )
    return rf"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({LOWER.format("coalesce(text, '')")}, '[.,;:!?\x0A-\x0D]')) AS p FROM documents),
words AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, cast(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
counts AS (SELECT lang, size, phrase, count(*) AS a FROM ({grams}) GROUP BY ALL HAVING count(*) >= {min_count}),
split AS (SELECT *, string_split(phrase, ' ') AS w FROM counts WHERE size > 1),
cuts AS (SELECT lang, phrase, a, k, array_to_string(list_slice(w, 1, k), ' ') AS head, array_to_string(list_slice(w, k + 1, size), ' ') AS tail
         FROM (SELECT *, unnest(range(1, size)) AS k FROM split)),
scored AS (SELECT c.lang, c.phrase, c.a, k, h.a AS l, t.a AS r, n, (1000::HUGEINT * c.a * n) // (h.a::HUGEINT * t.a) AS score
           FROM cuts c JOIN counts h ON h.lang = c.lang AND h.phrase = c.head JOIN counts t ON t.lang = c.lang AND t.phrase = c.tail JOIN totals s ON s.lang = c.lang),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_parts AS (SELECT lang, a, array_to_string(list_slice(w, i, i + m - 1), ' ') AS phrase
                FROM (SELECT *, unnest(range(1, size - m + 2)) AS i FROM (SELECT *, unnest(range(2, size)) AS m FROM split))),
longer AS (SELECT lang, phrase, max(a) AS longer FROM inner_parts GROUP BY ALL),
kept AS (SELECT l.* FROM lowest l LEFT JOIN longer g ON g.lang = l.lang AND g.phrase = l.phrase WHERE longer IS NULL OR 100 * longer < 100 * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, cast(score AS BIGINT) AS score FROM ranked WHERE rank <= {top}"""


def window_sql(window: int = 10) -> str:
    """All runs of words of the documents, of each length that a window has, against all windows."""
    words = rf"regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return rf"""
WITH items AS (SELECT coalesce(cast(item_id AS VARCHAR), '') AS item, {words} AS w FROM benchmark),
windows AS (SELECT DISTINCT item, least(len(w), {window}) AS size, array_to_string(list_slice(w, i + 1, i + {window}), ' ') AS run
            FROM (SELECT *, unnest(range(greatest(len(w) - {window}, 0) + 1)) AS i FROM items WHERE len(w) > 0)),
docs AS (SELECT row_number() OVER () AS r, doc_id, {words} AS w FROM documents),
runs AS (SELECT r, i, size, array_to_string(list_slice(w, i + 1, i + size), ' ') AS run
         FROM (SELECT r, w, size, unnest(range(len(w) - size + 1)) AS i FROM docs, (SELECT DISTINCT size FROM windows) WHERE len(w) >= size)),
found AS (SELECT r, i, u.size, item FROM runs u JOIN windows v ON u.run = v.run AND u.size = v.size),
hits AS (SELECT r, count(*) AS n_hit FROM (SELECT DISTINCT r, unnest(range(i, i + size)) AS place FROM found) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT r, item FROM found) GROUP BY r)
SELECT doc_id, cast(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (r) LEFT JOIN named USING (r)"""


def merkle_sql(levels: int = 8, lang_levels: int = 3) -> str:
    """The trees level by level, and each leaf's way up by a join with the siblings of each level."""

    def field(column: str) -> str:
        return f"coalesce(strlen(cast({column} AS VARCHAR)) || ':' || cast({column} AS VARCHAR), '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join([*map(field, ("doc_id", "source", "lang", "n_chars")), text]) + ")"

    def tree(name: str, count: int) -> list[str]:
        out = []
        for j in range(count):
            out.append(f"""{name}s{j} AS (SELECT g, rank, n, coalesce(string_agg(hash, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
  coalesce(string_agg(hash, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name}{j} WINDOW w AS (PARTITION BY g, rank // 8 ORDER BY rank))""")
            out.append(f"{name}{j + 1} AS (SELECT g, n, rank // 8 AS rank, CASE WHEN n > {8**j} THEN sha256(string_agg(hash, '' ORDER BY rank)) ELSE max(hash) END AS hash FROM {name}{j} GROUP BY g, n, rank // 8)")
        return out

    def climb(name: str, way: str, count: int) -> list[str]:
        return [
            f"{way}{j + 1} AS (SELECT p.* REPLACE (spot // 8 AS spot, proof || l || r AS proof, CASE WHEN n > {8**j} THEN sha256(l || fold || r) ELSE fold END AS fold) FROM {way}{j} p JOIN {name}s{j} s ON s.g = p.g AND s.rank = p.spot)"
            for j in range(count)
        ]

    lowered = field(LOWER.format("text"))
    crc = "xor(list_reduce([4294967295] || list_transform(string_split(cast(doc_id AS VARCHAR), ''), lambda ch: cast(ascii(ch) AS BIGINT)), lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, i: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)), 4294967295)"
    parts = [
        f"leaves AS (SELECT doc_id, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g, {leaf(field('text'))} AS leaf, CASE WHEN doc_id IS NOT NULL AND {crc} % 3 = 0 THEN {leaf(lowered)} END AS changed FROM documents)",
        "placed AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank, count(*) OVER (PARTITION BY g) AS n FROM leaves)",
        "a0 AS (SELECT g, n, rank, leaf AS hash FROM placed)",
        *tree("a", levels),
        f"b0 AS (SELECT 0 AS g, g AS rank, count(*) OVER () AS n, hash FROM a{levels})",
        *tree("b", lang_levels),
        "p0 AS (SELECT doc_id, leaf, g, rank AS spot, '' AS proof, coalesce(changed, leaf) AS fold FROM placed)",
        *climb("a", "p", levels),
        f"q0 AS (SELECT doc_id, leaf, a{levels}.hash AS subroot, 0 AS g, p.g AS spot, proof, fold FROM p{levels} p JOIN a{levels} ON a{levels}.g = p.g)",
        *climb("b", "q", lang_levels),
    ]
    return "WITH " + ",\n".join(parts) + f"\nSELECT doc_id, leaf, subroot, b{lang_levels}.hash AS root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = b{lang_levels}.hash AS verified FROM q{lang_levels}, b{lang_levels}"
