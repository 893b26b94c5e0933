"""DuckDB SQL of the vector codes, the quality rules and the collocations, over the same tables."""

from __future__ import annotations

from kinesia.llm import collocations, quality, vector_codes


def vector_codes_sql(parts: int = vector_codes.PARTS, entries: int = vector_codes.ENTRIES, rounds: int = vector_codes.ROUNDS) -> str:
    """The Lloyd rounds one after the other, each a join of all parts with their position's entries."""
    step = f"(len(x) // {parts})"
    ctes = [
        f"v AS (SELECT vec_id, label, [CAST(floor({vector_codes.SCALE} * CAST(c AS DOUBLE)) AS BIGINT) FOR c IN embedding] AS x FROM embeddings"
        " WHERE embedding IS NOT NULL AND len([c FOR c IN embedding IF c IS NULL OR NOT isfinite(c)]) = 0)",
        f"parts AS MATERIALIZED (SELECT vec_id, p, x[p * {step} + 1:(p + 1) * {step}] AS y FROM v, range({parts}) t(p))",
        f"b0 AS (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, y AS c FROM parts"
        f" QUALIFY row_number() OVER (PARTITION BY p ORDER BY vec_id) <= {entries})",
    ]
    for r in range(rounds + 1):
        ctes.append(
            f"d{r} AS (SELECT vec_id, parts.p, e, y, list_sum([CAST((z[1] - z[2]) * (z[1] - z[2]) AS HUGEINT) FOR z IN list_zip(y, c)]) AS d"
            f" FROM parts JOIN b{r} b ON parts.p = b.p)"
        )
        ctes.append(f"a{r} AS MATERIALIZED (SELECT vec_id, p, e, y, d FROM d{r} QUALIFY row_number() OVER (PARTITION BY vec_id, p ORDER BY d, e) = 1)")
        if r < rounds:
            ctes.append(f"w{r} AS (SELECT p, e, unnest(y) AS c, unnest(range(len(y))) AS i FROM a{r})")
            ctes.append(f"s{r} AS (SELECT p, e, i, sum(c) AS s, count(*) AS n FROM w{r} GROUP BY p, e, i)")
            ctes.append(f"m{r} AS (SELECT p, e, list(CAST((s - (((s % n) + n) % n)) // n AS BIGINT) ORDER BY i) AS c FROM s{r} GROUP BY p, e)")
            ctes.append(f"b{r + 1} AS MATERIALIZED (SELECT b{r}.p, b{r}.e, coalesce(m{r}.c, b{r}.c) AS c FROM b{r} LEFT JOIN m{r} ON b{r}.p = m{r}.p AND b{r}.e = m{r}.e)")
    return f"""WITH {", ".join(ctes)},
flat AS (SELECT p, e, unnest(c) AS c, unnest(range(len(c))) AS i FROM b{rounds}),
sha AS (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY p, e, i)) AS h FROM flat),
coded AS (SELECT vec_id, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY vec_id)
SELECT v.vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256
FROM v JOIN coded ON v.vec_id = coded.vec_id, sha"""


def quality_sql() -> str:
    word, width = quality.WORD, quality.WINDOW
    ratios = " UNION ALL ".join(
        f"SELECT lang, source, '{name}' AS ratio, ({scale} * {num}) // greatest({den}, 1) AS value FROM c WHERE NOT base_failed"
        for name, (num, scale, den, *_) in quality.RATIOS.items()
    )
    fences, names = [], []
    for name, (_, _, _, two_sided, share, least) in quality.RATIOS.items():
        slack = f"({quality.FENCE} * (q3 - q1) + greatest(({share} * q2) // 1000, {least}))"
        low = f"q1 - {slack}" if two_sided else "0"
        fences += [f"max(CASE WHEN ratio = '{name}' THEN {low} END) AS {name}_low", f"max(CASE WHEN ratio = '{name}' THEN q3 + {slack} END) AS {name}_high"]
        names += [f"{name}_low", f"{name}_high"]
    cut = f"greatest(length(bin(value)) - {quality.SKETCH_BITS}, 0)"
    choose = lambda col: f"CASE WHEN o.docs >= {quality.MIN_DOCS} THEN o.{col} WHEN l.docs >= {quality.MIN_DOCS} THEN l.{col} ELSE g.{col} END"

    def level(name: str, keys: str) -> str:
        by = f"{keys}, " if keys else ""
        own = f"GROUP BY {keys}" if keys else ""
        return f"""{name}_m AS (SELECT {by}ratio, value, sum(n) AS n FROM sketch GROUP BY {by}ratio, value),
{name}_r AS (SELECT *, sum(n) OVER (PARTITION BY {by}ratio ORDER BY value) AS upto, sum(n) OVER (PARTITION BY {by}ratio) AS docs FROM {name}_m),
{name}_q AS (SELECT {by}ratio, max(docs) AS docs, min(CASE WHEN 4 * upto >= docs THEN value END) AS q1,
  min(CASE WHEN 4 * upto >= 2 * docs THEN value END) AS q2, min(CASE WHEN 4 * upto >= 3 * docs THEN value END) AS q3 FROM {name}_r GROUP BY {by}ratio),
{name}_f AS (SELECT {by}max(docs) AS docs, {", ".join(fences)} FROM {name}_q {own})"""

    inside = " AND ".join(
        f"({scale} * {num}) // greatest({den}, 1) BETWEEN {choose(f'{name}_low')} AND {choose(f'{name}_high')}"
        for name, (num, scale, den, *_) in quality.RATIOS.items()
    )
    return rf"""WITH t AS (SELECT doc_id, lang, source, coalesce(text, '') AS txt FROM documents),
s AS (SELECT *, regexp_extract_all(txt, '{word}') AS ws, [x FOR x IN string_split(txt, chr(10)) IF regexp_matches(x, '{word}')] AS ls FROM t),
wins AS (SELECT doc_id, unnest(range(1, len(ws) - {width - 2})) AS place, ws FROM s WHERE len(ws) >= {width}),
keyed AS (SELECT doc_id, place, array_to_string(ws[place:place + {width - 1}], ' ') AS win FROM wins),
again AS (SELECT doc_id, place FROM keyed QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1),
words AS (SELECT DISTINCT doc_id, place + i AS place FROM again, range({width}) r(i)),
reps AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
f AS (SELECT s.doc_id, lang, source, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
  CAST(length(txt) - length(translate(txt, '{quality.SYMBOLS}', '')) AS BIGINT) AS n_symbols, len(ls) AS n_lines,
  CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
  FROM s LEFT JOIN reps ON s.doc_id = reps.doc_id),
c AS (SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM f),
vals AS ({ratios}),
sketch AS (SELECT lang, source, ratio, (value >> {cut}) << {cut} AS value, count(*) AS n FROM vals GROUP BY ALL),
{level("own", "lang, source")},
{level("of_lang", "lang")},
{level("of_all", "")}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND coalesce({inside}, false) AS kept
FROM c LEFT JOIN own_f o ON c.lang IS NOT DISTINCT FROM o.lang AND c.source IS NOT DISTINCT FROM o.source
LEFT JOIN of_lang_f l ON c.lang IS NOT DISTINCT FROM l.lang LEFT JOIN of_all_f g ON true"""


def collocations_sql(top: int = collocations.TOP, least: int = collocations.MIN_COUNT) -> str:
    """All phrases counted, every cut scored, then the drops and the ranks."""
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    grams = " UNION ALL ".join(
        f"SELECT lang, {m} AS m, ws[i:i + {m - 1}] AS w FROM (SELECT lang, ws, unnest(range(1, len(ws) - {m - 2})) AS i FROM pieces WHERE len(ws) >= {m})" for m in range(1, 5)
    )
    return rf"""WITH d AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({lower}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
pieces AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM d),
total AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM pieces GROUP BY lang),
grams AS ({grams}),
f AS MATERIALIZED (SELECT lang, m, w, count(*) AS a FROM grams GROUP BY lang, m, w),
cand AS MATERIALIZED (SELECT * FROM f WHERE m > 1 AND a >= {least}),
inner_parts AS (SELECT DISTINCT c.lang, c.w[i:i + k - 1] AS w, c.a FROM cand c, range(1, 4) s(i), range(2, 4) t(k) WHERE k < c.m AND i + k - 1 <= c.m),
gone AS (SELECT DISTINCT c.lang, c.w FROM cand c JOIN inner_parts p ON c.lang = p.lang AND c.w = p.w WHERE 100 * p.a >= {collocations.DROP_PERCENT} * c.a),
cuts AS (SELECT c.lang, c.w, c.a, k, x.a AS l, y.a AS r,
  CAST((CAST({collocations.SCALE} AS HUGEINT) * c.a) // (x.a + y.a) AS BIGINT) AS score
  FROM cand c, range(1, 4) t(k), f x, f y
  WHERE k < c.m AND x.lang = c.lang AND x.w = c.w[1:k] AND y.lang = c.lang AND y.w = c.w[k + 1:c.m]),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, w ORDER BY score, k) = 1),
ranked AS (SELECT b.lang, array_to_string(b.w, ' ') AS phrase, a, l, r, score,
  row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, encode(array_to_string(b.w, ' '))) AS rank
  FROM best b ANTI JOIN gone g ON b.lang = g.lang AND b.w = g.w)
SELECT ranked.lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total ON ranked.lang = total.lang WHERE rank <= {top}"""
