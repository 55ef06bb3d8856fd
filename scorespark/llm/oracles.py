"""DuckDB SQL for the queries that SQL can express, written another way than the operators."""

from __future__ import annotations

from scorespark.llm.licences import CUE, THRESHOLD, TEMPLATES, TOKEN

ORACLES: dict[str, str] = {}

# Spans of repeated runs of L words or more are the words of repeated L-word windows,
# and a run longer than M occurs twice exactly if a window of M + 1 words does.
ORACLES["op1_suffix_repetition"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         row_number() OVER () AS r
  FROM documents
), p AS (
  SELECT r, w, unnest(generate_series(1, len(w))) AS i FROM d
), g AS (
  SELECT r, i, k, count(*) OVER (PARTITION BY r, k, w[i : i + k - 1]) > 1 AS again
  FROM p, (VALUES (3), (10), (31)) AS sizes(k)
  WHERE i + k - 1 <= len(w)
), c AS (
  SELECT r, k, count(DISTINCT i + j) AS n
  FROM (SELECT r, k, i, unnest(generate_series(0, k - 1)) AS j FROM g WHERE again)
  GROUP BY r, k
), l AS (
  SELECT r, sum(n - 1) AS n_dup_lines
  FROM (SELECT r, line, count(*) AS n
        FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d)
        WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r, line)
  GROUP BY r
), f AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         coalesce(l.n_dup_lines, 0)::BIGINT AS n_dup_lines,
         coalesce(c3.n, 0)::BIGINT AS n_repeat_words,
         coalesce(c10.n, 0)::BIGINT AS n_covered_words,
         c31.n IS NOT NULL AS long_repeat
  FROM d LEFT JOIN l USING (r)
  LEFT JOIN c c3 ON c3.r = d.r AND c3.k = 3
  LEFT JOIN c c10 ON c10.r = d.r AND c10.k = 10
  LEFT JOIN c c31 ON c31.r = d.r AND c31.k = 31
), b AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_covered_words, base_failed,
       NOT base_failed AND n_covered_words <= 0.2 * n_words AND NOT long_repeat AS kept
FROM b
"""

# The tilt of a source by halving a bracket; the capped sources are the first ones by size per weight,
# up to where the rest fits.
ORACLES["op7_entropy_mix"] = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '') || '|' || coalesce(text, '')) AS h FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY encode(source) NULLS LAST)) - 1) % 3 + 1]::DOUBLE AS weight FROM s
), o AS (
  SELECT *, row_number() OVER (ORDER BY source_size / weight, source) AS k FROM w
), c AS (
  SELECT k, 3.0::DOUBLE * source_size / weight AS own,
         ((SELECT sum(source_size) FROM s)
           - coalesce(sum(3.0::DOUBLE * source_size) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM o
), v AS (
  SELECT level FROM c WHERE own >= level ORDER BY k LIMIT 1
), t AS (
  SELECT source, source_size, least(3.0::DOUBLE * source_size, weight * (SELECT level FROM v)) AS target FROM w
), n AS (
  SELECT source, size, count(*) AS n FROM d GROUP BY source, size
), l AS (
  SELECT source, sum(size * n)::DOUBLE / sum(n) AS unit, min(size) AS least, list({'x': size::DOUBLE, 'n': n::DOUBLE}) AS docs FROM n WHERE size > 0 GROUP BY source
), b AS (
  SELECT t.*, unit, list_reduce(list_transform(range(200), lambda k: [0.0::DOUBLE, 0.0::DOUBLE]),
      lambda s, k: CASE WHEN list_sum(list_transform(docs, lambda y: y.n * y.x * exp(least(ln(3.0::DOUBLE), (s[1] + s[2]) / 2 * y.x / unit)))) < target
        THEN [(s[1] + s[2]) / 2, s[2]] ELSE [s[1], (s[1] + s[2]) / 2] END, [-50.0::DOUBLE * unit / least, ln(3.0::DOUBLE) * unit / least]) AS bracket
  FROM t LEFT JOIN l ON t.source IS NOT DISTINCT FROM l.source
), r AS (
  SELECT n.source, n.size, n.n, source_size, target,
         CASE WHEN size = 0 OR unit IS NULL THEN 1000000 ELSE round(1000000 * exp(least(ln(3.0::DOUBLE), bracket[2] * size / unit))) END::BIGINT AS rate
  FROM n JOIN b ON n.source IS NOT DISTINCT FROM b.source
), f AS (
  SELECT *, rate % 1000000 AS part, 500000 + coalesce(sum((rate % 1000000) * n) OVER (PARTITION BY source ORDER BY size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM r
), p AS (
  SELECT doc_id, d.size, source_size, target, rate, part, start, row_number() OVER (PARTITION BY d.source, d.size ORDER BY h) AS rank
  FROM d JOIN f ON d.size = f.size AND d.source IS NOT DISTINCT FROM f.source
), q AS (
  SELECT *, (rate // 1000000 + (start + rank * part) // 1000000 - (start + (rank - 1) * part) // 1000000)::INTEGER AS copies FROM p
)
SELECT doc_id, size, source_size, target, copies, copies * size AS taken FROM q
"""

# Any window within the allowed substitutions holds four words in a row unchanged, or all of a shorter item,
# so runs of that many equal words name every alignment that can qualify.
_WORDS = r"""list_filter(list_transform(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'),
      lambda x: regexp_replace(translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                          '^[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]+|[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]+$', '', 'g')),
      lambda x: x <> '')"""
ORACLES["op2_spaced_seeds"] = f"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r, {_WORDS} AS w FROM documents
), b AS (
  SELECT *, least(20, len(v)) AS size,
         CASE WHEN len(v) >= 18 THEN 3 WHEN len(v) >= 15 THEN 2 WHEN len(v) >= 10 THEN 1 ELSE 0 END AS allowed
  FROM (SELECT item_id, row_number() OVER () AS t, {_WORDS} AS v FROM benchmark) WHERE len(v) >= 1
), k AS (
  SELECT DISTINCT least(4, len(v)) AS run FROM b
), dg AS (
  SELECT r, i, run, w[i : i + run - 1] AS g FROM (SELECT r, w, run, unnest(generate_series(1, len(w) - run + 1)) AS i FROM d, k)
), bg AS (
  SELECT t, j, run, v[j : j + run - 1] AS g FROM (SELECT t, v, least(4, len(v)) AS run, unnest(generate_series(1, len(v) - least(4, len(v)) + 1)) AS j FROM b)
), a AS (
  SELECT DISTINCT r, t, i - j AS shift FROM dg JOIN bg USING (run, g)
), x AS (
  SELECT doc_id, item_id, w, v, size, allowed, shift,
         unnest(generate_series(greatest(1, 1 - shift), least(len(v), len(w) - shift) - size + 1)) AS k
  FROM a JOIN d USING (r) JOIN b USING (t)
), y AS (
  SELECT doc_id, item_id, len(v) AS n, k, size, allowed,
         len(list_filter(range(size), lambda o: v[k + o] <> w[k + o + shift])) AS wrong
  FROM x
), z AS (
  SELECT doc_id, item_id, n, wrong, unnest(generate_series(k, k + size - 1)) AS place FROM y WHERE wrong <= allowed
)
SELECT doc_id, item_id, max(n)::BIGINT AS item_words, count(DISTINCT place)::BIGINT AS covered_words, min(wrong)::BIGINT AS substitutions
FROM z GROUP BY doc_id, item_id
"""

ORACLES["op6_zip_packages"] = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, upper(sha1(coalesce(html, ''))) AS h,
         min(page_id) OVER (PARTITION BY sha1(coalesce(html, ''))) AS first
  FROM pages
), q AS (
  SELECT *, first IS NOT NULL AND coalesce(page_id > first, TRUE) AS again,
         array_to_string(list_transform(range(32), lambda k:
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[((('0x' || h[(k // 4) * 5 + 1 : (k // 4) * 5 + 5])::BIGINT >> (15 - 5 * (k % 4))) & 31) + 1]), '') AS payload_digest
  FROM p
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN first END AS refers_to
FROM q
"""

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TEMPLATES = ",\n".join("({}, '{}', '{}')".format(k, name, text.replace("'", "''")) for k, (name, text) in enumerate(TEMPLATES))
ORACLES["op4_licence_scan"] = rf"""
WITH t(k, licence, text) AS (VALUES {_TEMPLATES}),
tc AS (
  SELECT k, licence, token, count(*) AS n
  FROM (SELECT k, licence, unnest(regexp_extract_all({_LOWER.format('text')}, '{TOKEN}')) AS token FROM t) GROUP BY ALL
), idf AS (
  SELECT token, ln((1 + (SELECT count(*) FROM t))::DOUBLE / (1 + count(*))) + 1 AS idf FROM tc GROUP BY token
), tw AS (
  SELECT k, licence, token, (1 + ln(n)) * idf AS w FROM tc JOIN idf USING (token)
), tn AS (
  SELECT k, sqrt(sum(w * w)) AS length FROM tw GROUP BY k
), d AS (
  SELECT doc_id, row_number() OVER () AS r, source || '/' || lang AS folder, strlen(text) <= 400 AS notice, text
  FROM documents
), p AS (
  SELECT r, text = passage AS is_whole, passage
  FROM (SELECT r, text, unnest(list_concat([text], string_split_regex(text, '\n[ \t\r]*\n'), string_split(text, chr(10)))) AS passage FROM d)
  WHERE regexp_matches(passage, '{CUE}')
), u AS (
  SELECT DISTINCT passage FROM p
), uc AS (
  SELECT passage, token, count(*) AS n
  FROM (SELECT passage, unnest(regexp_extract_all({_LOWER.format('passage')}, '{TOKEN}')) AS token FROM u) GROUP BY ALL
), uw AS (
  SELECT passage, token, (1 + ln(n)) * coalesce(idf, ln(1 + (SELECT count(*) FROM t)) + 1) AS w FROM uc LEFT JOIN idf USING (token)
), un AS (
  SELECT passage, sqrt(sum(w * w)) AS length FROM uw GROUP BY passage
), c AS (
  SELECT passage, licence, round(sum(uw.w * tw.w) / any_value(un.length) / any_value(tn.length), 6) AS cosine
  FROM uw JOIN tw USING (token) JOIN un USING (passage) JOIN tn USING (k) GROUP BY passage, k, licence
), h AS (
  SELECT r, is_whole, licence, cosine FROM p JOIN c USING (passage) WHERE cosine >= {THRESHOLD}
), own AS (
  SELECT r, first(licence ORDER BY cosine DESC, licence) AS licence, max(cosine) AS cosine, bool_or(is_whole) AS whole FROM h GROUP BY r
), f AS (
  SELECT folder AS directory, first(licence ORDER BY cosine DESC, licence) AS inherited, max(cosine) AS inherited_cosine
  FROM own JOIN d USING (r) WHERE notice OR whole GROUP BY folder
), n AS (
  SELECT folder, first(directory ORDER BY strlen(directory) DESC) AS directory, first(inherited ORDER BY strlen(directory) DESC) AS inherited,
         first(inherited_cosine ORDER BY strlen(directory) DESC) AS inherited_cosine
  FROM (SELECT DISTINCT folder FROM d) JOIN f ON folder = directory OR starts_with(folder, directory || '/') OR directory = ''
  GROUP BY folder
)
SELECT doc_id, coalesce(licence, inherited) AS licence, CASE WHEN licence IS NOT NULL THEN cosine ELSE inherited_cosine END AS cosine,
       CASE WHEN licence IS NOT NULL THEN 'own' WHEN inherited IS NOT NULL THEN 'inherited' ELSE 'none' END AS how,
       CASE WHEN licence IS NULL THEN directory END AS directory
FROM d LEFT JOIN own USING (r) LEFT JOIN n USING (folder)
"""

# DuckDB has no CRC-32: eight steps of the reversed polynomial for each character of a decimal number.
_CRC32 = """xor(list_reduce(list_transform(string_split({}::VARCHAR, ''), lambda c: unicode(c)::BIGINT),
      lambda s, c: list_reduce(list_transform(range(8), lambda k: 0::BIGINT),
        lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(s, c)), 4294967295::BIGINT), 4294967295)"""

# A run repeats at least five words in a row, so five equal words name every lag that can have one;
# consecutive places with the same lag make a run, of which the smallest lag is the period.
ORACLES["op11_scale_tiled_runs"] = rf"""
WITH t AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, {_CRC32.format("doc_id")} AS h
  FROM documents
), u AS (
  SELECT *, len(w)::BIGINT AS n, h // 10 AS g FROM t
), v AS (
  SELECT *, CASE WHEN n > 0 THEN g % n END AS a FROM u
), d AS (
  SELECT r, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
    THEN list_transform(range(n), lambda i: w[CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END + 1]) ELSE w END AS w
  FROM v
), x AS (
  SELECT r, n, i, w[i + 1 : i + 5] AS five FROM (SELECT r, n, w, unnest(range(n - 4)) AS i FROM d)
), m AS (
  SELECT x.r, x.i, y.i - x.i AS q FROM x JOIN x AS y ON x.r = y.r AND x.five = y.five AND y.i > x.i AND 4 * (y.i - x.i) <= x.n
), k AS (
  SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS part FROM m
), l AS (
  SELECT r, q, min(i) AS start, count(*) + 4 + q AS length FROM k GROUP BY r, q, part HAVING length >= greatest(6, 4 * q)
), runs AS (
  SELECT r, start, length, min(q) AS period FROM l GROUP BY r, start, length
), best AS (
  SELECT r, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listed,
         first(struct_pack(start, length, period) ORDER BY length::DOUBLE / period DESC, start, period) AS top
  FROM runs GROUP BY r
), gone AS (
  SELECT DISTINCT r, unnest(range(start + period, start + length)) AS i FROM runs
), kept AS (
  SELECT r, string_agg(word, ' ' ORDER BY i) AS collapsed
  FROM (SELECT r, unnest(w) AS word, unnest(range(n)) AS i FROM d) ANTI JOIN gone USING (r, i) GROUP BY r
)
SELECT doc_id, n AS n_words, coalesce(n_runs, 0)::BIGINT AS n_runs, top.start::BIGINT AS start, top.length::BIGINT AS length,
       top.period::BIGINT AS period, (1000 * top.length // top.period)::BIGINT AS exponent_milli,
       sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM d LEFT JOIN best USING (r) LEFT JOIN kept USING (r)
"""


def _merkle() -> str:
    """Level by level, for groups of up to 2^24 rows and up to 2^8 groups."""

    def leaf(n_chars: str) -> str:
        fields = ("doc_id", "source", "lang", n_chars, "text")
        return "sha256(" + " || ".join(f"coalesce(strlen(({f})::VARCHAR) || ':' || ({f})::VARCHAR, '-')" for f in fields) + ")"

    def level(out: str, below: str) -> str:
        return f"""{out} AS MATERIALIZED (
  SELECT key, i // 2 AS i, CASE WHEN total = 1 THEN any_value(d) ELSE sha256(string_agg(d, '' ORDER BY i)) END AS d, (total + 1) // 2 AS total
  FROM {below} GROUP BY key, i // 2, total
)"""

    def step(out: str, below: str, nodes: str, k: int, key: str, i: str, total: str) -> str:
        return f"""{out} AS MATERIALIZED (
  SELECT f.* REPLACE (proof || coalesce(s.d, '') AS proof,
    CASE WHEN ({total} - 1) >> {k} = 0 THEN x WHEN s.d IS NULL THEN sha256(x) WHEN ({i} >> {k}) & 1 = 1 THEN sha256(s.d || x) ELSE sha256(x || s.d) END AS x)
  FROM {below} f LEFT JOIN {nodes} s ON s.key = {key} AND s.i = xor({i} >> {k}, 1)
)"""

    parts = [
        f"""t AS (
  SELECT doc_id, CASE WHEN lang IS NULL THEN '-' ELSE '=' || lang END AS key, {leaf("n_chars")} AS leaf,
         CASE WHEN {_CRC32.format("doc_id")} % 7 = 0 THEN {leaf("n_chars + 1")} END AS changed
  FROM documents
)""",
        """p AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY key) AS total FROM t
)""",
        "n0 AS MATERIALIZED (SELECT key, i, leaf AS d, total FROM p)",
        *(level(f"n{k + 1}", f"n{k}") for k in range(24)),
        """m0 AS MATERIALIZED (
  SELECT '' AS key, row_number() OVER (ORDER BY key) - 1 AS i, d, count(*) OVER () AS total, key AS own FROM n24
)""",
        *(level(f"m{k + 1}", f"m{k}") for k in range(8)),
        """f0 AS (
  SELECT doc_id, leaf, p.key, p.i, p.total, m0.i AS j, m0.total AS groups, m0.d AS subroot, '' AS proof, coalesce(changed, leaf) AS x
  FROM p JOIN m0 ON own = p.key
)""",
        *(step(f"f{k + 1}", f"f{k}", f"n{k}", k, "f.key", "f.i", "f.total") for k in range(24)),
        *(step(f"f{24 + k + 1}", f"f{24 + k}", f"m{k}", k, "''", "f.j", "groups") for k in range(8)),
    ]
    return (
        "WITH " + ", ".join(parts) + """
SELECT doc_id, leaf, subroot, m8.d AS root, sha256(proof) AS proof_sha256, x AS folded_root, x = m8.d AS verified FROM f32, m8
"""
    )


ORACLES["op13_path_copying_tree"] = _merkle()
