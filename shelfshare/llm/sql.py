"""SQL that queries of this package are held against, where SQL can express the whole result."""

_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_NIBBLES = "".join(f"{i:04b}" for i in range(16))
#: Base32 of a hex digest of 40 characters: 160 bits, five to a letter.
_BITS = f"array_to_string(list_transform(range(1, 41), lambda i: substr('{_NIBBLES}', 4 * instr('0123456789abcdef', substr(hex, i, 1)) - 3, 4)), '')"
_LETTER = " + ".join(f"{16 >> k} * CAST(substr(bits, 5 * i + {k + 1}, 1) AS INTEGER)" for k in range(5))

WARC = f"""WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages), h AS (SELECT *, sha1(payload) AS hex, max(page_id) OVER (PARTITION BY payload) AS top FROM p), b AS (SELECT *, {_BITS} AS bits FROM h)
SELECT page_id, CAST(octet_length(encode(payload)) AS BIGINT) AS payload_bytes, array_to_string(list_transform(range(0, 32), lambda i: substr('{_ALPHABET}', 1 + {_LETTER}, 1)), '') AS payload_digest,
  CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> top THEN top END AS refers_to FROM b"""

JACCARD = """WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
s AS (SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN [array_to_string(words, ' ')] ELSE list_distinct(list_transform(range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2])) END AS grams FROM w),
e AS (SELECT doc_id, len(grams) AS n, unnest(grams) AS gram FROM s),
links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
linked AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id, doc_id AS other FROM s UNION SELECT r.doc_id, l.b FROM reach r JOIN linked l ON l.a = r.other)
SELECT doc_id, CAST(len(grams) AS BIGINT) AS n_shingles, low AS component_id FROM s JOIN (SELECT doc_id, min(other) AS low FROM reach GROUP BY doc_id) USING (doc_id)"""


#: CRC-32 by a table of 256 that the query makes itself: eight halvings of each byte.
_CRC_TABLE = "crc_table AS (SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)), lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS t)"


def _crc32(text: str) -> str:
    """SQL for the CRC-32 of a text's UTF-8, where crc_table is joined."""
    digit = lambda at: f"(instr('0123456789ABCDEF', substr(hex(encode({text})), {at}, 1)) - 1)"
    octets = f"list_transform(range(octet_length(encode({text}))), lambda i: CAST(16 * {digit('2 * i + 1')} + {digit('2 * i + 2')} AS BIGINT))"
    return f"xor(list_reduce(list_prepend(4294967295, {octets}), lambda c, o: xor(c >> 8, t[1 + (xor(c, o) & 255)])), 4294967295)"


RUNS = f"""WITH {_CRC_TABLE}, d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words, {_crc32("CAST(doc_id AS VARCHAR)")} AS h FROM documents, crc_table),
g AS (SELECT *, len(words) AS n, h // 10 AS g, CASE WHEN h % 10 = 0 AND len(words) > 0 THEN (h // 10) % len(words) END AS a FROM d),
w AS (SELECT doc_id, CASE WHEN a IS NULL THEN words ELSE list_transform(range(n), lambda i: words[1 + CASE WHEN i >= a THEN a + (i - a) % (1 + (n - a) // (3 + g % 8)) ELSE i END]) END AS words FROM g),
e AS (SELECT doc_id, len(words) AS n, unnest(words) AS word, unnest(range(len(words))) AS i FROM w),
same AS (SELECT x.doc_id, x.i - y.i AS lag, x.i FROM e x JOIN e y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i < x.i AND 4 * (x.i - y.i) <= x.n),
stretches AS (SELECT doc_id, lag, min(i) - lag AS start, max(i) + 1 AS stop FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, lag ORDER BY i) AS island FROM same) GROUP BY doc_id, lag, island),
runs AS (SELECT doc_id, start, stop - start AS length, min(lag) AS period FROM stretches WHERE stop - start >= greatest(6, 4 * lag) GROUP BY doc_id, start, stop),
ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY length / period DESC, start, period) AS place FROM runs),
listed AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines FROM runs GROUP BY doc_id),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM e WHERE NOT EXISTS (SELECT 1 FROM runs r WHERE r.doc_id = e.doc_id AND e.i >= r.start + r.period AND e.i < r.start + r.length) GROUP BY doc_id)
SELECT w.doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, CAST(1000 * length // period AS BIGINT) AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM w LEFT JOIN listed USING (doc_id) LEFT JOIN kept USING (doc_id) LEFT JOIN (SELECT * FROM ranked WHERE place = 1) best USING (doc_id)"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SPELLING = f"""WITH RECURSIVE {_CRC_TABLE}, found AS (SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents),
counted AS (SELECT doc_id, run, count(*) AS n FROM found WHERE length(run) >= 6 GROUP BY ALL), hashed AS (SELECT *, {_crc32("doc_id || ':' || run")} AS h FROM counted, crc_table),
harmed AS (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed),
v AS (SELECT word, CAST(sum(n) AS BIGINT) AS n, length(word) AS size FROM harmed WHERE length(word) >= 6 GROUP BY ALL HAVING sum(n) >= 5),
cut AS (SELECT word, n, size, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM (SELECT *, unnest(range(size)) AS i FROM v)),
near AS (SELECT a.word, b.word AS other, b.n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word UNION SELECT c.word, v.word, v.n FROM cut c JOIN v ON c.rest = v.word UNION SELECT v.word, c.word, c.n FROM cut c JOIN v ON c.rest = v.word),
best AS (SELECT word, other, n AS other_n, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY n DESC, other) AS place FROM near),
forms AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 5 * v.n THEN other END AS form, CASE WHEN other_n >= 5 * v.n THEN other_n END AS form_n FROM v LEFT JOIN best b ON b.word = v.word AND place = 1),
walk AS (SELECT word, word AS here, 0 AS step FROM forms UNION ALL SELECT w.word, f.form, step + 1 FROM walk w JOIN forms f ON f.word = w.here WHERE f.form IS NOT NULL),
ends AS (SELECT word, arg_max(here, step) AS root FROM walk GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN ends USING (word)"""

ORACLE_SQL = {"op5_warc": WARC, "op6_ngram_jaccard": JACCARD, "op11_periodic_runs": RUNS, "op12_spelling_variants": SPELLING}
