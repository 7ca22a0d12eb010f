"""SQL for the corpus operators, where SQL can express them."""

from __future__ import annotations

from tidewarden.llm.tokens import STEP, UNSPACED
from tidewarden.llm.winnowing import Winnower

OP9 = """
WITH sized AS (
  SELECT doc_id, source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         md5(concat_ws(':', '17', CAST(doc_id AS VARCHAR))) AS shuffled
  FROM documents),
sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighted AS (
  SELECT *, [5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)] AS weight,
         2 * source_size AS most FROM sources),
levels AS (
  SELECT *, ((SELECT sum(source_size) FROM sources) * CAST(1.5 AS DOUBLE)
             - coalesce(sum(most) OVER before, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level,
         most / weight AS ratio
  FROM weighted WINDOW before AS (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size,
         least(CAST(most AS DOUBLE), weight * (SELECT level FROM levels WHERE ratio >= level ORDER BY ratio, source NULLS LAST LIMIT 1)) AS target
  FROM levels),
timed AS (
  SELECT s.*, t.source_size, t.target,
         sum(size) OVER (PARTITION BY s.source ORDER BY shuffled, doc_id, size ROWS UNBOUNDED PRECEDING) AS served
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
entries AS (
  SELECT *, (served + epoch * source_size) / target AS finish
  FROM timed, (VALUES (0), (1)) e(epoch) WHERE size > 0 AND target > 0),
ordered AS (
  SELECT *, sum(size) OVER (ORDER BY finish, source NULLS LAST, shuffled, doc_id, size ROWS UNBOUNDED PRECEDING) AS upto FROM entries),
taken AS (
  SELECT doc_id, CAST(sum(size) AS BIGINT) AS taken FROM ordered
  WHERE upto <= (SELECT sum(source_size) * CAST(1.5 AS DOUBLE) FROM sources) GROUP BY doc_id)
SELECT t.doc_id, t.size, t.source_size, t.target, coalesce(k.taken, 0) AS taken
FROM timed t LEFT JOIN taken k USING (doc_id)
"""

OP1 = """
WITH ints AS (
  SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum([p[1] * p[2] FOR p IN list_zip(q.v, c.v)]) AS BIGINT) AS score
  FROM ints q JOIN ints c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM scored)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""

OP5 = """
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(
    regexp_replace(lower(coalesce(text, '')), '([UNSPACED])', ' \\1 ', 'g'), '[\\p{L}\\p{N}\\p{M}]+') AS words
  FROM documents),
texts AS (
  SELECT min(doc_id) AS text_id, count(*) AS n_copies, any_value(words) AS words, list(doc_id) AS ids
  FROM split GROUP BY CASE WHEN len(words) = 0 THEN [CAST(doc_id AS VARCHAR), ''] ELSE words END),
shingles AS (
  SELECT DISTINCT text_id, unnest(
    CASE WHEN len(words) >= 5 THEN [array_to_string(words[i:i + 4], ' ') FOR i IN range(1, len(words) - 3)]
         ELSE [array_to_string(words, ' ')] END) AS s
  FROM texts WHERE len(words) > 0),
sizes AS (SELECT text_id, count(*) AS n FROM shingles GROUP BY 1),
common AS (
  SELECT a.text_id AS a, b.text_id AS b, count(*) AS n
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.text_id < b.text_id GROUP BY 1, 2),
pairs AS (
  SELECT a, b FROM common c JOIN sizes x ON c.a = x.text_id JOIN sizes y ON c.b = y.text_id
  WHERE c.n >= 0.8 * (x.n + y.n - c.n)),
links AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least_reached AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
counted AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT unnest(t.ids) AS doc_id, least(t.text_id, coalesce(r.b, t.text_id)) AS class_id, t.text_id,
       coalesce(c.n, 0) AS n_links, t.n_copies
FROM texts t LEFT JOIN least_reached r ON t.text_id = r.a LEFT JOIN counted c ON t.text_id = c.a
""".replace("UNSPACED", "".join(f"\\x{{{low:X}}}-\\x{{{high:X}}}" for low, high in UNSPACED))

OP8 = """
WITH rows AS (SELECT *, row_number() OVER () AS rid FROM documents),
split AS (SELECT rid, doc_id, source, generate_subscripts(string_split(text, chr(10)), 1) AS place,
                 unnest(string_split(text, chr(10))) AS line FROM rows WHERE text IS NOT NULL),
trimmed AS (SELECT *, trim(line, ' ' || chr(9) || chr(13) || chr(11) || chr(12)) AS bare FROM split),
spread AS (
  SELECT bare, min(doc_id) AS first FROM trimmed WHERE bare <> '' GROUP BY bare
  HAVING count(DISTINCT coalesce(source, chr(0))) >= 10),
marked AS (
  SELECT t.rid, t.place, t.line, s.bare IS NOT NULL AND t.doc_id <> s.first AS gone
  FROM trimmed t LEFT JOIN spread s ON t.bare = s.bare),
joined AS (
  SELECT rid, bool_or(gone) AS changed, coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '') AS text
  FROM marked GROUP BY rid)
SELECT r.doc_id, CASE WHEN j.changed THEN j.text ELSE r.text END AS text, r.lang, r.source,
       CASE WHEN j.changed THEN length(j.text) ELSE r.n_chars END AS n_chars
FROM rows r LEFT JOIN joined j USING (rid)
"""


def _op11(rule: Winnower) -> str:
    """Winnowing with the k and window of the rule; sums of 128 bits stand for those modulo 2 ** 64."""
    places = range(rule.k)
    weights = [pow(int(STEP), j, 1 << 64) for j in places]
    gram = " + ".join(f"coalesce((lead(point, {j}) OVER w + 1)::UHUGEINT * {weights[j]}::UHUGEINT, 0)" for j in places)
    return f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text, CAST(length(coalesce(text, '')) AS BIGINT) AS n_chars FROM documents),
followed AS (
  SELECT *, coalesce(lead(text) OVER (ORDER BY doc_id DESC), first_value(text) OVER (ORDER BY doc_id DESC)) AS after FROM docs),
changed AS (SELECT *, substr(text, 1, n_chars - n_chars // 3) || substr(after, 1, n_chars // 3) AS edited FROM followed),
texts AS (
  SELECT t, row_number() OVER () AS id, length(t) AS n
  FROM (SELECT text AS t FROM changed UNION SELECT edited FROM changed)),
points AS (
  SELECT id, n, generate_subscripts(c, 1) - 1 AS i, unnest(c) AS point
  FROM (SELECT id, n, [unicode(x) FOR x IN regexp_extract_all(t, '(?s).')] AS c FROM texts)),
grams AS (
  SELECT id, n, i, CAST(({gram}) % 18446744073709551616::UHUGEINT AS UBIGINT) AS hash
  FROM points WINDOW w AS (PARTITION BY id ORDER BY i)),
valid AS (SELECT id, i, hash, greatest(n - {rule.k}, 0) AS last FROM grams WHERE i <= greatest(n - {rule.k}, 0)),
least_of AS (
  SELECT id, i, last, min((hash::UHUGEINT * 4294967296::UHUGEINT) + (4294967295 - i)::UHUGEINT) OVER
    (PARTITION BY id ORDER BY i ROWS BETWEEN CURRENT ROW AND {rule.window - 1} FOLLOWING) AS x FROM valid),
kept AS (
  SELECT DISTINCT id, CAST(x // 4294967296::UHUGEINT AS UBIGINT) AS hash, CAST(4294967295::UHUGEINT - x % 4294967296::UHUGEINT AS BIGINT) AS place
  FROM least_of WHERE i <= greatest(last - {rule.window - 1}, 0)),
numbered AS (SELECT *, hash::UHUGEINT + 18446744073709551616::UHUGEINT * CAST(row_number() OVER (PARTITION BY id, hash ORDER BY place) AS UHUGEINT) AS nth FROM kept),
prints AS (
  SELECT t, coalesce(string_agg(lower(lpad(to_hex(hash), 16, '0')) || ':' || place, ',' ORDER BY place), '') AS said,
         coalesce(list(nth) FILTER (nth IS NOT NULL), []) AS hashes
  FROM texts LEFT JOIN numbered USING (id) GROUP BY t),
near AS (
  SELECT c.doc_id, c.n_chars, sha256(c.edited) AS edited_sha256, o.said AS fingerprint, e.said AS edited_fingerprint,
         o.hashes AS h, len(list_intersect(o.hashes, e.hashes)) AS be, len(e.hashes) AS ne,
         len(list_intersect(o.hashes, f.hashes)) AS bf, len(f.hashes) AS nf
  FROM changed c JOIN prints o ON c.text = o.t JOIN prints e ON c.edited = e.t JOIN prints f ON c.after = f.t)
SELECT doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
       CASE WHEN len(h) + ne = 0 THEN 1.0::DOUBLE ELSE be::DOUBLE / (len(h) + ne - be) END AS near_edited,
       CASE WHEN len(h) + nf = 0 THEN 1.0::DOUBLE ELSE bf::DOUBLE / (len(h) + nf - bf) END AS near_next
FROM near
"""


OP13 = """
WITH docs AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
occurring AS (
  SELECT rid, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (
  SELECT lang, term, CAST(count(*) AS BIGINT) AS n FROM occurring GROUP BY ALL HAVING count(DISTINCT rid) >= 3),
langs AS (SELECT lang, CAST(count(*) AS HUGEINT) AS v, sum(n) AS total FROM kept GROUP BY lang),
counts AS (SELECT lang, source, term, count(*) AS n FROM occurring SEMI JOIN kept USING (lang, term) GROUP BY ALL),
groups AS (SELECT DISTINCT lang, source FROM docs),
sizes AS (
  SELECT g.lang, g.source, coalesce(sum(c.n), 0) AS total FROM groups g LEFT JOIN counts c USING (lang, source) GROUP BY ALL),
shares AS (
  SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n,
         1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 1) // (s.total + l.v) AS p,
         1 + 1000000000::HUGEINT * (k.n + 1) // (l.total + l.v) AS q
  FROM sizes s JOIN kept k USING (lang) JOIN langs l USING (lang) LEFT JOIN counts c USING (lang, source, term)),
summed AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT g.lang, g.source, o.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
  FROM groups g JOIN groups o ON g.lang = o.lang AND g.source <> o.source
  LEFT JOIN summed s ON s.lang = g.lang AND s.source = g.source AND s.item = o.source),
valued AS (
  SELECT 'pair' AS part, lang, source, item, value FROM pairs UNION ALL
  SELECT 'term', lang, source, term, CAST((p - q) * (p - q) // q AS BIGINT) FROM shares WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INT) AS rank FROM valued)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""

SQL = {
    "op1_topk": OP1,
    "op5_jaccard": OP5,
    "op8_line_dedup": OP8,
    "op9_mixing": OP9,
    "op11_winnowing": _op11(Winnower()),
    "op13_divergence": OP13,
}
