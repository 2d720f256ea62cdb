"""DuckDB SQL of the operators that SQL can express, written apart from the Spark code."""

from .license_texts import PHRASES as _LICENSE_PHRASES
from .license_texts import TEXTS as _LICENSE_TEXTS

CHAT = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
s AS (
  SELECT *, len(regexp_extract_all(text, '<\\*/?s>|\[\\*/?(INST|ROLE)\]')) AS marks,
    regexp_matches(text, '</?s>|\[/?(INST|ROLE)\]|<\\+/?s>|\[\\+/?(INST|ROLE)\]') AS escaped
  FROM t)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
  CAST(sum(length(text) + CASE WHEN escaped THEN marks ELSE 0 END
    + CASE role WHEN 'user' THEN 22 WHEN 'assistant' THEN 7 ELSE 23 + length(role) END) AS BIGINT) AS formatted_chars,
  true AS identical
FROM s GROUP BY conv_id
"""

MIX = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
    md5('0:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS k
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0 ELSE 1.0 END AS weight
  FROM s),
l AS (
  SELECT *, (sum(source_size::DOUBLE) OVER () - coalesce(sum(3.0::DOUBLE * source_size) OVER o, 0))
    / (sum(weight) OVER () - coalesce(sum(weight) OVER o, 0)) AS level
  FROM w WINDOW o AS (ORDER BY 3.0::DOUBLE * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
g AS (SELECT source, source_size, least(3.0::DOUBLE * source_size, weight * max(level) OVER ()) AS target FROM l),
b AS (SELECT *, CAST(round(target) AS BIGINT) AS budget FROM g),
p AS (
  SELECT d.doc_id, d.size, b.source_size, b.target, b.budget,
    CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs,
    coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target,
  CAST(epochs * size + greatest(0, least(size, budget - epochs * source_size - before)) AS BIGINT) AS taken
FROM p
"""

QUALITY = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
tri AS (
  SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS t
  FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, t) AS n FROM tri) WHERE n > 1),
rep AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS j FROM twice) GROUP BY r),
c AS (
  SELECT d.r, doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words,
    CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(len(lines) AS BIGINT) AS n_lines,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN rep ON d.r = rep.r),
f AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    CASE WHEN word_chars > 0 THEN n_symbols / word_chars ELSE 0.0 END AS v1,
    CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0.0 END AS v2,
    CASE WHEN n_words > 0 THEN n_repeat_words / n_words ELSE 0.0 END AS v3,
    CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0.0 END AS v4
  FROM c),
v AS (
  SELECT lang, source, unnest([1, 2, 3, 4]) AS name, unnest([v1, v2, v3, v4]) AS value FROM f WHERE NOT base_failed),
k AS (
  SELECT lang, source, name, CASE WHEN value > 0 THEN CAST(ceil(ln(value) / ln(1.02)) AS INTEGER) END AS bucket, count(*) AS n
  FROM v GROUP BY ALL),
g AS (
  SELECT 0 AS lvl, lang, source, name, bucket, n FROM k
  UNION ALL SELECT 1, lang, NULL, name, bucket, sum(n) FROM k GROUP BY lang, name, bucket
  UNION ALL SELECT 2, NULL, NULL, name, bucket, sum(n) FROM k GROUP BY name, bucket),
o AS (
  SELECT *, sum(n) OVER (PARTITION BY lvl, lang, source, name ORDER BY bucket NULLS FIRST) AS upto,
    sum(n) OVER (PARTITION BY lvl, lang, source, name) AS total, CASE WHEN bucket IS NULL THEN 0.0 ELSE pow(1.02, bucket) END AS edge
  FROM g),
q AS (
  SELECT lvl, lang, source, name, max(total) AS total, min(edge) FILTER (WHERE 4 * upto >= total) AS q1, min(edge) FILTER (WHERE 2 * upto >= total) AS q2,
    min(edge) FILTER (WHERE 4 * upto >= 3 * total) AS q3, min(edge) FILTER (WHERE 100 * upto >= 99 * total) AS tail
  FROM o GROUP BY ALL),
dev AS (
  SELECT o.name, round(sum(o.n * abs(edge - q2)) / sum(o.n), 9) AS least
  FROM o JOIN q ON q.lvl = 0 AND o.name = q.name AND o.lang IS NOT DISTINCT FROM q.lang AND o.source IS NOT DISTINCT FROM q.source
  WHERE o.lvl = 0 GROUP BY o.name),
y AS (
  SELECT a.lang, a.source, a.name, dev.least, e.tail,
    CASE WHEN a.total >= 50 THEN a.q1 WHEN b.total >= 50 THEN b.q1 WHEN e.total >= 50 THEN e.q1 END AS low,
    CASE WHEN a.total >= 50 THEN a.q3 WHEN b.total >= 50 THEN b.q3 WHEN e.total >= 50 THEN e.q3 END AS high
  FROM q a JOIN q b ON b.lvl = 1 AND a.name = b.name AND a.lang IS NOT DISTINCT FROM b.lang JOIN q e ON e.lvl = 2 AND e.name = a.name
    JOIN dev ON dev.name = a.name
  WHERE a.lvl = 0),
z AS (
  SELECT lang, source, name, CASE WHEN high IS NULL THEN NULL WHEN name IN (2, 3) THEN greatest(high + 3 * greatest(high - low, least), tail)
    ELSE high + 3 * greatest(high - low, least) END AS most
  FROM y),
m AS (
  SELECT lang, source, max(most) FILTER (WHERE name = 1) AS m1, max(most) FILTER (WHERE name = 2) AS m2,
    max(most) FILTER (WHERE name = 3) AS m3, max(most) FILTER (WHERE name = 4) AS m4
  FROM z GROUP BY lang, source)
SELECT f.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND coalesce(v1 <= m1, true) AND coalesce(v2 - 3 * sqrt(v2 / greatest(n_lines, 1)) <= m2, true)
    AND coalesce(v3 - 3 * sqrt(v3 * 6 / greatest(n_words, 1)) <= m3, true) AND coalesce(v4 - 3 * sqrt(v4 / greatest(n_words, 1)) <= m4, true) AS kept
FROM f LEFT JOIN m ON f.lang IS NOT DISTINCT FROM m.lang AND f.source IS NOT DISTINCT FROM m.source
"""

PHRASES = r"""
WITH p AS (
  SELECT lang, piece, row_number() OVER () AS id FROM (
    SELECT coalesce(lang, 'und') AS lang,
      unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents)),
w AS (SELECT id, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
g AS (
  SELECT lang, 1 AS k, unnest(w) AS phrase FROM w
  UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM w
  UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM w),
f AS (SELECT lang, k, phrase, CAST(count(*) AS HUGEINT) AS f FROM g GROUP BY ALL),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS s FROM f WHERE k > 1 AND f >= 10),
cut AS (
  SELECT lang, phrase, a, 1 AS cut_at, s[1] AS x, array_to_string(s[2:], ' ') AS y FROM c
  UNION ALL SELECT lang, phrase, a, 2, s[1] || ' ' || s[2], s[3] FROM c WHERE k = 3),
sc AS (
  SELECT cut.lang, cut.phrase, a, x.f AS l, y.f AS r, cut_at, 1000000 * a * a // (x.f * y.f) AS score
  FROM cut JOIN f x ON cut.lang = x.lang AND cut.x = x.phrase JOIN f y ON cut.lang = y.lang AND cut.y = y.phrase),
low AS (SELECT * FROM sc QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut_at) = 1),
longer AS (
  SELECT lang, part, max(a) AS most FROM (
    SELECT lang, a, unnest([s[1] || ' ' || s[2], s[2] || ' ' || s[3]]) AS part FROM c WHERE k = 3) GROUP BY ALL),
kept AS (
  SELECT low.* FROM low LEFT JOIN longer ON low.lang = longer.lang AND low.phrase = longer.part
  WHERE longer.most IS NULL OR 100 * longer.most < 50 * low.a),
t AS (SELECT lang, count(*) AS n FROM g WHERE k = 1 GROUP BY lang)
SELECT kept.lang, row_number() OVER (PARTITION BY kept.lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase,
  CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, t.n, CAST(score AS BIGINT) AS score
FROM kept JOIN t ON kept.lang = t.lang QUALIFY rank <= 2000
"""

_LICENSE_ROWS = ", ".join(f"({i}, '{label}', {str(i < len(_LICENSE_PHRASES)).lower()}, $t${text}$t$)"
                          for i, (label, text) in enumerate([*_LICENSE_PHRASES, *_LICENSE_TEXTS]))

LICENSES = r"""
WITH t(t, label, base, text) AS (VALUES """ + _LICENSE_ROWS + r"""),
tw AS (SELECT t, label, base, regexp_extract_all(lower(text), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM t),
tk AS (
  SELECT t, label, base, w, len(w) AS size, least(3, len(w)) AS k, len(w) // 8 AS shift,
    greatest(1, (len(w) - least(3, len(w)) + 1) // 32) AS need
  FROM tw),
tg AS (
  SELECT t, k, tpos, array_to_string(w[tpos + 1:tpos + k], ' ') AS gram
  FROM (SELECT *, unnest(range(0, size - k + 1)) AS tpos FROM tk)),
d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
dg AS (
  SELECT r, k, dpos, array_to_string(w[dpos + 1:dpos + k], ' ') AS gram
  FROM (SELECT d.r, d.w, s.k, unnest(range(0, len(d.w) - s.k + 1)) AS dpos FROM d, (SELECT DISTINCT k FROM tk) s)),
h AS (SELECT r, t, tpos, dpos, dpos - tpos AS diagonal FROM dg JOIN tg ON dg.k = tg.k AND dg.gram = tg.gram),
v AS (SELECT r, t, diagonal, list(DISTINCT tpos) AS tposs, min(dpos) AS lo, max(dpos) AS hi FROM h GROUP BY ALL),
m AS (
  SELECT v.*, tk.k, tk.size, coalesce(diagonal - lag(diagonal) OVER (PARTITION BY r, v.t ORDER BY diagonal) > shift, true) AS far
  FROM v JOIN tk ON v.t = tk.t WHERE len(tposs) >= need),
c AS (SELECT *, sum(far::INT) OVER (PARTITION BY r, t ORDER BY diagonal) AS merged FROM m),
x AS (
  SELECT r, t, merged, -1 AS part, any_value(k) AS k, any_value(size) AS size, flatten(list(tposs)) AS tposs, min(lo) AS lo, max(hi) AS hi
  FROM c GROUP BY r, t, merged
  UNION ALL SELECT r, t, merged, row_number() OVER (), k, size, tposs, lo, hi FROM c),
y AS (
  SELECT *, len(list_distinct(flatten(list_transform(tposs, lambda p: range(p, p + k))))) AS n FROM x),
z AS (SELECT *, n >= 0.8 * size AND n >= 0.5 * (hi + k - lo) AS fine FROM y),
s AS (
  SELECT z.r, z.t, z.lo, z.n / z.size AS coverage
  FROM z LEFT JOIN (SELECT r, t, merged FROM z WHERE part = -1 AND fine) b ON z.r = b.r AND z.t = b.t AND z.merged = b.merged
  WHERE fine AND (part = -1 OR b.r IS NULL)),
o AS (
  SELECT r, count(*) FILTER (WHERE base) AS n_base, min(lo) FILTER (WHERE base) AS first_word, max(lo) FILTER (WHERE base) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels,
    max(coverage) AS score
  FROM s JOIN tk ON s.t = tk.t GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM d LEFT JOIN o ON d.r = o.r
"""
