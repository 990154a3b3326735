"""DuckDB SQL of the queries that SQL can state, each in its plainest form."""

from .licence_scan import TEMPLATES
from .pareto_mix import FILLS

#: Pareto order sampling with one window per source and pass over all documents.
PARETO_MIX = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5('1|' || coalesce(doc_id::VARCHAR, '-') || '|' || md5(coalesce(text, ''))) AS drawn
  FROM documents),
src AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS nth FROM d GROUP BY source),
w AS (SELECT source, source_size, 3 * source_size AS cap, [5.0::DOUBLE, 2.0, 1.0][(nth % 3 + 1)::INT] AS weight FROM src),
lev AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0))::DOUBLE
            / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0.0)) AS level
  FROM w WINDOW b AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
fill AS (SELECT arg_min(level, (cap / weight, source IS NULL, source)) AS fill FROM lev WHERE level * weight <= cap),
t AS (SELECT source, source_size, least(cap::DOUBLE, fill * weight) AS target FROM lev, fill),
r AS (SELECT source, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate FROM t),
e AS (SELECT d.*, source_size, target, least(3.0::DOUBLE, rate) AS expected, floor(least(3.0::DOUBLE, rate))::BIGINT AS sure,
             (('0x' || substr(drawn, 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0::DOUBLE AS u
      FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source),
q AS (SELECT *, CASE WHEN expected - sure > 0 THEN (u / (1 - u)) / ((expected - sure) / (1 - (expected - sure))) END AS q FROM e),
x0 AS (SELECT *, target - sum(sure * size) OVER (PARTITION BY source) AS rest, false AS taken FROM q),
""" + "".join(f"""
e{k} AS (SELECT *, q IS NOT NULL AND NOT taken AND {'true' if k == 1 else 'size <= rest'} AS may FROM x{k - 1}),
f{k} AS (SELECT *, may AND sum(CASE WHEN may THEN size ELSE 0 END) OVER (PARTITION BY source ORDER BY q NULLS LAST, drawn) <= rest AS fits FROM e{k}),
x{k} AS (SELECT * EXCLUDE (may, fits, rest, taken), taken OR fits AS taken,
                rest - sum(CASE WHEN fits THEN size ELSE 0 END) OVER (PARTITION BY source) AS rest FROM f{k}),""" for k in range(1, 2 + FILLS)) + rf"""
rest AS (SELECT * FROM x{1 + FILLS}),""" + r"""
g AS (SELECT source, drawn, min(q) AS q, sum(size) AS words, any_value(rest) AS rest FROM rest
      WHERE NOT taken AND q IS NOT NULL GROUP BY source, drawn HAVING sum(size) > 0),
c AS (SELECT source, arg_min(drawn, (abs(words - rest), q, drawn)) AS closing FROM g WHERE abs(words - rest) < rest GROUP BY source)
SELECT doc_id, size, source_size, target,
       ((sure + CASE WHEN taken OR coalesce(drawn = closing, false) THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM rest LEFT JOIN c ON rest.source IS NOT DISTINCT FROM c.source
"""

#: (kind, rank, pattern, group, least length of the group), as the scan's rules state them.
SECRET_RULES = (
    ("assign", 1, r"""((?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", 2, r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", 3, r"[0-9a-f]+", 0, 24),
    ("github", 4, r"gh[opsur]_[A-Za-z0-9]{36,}", 0, 40),
    ("pem", 5, r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 0),
)

SECRETS = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
m AS (""" + " UNION ALL ".join(f"""
  SELECT doc_id, '{kind}' AS kind, {rank} AS rk, {least} AS least, string_split_regex(t, '{pattern}') AS p,
         regexp_extract_all(t, '{pattern}', 0) AS w, regexp_extract_all(t, '{pattern}', {group}) AS v
  FROM d""" for kind, rank, pattern, group, least in SECRET_RULES) + r"""),
e AS (SELECT doc_id, kind, rk, least, unnest(range(len(w))) AS k, p, w, v FROM m),
l AS (SELECT doc_id, kind, rk, least, k, length(p[k + 1]) AS between_, length(w[k + 1]) AS whole, length(v[k + 1]) AS value FROM e),
s AS (SELECT *, sum(between_ + whole) OVER (PARTITION BY doc_id, kind ORDER BY k) AS stop FROM l),
f AS (SELECT doc_id, kind, rk, (stop - whole)::BIGINT AS start, stop::BIGINT AS stop FROM s WHERE value >= least),
g AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
             count(*) FILTER (kind = 'hex') AS n_hex,
             string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rk) FILTER (rk <= 3) AS base,
             string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rk) AS spans
      FROM f GROUP BY doc_id)
SELECT documents.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents LEFT JOIN g USING (doc_id)
"""

#: Every window of every document against every item window, as strings.
DECONTAMINATE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bl AS (SELECT item_id, w, least(10, len(w)) AS n FROM b WHERE len(w) > 0),
bk AS (SELECT item_id, n, w, unnest(range(1, len(w) - n + 2)) AS s FROM bl),
bw AS (SELECT DISTINCT item_id, n, array_to_string(w[s:s + n - 1], ' ') AS win FROM bk),
dk AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, (SELECT DISTINCT n FROM bl) WHERE len(w) >= n),
dw AS (SELECT doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') AS win FROM dk),
h AS (SELECT doc_id, item_id, s, n FROM dw JOIN bw USING (n, win)),
p AS (SELECT doc_id, unnest(range(s, s + n)) AS place FROM h),
c AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM p GROUP BY doc_id),
i AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
      FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM h WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN i USING (doc_id)
"""

LICENCES = r"""
WITH t(k, name, body) AS (VALUES """ + ", ".join(f"({k}, '{name}', '{body}')" for k, (name, body) in enumerate(TEMPLATES)) + r"""),
tt AS (SELECT k, unnest(regexp_extract_all(body, '[a-z0-9]+(?:\.[0-9]+)*')) AS term FROM t),
idf AS (SELECT term, ln((1.0::DOUBLE + (SELECT count(*) FROM t)) / (1 + count(DISTINCT k))) + 1 AS idf FROM tt GROUP BY term),
tw AS (SELECT k, term, count(*) * any_value(idf) AS w FROM tt JOIN idf USING (term) GROUP BY k, term),
tm AS (SELECT k, term, w / sqrt(sum(w * w) OVER (PARTITION BY k)) AS model FROM tw),
d AS (SELECT doc_id, concat_ws('/', coalesce(source, '-'), CASE WHEN doc_id % 3 > 0 THEN (doc_id // 4096)::VARCHAR END,
                               CASE WHEN doc_id % 3 > 1 THEN (doc_id // 256)::VARCHAR END) AS dir,
             concat(CASE WHEN regexp_matches(coalesce(text, ''), '(?i)licen[cs]|copyright|public domain|spdx|all rights reserved')
                         THEN 'LICENSE.' ELSE '' END, doc_id::VARCHAR) AS name, text FROM documents),
p AS (SELECT doc_id, dir, dir || '/' || name AS path, name LIKE 'LICENSE.%' AS is_licence, text FROM d),
seg AS (SELECT doc_id, unnest(string_split_regex(text, '\n|[.;!?]\x20+')) AS s FROM p),
st AS (SELECT DISTINCT doc_id, trim(s, ' ') AS statement FROM seg
       WHERE regexp_matches(s, '(?i)licen[cs]|copyright|public domain|spdx|all rights reserved')),
ds AS (SELECT DISTINCT statement FROM st),
sw0 AS (SELECT statement, unnest(regexp_extract_all(lower(statement), '[a-z0-9]+(?:\.[0-9]+)*')) AS term FROM ds),
sw AS (SELECT statement, term, count(*) * coalesce(any_value(idf), ln(1.0::DOUBLE + (SELECT count(*) FROM t)) + 1) AS w
       FROM sw0 LEFT JOIN idf USING (term) GROUP BY statement, term),
sm AS (SELECT statement, term, w / sqrt(sum(w * w) OVER (PARTITION BY statement)) AS weight FROM sw),
sc AS (SELECT statement, k, round(sum(weight * model), 6) AS score FROM sm JOIN tm USING (term) GROUP BY statement, k),
bs AS (SELECT statement, max((score, name)) AS b FROM sc JOIN t USING (k) GROUP BY statement HAVING max(score) >= 0.8),
own AS (SELECT doc_id, max(b) AS own FROM st JOIN bs USING (statement) GROUP BY doc_id),
od AS (SELECT dir, max(own)[2] AS name FROM p JOIN own USING (doc_id) WHERE is_licence GROUP BY dir),
near AS (SELECT doc_id, arg_max(od.dir, len(od.dir)) AS from_dir, arg_max(od.name, len(od.dir)) AS name
         FROM p JOIN od ON p.dir = od.dir OR starts_with(p.dir, od.dir || '/') GROUP BY doc_id)
SELECT doc_id, path, own[2] AS own_licence, own[1] AS own_score, coalesce(own[2], near.name) AS licence,
       CASE WHEN own IS NULL THEN from_dir END AS inherited_from
FROM p LEFT JOIN own USING (doc_id) LEFT JOIN near USING (doc_id)
"""
