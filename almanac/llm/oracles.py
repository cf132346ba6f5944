"""DuckDB SQL for the rows of those corpus queries that SQL can express. The others hash, train or tokenise."""

from __future__ import annotations

import re

from almanac.llm import licenses, mixing, quality, url_filter

_WORDS = r"regexp_extract_all(text, '[^\x20\x09-\x0D]+')"
_LOWER = f"translate({{}}, '{url_filter._UPPER}', '{url_filter._LOWER}')"


def _text(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


# --- URL filters

_RULES = ", ".join(f"({_text(r)}, {_text(v)}, {str(own).lower()})" for rows, own in (([(r, v) for v, r in url_filter.RULES], False), ([(r, "block") for r in url_filter.LISTED], True)) for r, v in rows)
_HOST = _LOWER.format(r"regexp_extract(url, '(?s)\A.*?://([^/?#]*)', 1)")
_CHAR = "chr(('0x' || substr(x, 1, 2))::INT)"
_UNESCAPED = f"""array_to_string(list_transform(string_split(path, '%'), lambda x, i: CASE WHEN i = 1 THEN x WHEN regexp_matches(x, '^[0-9A-Fa-f]{{2}}')
  THEN CASE WHEN regexp_matches({_CHAR}, '^[A-Za-z0-9._~-]$') THEN {_CHAR} ELSE '%' || upper(substr(x, 1, 2)) END || substr(x, 3) ELSE '%' || x END), '')"""
_RESOLVED = """list_reduce(list_prepend('', string_split(plain, '/')), lambda a, x: CASE WHEN x IN ('', '.') THEN a WHEN x = '..' THEN regexp_replace(a, '/[^/]*$', '') ELSE a || '/' || x END)
  || CASE WHEN regexp_matches(plain, '(^|/)\\.{0,2}$') THEN '/' ELSE '' END""".replace("\\\\", "\\")
URLS = rf"""
WITH rules(rule, verdict, listed) AS (VALUES {_RULES}),
parts AS (SELECT rule, verdict, listed, split_part(rule, '/', 1) AS rhost, substr(rule, strpos(rule, '/')) AS rpath FROM rules),
raw AS (SELECT page_id, coalesce({_HOST}, '') AS host, coalesce(regexp_extract(url, '(?s)\A.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
opened AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(host, '(?s)\A.*@', ''), ':[0-9]*$', ''), '\.+$', '') AS chost, {_UNESCAPED} AS plain FROM raw),
urls AS (SELECT page_id, host, path, chost, CASE WHEN plain = '' THEN '' ELSE {_RESOLVED} END AS cpath FROM opened),
fits AS (SELECT u.*, r.rule, r.verdict, r.listed, row_number() OVER (PARTITION BY page_id ORDER BY r.listed NULLS LAST, length(r.rule) DESC) AS n
         FROM urls u LEFT JOIN parts r ON CASE WHEN r.listed THEN (u.chost = r.rhost OR ends_with(u.chost, '.' || r.rhost)) AND starts_with(u.cpath, r.rpath)
                                          ELSE (u.host = r.rhost OR ends_with(u.host, '.' || r.rhost)) AND starts_with(u.path, r.rpath) END)
SELECT page_id, host, path, CASE WHEN NOT listed THEN rule END AS rule, coalesce(verdict, 'allow') AS verdict FROM fits WHERE n = 1
"""

# --- exact top-k

VECTORS = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::DOUBLE) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM r WHERE rank <= 5
"""

# --- quality rules


def _rate(name: str) -> str:
    a, b = quality.RATES[name][:2]
    return f"(1000 * {a}) // greatest({b}, 1)"


def _bin(v: str) -> str:
    power = f"(length(bin({v})) - 1)"
    return f"CASE WHEN {v} < 64 THEN {v} ELSE 64 + ({power} - 6) * 32 + ({v} >> ({power} - 5)::INT) - 32 END"


def _bin_start(b: str) -> str:
    return f"CASE WHEN {b} < 64 THEN {b} ELSE (32 + ({b} - 64) % 32) << (({b} - 64) // 32 + 1)::INT END"


def _limits() -> str:
    out = []
    for r, (_, size, event, below, above) in quality.RATES.items():
        one = f"(1000 * {event}) // greatest(max(CASE WHEN rate = '{size}' THEN middle END), 1)"
        low, middle, high = (f"max(CASE WHEN rate = '{r}' THEN {c} END)" for c in ("low", "middle", "high"))
        low_bin, high_bin = (f"max(CASE WHEN rate = '{r}' THEN {c} END)" for c in ("low_bin", "high_bin"))
        if below is not None:
            out.append(f"{low} - {below} * greatest({middle} - {low}, {low_bin}, {one}) AS {r}_least")
        out.append(f"{high} + {above} * greatest({high} - {middle}, {high_bin}, {one}) AS {r}_most")
    return ", ".join(out)


def _within() -> str:
    tests = [f"coalesce({_rate(r)} <= {r}_most, true)" for r in quality.RATES]
    tests += [f"coalesce({_rate(r)} >= {r}_least, true)" for r, x in quality.RATES.items() if x[3] is not None]
    return " AND ".join(tests)


_P = float(quality.PRIOR)
_NAMES = [*quality.RATES, *quality.SIZES]


def _quartile(k: int) -> str:
    return f"min(CASE WHEN 4 * (us + {_P} * (ul + {_P} * uz / nz) / (nl + {_P})) >= {k} * (ns + {_P}) THEN bin END)"


def _bin_width(b: str) -> str:
    return f"{_bin_start(f'({b} + 1)')} - {_bin_start(b)}"


_RATE_LIST = "[" + ", ".join(f"{{'rate': '{r}', 'bin': {_bin(_rate(r))}}}" for r in quality.RATES) + ", " + ", ".join(f"{{'rate': '{c}', 'bin': {_bin(c)}}}" for c in quality.SIZES) + "]"
QUALITY = rf"""
WITH d AS (SELECT doc_id, lang, source, text, coalesce({_WORDS}, []) AS ws, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM documents),
w AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS i, CASE WHEN len(ws) >= 8 THEN ws ELSE [] END AS ws FROM d),
g AS (SELECT doc_id, i, CASE WHEN i + 7 <= len(ws) THEN array_to_string(list_slice(ws, i, i + 7), ' ') END AS gram FROM w),
c AS (SELECT doc_id, i, gram IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, gram) > 1 AS twice FROM g),
r AS (SELECT doc_id, max(twice::INT) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS covered FROM c),
n AS (SELECT doc_id, sum(covered) AS n_repeat_words FROM r GROUP BY doc_id),
m AS (SELECT doc_id, lang, source, len(ws) AS n_words, CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
        length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
        CAST(coalesce(list_sum(list_transform(range(2, len(ws) + 1), lambda i: (ws[i] = ws[i - 1])::INT)), 0) AS BIGINT) AS n_echoes
      FROM d LEFT JOIN n USING (doc_id)),
f AS (SELECT *, n_words < {quality.LEAST_WORDS} OR 100 * n_repeat_words > {quality.MOST_REPEATED} * n_words AS base_failed FROM m),
sketch AS (SELECT lang, source, u.rate AS rate, u.bin AS bin, count(*) AS n FROM (SELECT lang, source, unnest({_RATE_LIST}) AS u FROM f WHERE NOT base_failed) GROUP BY ALL),
wide AS (SELECT lang, rate, bin, sum(n) AS n FROM sketch GROUP BY ALL), every AS (SELECT rate, bin, sum(n) AS n FROM sketch GROUP BY ALL),
cells AS (SELECT g.lang, g.source, z.rate, z.bin, coalesce(s.n, 0) AS s, coalesce(l.n, 0) AS l, z.n AS z FROM (SELECT DISTINCT lang, source FROM f) g CROSS JOIN every z
  LEFT JOIN sketch s ON s.rate = z.rate AND s.bin = z.bin AND s.lang IS NOT DISTINCT FROM g.lang AND s.source IS NOT DISTINCT FROM g.source
  LEFT JOIN wide l ON l.rate = z.rate AND l.bin = z.bin AND l.lang IS NOT DISTINCT FROM g.lang),
sums AS (SELECT *, (sum(s) OVER upto)::DOUBLE AS us, (sum(l) OVER upto)::DOUBLE AS ul, (sum(z) OVER upto)::DOUBLE AS uz, (sum(s) OVER every_bin)::DOUBLE AS ns, (sum(l) OVER every_bin)::DOUBLE AS nl, (sum(z) OVER every_bin)::DOUBLE AS nz FROM cells
  WINDOW upto AS (PARTITION BY lang, source, rate ORDER BY bin ROWS UNBOUNDED PRECEDING), every_bin AS (PARTITION BY lang, source, rate)),
q AS (SELECT lang, source, rate, {_quartile(1)} AS l, {_quartile(2)} AS m, {_quartile(3)} AS h FROM sums GROUP BY lang, source, rate),
s AS (SELECT lang, source, rate, {_bin_start('l')} AS low, {_bin_start('m')} AS middle, {_bin_start('h')} AS high, {_bin_width('l')} AS low_bin, {_bin_width('h')} AS high_bin FROM q),
t AS (SELECT lang, source, {_limits()} FROM s GROUP BY ALL)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND {_within()} AS kept
FROM f LEFT JOIN t ON f.lang IS NOT DISTINCT FROM t.lang AND f.source IS NOT DISTINCT FROM t.source
"""

# --- license scans


def _template_words(text: str) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(str.maketrans(url_filter._UPPER, url_filter._LOWER)))


def _template_rows() -> str:
    rows = []
    notices = [(True, label, text, text) for label, text in licenses.PHRASES] + [(False, *n) for n in licenses.NOTICES]
    for number, (exact, label, text, key) in enumerate(notices):
        ws = _template_words(text)
        n = len(ws) - licenses.K + 1
        inside = f" {' '.join(_template_words(key))} " if key else ""
        before = f" {' '.join(ws)} ".index(inside)
        at = f" {' '.join(ws)} "[:before].count(" ") if key else 0
        keys = range(at, at + max(0, len(_template_words(key)) - licenses.K + 1))
        rows += [f"({number}, '{label}', {str(exact).lower()}, {i}, {str(i in keys).lower()}, {n}, {len(keys)}, '{' '.join(ws[i : i + licenses.K])}')" for i in range(n)]
    return ", ".join(rows)


LICENSES = rf"""
WITH tpl(template, label, phrase, place, is_key, n, n_key, gram) AS (VALUES {_template_rows()}),
d AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
g AS (SELECT doc_id, unnest(range(1, len(ws))) AS i, ws FROM d),
hits AS (SELECT DISTINCT doc_id, template, label, phrase, t.n, n_key, is_key, place, i - 1 - place AS diagonal FROM g JOIN tpl t ON ws[i] || ' ' || ws[i + 1] = t.gram),
base AS (SELECT doc_id, label, diagonal AS pos FROM hits WHERE phrase GROUP BY doc_id, template, label, n, diagonal HAVING count(*) = n),
o AS (SELECT *, count(*) OVER (PARTITION BY doc_id, template, diagonal) AS votes FROM hits WHERE NOT phrase),
e AS (SELECT DISTINCT doc_id, template, diagonal, n FROM o WHERE votes >= least({licenses.LEAST_VOTES}, n)),
f AS (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY doc_id, template ORDER BY diagonal) <= greatest({licenses.MOST_GAP}, n // 4) THEN 0 ELSE 1 END AS opens FROM e),
i AS (SELECT *, sum(opens) OVER (PARTITION BY doc_id, template ORDER BY diagonal ROWS UNBOUNDED PRECEDING) AS island FROM f),
spans AS (SELECT o.doc_id, o.template, o.label, island, o.n, count(DISTINCT place) AS places, count(DISTINCT CASE WHEN is_key THEN place END) = n_key AS has_key, min(diagonal + place) AS starts, max(diagonal + place + {licenses.K}) AS ends
          FROM o JOIN i USING (doc_id, template, diagonal) GROUP BY o.doc_id, o.template, o.label, island, o.n, n_key),
counting AS (SELECT * FROM spans WHERE has_key AND places / n >= {licenses.COVERED}),
kept AS (SELECT a.doc_id, a.label FROM counting a WHERE NOT EXISTS (SELECT 1 FROM counting b WHERE b.doc_id = a.doc_id AND b.label <> a.label AND b.starts < a.ends AND a.starts < b.ends
         AND (b.places > a.places OR (b.places = a.places AND (b.n < a.n OR (b.n = a.n AND b.template < a.template)))))),
b AS (SELECT doc_id, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM base GROUP BY doc_id),
l AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT doc_id, label FROM base UNION SELECT doc_id, label FROM kept) GROUP BY doc_id),
s AS (SELECT doc_id, max(places / n) AS covered FROM spans GROUP BY doc_id)
SELECT doc_id, len(ws) AS n_words, coalesce(n_base, 0) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
CAST(CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(covered, 0.0) END AS DOUBLE) AS score
FROM d LEFT JOIN b USING (doc_id) LEFT JOIN l USING (doc_id) LEFT JOIN s USING (doc_id)
"""

# --- WARC

WARC = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
k AS (SELECT payload_digest, payload_bytes, max(page_id) AS kept FROM p WHERE payload_bytes >= 1000 GROUP BY ALL)
SELECT page_id, p.payload_bytes, p.payload_digest, CASE WHEN coalesce(kept, page_id) = page_id THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN kept <> page_id THEN kept END AS refers_to
FROM p LEFT JOIN k USING (payload_digest, payload_bytes)
"""

# --- MinHash near-duplicates: all pairs that share a shingle, links, and what reaches what

NEAR = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(ws) = 1 THEN ws[1] ELSE ws[i] || ' ' || ws[i + 1] END AS shingle FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws), 2))) AS i FROM d WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
reach(node, other) AS (SELECT a, b FROM (SELECT a, b FROM links UNION SELECT b, a FROM links) UNION SELECT r.node, e.other FROM reach r JOIN (SELECT a AS node, b AS other FROM links UNION SELECT b, a FROM links) e ON r.other = e.node)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(m.least, d.doc_id)) AS component_id, d.doc_id = least(d.doc_id, coalesce(m.least, d.doc_id)) AS kept
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN (SELECT node, min(other) AS least FROM reach GROUP BY node) m ON m.node = d.doc_id
"""

# --- mixing: resharing the excess, found as one level; full passes and the blocks of the partial pass; the tree's urns, ball
# by ball; and each source's permuted blocks, dealt out to the shards' quotas


def _key(*parts: str) -> str:
    text = " || ':' || ".join(["'" + str(mixing.SEED) + "'", *parts])
    return f"('0x' || substr(md5({text}), 1, 15))::BIGINT"


_WEIGHTS = f"[{', '.join(str(float(w)) for w in mixing.WEIGHTS)}][(ord - 1) % {len(mixing.WEIGHTS)} + 1]"
MIXING = rf"""
WITH RECURSIVE d AS (SELECT doc_id, source, coalesce(len({_WORDS}), 0) AS size, {_key("coalesce(doc_id::VARCHAR, 'null')")} AS h FROM documents),
o AS (SELECT source, sum(size)::BIGINT AS source_size, count(*) AS docs, row_number() OVER (ORDER BY source NULLS LAST) AS ord FROM d GROUP BY source),
w AS (SELECT *, {_WEIGHTS} AS weight, {mixing.CAP} * source_size AS most FROM o),
l AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(most) OVER (ORDER BY most / weight, ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(weight) OVER (ORDER BY most / weight, ord ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
v AS (SELECT level AS filled FROM l WHERE level <= most / weight ORDER BY most / weight, ord LIMIT 1),
t AS (SELECT ord, source, source_size, least(most, filled * weight)::DOUBLE AS target, pow(2, ceil(log2(greatest(docs / {mixing.DOCS_PER_BLOCK}, 1))))::BIGINT AS blocks FROM l, v),
p AS (SELECT *, CASE WHEN source_size > 0 THEN round(target)::BIGINT // source_size ELSE 0 END AS passes, round(target)::BIGINT - CASE WHEN source_size > 0 THEN round(target)::BIGINT // source_size ELSE 0 END * source_size AS rest FROM t),
x AS (SELECT d.doc_id, d.size, d.h, d.h % p.blocks AS block, p.* EXCLUDE (source) FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source),
r AS (SELECT *, sum(size) OVER (PARTITION BY ord ORDER BY block, h, doc_id, size ROWS UNBOUNDED PRECEDING) AS until FROM x),
k AS (SELECT *, greatest(0, least(size, rest - (until - size))) AS part FROM r),
m AS (SELECT ord, blocks, passes * blocks + CASE WHEN rest > 0 THEN coalesce(arg_min(block, until) FILTER (WHERE size > 0 AND until > rest), 0) + 1 ELSE 0 END AS instances FROM k GROUP BY ord, blocks, passes, rest),
shards AS (SELECT greatest({mixing.LEAST_SHARDS}, pow(2, ceil(log2(greatest(ceil(sum(size) / {mixing.WORDS_PER_SHARD}), 1)))))::INT AS n FROM d),
urn(lo, hi, ord, i) AS (
  SELECT 0, n, ord, unnest(range(1, instances + 1)) FROM m, shards
  UNION ALL
  SELECT CASE WHEN drawn <= share THEN lo ELSE mid END, CASE WHEN drawn <= share THEN mid ELSE hi END, ord, i FROM
    (SELECT *, row_number() OVER (PARTITION BY lo, hi ORDER BY key, ord, i) AS drawn, (2 * balls * (mid - lo) + (hi - lo)) // (2 * (hi - lo)) AS share FROM
      (SELECT *, (lo + hi) // 2 AS mid, count(*) OVER (PARTITION BY lo, hi) AS balls, {_key("'urn'", "lo::VARCHAR", "hi::VARCHAR", "ord::VARCHAR", "i::VARCHAR")} AS key FROM urn WHERE hi - lo > 1))),
quota AS (SELECT ord, lo AS shard, count(*) AS quota FROM urn WHERE hi - lo = 1 GROUP BY ALL),
slot AS (SELECT ord, shard, quota, row_number() OVER (PARTITION BY ord ORDER BY shard) AS rank FROM (SELECT ord, shard, quota, unnest(range(quota)) FROM quota)),
dealt AS (SELECT ord, blocks, i AS instance, row_number() OVER (PARTITION BY ord ORDER BY {_key("'order'", "ord::VARCHAR", "i::VARCHAR")}, i) AS rank FROM (SELECT ord, blocks, unnest(range(instances)) AS i FROM m)),
place AS (SELECT ord, instance % blocks AS block, instance // blocks AS pass, shard, quota FROM dealt JOIN slot USING (ord, rank)),
drawn AS (SELECT k.*, pass, shard, quota, CASE WHEN pass < passes THEN size ELSE part END AS words, {_key("'place'", "coalesce(doc_id::VARCHAR, 'null')", "pass::VARCHAR")} AS spot FROM k JOIN place USING (ord, block))
SELECT doc_id, size, source_size, target, CAST(coalesce(sum(words), 0) AS BIGINT) AS taken, CAST(count(words) AS INT) AS n_draws, coalesce(string_agg(CASE WHEN words > 0 THEN concat_ws(':', pass, words, shard, quota, spot) END, ';' ORDER BY pass), '') AS draws
FROM (SELECT doc_id, size, source_size, target, words, pass, shard, quota, spot FROM drawn WHERE words > 0 UNION ALL SELECT doc_id, size, source_size, target, NULL, NULL, NULL, NULL, NULL FROM k) GROUP BY doc_id, size, source_size, target
"""
