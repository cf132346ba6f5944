"""Queries by name over the driver's tables, with the DuckDB SQL that states the same rows."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac import params
from almanac.functions import text
from almanac.operators import articles, languages, mirror, nearby, render, search, sections
from almanac.plans import derive, samples
from almanac.runtime import new_folder
from almanac.sources import live, parse, wire
from almanac.streaming.refresh import Mirror

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


# --- SQL of the rules in derive.py and text.py

def _clean(x: str) -> str:
    x = f"regexp_replace({x}, '<[^>]+>', '', 'g')"
    for name, sign in text.ENTITIES:
        x = f"replace({x}, '{name}', '{sign.replace(chr(39), chr(39) * 2)}')"
    return f"regexp_replace({x}, '^[\\s\\p{{Z}}\\x{{FEFF}}]+|[\\s\\p{{Z}}\\x{{FEFF}}]+$', '', 'g')"


def _encode(x: str) -> str:
    x = f"url_encode(replace({x}, ' ', '_'))"
    for code, sign in (("%2A", "*"), ("%27", "''"), ("%21", "!"), ("%28", "("), ("%29", ")")):
        x = f"replace({x}, '{code}', '{sign}')"
    return x


_TOKENS = r"regexp_extract_all(lower(text), '[\p{L}\p{N}]+')"
_SECTIONS = """
lines AS (SELECT lang, doc_id, unnest(list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '')) AS line,
                 generate_subscripts(list_filter(string_split(text, chr(10)), lambda x: trim(x) <> ''), 1) AS i FROM documents WHERE text IS NOT NULL),
heads AS (SELECT *, trim(substr(trim(line), 1, 12)) AS head, 2 + (i - 1) % 2 AS level FROM lines)"""
_REQUESTS = """requests AS (SELECT doc_id AS request_id, 'Doc ' || CASE WHEN doc_id % 5 = 0 THEN doc_id + 10000000 ELSE doc_id END AS title,
    CASE WHEN doc_id % 11 = 0 THEN 'zz' WHEN doc_id % 13 = 0 THEN 'EN' ELSE lang END AS language, doc_id % 7 AS section_index FROM documents)"""
_GEO = """tags AS (SELECT s_name AS title, s_suppkey AS pageid, 48.8 + (s_suppkey * 37 % 1000) / 10000 AS latitude, 2.3 + (s_suppkey * 53 % 1000) / 10000 AS longitude FROM supplier)"""


def _away(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return f"2 * 6371008.8 * asin(sqrt(least(1.0, pow(sin((radians({lat2}) - radians({lat1})) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin((radians({lon2}) - radians({lon1})) / 2), 2))))"


_NEAR = f"near AS (SELECT *, {_away('48.85', '2.35', 'latitude', 'longitude')} AS exact FROM tags)"
_LINKS = f"""
p AS (SELECT page_id, regexp_extract(url, '://[^/]*/([a-z]+)/', 1) AS lang, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, url FROM pages),
links AS (SELECT a.lang AS source_lang, 'Page ' || a.page_id AS source_title, b.lang AS language_code, b.title || ' ' || b.page_id AS title,
                 CASE WHEN b.page_id % 3 <> 0 THEN b.url ELSE 'https://' || b.lang || '.{text.HOST}{text.ARTICLE_PATH}' || {_encode("b.title || ' ' || b.page_id")} END AS url
          FROM p a JOIN p b ON a.page_id // 50 = b.page_id // 50 AND a.lang <> b.lang),
numbered AS (SELECT *, row_number() OVER (PARTITION BY source_lang, source_title ORDER BY language_code, title) AS n FROM links)"""

# --- full-text search

_SEARCH = f"""a AS (SELECT doc_id, text, {_TOKENS} AS tk, len(regexp_extract_all(text, '\\S+')) AS wc FROM documents WHERE lang = 'en'),
s AS (SELECT *, len(list_filter(tk, lambda x: x = 'the')) AS t1, len(list_filter(tk, lambda x: x = 'of')) AS t2 FROM a),
hits AS (SELECT * FROM s WHERE t1 > 0 AND t2 > 0)"""
_EXCERPT = "substr(text, greatest(1, strpos(lower(text), 'the') - 60), 160)"
_SNIPPET = f"regexp_replace({_EXCERPT}, '^[\\s\\p{{Z}}\\x{{FEFF}}]+|[\\s\\p{{Z}}\\x{{FEFF}}]+$', '', 'g')"


@query(f"""WITH {_SEARCH} SELECT 'Doc ' || doc_id AS title, doc_id AS pageid, {_SNIPPET} AS snippet, wc AS wordcount, t1 + t2 AS score, 'en' AS language
FROM hits ORDER BY score DESC, pageid LIMIT 10""")
def search_topk(spark, sf_dir):
    return search.search(derive.articles(spark, sf_dir), "the of")


@query(f"WITH {_SEARCH} SELECT 'the of' AS effective_query, count(*) AS total_count, CAST(NULL AS VARCHAR) AS notice FROM hits")
def search_total(spark, sf_dir):
    return search.search_meta(derive.articles(spark, sf_dir), "the of")


@query(f"""WITH {_SEARCH} SELECT 'Doc ' || doc_id AS title, doc_id AS pageid, {_SNIPPET} AS snippet, wc AS wordcount, t1 + t2 AS score, 'en' AS language,
CASE WHEN text IS NOT NULL THEN string_split(text, chr(10))[1] END AS extract, text AS content FROM hits ORDER BY score DESC, pageid LIMIT 50""")
def search_articles(spark, sf_dir):
    return search.search_articles(derive.articles(spark, sf_dir), "the of", limit=50)


@query("""SELECT 'xylophone quagmire' AS effective_query, CAST(0 AS BIGINT) AS total_count, 'Nothing found for "xylophone quagmire" in "en". Other keywords or a broader query may help.' AS notice""")
def search_nothing(spark, sf_dir):
    return search.search_meta(derive.articles(spark, sf_dir), "xylophone quagmire")


@query(f"""WITH {_SEARCH}, st AS (SELECT count(*) AS n, avg(len(tk)) AS mean, sum((t1 > 0)::INT) AS d1, sum((t2 > 0)::INT) AS d2 FROM s)
SELECT 'Doc ' || doc_id AS title, doc_id AS pageid, round(0.0 + ln(1 + (n - d1 + 0.5) / (d1 + 0.5)) * t1 * 2.2 / (t1 + 1.2 * (1 - 0.75 + 0.75 * len(tk) / mean))
  + ln(1 + (n - d2 + 0.5) / (d2 + 0.5)) * t2 * 2.2 / (t2 + 1.2 * (1 - 0.75 + 0.75 * len(tk) / mean)), 6) AS score
FROM hits, st ORDER BY score DESC, pageid LIMIT 50""")
def search_bm25(spark, sf_dir):
    return search.search_bm25(derive.articles(spark, sf_dir), "the of", limit=50)


@query(rf"""WITH r(request_id, query, lang, most) AS (VALUES (1, 'the of', 'en', 10), (2, 'de la', 'fr', 50), (3, 'der', 'de', 50), (4, 'nowhere', 'en', 10)),
t AS (SELECT *, unnest(list_distinct(regexp_extract_all(lower(query), '[\p{{L}}\p{{N}}]+'))) AS term, len(list_distinct(regexp_extract_all(lower(query), '[\p{{L}}\p{{N}}]+'))) AS k FROM r),
i AS (SELECT lang, doc_id, unnest({_TOKENS}) AS term FROM documents), f AS (SELECT lang, doc_id, term, count(*) AS tf FROM i GROUP BY ALL),
h AS (SELECT request_id, most, k, doc_id, count(*) AS found, sum(tf) AS score FROM f JOIN t USING (lang, term) GROUP BY ALL HAVING count(*) = k),
o AS (SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY score DESC, doc_id) AS rank, count(*) OVER (PARTITION BY request_id) AS total_count FROM h)
SELECT request_id, CAST(rank AS INT) AS rank, doc_id AS pageid, CAST(score AS BIGINT) AS score, total_count FROM o WHERE rank <= most""")
def search_batch(spark, sf_dir):
    asked = spark.createDataFrame([(1, "the of", "en", 10), (2, "de la", "FR", 80), (3, "der", "de", 50), (4, "nowhere", "en", 10), (5, "the", "zz", 10)], "request_id int, query string, language string, limit int")
    return search.search_batch(search.postings(derive.articles(spark, sf_dir), asked), asked)


# --- text

@query(f"SELECT page_id, {_clean('html')} AS snippet FROM pages")
def snippet_clean(spark, sf_dir):
    return derive.table(spark, sf_dir, "pages").select("page_id", text.clean_snippet(F.col("html")).alias("snippet"))


@query(r"SELECT page_id, regexp_replace(regexp_replace(html, '<!--[\s\S]*?-->', '', 'g'), '\n{3,}', chr(10) || chr(10), 'g') AS html FROM pages")
def page_comment_strip(spark, sf_dir):
    return derive.table(spark, sf_dir, "pages").select("page_id", text.collapse_breaks(text.strip_comments(F.col("html"))).alias("html"))


@query(f"""SELECT page_id, 'https://' || regexp_extract(url, '://[^/]*/([a-z]+)/', 1) || '.{text.HOST}{text.ARTICLE_PATH}' || {_encode("regexp_extract(html, '<title>([^<]*)</title>', 1)")} AS url FROM pages""")
def title_url(spark, sf_dir):
    return derive.page_titles(spark, sf_dir).select("page_id", text.article_url(F.col("lang"), F.col("title")).alias("url"))


@query("SELECT doc_id, len(regexp_extract_all(text, '\\S+')) AS wordcount FROM documents")
def word_counts(spark, sf_dir):
    return derive.articles(spark, sf_dir).select(F.col("pageid").alias("doc_id"), "wordcount")


@query(r"SELECT page_id, regexp_matches(html, '^\s*<(?i:!DOCTYPE html|html)') AS html FROM pages")
def html_sniff(spark, sf_dir):
    return derive.table(spark, sf_dir, "pages").select("page_id", text.is_html(F.col("html")).alias("html"))


# --- summaries and articles

@query("""SELECT 'Doc ' || doc_id AS title, 'standard' AS page_type, doc_id AS pageid, CAST(NULL AS VARCHAR) AS wikibase_item, CAST(NULL AS VARCHAR) AS description,
string_split(text, chr(10))[1] AS extract, CAST(NULL AS VARCHAR) AS thumbnail_url, lang AS language FROM documents WHERE string_split(text, chr(10))[1] <> ''""")
def lead_summary(spark, sf_dir):
    return articles.summaries(derive.articles(spark, sf_dir).where("extract != ''"))


@query("""SELECT 'Doc 3' AS title, 'standard' AS page_type, doc_id AS pageid, CAST(NULL AS VARCHAR) AS wikibase_item, CAST(NULL AS VARCHAR) AS description,
string_split(text, chr(10))[1] AS extract, CAST(NULL AS VARCHAR) AS thumbnail_url, lang AS language FROM documents WHERE doc_id = 3""")
def summary_single(spark, sf_dir):
    a = derive.articles(spark, sf_dir)
    return articles.summary(a, "Doc 3", a.where("pageid = 3").first()["lang"])


@query("SELECT 'Doc 3' AS title, doc_id AS pageid, text AS content, 'full_article' AS content_type, lang AS language FROM documents WHERE doc_id = 3")
def article_single(spark, sf_dir):
    a = derive.articles(spark, sf_dir)
    return articles.article(a, "Doc 3", a.where("pageid = 3").first()["lang"])


_FOUND = "FROM requests r LEFT JOIN documents d ON 'Doc ' || d.doc_id = r.title AND d.lang = lower(r.language) AND r.language <> 'zz'"


@query(f"""WITH {_REQUESTS}, s AS (SELECT r.*, d.doc_id, d.text, CASE WHEN language = 'zz' THEN 'invalid_language' WHEN d.doc_id IS NULL THEN 'not_found' WHEN coalesce(text, '') = '' THEN 'no_content' ELSE 'ok' END AS status {_FOUND})
SELECT request_id, title, doc_id AS pageid, CASE WHEN status = 'ok' THEN text END AS content, language, status FROM s""")
def article_lookup(spark, sf_dir):
    return articles.lookup(derive.articles(spark, sf_dir), derive.requests(spark, sf_dir))


@query(f"WITH {_REQUESTS} SELECT request_id, title, language FROM requests r WHERE NOT EXISTS (SELECT 1 FROM documents d WHERE 'Doc ' || d.doc_id = r.title AND d.lang = lower(r.language))")
def missing_titles(spark, sf_dir):
    return articles.missing(derive.articles(spark, sf_dir), derive.requests(spark, sf_dir)).select("request_id", "title", "language")


# --- sections

@query(f"""WITH {_SECTIONS} SELECT lang, 'Doc ' || doc_id AS article, doc_id AS pageid, CAST(i AS INT) AS "index", CASE WHEN doc_id % 2 = 0 THEN 'S' ELSE '' END || i AS number,
head AS title, CAST(level AS INT) AS level, doc_id % 2 <> 0 AS derived FROM heads""")
def toc(spark, sf_dir):
    rows = sections.contents(derive.headed_articles(spark, sf_dir), derive.stored_sections(spark, sf_dir), text.HEADING_LINE)
    return rows.select("lang", F.col("title").alias("article"), "pageid", "derived", F.inline("entries")).select("lang", "article", "pageid", "index", "number", "title", "level", "derived")


@query(f"""WITH {_SECTIONS} SELECT doc_id AS pageid, count(*) AS total_sections, CAST(max(level) AS INT) AS deepest FROM heads GROUP BY doc_id""")
def toc_fallback(spark, sf_dir):
    rows = sections.contents(derive.headed_articles(spark, sf_dir), derive.sections(spark, sf_dir).where("false"), text.HEADING_LINE).where("total_sections > 0")
    return rows.select("pageid", "total_sections", F.array_max(F.transform("entries", lambda e: e["level"])).alias("deepest"))


@query(f"""WITH {_REQUESTS}, {_SECTIONS}, n AS (SELECT doc_id, count(*) AS n FROM heads GROUP BY doc_id), s AS (SELECT r.*, d.doc_id, coalesce(n.n, 0) AS k {_FOUND} LEFT JOIN n ON n.doc_id = d.doc_id)
SELECT request_id, title, doc_id AS pageid, CASE WHEN doc_id IS NULL THEN 0 ELSE k END AS total_sections, CASE WHEN language = 'zz' THEN 'invalid_language' WHEN doc_id IS NULL THEN 'not_found' WHEN k = 0 THEN 'no_sections' ELSE 'ok' END AS status FROM s""")
def toc_requests(spark, sf_dir):
    a = derive.headed_articles(spark, sf_dir)
    return sections.toc_batch(a, derive.stored_sections(spark, sf_dir), derive.requests(spark, sf_dir)).drop("entries")


_CONTENT = "repeat('=', level) || ' ' || head || ' ' || repeat('=', level) || chr(10) || chr(10) || 'Text: ' || line"


@query(f"""WITH {_SECTIONS} SELECT lang, 'Doc ' || doc_id AS title, doc_id AS pageid, CAST(i AS INT) AS section_index, head AS section_title, trim({_CONTENT}) AS content, 'section' AS content_type
FROM heads""")
def section_read(spark, sf_dir):
    return sections.section_rows(derive.sections(spark, sf_dir))


@query(f"""WITH {_REQUESTS}, {_SECTIONS}, s AS (SELECT r.*, d.doc_id, h.head, h.level, h.line {_FOUND} LEFT JOIN heads h ON h.doc_id = d.doc_id AND h.i = r.section_index)
SELECT request_id, title, CAST(section_index AS INT) AS section_index, head AS section_title, trim({_CONTENT}) AS content,
CASE WHEN language = 'zz' THEN 'invalid_language' WHEN section_index < 1 THEN 'invalid_section' WHEN doc_id IS NULL THEN 'not_found' WHEN head IS NULL THEN 'invalid_section' ELSE 'ok' END AS status FROM s""")
def section_requests(spark, sf_dir):
    return sections.section_batch(derive.articles(spark, sf_dir), derive.sections(spark, sf_dir), derive.requests(spark, sf_dir))


# --- places

@query(f"""WITH {_GEO}, {_NEAR} SELECT title, pageid, latitude, longitude, round(exact, 1) AS distance_meters, 'en' AS language FROM near WHERE exact <= 5000
ORDER BY distance_meters, pageid LIMIT 10""")
def nearby_points(spark, sf_dir):
    return nearby.nearby(derive.geotags(spark, sf_dir), 48.85, 2.35, 5000)


@query(f"""WITH {_GEO}, {_NEAR}, k AS (SELECT least(count(*), 50) AS shown FROM near WHERE exact <= 10000)
SELECT CAST(48.85 AS DOUBLE) AS query_latitude, CAST(2.35 AS DOUBLE) AS query_longitude, 10000 AS radius_meters_used, shown, 50 AS cap, shown >= 50 AS truncated,
CASE WHEN shown = 0 THEN 'Nothing within 10000 m; a larger radius_meters may help, or other coordinates.' WHEN shown >= 50 THEN 'Only the first 50 are shown; a larger limit shows more.' END AS notice FROM k""")
def nearby_total(spark, sf_dir):
    return nearby.nearby_meta(derive.geotags(spark, sf_dir), 48.85, 2.35, 99_999, 999)


@query(f"""WITH {_GEO}, pts AS (SELECT c_custkey AS point_id, 48.8 + (c_custkey * 41 % 1000) / 10000 AS plat, 2.3 + (c_custkey * 59 % 1000) / 10000 AS plon FROM customer),
j AS (SELECT *, {_away('plat', 'plon', 'latitude', 'longitude')} AS exact FROM pts, tags WHERE abs(latitude - plat) < 0.02),
o AS (SELECT *, round(exact, 1) AS distance_meters, row_number() OVER (PARTITION BY point_id ORDER BY round(exact, 1), pageid) AS rank FROM j WHERE exact <= 1000)
SELECT point_id, CAST(rank AS INT) AS rank, title, pageid, distance_meters FROM o WHERE rank <= 10""")
def nearby_batch(spark, sf_dir):
    return nearby.nearby_batch(derive.geotags(spark, sf_dir), derive.points(spark, sf_dir))


# --- languages

@query(f"WITH {_LINKS} SELECT source_lang, source_title, language_code, title, url FROM numbered WHERE n <= 500")
def language_links(spark, sf_dir):
    return languages.link_rows(derive.langlinks(spark, sf_dir))


@query(f"""WITH {_LINKS}, k AS (SELECT source_lang, source_title, count(*) AS c FROM numbered WHERE n <= 500 GROUP BY ALL),
r AS (SELECT page_id AS request_id, 'Page ' || CASE WHEN page_id % 7 = 0 THEN page_id + 10000000 ELSE page_id END AS title, CASE WHEN page_id % 9 = 0 THEN 'xx' ELSE lang END AS language FROM p)
SELECT request_id, r.title, coalesce(c, 0) AS total_languages, CASE WHEN language = 'xx' THEN 'invalid_language' WHEN p.page_id IS NULL THEN 'not_found' WHEN c IS NULL THEN 'no_other_languages' ELSE 'ok' END AS status
FROM r LEFT JOIN p ON r.title = 'Page ' || p.page_id AND r.language = p.lang LEFT JOIN k ON k.source_title = 'Page ' || p.page_id AND k.source_lang = p.lang""")
def language_requests(spark, sf_dir):
    p = derive.page_titles(spark, sf_dir)
    title = F.concat(F.lit("Page "), F.when(F.col("page_id") % 7 == 0, F.col("page_id") + 10_000_000).otherwise(F.col("page_id")).cast("string"))
    asked = p.select(F.col("page_id").alias("request_id"), title.alias("title"), F.when(F.col("page_id") % 9 == 0, "xx").otherwise(F.col("lang")).alias("language"))
    return languages.languages_batch(derive.page_articles(spark, sf_dir), derive.langlinks(spark, sf_dir), asked).drop("editions")


_CODES = ["EN", "simple", "zh-min-nan", "zz", "not_a_code!!", "fr\n", "e", "be-tarask"]


@query(f"""WITH c AS (SELECT DISTINCT lang AS language FROM documents UNION SELECT unnest([{', '.join(repr(c) if chr(10) not in c else "'fr' || chr(10)" for c in _CODES)}]))
SELECT language, regexp_full_match(lower(language), '[a-z]{{2,3}}(-[a-z0-9]+)*') AND lower(language) IN ({', '.join(repr(c) for c in params.EDITIONS)}) AS known FROM c""")
def known_editions(spark, sf_dir):
    codes = derive.table(spark, sf_dir, "documents").select(F.col("lang").alias("language")).union(spark.createDataFrame([(c,) for c in _CODES], "language string")).distinct()
    return params.with_edition(codes).select("language", "known")


# --- parameters: what each check answers, and the requests that are sent

#: Parameters and values as JSON.
_CHECKS = [
    ("limit", "1"), ("limit", "50"), ("limit", "51"), ("limit", "99999"), ("limit", "0"), ("limit", "-3"), ("limit", "2.5"), ("limit", "true"),
    ("radius_meters", "1"), ("radius_meters", "10000"), ("radius_meters", "10001"), ("radius_meters", "0"),
    ("section_index", "1"), ("section_index", "999"), ("section_index", "0"), ("section_index", "-1"), ("section_index", "1.5"),
    ("latitude", "90"), ("latitude", "-90.0"), ("latitude", "90.01"), ("latitude", "-91"), ("longitude", "180"), ("longitude", "-180.5"), ("longitude", "181"),
    ("language", '"EN"'), ("language", '"zh-min-nan"'), ("language", '"simple"'), ("language", '"zz"'), ("language", '"not a code"'), ("language", '""'), ("language", "null"), ("title", '"Python"'), ("title", '""'), ("title", "null"),
]
_RULES = {
    "limit": params.row_limit, "radius_meters": params.radius, "section_index": params.section_index, "language": params.language, "title": lambda x: params.text("title", x),
    "latitude": lambda x: params.coordinates(x, 0)[0], "longitude": lambda x: params.coordinates(0, x)[1],
}


@query(r"""SELECT *, CASE
  WHEN name IN ('limit', 'radius_meters', 'section_index') THEN CASE WHEN regexp_full_match(given, '[1-9][0-9]*') THEN CAST(least(CAST(given AS BIGINT), CASE name WHEN 'limit' THEN 50 WHEN 'radius_meters' THEN 10000 ELSE 9999999 END) AS VARCHAR)
    WHEN name = 'section_index' THEN 'invalid_section' ELSE 'invalid_parameter' END
  WHEN name IN ('latitude', 'longitude') THEN CASE WHEN abs(TRY_CAST(given AS DOUBLE)) <= CASE name WHEN 'latitude' THEN 90 ELSE 180 END THEN CAST(CAST(given AS DOUBLE) AS VARCHAR) ELSE 'invalid_coordinates' END
  WHEN name = 'language' THEN CASE given WHEN '"EN"' THEN 'en' WHEN '"zh-min-nan"' THEN 'zh-min-nan' ELSE 'invalid_language' END
  ELSE CASE WHEN given IN ('null', '""') THEN 'invalid_parameter' ELSE trim(given, '"') END END AS answer
FROM (VALUES """ + ", ".join(f"('{n}', '{v}')" for n, v in _CHECKS) + ") AS t(name, given)")
def param_checks(spark, sf_dir):
    """The value that is used, or the reason of the refusal, for each parameter and value."""
    rows = []
    for name, given in _CHECKS:
        try:
            rows.append((name, given, str(_RULES[name](json.loads(given)))))
        except params.QueryError as e:
            rows.append((name, given, e.reason))
    return spark.createDataFrame(rows, "name string, given string, answer string")


_EN = f"https://en.{text.HOST}"
_ACTION = "&format=json&formatversion=2"


@query(f"""SELECT * FROM (VALUES (1, '{_EN}/w/api.php?action=query&list=search&srsearch=a+b%26c&srlimit=50&srprop=snippet%7Cwordcount{_ACTION}'),
(2, '{_EN}/api/rest_v1/page/summary/A_B%2F%C3%A9'), (3, '{_EN}/w/api.php?action=query&prop=extracts&titles=Caf%C3%A9&explaintext=true&exsectionformat=wiki{_ACTION}'),
(4, '{_EN}/w/api.php?action=parse&page=P&prop=wikitext&section=3{_ACTION}'), (5, '{_EN}/w/api.php?action=parse&page=P&prop=sections{_ACTION}'),
(6, '{_EN}/w/api.php?action=query&prop=langlinks&titles=P&lllimit=500&llprop=url{_ACTION}'),
(7, '{_EN}/w/api.php?action=query&list=geosearch&gscoord=47.620512%7C-122.349312&gsradius=10000&gslimit=10{_ACTION}')) AS t(id, url)""")
def request_urls(spark, sf_dir):
    """The address that each operator's request goes to."""
    asked = [("search", dict(query="a b&c", limit=999)), ("summary", dict(title="A B/é")), ("article", dict(title="Café")), ("section", dict(title="P", section_index=3)), ("sections", dict(title="P")), ("languages", dict(title="P")), ("nearby", dict(latitude=47.620512, longitude=-122.349312, radius_meters=99_999))]
    return spark.createDataFrame([(i + 1, live.url_of(operator, "EN", **given)) for i, (operator, given) in enumerate(asked)], "id int, url string")


# --- rendering

@query(f"""WITH {_SEARCH}, o AS (SELECT *, row_number() OVER (ORDER BY t1 + t2 DESC, doc_id) AS rank FROM hits), k AS (SELECT *, {_SNIPPET} AS snippet FROM o WHERE rank <= 10)
SELECT 1 AS request_id, 'en' AS language, '**' || count(*) || ' results** (en)' || chr(10) || chr(10) || string_agg('### Doc ' || doc_id || chr(10) || '**Page ID:** ' || doc_id || ' | **Words:** ' || wc || CASE WHEN snippet <> '' THEN chr(10) || snippet ELSE '' END, chr(10) ORDER BY rank) AS markdown FROM k""")
def render_search(spark, sf_dir):
    rows = search.search(derive.articles(spark, sf_dir), "the of")
    order = F.row_number().over(search.Window.partitionBy("language").orderBy(F.col("score").desc(), "pageid"))
    return render.search_results(rows.withColumn("rank", order).withColumn("request_id", F.lit(1)), ["request_id"])


@query("""SELECT doc_id AS pageid, '# Doc ' || doc_id || chr(10) || '**Type:** standard | **Language:** ' || lang || chr(10) || '**Page ID:** ' || doc_id || chr(10) || chr(10) || string_split(text, chr(10))[1] AS markdown FROM documents""")
def render_summary(spark, sf_dir):
    return articles.summaries(derive.articles(spark, sf_dir)).select("pageid", render.summaries().alias("markdown"))


@query("""SELECT doc_id AS pageid, '# Doc ' || doc_id || chr(10) || '**Type:** full_article | **Language:** ' || lang || ' | **Page ID:** ' || doc_id || chr(10) || chr(10) || text AS markdown FROM documents""")
def render_article(spark, sf_dir):
    a = derive.articles(spark, sf_dir).select("title", "pageid", F.col("full_text").alias("content"), F.lit("full_article").alias("content_type"), F.col("lang").alias("language"))
    return a.select("pageid", render.articles().alias("markdown"))


@query(f"""WITH {_SECTIONS} SELECT doc_id AS pageid, CAST(i AS INT) AS section_index, '# Doc ' || doc_id || chr(10) || '**Type:** section | **Language:** ' || lang || ' | **Page ID:** ' || doc_id || chr(10) || '**Section:** ' || head || chr(10) || chr(10) || trim({_CONTENT}) AS markdown
FROM heads""")
def render_section(spark, sf_dir):
    rows = sections.section_rows(derive.sections(spark, sf_dir)).withColumnRenamed("lang", "language")
    return rows.select("pageid", "section_index", render.articles(True).alias("markdown"))


@query(f"""WITH {_SECTIONS} SELECT doc_id AS pageid, '## Table of Contents — Doc ' || doc_id || ' (' || any_value(lang) || ')' || chr(10) || count(*) || ' sections | Page ID: ' || doc_id || chr(10) || chr(10) ||
string_agg(repeat('  ', level - 2) || CASE WHEN doc_id % 2 = 0 THEN 'S' ELSE '' END || i || '. **' || head || '** (index: ' || i || ', level: ' || level || ')', chr(10) ORDER BY i) AS markdown FROM heads GROUP BY doc_id""")
def render_toc(spark, sf_dir):
    rows = sections.contents(derive.headed_articles(spark, sf_dir), derive.stored_sections(spark, sf_dir), text.HEADING_LINE).where("total_sections > 0")
    return rows.withColumnRenamed("lang", "language").select("pageid", render.contents().alias("markdown"))


@query(f"""WITH {_GEO}, {_NEAR}, o AS (SELECT *, round(exact, 1) AS d, row_number() OVER (ORDER BY round(exact, 1), pageid) AS rank FROM near WHERE exact <= 5000)
SELECT 1 AS request_id, 'en' AS language, '**' || count(*) || ' articles** (en)' || chr(10) || chr(10) || string_agg('### ' || title || chr(10) || '**Page ID:** ' || pageid || ' | **Distance:** ' || regexp_replace(CAST(d AS VARCHAR), '\\.0$', '') || 'm | **Coords:** (' ||
regexp_replace(CAST(latitude AS VARCHAR), '\\.0$', '') || ', ' || regexp_replace(CAST(longitude AS VARCHAR), '\\.0$', '') || ')', chr(10) ORDER BY rank) AS markdown FROM o WHERE rank <= 10""")
def render_nearby(spark, sf_dir):
    rows = nearby.nearby(derive.geotags(spark, sf_dir), 48.85, 2.35, 5000)
    order = F.row_number().over(search.Window.partitionBy("language").orderBy("distance_meters", "pageid"))
    return render.nearby_results(rows.withColumn("rank", order).withColumn("request_id", F.lit(1)), ["request_id"])


@query(f"""WITH {_LINKS} SELECT source_title, source_lang AS source_language, '## Language editions for "' || source_title || '" (' || source_lang || ')' || chr(10) || '**' || count(*) || ' languages available**' || chr(10) || chr(10) ||
string_agg('- **' || language_code || '**: [' || title || '](' || url || ')', chr(10) ORDER BY language_code, title) AS markdown FROM numbered WHERE n <= 500 GROUP BY source_title, source_lang""")
def render_languages(spark, sf_dir):
    rows = languages.link_rows(derive.langlinks(spark, sf_dir)).withColumnRenamed("source_lang", "source_language")
    return render.language_list(rows, [])


# --- captured responses: what each must decode to is stated in SQL

@query(samples.SEARCH_SQL)
def wire_search(spark, sf_dir):
    return wire.search_hits(samples.frame(spark, samples.SEARCH)).where("status = 'ok'").drop("status")


@query(samples.SUMMARY_SQL)
def wire_summary(spark, sf_dir):
    return wire.summaries(samples.frame(spark, samples.SUMMARY))


@query(samples.ARTICLE_SQL)
def wire_article(spark, sf_dir):
    return wire.articles(samples.frame(spark, samples.ARTICLE))


@query(samples.SECTION_SQL)
def wire_section(spark, sf_dir):
    return wire.sections(samples.frame(spark, samples.SECTION).withColumn("section_index", F.lit(5)))


@query(samples.CONTENTS_SQL)
def wire_sections(spark, sf_dir):
    rows = wire.contents(samples.frame(spark, samples.CONTENTS)).select("id", "pageid", "status", F.explode_outer("entries").alias("e"))
    return rows.select("id", "pageid", "status", "e.index", "e.number", "e.title", "e.level")


@query(samples.LANGUAGES_SQL)
def wire_languages(spark, sf_dir):
    return wire.language_links(samples.frame(spark, samples.LANGUAGES))


@query(samples.GEO_SQL)
def wire_nearby(spark, sf_dir):
    return wire.geo_hits(samples.frame(spark, samples.GEO)).where("status = 'ok'").drop("status")


@query(samples.BROKEN_SQL)
def wire_broken(spark, sf_dir):
    """The status that each decoder gives to bodies that are no JSON objects, and to errors."""
    bodies = samples.frame(spark, samples.BROKEN).withColumn("section_index", F.lit(1))
    decoders = {"search": wire.search_hits, "summary": wire.summaries, "article": wire.articles, "section": wire.sections, "contents": wire.contents, "languages": wire.language_links, "nearby": wire.geo_hits}
    rows = [f(bodies).select(F.lit(kind).alias("kind"), "id", "status") for kind, f in decoders.items()]
    out = rows[0]
    for more in rows[1:]:
        out = out.union(more)
    return out


# --- extras: a mirror of one's own tables

@query("""SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus IN ('O', 'F') AND o_totalprice >= 100000 AND o_orderkey <> 7 ORDER BY o_totalprice DESC, o_orderkey LIMIT 100 OFFSET 10""")
def mirror_query(spark, sf_dir):
    rows = mirror.query(derive.table(spark, sf_dir, "orders"), [("o_orderstatus", "in", ["O", "F"]), ("o_totalprice", "gte", 100000.0), ("o_orderkey", "ne", 7)], [("o_totalprice", "desc"), ("o_orderkey", "asc")], 100, 10)
    return rows.select("o_orderkey", "o_totalprice", "o_orderstatus")


@query("""SELECT 'orders' AS name, least(count(*), 10000) AS shown, count(*) > 10000 AS truncated FROM orders UNION ALL SELECT 'nation', count(*), false FROM nation""")
def mirror_capped(spark, sf_dir):
    """How many rows of a table are shown, and whether there are more."""
    rows = []
    for name in ("orders", "nation"):
        shown, more = mirror.capped(derive.table(spark, sf_dir, name))
        rows.append(shown.agg(F.count("*").alias("shown")).select(F.lit(name).alias("name"), "shown", F.lit(more).alias("truncated")))
    return rows[0].union(rows[1])


@query("""SELECT s_suppkey AS id, CASE WHEN s_suppkey % 4 <> 0 THEN s_name END AS name, CASE WHEN s_suppkey % 4 <> 0 THEN s_nationkey END AS nation, CASE WHEN s_suppkey % 4 <> 0 THEN round(s_acctbal, 2) END AS balance,
CASE WHEN s_suppkey % 4 = 0 THEN 'unreadable' ELSE 'ok' END AS status FROM supplier""")
def parsed_texts(spark, sf_dir):
    """Suppliers written as CSV, JSON and XML, a quarter of them broken, and read again."""
    s = derive.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"), F.round("s_acctbal", 2).alias("balance"))
    row, kind = F.struct("name", "nation", "balance"), F.col("id") % 3
    body = F.when(kind == 0, F.to_csv(row)).when(kind == 1, F.to_json(row)).otherwise(F.to_xml(row))
    broken = F.when(kind == 0, F.concat(body, F.lit(",one,too,many"))).otherwise(F.expr("substr(body, 1, length(body) - 3)"))
    df = s.withColumn("body", body).withColumn("body", F.when(F.col("id") % 4 == 0, broken).otherwise(F.col("body")))
    schema = "name string, nation long, balance double"
    df = df.withColumn("r", F.when(kind == 0, parse.csv(F.col("body"), schema)).when(kind == 1, parse.json_object(F.col("body"), schema)).otherwise(parse.xml(F.col("body"), schema)))
    return df.select("id", "r.name", "r.nation", "r.balance", F.when(F.col("r").isNull(), "unreadable").otherwise("ok").alias("status"))


@query("""WITH c AS (SELECT user_id, event_id, value, event_type FROM events), l AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1),
cur AS (SELECT c_custkey AS user_id, CAST(-1 AS BIGINT) AS event_id, c_acctbal AS value FROM customer)
SELECT user_id, event_id, value FROM cur WHERE user_id NOT IN (SELECT user_id FROM l) UNION ALL SELECT user_id, event_id, value FROM l WHERE event_type <> 'purchase'""")
def mirror_upsert(spark, sf_dir):
    changes = derive.table(spark, sf_dir, "events").select("user_id", "event_id", "value", (F.col("event_type") == "purchase").alias("deleted"))
    current = derive.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), F.lit(-1).cast("long").alias("event_id"), F.col("c_acctbal").alias("value"))
    return mirror.upsert(current, changes, ["user_id"], "event_id")


@query("""WITH l AS (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1)
SELECT user_id, event_id, value FROM l WHERE event_type <> 'purchase'""")
def mirror_out_of_order(spark, sf_dir):
    """Changes in three batches, each with events from all of time: newer rows and deletions stand against later, older changes."""
    columns = "user_id long, event_id long, value double"
    m = Mirror(spark, f"{new_folder(spark, 'mirror')}/table", columns, ["user_id"], "event_id", buckets=8)
    changes = derive.table(spark, sf_dir, "events").select("user_id", "event_id", "value", (F.col("event_type") == "purchase").alias("deleted"))
    for batch, rest in enumerate((2, 0, 1)):
        m.apply(changes.where(F.col("event_id") % 3 == rest), batch)
    return m.table()


@query("""SELECT user_id, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1 AND event_type <> 'purchase'""")
def mirror_refresh(spark, sf_dir):
    """A stream of changes, followed to its end."""
    columns = "user_id long, event_id long, value double"
    folder = new_folder(spark, "mirror")
    changes = spark.readStream.schema(f"{columns}, event_type string").option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    m = Mirror(spark, f"{folder}/table", columns, ["user_id"], "event_id")
    m.follow(changes.select("user_id", "event_id", "value", (F.col("event_type") == "purchase").alias("deleted")), f"{folder}/checkpoint").awaitTermination()
    return m.table()


@query("""SELECT r_name, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY r_name""")
def workspace_rollup(spark, sf_dir):
    w = mirror.Workspace(spark)
    for name in ("orders", "customer", "nation", "region"):
        w.register(name, derive.table(spark, sf_dir, name))
    return w.sql("SELECT r_name, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY r_name")
