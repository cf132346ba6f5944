"""Captured responses in small, and what they must decode to."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

# Bodies below follow the remote service's interface; those of SEARCH to GEO are golden inputs (fixed values).
_HTML = "  <!DOCTYPE html><html><body>busy</body></html>"


def frame(spark: SparkSession, bodies: list) -> DataFrame:
    """id (from 1), title (the asked one) and body of each response."""
    rows = [(i + 1, f"Asked {i + 1}", b if isinstance(b, str) else json.dumps(b, ensure_ascii=False)) for i, b in enumerate(bodies)]
    return spark.createDataFrame(rows, "id int, title string, body string")


SEARCH = [
    {"query": {"searchinfo": {"totalhits": 500}, "search": [{"title": "Nikko", "pageid": 11, "snippet": "sous le nom d&#039;« hôtel Nikko »&amp;more<b>highlight</b>", "wordcount": 7}]}},
    {"query": {"search": [{"title": "Python", "pageid": 12, "snippet": '<span class="searchmatch">Python</span> is a <b>language</b>.'}]}},
    {"query": {"searchinfo": {"totalhits": 0}, "search": []}},
    {"query": {"searchinfo": {"totalhits": 1}, "search": [{"title": "E", "pageid": 13, "snippet": " &amp;lt;x&quot;﻿", "wordcount": 1}]}},
]
SEARCH_SQL = """SELECT * FROM (VALUES (1, CAST(500 AS BIGINT), 1, 'Nikko', CAST(11 AS BIGINT), 'sous le nom d''« hôtel Nikko »&morehighlight', CAST(7 AS BIGINT)),
(2, 1, 1, 'Python', 12, 'Python is a language.', 0), (4, 1, 1, 'E', 13, '<x"', 1)) AS t(id, total_count, rank, title, pageid, snippet, wordcount)"""

SUMMARY = [
    {"type": "standard", "title": "Python", "pageid": 23862, "wikibase_item": "Q28865", "description": "language", "extract": "A language.", "thumbnail": {"source": "http://x/y.png", "width": 1, "height": 2}},
    {"type": "disambiguation", "title": "Mercury", "pageid": 5, "extract": "Mercury may refer to:"},
    {"title": "Empty", "extract": ""},
    {"title": "None"},
    _HTML,
]
SUMMARY_SQL = """SELECT * FROM (VALUES (1, 'Python', 'standard', CAST(23862 AS BIGINT), 'Q28865', 'language', 'A language.', 'http://x/y.png', 'ok'), (2, 'Mercury', 'disambiguation', 5, NULL, NULL, 'Mercury may refer to:', NULL, 'ok'),
(3, 'Empty', 'article', NULL, NULL, NULL, '', NULL, 'not_found'), (4, 'None', 'article', NULL, NULL, NULL, NULL, NULL, 'not_found'), (5, 'Asked 5', 'article', NULL, NULL, NULL, NULL, NULL, 'unavailable'))
AS t(id, title, page_type, pageid, wikibase_item, description, extract, thumbnail_url, status)"""

ARTICLE = [
    {"query": {}},
    {"query": {"pages": {"-1": {"title": "Gone", "missing": ""}}}},
    {"query": {"pages": {"7": {"title": "Blank", "pageid": 7, "extract": ""}}}},
    {"query": {"pages": {"23862": {"title": "Python", "pageid": 23862, "extract": "Python is a programming language."}}}},
    {"query": {"pages": [{"title": "Listed", "pageid": 9, "extract": "In a list."}]}},
    {"query": {"pages": [{"title": "Gone too", "missing": True}]}},
    _HTML,
]
ARTICLE_SQL = """SELECT * FROM (VALUES (1, 'Asked 1', CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR), 'not_found'), (2, 'Gone', NULL, NULL, 'not_found'), (3, 'Blank', 7, NULL, 'no_content'), (4, 'Python', 23862, 'Python is a programming language.', 'ok'),
(5, 'Listed', 9, 'In a list.', 'ok'), (6, 'Gone too', NULL, NULL, 'not_found'), (7, 'Asked 7', NULL, NULL, 'unavailable')) AS t(id, title, pageid, content, status)"""

SECTION = [
    {"parse": {"title": "Python", "pageid": 1, "wikitext": "== History ==\n\nPython was created in 1991 by [[Guido van Rossum|Guido]]<ref>x</ref>."}},
    {"parse": {"title": "Plain", "pageid": 2, "wikitext": "Just plain text without a heading."}},
    {"error": {"code": "nosuchsection", "info": "no"}},
    {"error": {"code": "missingtitle", "info": "no"}},
    {"error": {"code": "ratelimited", "info": "slow"}},
    {"parse": {"title": "Deep", "pageid": 3, "wikitext": "=== Box ===\n{{Infobox|a={{b|{{c}}}}}}'''Bold''' and ''italic''<!-- == hidden == -->\n\n\n\n[[File:x.png|thumb|a [[link]]]]<nowiki>[[raw]]</nowiki>"}},
]
SECTION_SQL = """SELECT * FROM (VALUES (1, 'Python', CAST(1 AS BIGINT), 'History', '== History ==' || chr(10) || chr(10) || 'Python was created in 1991 by Guido.', 'ok'),
(2, 'Plain', 2, 'Section 5', 'Just plain text without a heading.', 'ok'), (3, 'Asked 3', NULL, NULL, NULL, 'invalid_section'), (4, 'Asked 4', NULL, NULL, NULL, 'not_found'), (5, 'Asked 5', NULL, NULL, NULL, 'unavailable'),
(6, 'Deep', 3, 'Box', '=== Box ===' || chr(10) || chr(10) || 'Bold and italic' || chr(10) || chr(10) || '[[raw]]', 'ok')) AS t(id, title, pageid, section_title, content, status)"""

CONTENTS = [
    {"parse": {"title": "P", "pageid": 1, "sections": [{"level": "2", "line": "History", "number": "1", "index": "1"}, {"level": "3", "line": "Origins", "number": "1.1", "index": "2"}, {"line": "None"}, {"index": "T-1", "line": "Elsewhere"}, {"index": "3"}]}},
    {"parse": {"title": "Q", "pageid": 2, "sections": []}},
    {"error": {"code": "missingtitle"}},
    {"error": {"code": "nosuchsection"}},
]
CONTENTS_SQL = """SELECT * FROM (VALUES (1, CAST(1 AS BIGINT), 'ok', 1, '1', 'History', 2), (1, 1, 'ok', 2, '1.1', 'Origins', 3), (1, 1, 'ok', 3, '', '', 2), (2, 2, 'no_sections', NULL, NULL, NULL, NULL),
(3, NULL, 'not_found', NULL, NULL, NULL, NULL), (4, NULL, 'unavailable', NULL, NULL, NULL, NULL)) AS t(id, pageid, status, "index", number, title, level)"""

LANGUAGES = [
    {"query": {"pages": {"1": {"title": "Python", "pageid": 1, "langlinks": [{"lang": "fr", "title": "Python (langage)", "url": "https://fr.example.org/Python"}, {"lang": "de", "title": "Test (Deutsch) ä!*~'"}]}}}},
    {"query": {"pages": [{"title": "Alone", "pageid": 2}]}},
    {"query": {"pages": {"-1": {"title": "Gone", "missing": ""}}}},
]
LANGUAGES_SQL = """SELECT * FROM (VALUES (1, 'fr', 'Python (langage)', 'https://fr.example.org/Python', 'ok'), (1, 'de', 'Test (Deutsch) ä!*~''', 'https://de.wikipedia.org/wiki/Test_(Deutsch)_%C3%A4!*~''', 'ok'),
(2, NULL, NULL, NULL, 'no_other_languages'), (3, NULL, NULL, NULL, 'not_found')) AS t(id, language_code, title, url, status)"""

GEO = [
    {"query": {"geosearch": [{"pageid": 1, "ns": 0, "title": "Space Needle", "lat": 47.6205, "lon": -122.3493, "dist": 150}, {"pageid": 2, "ns": 0, "title": "Monorail", "lat": 47.6, "lon": -122.3, "dist": 200.5}]}},
    {"query": {"geosearch": []}},
]
GEO_SQL = """SELECT * FROM (VALUES (1, 1, 'Space Needle', CAST(1 AS BIGINT), CAST(47.6205 AS DOUBLE), CAST(-122.3493 AS DOUBLE), CAST(150 AS DOUBLE)), (1, 2, 'Monorail', 2, 47.6, -122.3, 200.5)) AS t(id, rank, title, pageid, latitude, longitude, distance_meters)"""

#: Bodies that no decoder can read, and errors of the service itself.
BROKEN = ["", "busy, try again", '{"query": {"pages": {"1": {"title": "Cu', "null", "[]", '"text"', _HTML, {"error": {"code": "ratelimited", "info": "slow"}}, {"error": {"info": "no code"}}]
BROKEN_SQL = """SELECT kind, id, CASE WHEN kind = 'summary' AND id >= 8 THEN 'not_found' ELSE 'unavailable' END AS status
FROM (SELECT unnest(['search', 'summary', 'article', 'section', 'contents', 'languages', 'nearby']) AS kind), (SELECT CAST(unnest(range(1, 10)) AS INT) AS id)"""
