"""Schemas of the corpus tables and of the remote service's JSON, as DDL. Nothing is ever inferred."""

ARTICLES = (
    "lang STRING, title STRING, pageid BIGINT, page_type STRING, wikibase_item STRING, description STRING, "
    "extract STRING, full_text STRING, wikitext STRING, thumbnail_url STRING, wordcount BIGINT"
)
SECTIONS = "lang STRING, title STRING, pageid BIGINT, index INT, number STRING, section_title STRING, level INT, wikitext STRING"
GEOTAGS = "lang STRING, title STRING, pageid BIGINT, latitude DOUBLE, longitude DOUBLE"
LANGLINKS = "source_lang STRING, source_title STRING, language_code STRING, title STRING, url STRING"
EDITIONS = "code STRING"

TABLES = {"articles": ARTICLES, "sections": SECTIONS, "geotags": GEOTAGS, "langlinks": LANGLINKS, "editions": EDITIONS}

#: JSON bodies by kind. Pages come as a map by id or as a list, so both forms have a schema.
_PAGE = "pageid: BIGINT, title: STRING, missing: STRING, extract: STRING, langlinks: ARRAY<STRUCT<lang: STRING, title: STRING, url: STRING>>"
_ERROR = "error STRUCT<code: STRING, info: STRING>"
WIRE = {
    "error": _ERROR,
    "search": f"query STRUCT<searchinfo: STRUCT<totalhits: BIGINT>, search: ARRAY<STRUCT<title: STRING, pageid: BIGINT, snippet: STRING, wordcount: BIGINT>>>, {_ERROR}",
    "summary": "type STRING, title STRING, pageid BIGINT, wikibase_item STRING, description STRING, extract STRING, thumbnail STRUCT<source: STRING>",
    "pages_map": f"query STRUCT<pages: MAP<STRING, STRUCT<{_PAGE}>>>",
    "pages_list": f"query STRUCT<pages: ARRAY<STRUCT<{_PAGE}>>>",
    "wikitext": f"parse STRUCT<title: STRING, pageid: BIGINT, wikitext: STRING>, {_ERROR}",
    "sections": f"parse STRUCT<title: STRING, pageid: BIGINT, sections: ARRAY<STRUCT<level: STRING, line: STRING, number: STRING, index: STRING>>>, {_ERROR}",
    "geosearch": f"query STRUCT<geosearch: ARRAY<STRUCT<pageid: BIGINT, title: STRING, lat: DOUBLE, lon: DOUBLE, dist: DOUBLE>>>, {_ERROR}",
}
