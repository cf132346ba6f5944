"""Captured responses of the remote service (one JSON body per row) as typed rows with a status.

A body that is null, an HTML page, cut short or anything else but a JSON object is an outage: its status is unavailable in
every decoder, as is that of an error the service reports without a known code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almanac import schemas
from almanac.functions import text


def quarantine(responses: DataFrame, body: str = "body") -> tuple[DataFrame, DataFrame]:
    """Rows with a JSON object, and the others: failures that may pass, to be fetched again."""
    good = readable(F.col(body))
    return responses.where(good), responses.where(~good)


def readable(body: Column) -> Column:
    """Whether a body is a whole JSON object."""
    return F.coalesce(body.rlike(r"\A\s*\{") & F.try_parse_json(body).isNotNull(), F.lit(False))


def _json(kind: str, body: str) -> Column:
    return F.from_json(F.col(body), schemas.WIRE[kind], {"mode": "PERMISSIVE"})


def _status(ok: Column, error: Column | None = None, section: bool = False) -> Column:
    """What a body and an error code mean: an unknown code is an outage, and so is a body that is no JSON object."""
    out = F.when(~readable(F.col("body")), "unavailable")
    if error is None:
        return out.otherwise(ok)
    if section:
        out = out.when(error == "nosuchsection", "invalid_section")
    return out.when(error == "missingtitle", "not_found").when(error.isNotNull(), "unavailable").otherwise(ok)


def _error(field: Column) -> Column:
    """An error's code; an error without one still is one."""
    return F.when(field.isNotNull(), F.coalesce(field["code"], F.lit("")))


def search_hits(responses: DataFrame) -> DataFrame:
    """responses (id, body) to id, total_count, rank, title, pageid, snippet, wordcount, status; without hits one row, with nulls and no_hits or unavailable."""
    df = responses.withColumn("r", _json("search", "body"))
    hits = F.coalesce(F.col("r.query.search"), F.array().cast("array<struct<title:string,pageid:bigint,snippet:string,wordcount:bigint>>"))
    df = df.withColumn("hits", hits).withColumn("status", _status(F.when(F.size("hits") == 0, "no_hits").otherwise("ok"), _error(F.col("r.error"))))
    df = df.withColumn("total_count", F.coalesce(F.col("r.query.searchinfo.totalhits"), F.size("hits").cast("long")))
    df = df.select("id", "status", F.when(F.col("status") != "unavailable", F.col("total_count")).alias("total_count"), F.posexplode_outer("hits").alias("rank", "h"))
    snippet = F.when(F.col("h").isNotNull(), text.clean_snippet(F.coalesce("h.snippet", F.lit(""))))
    return df.select("id", "total_count", (F.col("rank") + 1).alias("rank"), "h.title", "h.pageid", snippet.alias("snippet"), F.when(F.col("h").isNotNull(), F.coalesce("h.wordcount", F.lit(0))).alias("wordcount"), "status")


def summaries(responses: DataFrame) -> DataFrame:
    """responses (id, title, body) to id, title, page_type, pageid, wikibase_item, description, extract, thumbnail_url, status."""
    df = responses.withColumn("r", _json("summary", "body"))
    filled = F.col("r.extract").isNotNull() & (F.col("r.extract") != "")
    status = _status(F.when(filled, "ok").otherwise("not_found"))
    return df.select("id", F.coalesce("r.title", "title").alias("title"), F.coalesce("r.type", F.lit("article")).alias("page_type"), "r.pageid", "r.wikibase_item", "r.description", "r.extract", F.col("r.thumbnail.source").alias("thumbnail_url"), status.alias("status"))


def first_page(body: str = "body") -> Column:
    """The first page of a response, whichever form its pages have."""
    as_map = F.get(F.map_values(_json("pages_map", body)["query"]["pages"]), F.lit(0))
    as_list = F.get(_json("pages_list", body)["query"]["pages"], F.lit(0))
    return F.coalesce(as_map, as_list)


def _page_error() -> Column:
    return _error(_json("error", "body")["error"])


def articles(responses: DataFrame) -> DataFrame:
    """responses (id, title, body) to id, title, pageid, content, status (ok, not_found, no_content, unavailable)."""
    df = responses.withColumn("p", first_page())
    gone = F.col("p").isNull() | F.col("p.missing").isNotNull()
    empty = F.col("p.extract").isNull() | (F.col("p.extract") == "")
    status = _status(F.when(gone, "not_found").when(empty, "no_content").otherwise("ok"), _page_error())
    return df.select("id", F.coalesce("p.title", "title").alias("title"), "p.pageid", F.when(status == "ok", F.col("p.extract")).alias("content"), status.alias("status"))


def sections(responses: DataFrame) -> DataFrame:
    """responses (id, title, section_index, body) to id, title, pageid, section_title, content, status."""
    df = responses.withColumn("r", _json("wikitext", "body"))
    status = _status(F.lit("ok"), _error(F.col("r.error")), True)
    raw = F.coalesce("r.parse.wikitext", F.lit(""))
    ok = status == "ok"
    return df.select("id", F.coalesce("r.parse.title", "title").alias("title"), "r.parse.pageid", F.when(ok, text.section_title(raw, F.col("section_index"))).alias("section_title"), F.when(ok, text.strip_wikitext(raw)).alias("content"), status.alias("status"))


def contents(responses: DataFrame) -> DataFrame:
    """responses (id, title, body) to id, title, pageid, entries, status. Entries without an index, or with one that is no number, go."""
    df = responses.withColumn("r", _json("sections", "body"))
    listed = F.filter(F.coalesce("r.parse.sections", F.array().cast("array<struct<level:string,line:string,number:string,index:string>>")), lambda s: s["index"].try_cast("int").isNotNull())
    entries = F.transform(listed, lambda s: F.struct(s["index"].try_cast("int").alias("index"), F.coalesce(s["number"], F.lit("")).alias("number"), F.coalesce(s["line"], F.lit("")).alias("title"), F.coalesce(text.number_or(s["level"], "2"), F.lit(2)).alias("level")))
    status = _status(F.when(F.size(entries) == 0, "no_sections").otherwise("ok"), _error(F.col("r.error")))
    return df.select("id", "title", "r.parse.pageid", entries.alias("entries"), status.alias("status"))


def language_links(responses: DataFrame) -> DataFrame:
    """responses (id, title, body) to id, language_code, title, url, status; one row with nulls where there are no links."""
    df = responses.withColumn("p", first_page())
    gone = F.col("p").isNull() | F.col("p.missing").isNotNull()
    links = F.when(~gone, F.col("p.langlinks"))
    status = _status(F.when(gone, "not_found").when(F.coalesce(F.size(links), F.lit(0)) <= 0, "no_other_languages").otherwise("ok"), _page_error())
    df = df.select("id", status.alias("status"), F.explode_outer(links).alias("l"))
    return df.select("id", F.col("l.lang").alias("language_code"), "l.title", F.coalesce("l.url", text.article_url(F.col("l.lang"), F.col("l.title"))).alias("url"), "status")


def geo_hits(responses: DataFrame) -> DataFrame:
    """responses (id, body) to id, rank, title, pageid, latitude, longitude, distance_meters, status; without places one row, with nulls and no_hits or unavailable."""
    df = responses.withColumn("r", _json("geosearch", "body"))
    places = F.col("r.query.geosearch")
    status = _status(F.when(F.coalesce(F.size(places), F.lit(0)) <= 0, "no_hits").otherwise("ok"), _error(F.col("r.error")))
    df = df.select("id", status.alias("status"), F.posexplode_outer(places).alias("rank", "g"))
    return df.select("id", (F.col("rank") + 1).alias("rank"), "g.title", "g.pageid", F.col("g.lat").alias("latitude"), F.col("g.lon").alias("longitude"), F.col("g.dist").alias("distance_meters"), "status")
