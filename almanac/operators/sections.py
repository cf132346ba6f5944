"""Tables of contents, stored or derived from headings, and the text of single sections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almanac import params
from almanac.functions import text
from almanac.operators.articles import _one, by_title

_ENTRY = "array<struct<index:int,number:string,title:string,level:int>>"


def contents(articles: DataFrame, sections: DataFrame, pattern: str = text.HEADING) -> DataFrame:
    """Every article with its entries, in order: lang, title, pageid, entries, total_sections, derived.

    Where an article has no stored sections, its text's headings take their place.
    """
    entry = F.struct("index", F.coalesce("number", F.lit("")).alias("number"), F.coalesce("section_title", F.lit("")).alias("title"), F.coalesce("level", F.lit(2)).alias("level"))
    stored = sections.where(F.col("index").isNotNull()).groupBy(F.col("lang").alias("_l"), F.col("title").alias("_t")).agg(F.array_sort(F.collect_list(entry)).alias("stored"))
    df = articles.select("lang", "title", "pageid", "full_text").join(stored, (F.col("lang") == F.col("_l")) & (F.col("title") == F.col("_t")), "left")
    own = F.coalesce(F.col("stored").cast(_ENTRY), F.array().cast(_ENTRY))
    df = df.withColumn("entries", F.when(F.size(own) > 0, own).otherwise(F.coalesce(text.headings(F.col("full_text"), pattern).cast(_ENTRY), F.array().cast(_ENTRY))))
    return df.select("lang", "title", "pageid", "entries", F.size("entries").cast("long").alias("total_sections"), (F.size(own) == 0).alias("derived"))


def table_of_contents(articles: DataFrame, sections: DataFrame, title: str, language: str = "en") -> DataFrame:
    """index, number, title, level of one article's sections. Without any, no_sections is raised; the asked title is echoed."""
    found = by_title(articles, title, language)
    own = by_title(sections, title, language)
    row = _one(contents(found, own), f'No article "{title}" in "{language}".', title, language)
    if not row.first()["total_sections"]:
        raise params.NotFound("no_sections", f'"{title}" in "{language}" has no sections.', title=title, language=language)
    out = row.select(F.lit(title).alias("article"), "pageid", "total_sections", F.lit(language).alias("language"), F.inline("entries"))
    return out.select("article", "pageid", "language", "total_sections", "index", "number", "title", "level")


def toc_batch(articles: DataFrame, sections: DataFrame, requests: DataFrame) -> DataFrame:
    """requests (request_id, title, language) to request_id, title, pageid, entries, total_sections, status."""
    asked = params.with_edition(requests).select("request_id", F.col("title").alias("asked"), "known", F.lower("language").alias("_lang"))
    wanted = asked.where("known").select(F.col("_lang").alias("_wl"), F.col("asked").alias("_wt")).distinct()
    # what nobody asks for goes before sections are gathered and headings looked for
    own = [t.join(wanted, (F.col("lang") == F.col("_wl")) & (F.col("title") == F.col("_wt")), "left_semi") for t in (articles, sections)]
    df = asked.join(contents(*own), (F.col("_lang") == F.col("lang")) & (F.col("asked") == F.col("title")) & F.col("known"), "left")
    status = F.when(~F.col("known"), "invalid_language").when(F.col("lang").isNull(), "not_found").when(F.col("total_sections") == 0, "no_sections").otherwise("ok")
    return df.select("request_id", F.col("asked").alias("title"), "pageid", "entries", F.coalesce("total_sections", F.lit(0)).alias("total_sections"), status.alias("status"))


def section_rows(sections: DataFrame) -> DataFrame:
    """Stored sections as read: lang, title, pageid, section_index, section_title, content, content_type."""
    return sections.select("lang", "title", "pageid", F.col("index").alias("section_index"), text.section_title(F.col("wikitext"), F.col("index")).alias("section_title"), text.strip_wikitext(F.coalesce("wikitext", F.lit(""))).alias("content"), F.lit("section").alias("content_type"))


def section(articles: DataFrame, sections: DataFrame, title: str, section_index: int, language: str = "en") -> DataFrame:
    """One row of section_rows(). An index that the article does not have is an invalid_section."""
    params.language(language)
    index = params.section_index(section_index)
    _one(by_title(articles, title, language).select("title"), f'No article "{title}" in "{language}".', title, language)
    rows = section_rows(by_title(sections, title, language).where(F.col("index") == index)).drop("lang").withColumn("language", F.lit(language))
    found = rows.limit(1).collect()
    if not found:
        raise params.ValidationError("invalid_section", f'"{title}" has no section {index}.', title=title, section_index=index)
    return rows.sparkSession.createDataFrame(found, rows.schema)


def section_batch(articles: DataFrame, sections: DataFrame, requests: DataFrame) -> DataFrame:
    """requests (request_id, title, section_index, language) to request_id, title, section_index, section_title, content, status."""
    asked = params.with_edition(requests).select("request_id", F.col("title").alias("asked"), F.col("section_index").alias("wanted"), "known", F.lower("language").alias("_lang"))
    pages = articles.select(F.col("lang").alias("_al"), F.col("title").alias("_at"))
    df = asked.join(pages, (F.col("_lang") == F.col("_al")) & (F.col("asked") == F.col("_at")) & F.col("known"), "left")
    wanted = asked.where("known").select(F.col("_lang").alias("_wl"), F.col("asked").alias("_wt"), F.col("wanted").alias("_wi")).distinct()
    # markup is stripped of the sections asked for only
    own = section_rows(sections.join(wanted, (F.col("lang") == F.col("_wl")) & (F.col("title") == F.col("_wt")) & (F.col("index") == F.col("_wi")), "left_semi"))
    df = df.join(own, (F.col("_al") == F.col("lang")) & (F.col("_at") == F.col("title")) & (F.col("wanted") == F.col("section_index")), "left")
    status = F.when(~F.col("known"), "invalid_language").when(F.col("wanted") < 1, "invalid_section").when(F.col("_at").isNull(), "not_found").when(F.col("section_index").isNull(), "invalid_section").otherwise("ok")
    return df.select("request_id", F.col("asked").alias("title"), F.col("wanted").alias("section_index"), "section_title", "content", status.alias("status"))
