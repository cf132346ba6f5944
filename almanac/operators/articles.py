"""Lead summaries and whole articles by title, one at a time or for a table of requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almanac import params
from almanac.functions import text


def by_title(articles: DataFrame, title: str, language: str) -> DataFrame:
    """Rows of an article: both comparisons reach the scan."""
    lang = params.language(language)
    return articles.where((F.col("lang") == lang) & (F.col("title") == params.text("title", title)))


def _one(df: DataFrame, missing: str, title: str, language: str) -> DataFrame:
    """df if it has a row. A single lookup answers at once, so the row is fetched and given back as a local table."""
    rows = df.limit(1).collect()
    if not rows:
        raise params.NotFound("not_found", missing, title=title, language=language)
    return df.sparkSession.createDataFrame(rows, df.schema)


def summaries(found: DataFrame, language: Column | None = None) -> DataFrame:
    """The summary's columns of article rows: absent values stay null, only the type has a default."""
    return found.select(
        "title", F.coalesce("page_type", F.lit("article")).alias("page_type"), "pageid", "wikibase_item", "description", "extract", "thumbnail_url",
        (F.col("lang") if language is None else language).alias("language"),
    )


def summary(articles: DataFrame, title: str, language: str = "en", redirects: DataFrame | None = None) -> DataFrame:
    """One row. An article whose lead is null or empty counts as not found. redirects: lang, title, target."""
    found = by_title(articles, title, language)
    if redirects is not None:
        to = redirects.where((F.col("lang") == params.language(language)) & (F.col("title") == title)).select(F.col("lang").alias("_l"), F.col("target"))
        found = found.unionByName(articles.join(F.broadcast(to.limit(1)), (articles["lang"] == F.col("_l")) & (articles["title"] == F.col("target"))).select(articles.columns))
    return _one(summaries(found.where(_filled("extract")), F.lit(language)), f'No readable article "{title}" in "{language}".', title, language)


def article(articles: DataFrame, title: str, language: str = "en") -> DataFrame:
    """One row: title, pageid, content, content_type, language. Text keeps its heading marks."""
    found = by_title(articles, title, language).where(_filled("full_text"))
    rows = found.select("title", "pageid", F.col("full_text").alias("content"), F.lit("full_article").alias("content_type"), F.lit(language).alias("language"))
    return _one(rows, f'No readable article "{title}" in "{language}".', title, language)


def _filled(column: str) -> Column:
    return F.col(column).isNotNull() & (F.col(column) != "")


def lookup(articles: DataFrame, requests: DataFrame, content: str = "full_text") -> DataFrame:
    """requests (request_id, title, language) to request_id, title, pageid, content, language, status.

    status: ok, invalid_language, not_found, or no_content where the article's text is null or empty. The request's title is
    echoed where there is no article. The larger side is not broadcast; Spark decides by size.
    """
    asked = params.with_edition(requests).select("request_id", F.col("title").alias("asked"), "language", "known", F.lower("language").alias("_lang"))
    pages = articles.select("lang", "title", "pageid", F.col(content).alias("content"))
    df = asked.join(pages, (F.col("_lang") == F.col("lang")) & (F.col("asked") == F.col("title")) & F.col("known"), "left")
    status = F.when(~F.col("known"), "invalid_language").when(F.col("lang").isNull(), "not_found").when(~_filled("content") | F.col("content").isNull(), "no_content").otherwise("ok")
    return df.select("request_id", F.coalesce("title", "asked").alias("title"), "pageid", F.when(status == "ok", F.col("content")).alias("content"), "language", status.alias("status"))


def missing(articles: DataFrame, requests: DataFrame) -> DataFrame:
    """The requests without an article."""
    return requests.join(articles.select("lang", "title"), (F.lower(requests["language"]) == F.col("lang")) & (requests["title"] == articles["title"]), "left_anti")


def from_texts(texts: DataFrame, heading_pattern: str | None = None) -> DataFrame:
    """Articles of a table lang, title, pageid, full_text: lead and word count are worked out."""
    null = lambda n: F.lit(None).cast("string").alias(n)
    t = F.col("full_text")
    return texts.select("lang", "title", "pageid", F.lit("standard").alias("page_type"), null("wikibase_item"), null("description"), text.lead(t).alias("extract"), t, null("wikitext"), null("thumbnail_url"), text.word_count(t).alias("wordcount"))
