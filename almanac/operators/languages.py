"""An article's other language editions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from almanac import params
from almanac.functions import text
from almanac.operators.articles import _one, by_title


def link_rows(links: DataFrame, most: int = params.MOST_LINKS) -> DataFrame:
    """Links to other editions with their address, made from language and title where none is given; the first `most` of an article by code."""
    df = links.where(F.lower("language_code") != F.lower("source_lang"))
    order = Window.partitionBy("source_lang", "source_title").orderBy("language_code", "title")
    df = df.withColumn("_at", F.row_number().over(order)).where(F.col("_at") <= most)
    return df.select("source_lang", "source_title", "language_code", "title", F.coalesce("url", text.article_url(F.col("language_code"), F.col("title"))).alias("url"))


def languages(articles: DataFrame, links: DataFrame, title: str, language: str = "en") -> DataFrame:
    """language_code, title, url, with source_title and total_languages. Without any, no_other_languages is raised."""
    lang = params.language(language)
    _one(by_title(articles, title, language).select("title"), f'No article "{title}" in "{language}".', title, language)
    own = link_rows(links.where((F.col("source_lang") == lang) & (F.col("source_title") == title)))
    total = own.count()  # MOST_LINKS at most
    if not total:
        raise params.NotFound("no_other_languages", f'"{title}" has no edition besides "{language}".', title=title, language=language)
    return own.select(F.lit(title).alias("source_title"), F.lit(language).alias("source_language"), "language_code", "title", "url", F.lit(total).cast("long").alias("total_languages")).orderBy("language_code", "title")


def languages_batch(articles: DataFrame, links: DataFrame, requests: DataFrame) -> DataFrame:
    """requests (request_id, title, language) to request_id, title, total_languages, editions (array by code), status."""
    wanted = params.with_edition(requests).where("known").select(F.lower("language").alias("_wl"), F.col("title").alias("_wt")).distinct()
    links = links.join(wanted, (F.col("source_lang") == F.col("_wl")) & (F.col("source_title") == F.col("_wt")), "left_semi")
    rows = link_rows(links).groupBy(F.col("source_lang").alias("_sl"), F.col("source_title").alias("_st")).agg(F.array_sort(F.collect_list(F.struct("language_code", "title", "url"))).alias("editions"))
    asked = params.with_edition(requests).select("request_id", F.col("title").alias("asked"), "known", F.lower("language").alias("_lang"))
    pages = articles.select("lang", F.col("title").alias("_at"))
    df = asked.join(pages, (F.col("_lang") == F.col("lang")) & (F.col("asked") == F.col("_at")) & F.col("known"), "left")
    df = df.join(rows, (F.col("lang") == F.col("_sl")) & (F.col("_at") == F.col("_st")), "left")
    status = F.when(~F.col("known"), "invalid_language").when(F.col("_at").isNull(), "not_found").when(F.col("editions").isNull(), "no_other_languages").otherwise("ok")
    return df.select("request_id", F.col("asked").alias("title"), F.when(F.col("editions").isNull(), 0).otherwise(F.size("editions")).cast("long").alias("total_languages"), "editions", status.alias("status"))
