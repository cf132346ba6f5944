"""Ranked full-text search: all terms must occur; the score is the sum of their frequencies, or BM25."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from almanac import params
from almanac.functions import text

K1, B = 1.2, 0.75
#: Up to so many distinct terms of a request table are broadcast.
SMALL_TERMS = 200_000


def terms_of(query: str) -> list[str]:
    """Distinct terms in order: runs of letters and digits, lower-cased; of a run without spaces its neighbouring letters."""
    inside = text._SPACELESS_START.pattern
    found = []
    for run in re.findall(rf"{inside}+|(?:(?!{inside})[^\W_])+", params.text("query", query).lower()):
        found += [run[i : i + 2] for i in range(max(1, len(run) - 1))] if re.match(inside, run) else [run]
    return list(dict.fromkeys(found))


def _counted(df: DataFrame, terms: list[str]) -> DataFrame:
    """df with counted: n, the tokens of a text, and tf, how often each term is among them.

    The struct comes out of a generator: a plain column would be worked out again for every filter that Catalyst pushes below it.
    """
    frequency = lambda tokens, term: F.size(F.filter(tokens, lambda t: t == term))
    both = text.let(text.tokens(F.col("full_text")), lambda tokens: F.struct(F.size(tokens).alias("n"), F.array(*[frequency(tokens, t) for t in terms]).cast("array<int>").alias("tf")))
    return df.select("*", F.explode(F.array(both)).alias("counted"))


def matches(articles: DataFrame, query: str, language: str = "en") -> DataFrame:
    """All hits, unordered: articles with counted (see _counted) and score. Parameters are checked first."""
    lang, terms = params.language(language), terms_of(query)
    df = articles.where(F.col("lang") == lang)
    for term in terms:  # cheap, before anything is cut into tokens
        df = df.where(F.contains(F.lower("full_text"), F.lit(term)))
    df = _counted(df, terms).where(F.lit(bool(terms)) & F.forall("counted.tf", lambda n: n > 0))
    return df.withColumn("score", F.aggregate("counted.tf", F.lit(0).cast("long"), lambda a, n: a + n))


def search(articles: DataFrame, query: str, limit: int = params.SEARCH_LIMIT, language: str = "en") -> DataFrame:
    """The best `limit` (50 at most) hits: title, pageid, snippet, wordcount, score, language. No hits are no error."""
    terms = terms_of(query)
    top = matches(articles, query, language).orderBy(F.col("score").desc(), "pageid").limit(params.row_limit(limit))
    snippet = text.trim(text.excerpt(F.col("full_text"), terms or [""]))
    return top.select("title", "pageid", snippet.alias("snippet"), F.coalesce("wordcount", F.lit(0)).alias("wordcount"), "score", F.lit(language).alias("language"))


def search_meta(articles: DataFrame, query: str, language: str = "en") -> DataFrame:
    """One row: effective_query, total_count (hits before the limit), notice (only if there are none)."""
    notice = F.lit(f'Nothing found for "{query}" in "{language}". Other keywords or a broader query may help.')
    total = matches(articles, query, language).agg(F.count("*").alias("total_count"))
    return total.select(F.lit(query).alias("effective_query"), "total_count", F.when(F.col("total_count") == 0, notice).alias("notice"))


def search_bm25(articles: DataFrame, query: str, limit: int = params.SEARCH_LIMIT, language: str = "en") -> DataFrame:
    """Hits of search() in the order of BM25, rounded to six places. Lengths and document frequencies are of the whole edition."""
    terms = terms_of(query)
    edition = _counted(articles.where(F.col("lang") == params.language(language)).select("full_text"), terms)
    has = [F.sum((F.col("counted.tf")[i] > 0).cast("int")).alias(f"df_{i}") for i in range(len(terms))]
    stats = edition.agg(F.count("*").alias("n"), F.avg("counted.n").alias("mean"), *has)
    df = matches(articles, query, language).withColumn("s", stats.select(F.struct("*")).scalar())
    score = F.lit(0.0)
    for i in range(len(terms)):
        idf = F.log(1 + (F.col("s.n") - F.col(f"s.df_{i}") + 0.5) / (F.col(f"s.df_{i}") + 0.5))
        tf = F.col("counted.tf")[i]
        score = score + idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * F.col("counted.n") / F.col("s.mean")))
    df = df.withColumn("score", F.round(score, 6)).orderBy(F.col("score").desc(), "pageid").limit(params.row_limit(limit))
    return df.select("title", "pageid", "score")


def asked_terms(requests: DataFrame) -> DataFrame:
    """The terms (request_id, lang, most, n_terms, term) of requests (request_id, query, language, limit) in known editions."""
    asked = params.with_edition(requests).where("known").withColumn("terms", text.query_terms(F.col("query")))
    return asked.select("request_id", F.lower("language").alias("lang"), F.least(F.col("limit"), F.lit(params.MOST_ROWS)).alias("most"), F.size("terms").alias("n_terms"), F.explode("terms").alias("term"))


def _wanted(asked: DataFrame) -> DataFrame:
    """Distinct terms, to be broadcast if they are counted to be few."""
    terms = asked.select("lang", "term").distinct()
    return F.broadcast(terms) if terms.count() <= SMALL_TERMS else terms


def postings(articles: DataFrame, requests: DataFrame | None = None) -> DataFrame:
    """The inverted index: lang, term, pageid, tf. Written partitioned by lang and sorted by term, a lookup reads few row groups.

    requests: only their terms are counted; the others go before anything is shuffled.
    """
    words = articles.select("lang", "pageid", F.explode(text.tokens(F.col("full_text"))).alias("term"))
    if requests is not None:
        words = words.join(_wanted(asked_terms(requests)), ["lang", "term"], "left_semi")
    return words.groupBy("lang", "term", "pageid").agg(F.count("*").alias("tf"))


def read_hits(hits: DataFrame, articles: DataFrame) -> DataFrame:
    """hits (pageid, language, ...) with each article's lead and text: extract, content. A hit whose article is gone has nulls."""
    own = articles.select(F.col("lang").alias("_lang"), F.col("pageid").alias("_page"), "extract", F.col("full_text").alias("content"))
    # only articles that were hit take part, so their texts move with few others
    keys = hits.select(F.lower("language").alias("_l"), F.col("pageid").alias("_p")).distinct()
    own = own.join(keys, (F.col("_lang") == F.col("_l")) & (F.col("_page") == F.col("_p")), "left_semi")
    return hits.join(own, (F.lower(hits["language"]) == F.col("_lang")) & (hits["pageid"] == F.col("_page")), "left").drop("_lang", "_page")


def search_articles(articles: DataFrame, query: str, limit: int = params.SEARCH_LIMIT, language: str = "en") -> DataFrame:
    """search(), with each hit's extract and content."""
    return read_hits(search(articles, query, limit, language), articles)


def search_batch(index: DataFrame, requests: DataFrame) -> DataFrame:
    """requests (request_id, query, language, limit) over postings(): request_id, rank, pageid, score, total_count.

    Terms of the requests join the index by (lang, term). Of a stored index only postings of asked terms are ever shuffled; where
    there is none, give postings() the requests.
    """
    asked = asked_terms(requests)
    hits = index.join(_wanted(asked), ["lang", "term"], "left_semi").join(asked, ["lang", "term"]).groupBy("request_id", "most", "n_terms", "pageid").agg(F.count("*").alias("found"), F.sum("tf").alias("score"))
    hits = hits.where("found = n_terms")
    by = Window.partitionBy("request_id")
    # the best score is not needed, but with it both sides need the same columns, so the shuffled hits are reused
    totals = hits.groupBy(F.col("request_id").alias("_r")).agg(F.count("*").alias("total_count"), F.max("score").alias("_best"))
    # the bound that no request exceeds is a literal, so that tasks drop all but their best rows before the shuffle
    ranked = hits.withColumn("rank", F.row_number().over(by.orderBy(F.col("score").desc(), "pageid"))).where(F.col("rank") <= params.MOST_ROWS).where("rank <= most")
    ranked = ranked.join(totals, (F.col("request_id") == F.col("_r")) & (F.col("score") <= F.col("_best")))
    return ranked.select("request_id", "rank", "pageid", "score", "total_count")
