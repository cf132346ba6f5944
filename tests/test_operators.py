import math
import random

import pytest
from pyspark.sql import functions as F

from almanac import params, schemas
from almanac.operators import articles, languages, nearby, render, search, sections

from .conftest import rows

ARTICLES = [
    ("en", "Python", 1, "standard", "Q1", "language", "A language.", "A language of the kind.\n== Use ==\nthe of the", "", "http://p", 9),
    ("en", "Empty", 2, "standard", None, None, "", "", "", None, 0),
    ("en", "Mercury", 3, "disambiguation", None, None, "May refer to:", "the planet of the sun", "", None, 5),
    ("fr", "Tour", 4, None, None, None, "Une tour.", "la tour", "", None, None),
    ("en", "Flat", 5, "standard", None, None, "Flat.", "no headings of", "", None, 3),
]
SECTIONS = [("en", "Python", 1, 1, "1", "History", 2, "== History ==\nx"), ("en", "Python", 1, 2, "1.1", "Origins", 3, "plain"), ("en", "Python", 1, None, None, None, None, None)]
LINKS = [("en", "Python", "fr", "Python (langage)", "http://fr/x"), ("en", "Python", "de", "Test (Deutsch)", None), ("en", "Python", "en", "Self", None)]


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.createDataFrame(ARTICLES, schemas.ARTICLES), spark.createDataFrame(SECTIONS, schemas.SECTIONS), spark.createDataFrame(LINKS, schemas.LANGLINKS)


def test_search(corpus):
    a = corpus[0]
    got = search.search(a, "The OF the", 999, "EN").collect()
    assert [(r["title"], r["score"], r["language"]) for r in got] == [("Python", 5, "EN"), ("Mercury", 3, "EN")]
    assert search.search(a, "the of", 1).count() == 1
    assert search.search_meta(a, "the of").first()["total_count"] == 2
    assert search.search(a, "東京タワー").count() == 0 and "東京タワー" in search.search_meta(a, "東京タワー").first()["notice"]
    assert search.search(a, "!!!").count() == 0
    with pytest.raises(params.ValidationError):
        search.search(a, "the", 5.7)
    with pytest.raises(params.ValidationError):
        search.search(a, "the", language="INVALID!!")
    assert [r["title"] for r in search.search_bm25(a, "the of").collect()] == ["Python", "Mercury"]


def test_search_without_spaces(spark):
    texts = {1: "昨日は東京タワーに行った。", 2: "京都の東寺", 3: "ภาษาไทยเขียนติดกัน", 4: "tower 東京 mixed東京text"}
    a = spark.createDataFrame([("ja", f"T{i}", i, None, None, None, "", t, "", None, 1) for i, t in texts.items()], schemas.ARTICLES)
    found = lambda q: {r["pageid"] for r in search.search(a, q, 50, "ja").collect()}
    assert found("東京タワー") == {1} and found("東京") == {1, 4} and found("東") == {1, 2, 4} and found("京都") == {2}
    assert found("ไทย") == {3} and found("東京 tower") == {4} and found("大阪") == set()
    asked = spark.createDataFrame([(i, q, "ja", 50) for i, q in enumerate(["東京タワー", "東京", "東", "東京 tower", "ไทย"])], "request_id int, query string, language string, limit int")
    got = search.search_batch(search.postings(a), asked).collect()
    assert {(r["request_id"], r["pageid"]) for r in got} == {(0, 1), (1, 1), (1, 4), (2, 1), (2, 2), (2, 4), (3, 4), (4, 3)}


def test_hits_with_their_articles(spark, corpus):
    got = search.search_articles(corpus[0], "the of").collect()
    assert [(r["title"], r["extract"], r["content"]) for r in got] == [("Python", "A language.", ARTICLES[0][7]), ("Mercury", "May refer to:", "the planet of the sun")]
    hits = spark.createDataFrame([(1, "EN"), (99, "en"), (4, "en"), (1, "en")], "pageid long, language string")
    assert sorted((r["pageid"], r["language"], r["content"] is not None) for r in search.read_hits(hits, corpus[0]).collect()) == [(1, "EN", True), (1, "en", True), (4, "en", False), (99, "en", False)]


def test_batches_meet_their_requests_first(spark, corpus):
    asked = spark.createDataFrame([(1, "the of", "en", 5)], "request_id int, query string, language string, limit int")
    df = search.search_batch(search.postings(corpus[0], asked), asked)
    assert rows(df) == rows(search.search_batch(search.postings(corpus[0]), asked)) and df.count() == 2
    # other terms go before postings are counted, and tasks keep the best rows only
    plan = search.postings(corpus[0], asked)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate [lang") < plan.index("LeftSemi") < plan.index("Generate explode")
    assert "WindowGroupLimit" in df._jdf.queryExecution().executedPlan().toString()


def test_search_batch(spark, corpus):
    asked = spark.createDataFrame([(1, "the of", "EN", 1), (2, "tour", "fr", 99), (3, "the", "zz", 5)], "request_id int, query string, language string, limit int")
    assert rows(search.search_batch(search.postings(corpus[0]), asked)) == [(1, 1, 1, 5, 2), (2, 1, 4, 1, 1)]


def test_summary(spark, corpus):
    a = corpus[0]
    assert articles.summary(a, "Python").first().asDict() == {"title": "Python", "page_type": "standard", "pageid": 1, "wikibase_item": "Q1", "description": "language", "extract": "A language.", "thumbnail_url": "http://p", "language": "en"}
    assert articles.summary(a, "Mercury").first()["page_type"] == "disambiguation" and articles.summary(a, "Tour", "fr").first()["page_type"] == "article"
    redirects = spark.createDataFrame([("en", "Py", "Python")], "lang string, title string, target string")
    assert articles.summary(a, "Py", redirects=redirects).first()["title"] == "Python"
    for title in ("Empty", "Missing"):
        with pytest.raises(params.NotFound) as e:
            articles.summary(a, title)
        assert e.value.reason == "not_found"


def test_articles(spark, corpus):
    a = corpus[0]
    assert articles.article(a, "Flat").first()["content"] == "no headings of"
    with pytest.raises(params.NotFound):
        articles.article(a, "Empty")
    asked = spark.createDataFrame([(1, "Python", "EN"), (2, "Empty", "en"), (3, "Nope", "en"), (4, "Python", "zz"), (5, None, "en")], "request_id int, title string, language string")
    assert [(r["request_id"], r["status"], r["content"] is not None) for r in articles.lookup(a, asked).orderBy("request_id").collect()] == [(1, "ok", True), (2, "no_content", False), (3, "not_found", False), (4, "invalid_language", False), (5, "not_found", False)]
    assert rows(articles.missing(a, asked).select("request_id")) == [(3,), (4,), (5,)]


def test_sections(spark, corpus):
    a, s, _ = corpus
    got = sections.table_of_contents(a, s, "Python").orderBy("index").collect()
    assert [(r["index"], r["number"], r["title"], r["level"], r["total_sections"]) for r in got] == [(1, "1", "History", 2, 2), (2, "1.1", "Origins", 3, 2)]
    derived = sections.table_of_contents(a, s.where("false"), "Python").collect()
    assert [(r["index"], r["number"], r["title"], r["level"]) for r in derived] == [(1, "1", "Use", 2)]
    with pytest.raises(params.NotFound) as e:
        sections.table_of_contents(a, s, "Flat")
    assert e.value.reason == "no_sections"
    with pytest.raises(params.NotFound) as e:
        sections.table_of_contents(a, s, "Missing")
    assert e.value.reason == "not_found"


def test_section(corpus):
    a, s, _ = corpus
    r = sections.section(a, s, "Python", 1).first()
    assert (r["section_title"], r["content"], r["content_type"]) == ("History", "== History ==\n\nx", "section")
    assert sections.section(a, s, "Python", 2).first()["section_title"] == "Section 2"
    for index in (0, -1, 9, 1.5):
        with pytest.raises(params.ValidationError) as e:
            sections.section(a, s, "Python", index)
        assert e.value.reason == "invalid_section"


def test_languages(spark, corpus):
    a, _, links = corpus
    got = languages.languages(a, links, "Python").collect()
    assert [(r["language_code"], r["total_languages"]) for r in got] == [("de", 2), ("fr", 2)]
    assert got[1]["url"] == "http://fr/x" and "de." in got[0]["url"] and got[0]["url"].endswith("Test_(Deutsch)")
    with pytest.raises(params.NotFound) as e:
        languages.languages(a, links, "Flat")
    assert e.value.reason == "no_other_languages"
    many = spark.createDataFrame([("en", "Python", f"x{i:03d}", "t", None) for i in range(600)], schemas.LANGLINKS)
    assert languages.languages(a, many, "Python").count() == 500


def _haversine(a, b, c, d):
    a, b, c, d = map(math.radians, (a, b, c, d))
    return 2 * 6371008.8 * math.asin(math.sqrt(min(1, math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2)))


def _tags(spark):
    rng = random.Random(3)
    at = [(lat, lon) for lat, lon in ((0, 0), (89.95, 10), (-89.99, -170), (52, 179.99), (52, -179.99), (0, 180)) for _ in range(60)]
    at = [(max(-90, min(90, lat + rng.uniform(-0.1, 0.1))), (lon + rng.uniform(-0.1, 0.1) + 180) % 360 - 180) for lat, lon in at]
    return at, spark.createDataFrame([("en", f"T{i}", i, float(x), float(y)) for i, (x, y) in enumerate(at)], schemas.GEOTAGS)


def test_nearby_everywhere(spark):
    at, tags = _tags(spark)
    points = [(0.0, 0.0), (89.97, 100.0), (-90.0, 0.0), (90.0, 0.0), (52.0, 180.0), (52.0, -180.0), (0.01, 179.99)]
    asked = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(points)], "point_id int, latitude double, longitude double")
    batch = {}
    for r in nearby.nearby_batch(tags, asked, 10_000, 50).collect():
        batch.setdefault(r["point_id"], []).append((r["distance_meters"], r["pageid"]))
    for i, (x, y) in enumerate(points):
        away = sorted((round(_haversine(x, y, *p), 1), k) for k, p in enumerate(at) if _haversine(x, y, *p) <= 10_000)[:50]
        assert sorted(batch.get(i, [])) == away
        assert [(r["distance_meters"], r["pageid"]) for r in nearby.nearby(tags, x, y, 10_000, 50).collect()] == away


def test_nearby_meta(spark):
    _, tags = _tags(spark)
    m = nearby.nearby_meta(tags, 0, 0, 99_999, 2).first()
    assert (m["radius_meters_used"], m["shown"], m["cap"], m["truncated"]) == (10_000, 2, 2, True)
    m = nearby.nearby_meta(tags, 45, 45).first()
    assert m["shown"] == 0 and not m["truncated"] and "radius_meters" in m["notice"]
    with pytest.raises(params.ValidationError) as e:
        nearby.nearby(tags, 91, 0, language="zz")
    assert e.value.reason == "invalid_coordinates"


def test_rendering(spark, corpus):
    a, s, links = corpus
    md = articles.summary(a, "Python").select(render.summaries()).first()[0]
    assert md == "# Python\n*language*\n**Type:** standard | **Language:** en\n**Page ID:** 1\n**Wikidata QID:** Q1\n**Thumbnail:** http://p\n\nA language."
    md = articles.summary(a, "Tour", "fr").select(render.summaries()).first()[0]
    assert md == "# Tour\n**Type:** article | **Language:** fr\n**Page ID:** 4\n\nUne tour."
    md = sections.section(a, s, "Python", 1).select(render.articles(True)).first()[0]
    assert md == "# Python\n**Type:** section | **Language:** en | **Page ID:** 1\n**Section:** History\n\n== History ==\n\nx"
    md = render.language_list(languages.languages(a, links.where("url IS NOT NULL"), "Python"), []).first()["markdown"]
    assert md == '## Language editions for "Python" (en)\n**1 languages available**\n\n- **fr**: [Python (langage)](http://fr/x)'
    toc = sections.contents(a, s).where("title = 'Python'").withColumnRenamed("lang", "language").select(render.contents()).first()[0]
    assert toc == "## Table of Contents — Python (en)\n2 sections | Page ID: 1\n\n1. **History** (index: 1, level: 2)\n  1.1. **Origins** (index: 2, level: 3)"
    tags = spark.createDataFrame([(1, "en", 1, "Needle", 7, 150.0, 47.6205, -122.0)], "r int, language string, rank int, title string, pageid long, distance_meters double, latitude double, longitude double")
    assert render.nearby_results(tags, ["r"]).first()["markdown"] == "**1 articles** (en)\n\n### Needle\n**Page ID:** 7 | **Distance:** 150m | **Coords:** (47.6205, -122)"


def test_plans_prune_and_push(corpus, tmp_path):
    from almanac.sources import corpus as files

    a = corpus[0]
    files.write(a, str(tmp_path / "a"), "articles")
    read = files.read(a.sparkSession, str(tmp_path / "a"), "articles")
    plan = articles.by_title(read, "Python", "EN").select("pageid")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(lang" in plan and "EqualTo(title,Python)" in plan and "ReadSchema: struct<title:string,pageid:bigint>" in plan
    assert rows(read.select(a.columns)) == rows(a)
    plan = search.search(read, "the of")._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
    for fmt in ("json", "csv", "orc"):
        files.write(a.where("title = 'Python'"), str(tmp_path / fmt), "articles", fmt)
        assert files.read(a.sparkSession, str(tmp_path / fmt), "articles", fmt).select("title", "pageid", "full_text").first()["full_text"] == ARTICLES[0][7]
