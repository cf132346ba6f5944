"""Queries over derived tables against their SQL, on texts that the smallest tables do not have."""

from collections import Counter

import duckdb
import pytest

from almanac.plans import registry


@pytest.mark.parametrize("name", ["section_read", "render_section", "section_requests"])
def test_short_lines(spark, tmp_path, name):
    """Lines that "Text: " begins with keep their heading, at both levels of headings."""
    lines = ["T", "Te", "Tex", "Text", "Text:", "Text: T", " T ", "A", "Tex.", "To", "Text: Text: Text: more"]
    texts = [x for line in lines for x in (line, f"first\n{line}")] + ["\n".join(lines), "", None, " \n "]
    docs = spark.createDataFrame([(i + 1, t, "en", "a", len(t or "")) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    docs.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    df = registry.QUERIES[name](spark, str(tmp_path))
    want = con.execute(f"SELECT {', '.join(df.columns)} FROM ({registry.ORACLES[name]})").fetchall()
    assert Counter(map(tuple, df.collect())) == Counter(want) and len(want) > 20


def _against_sql(spark, folder, name, texts):
    """Rows of a query and of its SQL over texts, each with an id and a language."""
    docs = spark.createDataFrame([(i, t, lang, "a", len(t)) for i, t, lang in texts], "doc_id long, text string, lang string, source string, n_chars long")
    docs.coalesce(1).write.parquet(f"{folder}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    df = registry.QUERIES[name](spark, str(folder))
    want = con.execute(f"SELECT {', '.join(df.columns)} FROM ({registry.ORACLES[name]})").fetchall()
    return Counter(map(tuple, df.collect())), Counter(want)


@pytest.mark.parametrize("name", ["section_read", "render_section", "section_requests"])
def test_markup_in_lines(spark, tmp_path, name):
    """A line's markup is text, at both levels of headings and alone; spaces of any width are spaces."""
    lines = [
        "a [[link|shown]] b", "[[x]]", "{{t|u}} v", "x {| y |} z", "it's ''so'' '''bold'''", "''", "a <b>c</b> <ref>d</ref><ref name=e/> f", "[http://x.org y] z", "some words <nowiki>''q''</nowiki> r </NOWIKI > s <nowiki/>",
        "some long words\r== no heading == === nor this ===\x85== x", "Te [[x]]", "Text: [[x]]", "= x", "x =", " 　", " wide ", "　 twelve signs 　and more", "a\tb ​c", "{", "<", "\U0001f468‍\U0001f469‍\U0001f467 family of signs", r"\1 $1 \n",
    ]
    texts = [x for line in lines for x in (line, f"first\n{line}")] + ["\n".join(lines)]
    got, want = _against_sql(spark, tmp_path, name, [(i + 1, t, "en") for i, t in enumerate(texts)])
    assert got == want and want.total() > 20


@pytest.mark.parametrize("name", ["section_read", "render_section", "render_article"])
def test_without_language_or_id(spark, tmp_path, name):
    """A record without language or title has no markdown, as in SQL."""
    got, want = _against_sql(spark, tmp_path, name, [(1, "a line\nanother", "en"), (2, "a line\nanother", None), (None, "a line", "en"), (3, "a line", "")])
    assert got == want and want.total() >= 4
