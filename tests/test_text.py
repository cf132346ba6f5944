import urllib.parse

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from almanac.functions import text


def one(spark, f, value):
    return spark.createDataFrame([(value,)], "c string").select(f(F.col("c"))).first()[0]


@pytest.mark.parametrize(
    "raw,clean",
    [
        ("sous le nom d&#039;« hôtel Nikko »&amp;more<b>highlight</b>", "sous le nom d'« hôtel Nikko »&morehighlight"),
        ('<span class="searchmatch">Python</span> is a <b>language</b>.', "Python is a language."),
        ("&amp;lt;", "<"),
        ("﻿  x　\n", "x"),
        ("a &apos;b&quot; <c", "a 'b\" <c"),
        ("", ""),
        (None, None),
    ],
)
def test_snippets(spark, raw, clean):
    assert one(spark, text.clean_snippet, raw) == clean


@pytest.mark.parametrize(
    "raw,plain",
    [
        ("== History ==\n\nPython was created in 1991 by Guido van Rossum.", "== History ==\n\nPython was created in 1991 by Guido van Rossum."),
        ("[[Link|Shown]] and [[Plain]]", "Shown and Plain"),
        ("x[[File:a.png|thumb|[[inner]] text]]y", "xy"),
        ("a{{t|{{u|{{v}}}}}}b", "ab"),
        ("a<ref name=x>y</ref>b<ref name=z />c", "abc"),
        ("'''bold''' ''it''", "bold it"),
        ("<nowiki>[[x]] '''y'''</nowiki>", "[[x]] '''y'''"),
        ("a<!-- x\n== y ==\nz -->b", "== y ==\n\nab"),
        ("a\n\n\n\nb", "a\n\nb"),
        ("History is told\n== History ==\nrest", "History is told\n\nrest"),
        ("[http://x.org shown] text", "shown text"),
    ],
)
def test_wikitext(spark, raw, plain):
    assert one(spark, text.strip_wikitext, raw) == plain


def test_headings(spark):
    raw = "intro\n== A ==\nx\n=== B b ===\ny\n== no =\n====== F ======\n== ==\n"
    found = one(spark, text.headings, raw)
    assert [(h["index"], h["number"], h["title"], h["level"]) for h in found if h["title"] in ("A", "B b", "F")] == [(1, "1", "A", 2), (2, "2", "B b", 3), (3, "3", "F", 6)]
    assert one(spark, text.headings, "none") == []
    # white space of the original pattern includes line breaks; the stricter pattern stays in its line
    assert [h["title"] for h in one(spark, text.headings, "==bad=\n==")] == ["bad="]
    assert one(spark, lambda c: text.headings(c, text.HEADING_LINE), "==bad=\n==") == []


def test_section_titles(spark):
    f = lambda c: text.section_title(c, F.lit(5))
    assert one(spark, f, "== History ==\n\ntext") == "History"
    assert one(spark, f, "Just plain text without a heading.") == "Section 5"


@settings(max_examples=1, deadline=None)
@given(st.lists(st.text(st.characters(min_codepoint=32, max_codepoint=0x2FFF, exclude_categories=["Cs"]), max_size=12), min_size=200, max_size=300))
def test_url_titles(spark, titles):
    titles += ["A B", "C++ (x)!", "a'b*c~d", "ä/é?&#%"]
    df = spark.createDataFrame([(t,) for t in titles], "c string").select("c", text.url_title(F.col("c")))
    for raw, encoded in df.collect():
        assert encoded == urllib.parse.quote(raw.replace(" ", "_"), safe="-_.!~*'()")


def test_small_functions(spark):
    assert one(spark, text.word_count, " a  b c\n") == 3 and one(spark, text.word_count, "  ") == 0 and one(spark, text.word_count, None) is None
    assert one(spark, text.lead, "Lead.\n\n== A ==\nx") == "Lead."
    assert [one(spark, lambda c: text.number_or(c, "2"), x) for x in ("7", None, "T-1")] == [7, 2, None]
    assert [one(spark, text.is_html, x) for x in (" \n<!doctype HTML>", "<html>", '{"a":"<html>"}', None)] == [True, True, False, False]
    assert one(spark, text.collapse_breaks, "a\n\n\n\n\nb\n\nc") == "a\n\nb\n\nc"
    assert one(spark, lambda c: text.article_url(F.lit("DE"), c), "Test (Deutsch)").endswith("/wiki/Test_(Deutsch)")


def test_snippets_keep_what_is_no_markup(spark):
    plain = "if a < b and c > d then stop, other things & the &lt; end"
    assert one(spark, lambda c: text.excerpt(c, ["then"]), plain) == plain
    marked = one(spark, lambda c: text.snippet(c, ["the", "then", "lt"]), plain)
    assert marked == 'if a &lt; b and c &gt; d <span class="searchmatch">then</span> stop, other things &amp; <span class="searchmatch">the</span> &amp;<span class="searchmatch">lt</span>; end'
    assert one(spark, text.clean_snippet, marked).startswith("if a < b and c > d then stop, other things & the ")


def test_templates_nest_to_any_depth(spark):
    deep = "".join("{{t%d|" % i for i in range(40)) + "x" + "}}" * 40
    assert one(spark, text.strip_wikitext, f"before {deep}after {{{{open") == "before after {{open"
