"""Text functions, Column to Column. All stay inside the JVM."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Host of the editions and its path of articles (fixed values).
HOST, ARTICLE_PATH = "wikipedia.org", "/wiki/"
#: Character references that are decoded, in this order (fixed values).
ENTITIES = (("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#039;", "'"), ("&apos;", "'"))
#: Headings: the marker, and the title between two equal markers (fixed pattern).
HEADING = r"(?m)^(={2,6})\s*(.+?)\s*\1\s*$"
#: The same, but a heading does not reach into the next line.
HEADING_LINE = r"(?m)^(={2,6})[ \t]*(\S(?:.*?\S)?)[ \t]*\1[ \t]*$"
TOKEN = r"[\p{L}\p{N}]+"
#: Letters of scripts that put no spaces between words: Thai, Lao, Burmese, Khmer, kana and Han.
SPACELESS = r"\x{0E00}-\x{0EFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{3005}-\x{3007}\x{3040}-\x{30FA}\x{30FC}-\x{30FF}\x{31F0}-\x{31FF}\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}\x{FF66}-\x{FF9F}\x{20000}-\x{3FFFF}"

_SPACELESS_START = re.compile("[" + re.sub(r"\\x\{([0-9A-F]+)\}", lambda m: chr(int(m[1], 16)), SPACELESS) + "]")


def strip_tags(c: Column) -> Column:
    return F.regexp_replace(c, r"<[^>]+>", "")


def decode_entities(c: Column) -> Column:
    """One after another, so what one decodes another may decode again."""
    for name, sign in ENTITIES:
        c = F.replace(c, F.lit(name), F.lit(sign))
    return c


def trim(c: Column) -> Column:
    """Without leading and trailing white space of any alphabet, or byte order marks."""
    return F.regexp_replace(c, r"(?U)\A[\s\uFEFF]+|[\s\uFEFF]+\z", "")


def clean_snippet(c: Column) -> Column:
    return trim(decode_entities(strip_tags(c)))


def strip_comments(c: Column) -> Column:
    return F.regexp_replace(c, r"<!--[\s\S]*?-->", "")


def collapse_breaks(c: Column) -> Column:
    return F.regexp_replace(c, r"\n{3,}", "\n\n")


def _plain(c: Column) -> Column:
    """Markup of links, templates, references and emphasis reduced to its text."""
    c = F.regexp_replace(c, r"(?i)<ref[^>]*/>|<ref[^>]*>[\s\S]*?</ref>", "")
    c = let(c, _without_templates)
    c = F.regexp_replace(c, r"\{\|[\s\S]*?\|\}", "")
    c = F.regexp_replace(c, r"(?i)\[\[(?:File|Image):(?:[^\[\]]|\[\[[^\[\]]*\]\])*\]\]", "")
    c = F.regexp_replace(c, r"\[\[(?:[^\[\]|]*\|)?([^\[\]]*)\]\]", "$1")
    c = F.regexp_replace(c, r"\[https?://[^\s\]]+\s*([^\]]*)\]", "$1")
    c = F.regexp_replace(c, r"'{2,5}", "")
    c = F.regexp_replace(c, r"</?[A-Za-z][^>]*>", "")
    return F.regexp_replace(c, HEADING, "")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value worked out once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _without_templates(c: Column) -> Column:
    """Templates go from the innermost out; a text cannot nest them deeper than it opens them."""
    step = lambda a, _: F.when(F.contains(a, F.lit("{{")) & F.contains(a, F.lit("}}")), F.regexp_replace(a, r"\{\{[^{}]*\}\}", "")).otherwise(a)
    opened = F.size(F.regexp_extract_all(c, F.lit(r"\{\{"), F.lit(0)))
    return F.when(F.contains(c, F.lit("{{")), F.aggregate(F.sequence(F.lit(1), opened), c, step)).otherwise(c)


def strip_wikitext(c: Column) -> Column:
    """Section markup as plain text: what <nowiki> holds stays, and all headings stand first, unless the text begins with
    the first one's title. Headings are taken from the raw markup, so those inside comments count."""
    parts = F.split(c, r"(?i)</?nowiki\s*/?>")
    body = trim(F.array_join(F.transform(parts, lambda x, i: F.when(i % 2 == 0, _plain(x)).otherwise(x)), ""))

    def joined(both: Column) -> Column:
        found, plain = both["found"], both["body"]
        marks = F.array_join(F.transform(found, lambda h: F.concat(F.repeat(F.lit("="), h["level"]), F.lit(" "), h["title"], F.lit(" "), F.repeat(F.lit("="), h["level"]))), "\n\n")
        first = F.get(found, F.lit(0))["title"]
        return F.when((F.size(found) > 0) & ~F.startswith(plain, first), F.concat(marks, F.lit("\n\n"), plain)).otherwise(plain)

    full = let(F.struct(headings(c).alias("found"), body.alias("body")), joined)
    return trim(collapse_breaks(strip_comments(full)))


def headings(c: Column, pattern: str = HEADING) -> Column:
    """array<struct<index int, number string, title string, level int>> of a text's headings, numbered from 1."""
    marks, titles = F.regexp_extract_all(c, F.lit(pattern), F.lit(1)), F.regexp_extract_all(c, F.lit(pattern), F.lit(2))
    both = F.arrays_zip(marks.alias("mark"), titles.alias("title"))
    full = F.filter(both, lambda h: (h["mark"] != "") & (h["title"] != ""))
    return F.transform(full, lambda h, i: F.struct((i + 1).alias("index"), (i + 1).cast("string").alias("number"), h["title"].alias("title"), F.length(h["mark"]).alias("level")))


def section_title(wikitext: Column, index: Column) -> Column:
    first = F.regexp_extract(wikitext, r"(?m)^={2,6}\s*(.+?)\s*={2,6}", 1)
    return F.coalesce(F.nullif(first, F.lit("")), F.concat(F.lit("Section "), index.cast("string")))


def url_title(title: Column) -> Column:
    """A title as a URL's path segment: underscores for spaces, then percent-encoding that leaves A-Z a-z 0-9 - _ . ! ~ * ' ( )."""
    c = F.url_encode(F.replace(title, F.lit(" "), F.lit("_")))
    for code, sign in (("+", "%20"), ("%21", "!"), ("%27", "'"), ("%28", "("), ("%29", ")"), ("%7E", "~")):
        c = F.replace(c, F.lit(code), F.lit(sign))
    return c


def article_url(lang: Column, title: Column) -> Column:
    return F.concat(F.lit("https://"), F.lower(lang), F.lit(f".{HOST}{ARTICLE_PATH}"), url_title(title))


def number_or(c: Column, default: str) -> Column:
    """A decimal text as an integer; what is no number is null, what is absent is the default."""
    return F.coalesce(c, F.lit(default)).try_cast("int")


def is_html(body: Column) -> Column:
    """Whether a body is an HTML page where JSON was asked for."""
    return F.coalesce(body.rlike(r"(?i)\A\s*<(!DOCTYPE html|html)"), F.lit(False))


def word_count(c: Column) -> Column:
    t = trim(c)
    return F.when(t == "", 0).otherwise(F.size(F.split(t, r"(?U)\s+"))).cast("long")


def lead(c: Column) -> Column:
    """The text before the first heading."""
    return trim(F.get(F.split(c, r"(?m)^={2,6}[^=]", 2), F.lit(0)))


def tokens(c: Column) -> Column:
    """Runs of letters and digits, lower-cased. Where a script puts no spaces, every letter and every two neighbours are tokens."""
    pairs = lambda t: F.transform(F.sequence(F.lit(1), F.greatest(F.length(t) - 1, F.lit(1))), lambda i: t.substr(i, F.lit(2)))
    letters = lambda t: F.when(F.length(t) > 1, F.split(t, "")).otherwise(F.array().cast("array<string>"))
    cut = lambda t: F.when(t.rlike(f"^[{SPACELESS}]"), F.concat(letters(t), pairs(t))).otherwise(F.array(t))
    runs = rf"[{SPACELESS}]+|[\p{{L}}\p{{N}}&&[^{SPACELESS}]]+"
    mixed = lambda low: F.flatten(F.transform(F.regexp_extract_all(low, F.lit(runs), F.lit(0)), cut))
    return let(F.lower(c), lambda low: F.when(low.rlike(f"[{SPACELESS}]"), mixed(low)).otherwise(F.regexp_extract_all(low, F.lit(TOKEN), F.lit(0))))


def query_terms(c: Column) -> Column:
    """Distinct tokens a query asks for: of a run without spaces the neighbours, and a letter only if it stands alone."""
    low = F.lower(c)
    runs = F.regexp_extract_all(low, F.lit(rf"[{SPACELESS}]+|[\p{{L}}\p{{N}}&&[^{SPACELESS}]]+"), F.lit(0))
    pairs = lambda t: F.transform(F.sequence(F.lit(1), F.greatest(F.length(t) - 1, F.lit(1))), lambda i: t.substr(i, F.lit(2)))
    return F.array_distinct(F.flatten(F.transform(runs, lambda t: F.when(t.rlike(f"^[{SPACELESS}]"), pairs(t)).otherwise(F.array(t)))))


def excerpt(c: Column, terms: list[str], before: int = 60, width: int = 160) -> Column:
    """A piece of a plain text around the first term."""
    return F.substring(c, F.greatest(F.lit(1), F.instr(F.lower(c), terms[0]) - before), F.lit(width))


def snippet(c: Column, terms: list[str], before: int = 60, width: int = 160) -> Column:
    """An excerpt as markup: the plain text's signs escaped, and whole words that are terms marked."""
    word = r"(?<![\p{L}\p{N}])(%s)(?![\p{L}\p{N}])"
    spaced = [t for t in terms if t and not re.match(_SPACELESS_START, t)]
    free = [t for t in terms if t and re.match(_SPACELESS_START, t)]
    piece = excerpt(c, terms, before, width)
    for some, pattern in ((spaced, word), (free, "(%s)")):
        if some:  # private signs stand for the marks until all else is escaped
            piece = F.regexp_replace(piece, "(?iu)" + pattern % "|".join(sorted(some, key=len, reverse=True)), "\ue000$1\ue001")
    for sign, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        piece = F.replace(piece, F.lit(sign), F.lit(name))
    return F.replace(F.replace(piece, F.lit("\ue000"), F.lit('<span class="searchmatch">')), F.lit("\ue001"), F.lit("</span>"))
