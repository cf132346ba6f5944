"""Verdicts on URLs from a policy and a list, through a blocked Bloom filter and an exact hash join. DataFrame functions only.

A rule of the policy is a host, which stands for its subdomains too, and the beginning of a path, compared as they are
written. An entry of the list is a URL, likewise the beginning of those it stands for, but compared in canonical form:
without user, port and trailing dots of the host, with escapes of plain characters undone and dot segments and doubled
slashes resolved. The list is a table of any length (see listed_table); where no rule of the policy fits, it blocks.

All keys, the hosts and the whole URLs of rules and entries, go into one blocked Bloom filter: a key's hash names a block of
64 bits and four bits in it. Blocks are packed into arrays of CHUNK blocks, and broadcast if they take at most tables.MOST_BYTES
(33 million keys); a longer list is joined without a filter, as one that itself had to be shuffled would spare nothing. A URL
asks for its host's last labels, as many as some rule's host has; those that pass the filter are joined exactly with the
known hosts. Only for these are the lengths that the host's paths have cut from the URL's path; what passes the filter is
again joined exactly, which removes the false positives. The longest rule wins.

Defined cases: a null URL, or one without `://`, has an empty host and path, fits no rule and gets the default verdict;
repeated rows are all judged alike; among rules of equal length the one with more labels wins, then the smaller text; the
same rule with both verdicts blocks; an empty table gives no rows. Columns besides id and url are not read.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.llm import tables

#: (verdict, rule): the policy of the query.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
#: The method's own list: hosts whose pages are blocked where no rule speaks.
LISTED = ("cheap-pills.example.com/", "spam-farm.example.org/", "casino-win.example.net/", "free-download.example.com/")
DEFAULT = "allow"
BITS_PER_KEY = 16
#: Blocks of one row of the packed filter.
CHUNK = 4096
SMALL_RULES = 200_000
SMALL_HITS = 100_000
_PLAIN = "^[A-Za-z0-9._~-]$"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_table(spark: SparkSession, rules: Iterable[tuple[str, str]], listed: Iterable[str] = ()) -> DataFrame:
    """One row per rule: rule, verdict, listed (from the method's list, not the policy)."""
    rows = [(r, v, False) for v, r in rules] + [(r, "block", True) for r in listed]
    return spark.createDataFrame(rows, "rule string, verdict string, listed boolean")


def canonical_host(host: Column) -> Column:
    """Without user, port and trailing dots."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(host, r"(?s)\A.*@", ""), r":[0-9]*\z", ""), r"\.+\z", "")


def _unescaped(path: Column) -> Column:
    def one(x: Column, i: Column) -> Column:
        code = F.char(F.conv(x.substr(1, 2), 16, 10).cast("int"))
        kept = F.when(code.rlike(_PLAIN), code).otherwise(F.concat(F.lit("%"), F.upper(x.substr(1, 2))))
        return F.when(i == 0, x).when(x.rlike("^[0-9A-Fa-f]{2}"), F.concat(kept, x.substr(F.lit(3), F.length(x)))).otherwise(F.concat(F.lit("%"), x))

    return F.when(path.contains("%"), F.array_join(F.transform(F.split(path, "%"), one), "")).otherwise(path)


def _resolved(path: Column) -> Column:
    step = lambda a, x: F.when(x.isin("", "."), a).when(x == "..", F.regexp_replace(a, r"/[^/]*\z", "")).otherwise(F.concat(a, F.lit("/"), x))
    segments = F.split(path, "/")
    closing = F.when(F.element_at(segments, -1).isin("", ".", ".."), F.lit("/")).otherwise(F.lit(""))
    return F.when(path.rlike(r"//|/\."), F.concat(F.aggregate(segments, F.lit(""), step), closing)).otherwise(path)


def canonical_path(path: Column) -> Column:
    """Escapes of plain characters undone, others in upper case; dot segments and doubled slashes resolved. An empty path stays empty."""
    return _resolved(_unescaped(path))


def listed_table(spark: SparkSession, path: str) -> DataFrame:
    """The list in a file or folder of text, one URL prefix (host/path) a line; lines that are empty or start with # are left out."""
    line = F.trim("value")
    return spark.read.text(path).where((line != "") & ~line.startswith("#")).select(line.alias("rule"), F.lit("block").alias("verdict"), F.lit(True).alias("listed"))


def keyed(rules: DataFrame) -> DataFrame:
    """rules with listed, host, path, labels and path_length. A rule without a slash, or with an empty host, is refused when read."""
    slash = F.instr("rule", "/")
    checked = F.when(slash > 1, F.col("rule")).otherwise(F.raise_error(F.concat(F.lit("a rule is host/path: "), F.coalesce("rule", F.lit("null")))))
    df = rules.withColumn("rule", checked)
    host, path = F.translate(F.substring_index("rule", "/", 1), _UPPER, _LOWER), F.expr("substr(rule, instr(rule, '/'))")
    df = df.withColumn("host", F.when(F.col("listed"), canonical_host(host)).otherwise(host)).withColumn("path", F.when(F.col("listed"), canonical_path(path)).otherwise(path))
    df = df.groupBy("listed", "host", "path").agg(F.min(F.struct((F.col("verdict") != "block").alias("allows"), "rule", "verdict")).alias("r"))
    return df.select("listed", "host", "path", "r.rule", "r.verdict", F.size(F.split("host", r"\.")).alias("labels"), F.length("path").alias("path_length"))


def _host_key(listed: Column, host: Column) -> Column:
    return F.xxhash64(listed, host)


def _key(listed: Column, host: Column, path: Column) -> Column:
    return F.xxhash64(listed, host, F.lit("/"), path)


def _mask(key: Column) -> Column:
    """Four bits of a 64-bit block."""
    bits = [F.expr(f"shiftleft(1L, int(pmod(shiftrightunsigned(_k, {s}), 64)))") for s in (0, 6, 12, 18)]
    out = bits[0]
    for b in bits[1:]:
        out = out.bitwiseOR(b)
    return out


def _block(blocks: int) -> Column:
    return F.expr(f"pmod(xxhash64(_k), {blocks}L)")


def bloom(keys: DataFrame, blocks: int) -> DataFrame:
    """keys (_k) to the filter's non-empty blocks: block, bits."""
    return keys.withColumns({"block": _block(blocks), "mask": _mask(F.col("_k"))}).groupBy("block").agg(F.bit_or("mask").alias("bits"))


def packed(bits: DataFrame, blocks: int) -> DataFrame:
    """bloom()'s blocks as rows of CHUNK blocks each: chunk, words."""
    every = bits.sparkSession.range(blocks).select(F.col("id").alias("block"), F.lit(0).cast("long").alias("bits")).union(bits.select("block", "bits"))
    full = every.groupBy("block").agg(F.max_by("bits", F.abs(F.signum("bits"))).alias("bits"))
    words = F.transform(F.array_sort(F.collect_list(F.struct("block", "bits"))), lambda x: x["bits"])
    return full.groupBy(F.expr(f"block div {CHUNK}").alias("chunk")).agg(words.alias("words"))


def _possible(asked: DataFrame, filter_rows: DataFrame | None, blocks: int) -> DataFrame:
    """Rows of asked (_k, ...) whose key may be in the filter; all, where there is none."""
    if filter_rows is None:
        return asked
    df = asked.withColumns({"block": _block(blocks), "_m": _mask(F.col("_k"))})
    df = df.withColumns({"chunk": F.expr(f"block div {CHUNK}"), "_at": F.expr(f"int(block % {CHUNK}) + 1")})
    met = F.element_at("words", F.col("_at")).bitwiseAND(F.col("_m")) == F.col("_m")
    return df.join(F.broadcast(filter_rows), "chunk").where(met).select(*asked.columns)


def _tails(host: Column, labels: list[int], listed: bool) -> list[Column]:
    """The host's last labels, for each number of labels that some rule's host has."""
    parts = F.split(host, r"\.")
    return [F.when(F.size(parts) >= n, F.struct(F.lit(listed).alias("listed"), F.array_join(F.slice(parts, -n, n), ".").alias("h"))) for n in labels]


@tables.tidy
def judge(urls: DataFrame, rules: DataFrame, default: str = DEFAULT) -> DataFrame:
    """urls (id, url) to id, host, path, rule (null if none of the policy fits) and verdict. rules: see rule_table() and listed_table()."""
    known = tables.stored(keyed(rules), "url-rules")
    n = known.count()
    pages = urls.select("id", "url").withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    if not n:
        return pages.select("id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    hosts = tables.stored(known.groupBy("listed", "host").agg(F.sort_array(F.collect_set("path_length")).alias("lengths")), "url-hosts")
    keys = known.select(_key(F.col("listed"), F.col("host"), F.col("path")).alias("_k")).union(hosts.select(_host_key(F.col("listed"), F.col("host"))))
    blocks = max(1, -(-2 * n * BITS_PER_KEY // 64))
    bits = tables.stored(packed(bloom(keys, blocks), blocks), "url-bloom") if 8 * blocks <= tables.MOST_BYTES else None

    # numbers of labels: at most as many as a host can have
    labels = {own: sorted(r.labels for r in known.where(F.col("listed") == own).select("labels").distinct().collect()) for own in (False, True)}
    tails = _tails(F.col("host"), labels[False], False) + _tails(canonical_host(F.col("host")), labels[True], True)
    asked = pages.select("id", "url", "host", "path", F.explode(F.array_compact(F.array(*tails))).alias("c")).select("id", "url", "path", "c.listed", "c.h")
    asked = _possible(asked.withColumn("_k", _host_key(F.col("listed"), F.col("h"))), bits, blocks)
    near = tables.small(hosts, SMALL_RULES).select(F.col("listed").alias("_listed"), F.col("host").alias("_host"), "lengths")
    of_known = asked.join(near, (F.col("listed") == F.col("_listed")) & (F.col("h") == F.col("_host")))
    of_known = of_known.withColumn("p", F.when(F.col("listed"), canonical_path(F.col("path"))).otherwise(F.col("path")))
    cut = of_known.select("id", "url", "listed", "h", "p", F.explode(F.filter("lengths", lambda x: x <= F.length("p"))).alias("_n"))
    cut = cut.select("id", "url", "listed", "h", F.col("p").substr(F.lit(1), F.col("_n")).alias("p"))
    possible = _possible(cut.withColumn("_k", _key(F.col("listed"), F.col("h"), F.col("p"))), bits, blocks)
    exact = tables.small(known, SMALL_RULES).select("listed", F.col("host").alias("h"), F.col("path").alias("p"), "rule", "verdict", "labels")
    hits = possible.join(exact, ["listed", "h", "p"])
    # policy before list, then the longest rule; ties by labels, then by text
    best = F.min(F.struct("listed", (-F.length("rule")).alias("l"), (-F.col("labels")).alias("n"), "rule", "verdict")).alias("best")
    verdicts = tables.keep(tables.stored(hits.groupBy("id", "url").agg(best).select(F.col("id").alias("_id"), F.col("url").alias("_url"), "best"), "url-hits"))
    judged = pages.join(tables.small(verdicts, SMALL_HITS), pages["id"].eqNullSafe(F.col("_id")) & pages["url"].eqNullSafe(F.col("_url")), "left")
    return judged.select("id", "host", "path", F.when(~F.col("best.listed"), F.col("best.rule")).alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
