"""Quality rules with thresholds that the corpus itself sets, per language and source.

One pass counts, for each whole text, words, characters, symbols, repeated lines, repeated 8-word windows and words that
repeat the one before. Five rates of these (RATES, in thousandths) and two sizes go into sketches: histograms whose bins are
exact below 64 and then grow by a 32nd of their power of two, so a quantile is at most a 32nd too low, and sketches merge by
adding counts and do not depend on partitions.

A group's fence lies beyond a quartile of its own sketch by a multiple of a spread, which is the largest of the way from
the median to that quartile, the quartile's bin, and what one event (a symbol, a line, an 8-word window met again) adds to
the rate of a document of the group's median size. So every part of a fence comes from the group's sketches; quartiles
rather than outer quantiles, as up to a quarter of a source may be junk. To the sketch of a source, whatever its size, its
language's (the sum of its sources') adds the weight of PRIOR documents, and the sum of all adds as much to a language's: a
few odd documents move no fence, and a small source whose documents are alike sets its own. The thresholds, one row per
language and source, are then joined to the documents.

Defined cases: a null text has no words and fails the base rule; a null language or source is a group of its own; an
empty table gives no rows; repeated rows are judged alike, and counted each. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almanac.llm import tables, words

WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED = 30
#: The weight, in documents, of the next larger sketch in each.
PRIOR = 30
#: Thresholds of up to so many groups are broadcast.
SMALL_GROUPS = 100_000
#: Rate: numerator, denominator, what one event adds to the numerator (none for word length), and the fences in spreads below
#: the lower (None: no such fence) and above the upper quartile.
RATES = {
    "word_length": ("word_chars", "n_words", 0, 6, 8),
    "symbol_rate": ("n_symbols", "n_words", 1, None, 8),
    "dup_line_rate": ("n_dup_lines", "n_lines", 1, None, 3),
    "repeat_rate": ("n_repeat_words", "n_words", 2 * WINDOW, None, 4),
    "echo_rate": ("n_echoes", "n_words", 1, None, 10),
}
#: Counts whose medians are wanted.
SIZES = ("n_words", "n_lines")
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_echoes")


def _again(rows: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Rows (below 256) and hashes as one number each, so that one sort finds what repeats within a row."""
    return rows.astype(np.uint64) << np.uint64(56) | hashes >> np.uint64(8)


def measure(texts: words.Texts) -> dict[str, np.ndarray]:
    """COUNTS for each text; a piece of at most 256 texts."""
    w = texts.words(words.SPACED)
    n, o = len(texts), texts.offsets
    out = {"n_words": w.counts.astype(np.int64)}
    out["word_chars"] = words.totals(w.inside & (w.bytes & 0xC0 != 0x80), o)
    out["n_symbols"] = words.totals(_SYMBOL[w.bytes], o)

    at_break = np.flatnonzero(w.bytes == 10)
    begin = np.union1d(o[:-1][o[1:] > o[:-1]], at_break + 1)
    begin = begin[begin < len(w.bytes)].astype(np.int64)
    end = np.minimum(np.append(at_break, len(w.bytes))[np.searchsorted(at_break, begin)], o[np.searchsorted(o, begin, "right")]) if len(begin) else begin
    filled = np.searchsorted(w.starts, end) > np.searchsorted(w.starts, begin)
    begin, end = begin[filled], end[filled]
    row = np.searchsorted(o, begin, "right") - 1
    out["n_lines"] = np.bincount(row, minlength=n).astype(np.int64)
    key = np.sort(_again(row, w.spans(begin, end)))
    out["n_dup_lines"] = np.bincount((key[1:][key[1:] == key[:-1]] >> np.uint64(56)).astype(np.int64), minlength=n).astype(np.int64)

    h = w.hashes()
    echo = np.zeros(len(w), bool)
    echo[1:] = (h[1:] == h[:-1]) & (w.rows[1:] == w.rows[:-1])
    out["n_echoes"] = words.totals(echo, w.bounds)
    rolled, at = words.rolling(h, w.bounds, WINDOW)
    key = _again(w.rows[at], rolled)
    order = np.sort(key)
    twice = np.unique(order[1:][order[1:] == order[:-1]])
    covered = np.zeros(len(w) + 1, np.int32)
    if len(twice):
        place = np.minimum(np.searchsorted(twice, key), len(twice) - 1)
        first = at[twice[place] == key]
        np.add.at(covered, first, 1)
        np.add.at(covered, first + WINDOW, -1)
    out["n_repeat_words"] = words.totals(np.cumsum(covered[:-1]) > 0, w.bounds)
    return out


def _measured(keep: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in words.chunks(batch.column(keep)):
                m = measure(texts)
                same = batch.slice(texts.first, len(texts)).columns[:keep]
                yield pa.RecordBatch.from_arrays([*same, *[pa.array(m[c]) for c in COUNTS]], [*batch.schema.names[:keep], *COUNTS])

    return run


def counts(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns `keep` of docs (doc_id, lang, source, text, ...), and COUNTS of text."""
    tables.ship(docs.sparkSession)
    df = docs.select(*keep, F.col("text").alias("_whole_text"))
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields[:-1]], *[f"{c} long" for c in COUNTS]])
    return df.mapInArrow(_measured(len(keep)), schema)


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def rate(name: str) -> Column:
    a, b = RATES[name][:2]
    return F.expr(f"(1000 * {a}) div greatest({b}, 1)")


def bin_of(value: Column) -> Column:
    """The value's bin: itself below 64, else its power of two and the next five binary digits."""
    power = F.length(F.bin(value)) - 1
    return F.when(value < 64, value).otherwise(64 + (power - 6) * 32 + F.call_function("shiftright", value, power - 5) - 32).cast("long")


def bin_start(b: Column) -> Column:
    """The least value of a bin."""
    power = F.floor((b - 64) / 32).cast("int")
    return F.when(b < 64, b).otherwise(F.call_function("shiftleft", 32 + F.pmod(b - 64, F.lit(32)), power + 1)).cast("long")


def sketches(counted: DataFrame) -> DataFrame:
    """lang, source, rate, bin, n: the mergeable sketches of documents that pass the base rule; rates and sizes."""
    values = {r: rate(r) for r in RATES} | {c: F.col(c) for c in SIZES}
    rates = F.array(*[F.struct(F.lit(r).alias("rate"), bin_of(v).alias("bin")) for r, v in values.items()])
    sound = counted.where(~base_failed()).select("lang", "source", F.explode(rates).alias("r"))
    return sound.groupBy("lang", "source", "r.rate", "r.bin").agg(F.count("*").alias("n"))


def _listed(merged: DataFrame, keys: list[str], level: int) -> DataFrame:
    """Documents of each sketch, and its bins with their counts at this level (0: source, 1: language, 2: all); a sketch has a bounded number of bins."""
    counts = [F.when(F.lit(i == level), F.col("n")).otherwise(F.lit(0).cast("long")).alias(c) for i, c in enumerate("slz")]
    return merged.groupBy(*keys, "rate").agg(F.sum("n").alias("docs"), F.collect_list(F.struct("bin", *counts)).alias("bins"))


def _quartile(k: int, prior: int) -> Column:
    """The least bin until which there are k quarters of a group's documents, with those that larger sketches add; `bins` are in order."""
    start = "named_struct('s', 0L, 'l', 0L, 'z', 0L, 'bin', cast(null AS bigint))"
    weight = "double(a.s + b.s) + {p}D * (double(a.l + b.l) + {p}D * double(a.z + b.z) / z_docs) / (l_docs + {p}D)".format(p=prior)
    step = f"if(a.bin IS NULL AND 4D * ({weight}) >= {k}D * (s_docs + {prior}D), b.bin, a.bin)"
    return F.expr(f"aggregate(bins, {start}, (a, b) -> named_struct('s', a.s + b.s, 'l', a.l + b.l, 'z', a.z + b.z, 'bin', {step}), a -> a.bin)")


def thresholds(parts: DataFrame, groups: DataFrame, prior: int = PRIOR) -> DataFrame:
    """parts: sketches(), stored. groups: all (lang, source). One row per group, with <rate>_least and <rate>_most."""
    merged = {k: parts.groupBy(*k, "rate", "bin").agg(F.sum("n").alias("n")) for k in (("lang",), ())}
    levels = [(("lang", "source"), parts), *merged.items()]
    wanted = groups.select("lang", "source", F.explode(F.array(*[F.lit(r) for r in (*RATES, *SIZES)])).alias("rate"))
    for i, (keys, sketch) in enumerate(levels):
        q = _listed(sketch, list(keys), i).select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("rate").alias("_rate"), F.col("docs").alias(f"docs{i}"), F.col("bins").alias(f"bins{i}"))
        on = F.col("rate") == F.col("_rate")
        for k in keys:
            on = on & F.col(k).eqNullSafe(F.col(f"_{k}"))
        # the sketch of all is one row for each rate, of a bounded number of bins
        wanted = wanted.join(q if keys else F.broadcast(q), on, "left").drop("_rate", *[f"_{k}" for k in keys])
    docs = [F.coalesce(F.col(f"docs{i}").cast("double"), F.lit(0.0)) for i in range(3)]
    none = "cast(array() AS array<struct<bin: bigint, s: bigint, l: bigint, z: bigint>>)"
    bins = F.array_sort(F.concat(*[F.expr(f"coalesce(bins{i}, {none})") for i in range(3)]))
    wanted = wanted.select("lang", "source", "rate", docs[0].alias("s_docs"), docs[1].alias("l_docs"), docs[2].alias("z_docs"), bins.alias("bins"))
    wanted = wanted.select("lang", "source", "rate", *[_quartile(k, prior).alias(c) for k, c in ((1, "low"), (2, "middle"), (3, "high"))])
    at = lambda r, c: F.max(F.when(F.col("rate") == r, c))
    out = [at(r, bin_start(F.col(c))).alias(f"{r}_{c}") for r in (*RATES, *SIZES) for c in ("low", "middle", "high")]
    out += [at(r, bin_start(F.col(c) + 1) - bin_start(F.col(c))).alias(f"{r}_{c}_bin") for r in RATES for c in ("low", "high")]
    df = wanted.groupBy("lang", "source").agg(*out)
    fences = []
    for r, (_, size, event, below, above) in RATES.items():
        one = F.expr(f"1000 * {event} div greatest({size}_middle, 1)")
        if below is not None:
            fences.append((F.col(f"{r}_low") - below * F.greatest(F.col(f"{r}_middle") - F.col(f"{r}_low"), F.col(f"{r}_low_bin"), one)).alias(f"{r}_least"))
        fences.append((F.col(f"{r}_high") + above * F.greatest(F.col(f"{r}_high") - F.col(f"{r}_middle"), F.col(f"{r}_high_bin"), one)).alias(f"{r}_most"))
    return df.select("lang", "source", *fences)


def within() -> Column:
    """Whether a row with COUNTS is inside its group's thresholds; without thresholds (no sound document at all) it is."""
    ok = F.lit(True)
    for r, (_, _, _, below, _) in RATES.items():
        ok = ok & F.coalesce(rate(r) <= F.col(f"{r}_most"), F.lit(True))
        if below is not None:
            ok = ok & F.coalesce(rate(r) >= F.col(f"{r}_least"), F.lit(True))
    return ok


def judged(counted: DataFrame, prior: int = PRIOR, known: DataFrame | None = None) -> DataFrame:
    """counted: stored rows of counts() with lang and source. Adds the thresholds, base_failed and kept.

    known: thresholds() worked out before; else they come from `counted`.
    """
    if known is None:
        known = learned(counted, prior)
    t = tables.small(known, SMALL_GROUPS)
    t = t.withColumnsRenamed({"lang": "_lang", "source": "_source"})
    df = counted.join(t, counted["lang"].eqNullSafe(F.col("_lang")) & counted["source"].eqNullSafe(F.col("_source")), "left").drop("_lang", "_source")
    return df.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & within())


@tables.tidy
def learned(counted: DataFrame, prior: int = PRIOR) -> DataFrame:
    """The thresholds of all groups of `counted`, stored."""
    parts = tables.stored(sketches(counted), "quality-sketches")
    return tables.keep(tables.stored(thresholds(parts, counted.select("lang", "source").distinct(), prior), "quality-thresholds"))


def rules(docs: DataFrame, prior: int = PRIOR) -> DataFrame:
    """docs (doc_id, text, lang, source) to doc_id, lang, source, COUNTS, thresholds, base_failed and kept."""
    counted = tables.stored(counts(docs, ["doc_id", "lang", "source"]), "quality-counts")
    return judged(counted, prior)


def good_documents(docs: DataFrame, prior: int = PRIOR) -> DataFrame:
    """The rows of docs that rules() keeps, with their columns. Counts are taken again rather than joined: texts never move."""
    names = [f"_c{i}" for i in range(len(docs.columns))]
    counted = tables.stored(counts(docs, ["lang", "source"]), "quality-counts")
    known = learned(counted, prior)
    tables.drop(counted)
    renamed = docs.select(*[F.col(c).alias(n) for c, n in zip(docs.columns, names)], "lang", "source", "text")
    kept = judged(counts(renamed, [*names, "lang", "source"]), prior, known).where("kept")
    return kept.select(*[F.col(n).alias(c) for c, n in zip(docs.columns, names)])
