"""Mixing sources to target weights, by a multivariate-hypergeometric splitting tree. DataFrame functions only.

Documents of a source are dealt by a hash of doc_id into blocks (a power of two of them, of about DOCS_PER_BLOCK
documents). A source with target t and size s gives its floor(t / s) full passes and then its first blocks up to the
remaining words; the block at which they end gives documents in hash order, the last of them in part. These block
instances are the source's quota. A tree over the output shards halves the shards again and again: at each node an urn
holds a ball for each block instance of every source, and the left half draws its share of them without replacement, by a
keyed hash that differs at every node. So the quotas of a shard are a multivariate-hypergeometric draw, and those of all
shards add up to each source's quota. Each source's instances, permuted by another keyed hash, then fill the shards'
quotas one after another, so the draws of different shards are disjoint. Within a shard rows are ordered by a third hash.

A node's draw is a ranking of its balls by key; with more than MANY_BALLS in all, in parts that tasks share, with the same
result. Shards follow the corpus: one for every WORDS_PER_SHARD words, as a power of two, LEAST_SHARDS at least. Balls are rows, one
for about DOCS_PER_BLOCK documents and pass; documents meet the plan by their source and block, and nothing else is
gathered but a block's documents where a source's words end.

Defined cases: a null text has size 0; a null source is a source of its own, last in order; a source without words has
target 0; an empty table gives no rows; repeated rows of one doc_id are drawn alike (in the block where a source's words
end they share what is drawn); a null doc_id is a doc_id like others. Columns besides those named are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from almanac.llm import tables

WEIGHTS = (1, 2, 3)
CAP = 3.0
LEAST_SHARDS = 64
WORDS_PER_SHARD = 1 << 25
DOCS_PER_BLOCK = 512
SEED = 20011
#: Plans of up to so many sources, and of so many blocks, are broadcast.
SMALL_SOURCES = 20_000
SMALL_BLOCKS = 500_000
#: More balls than this are ranked in parts, by the first PART_BITS bits of their keys, rather than a node in one task.
MANY_BALLS, PART_BITS = 2_000_000, 12


def words_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(tables.WORD)), F.lit(0)).cast("long")


def _keyed(*parts: Column | str) -> Column:
    """60 bits of the parts, and the seed, that SQL elsewhere can work out too."""
    text = [F.lit(x) if isinstance(x, str) else F.coalesce(x.cast("string"), F.lit("null")) for x in parts]
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(SEED)), *text)), 1, 15), 16, 10).cast("long")


def _hash(doc_id: Column) -> Column:
    return _keyed(doc_id)


def shards_for(words: int) -> int:
    """One for every WORDS_PER_SHARD words, as a power of two."""
    return max(LEAST_SHARDS, 1 << max(0, -(-words // WORDS_PER_SHARD) - 1).bit_length())


def targets(sizes: DataFrame, weights=WEIGHTS, cap: float = CAP) -> DataFrame:
    """sizes: one row per source (source, source_size, n_docs). Adds ord, weight and target.

    The level to which uncapped sources are filled, per weight, is found in the order of cap * size / weight: it is what
    resharing the excess again and again arrives at.
    """
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("ord") - 1) % len(weights) + 1).cast("int"))
    df = sizes.withColumn("ord", F.row_number().over(ordered)).withColumn("weight", weight)
    df = df.withColumn("most", F.col("source_size") * F.lit(float(cap))).withColumn("ratio", F.col("most") / F.col("weight"))
    rising = Window.orderBy("ratio", "ord")
    everything = Window.partitionBy()
    capped = F.coalesce(F.sum("most").over(rising.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    open_weight = F.sum("weight").over(rising.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    df = df.withColumn("level", (F.sum("source_size").over(everything) - capped) / open_weight)
    df = df.withColumn("level", F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "ord", "level"))).over(everything)["level"])
    return df.withColumn("target", F.least("most", F.col("level") * F.col("weight"))).drop("most", "ratio", "level")


def _ranked(df: DataFrame, by: list[str], ties: list[str], wide: bool) -> DataFrame:
    """df with n, the rows of each group `by`, and drawn, their places in it by `key` and `ties`.

    wide: groups may be large, so they are ranked in parts by the key's first bits; places are the same.
    """
    group = Window.partitionBy(*by)
    if not wide:
        return df.withColumns({"n": F.count("*").over(group), "drawn": F.row_number().over(group.orderBy("key", *ties)).cast("long")})
    df = tables.stored(df.withColumn("part", F.expr(f"shiftright(key, {60 - PART_BITS})")), "mix-balls")
    sizes = df.groupBy(*by, "part").agg(F.count("*").alias("many"))
    sizes = sizes.withColumns({"n": F.sum("many").over(group), "before": F.coalesce(F.sum("many").over(group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))})
    own = F.row_number().over(Window.partitionBy(*by, "part").orderBy("key", *ties))
    return df.join(sizes.drop("many"), [*by, "part"]).withColumn("drawn", F.col("before") + own).drop("before", "part")


def _split(balls: DataFrame, wide: bool = False) -> DataFrame:
    """balls (lo, hi, ord, i) of the nodes of one level, by their shards lo to hi - 1: each goes to its node's left or right half. A node of one shard stays."""
    df = balls.withColumn("mid", F.expr("if(hi - lo > 1, (lo + hi) div 2, hi)")).withColumn("key", _keyed(F.lit("urn"), F.col("lo"), F.col("hi"), F.col("ord"), F.col("i")))
    df = _ranked(df, ["lo", "hi"], ["ord", "i"], wide)
    # the left half's share of the balls, rounded
    left = F.expr("drawn <= (2 * n * (mid - lo) + (hi - lo)) div (2 * (hi - lo))")
    return df.select(F.when(left, F.col("lo")).otherwise(F.col("mid")).cast("int").alias("lo"), F.when(left, F.col("mid")).otherwise(F.col("hi")).cast("int").alias("hi"), "ord", "i")


def quotas(sources: DataFrame, shards: int, wide: bool = False) -> DataFrame:
    """sources (ord, instances) to ord, shard, quota: how many block instances of each source every shard gets, where any."""
    balls = sources.select(F.lit(0).alias("lo"), F.lit(shards).alias("hi"), "ord", F.explode(F.expr("sequence(1L, instances)")).alias("i"))
    for _ in range(math.ceil(math.log2(max(1, shards)))):
        balls = _split(balls, wide)
    return balls.groupBy("ord", F.col("lo").alias("shard")).agg(F.count("*").alias("quota"))


def places(sources: DataFrame, quota: DataFrame, wide: bool = False) -> DataFrame:
    """sources (ord, blocks, instances) and quotas() to ord, block, at: an array of (pass, shard, quota) of the block's instances."""
    upto = F.sum("quota").over(Window.partitionBy("ord").orderBy("shard").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    slots = quota.withColumn("upto", upto).select("ord", "shard", "quota", F.explode(F.expr("sequence(upto - quota + 1, upto)")).alias("drawn"))
    every = sources.select("ord", "blocks", F.explode(F.expr("sequence(0L, instances - 1)")).alias("instance"))
    every = every.withColumn("key", _keyed(F.lit("order"), F.col("ord"), F.col("instance")))
    filled = _ranked(every, ["ord"], ["instance"], wide).join(slots, ["ord", "drawn"])
    at = F.struct(F.expr("instance div blocks").alias("pass"), "shard", "quota")
    return filled.groupBy("ord", F.expr("instance % blocks").alias("block")).agg(F.array_sort(F.collect_list(at)).alias("at"))


def plan(sized: DataFrame, weights=WEIGHTS, cap: float = CAP, shards: int | None = None) -> tuple[DataFrame, DataFrame, DataFrame, int]:
    """sized: stored rows (doc_id, source, size). Returns, stored, one row per source, the places of each block, what boundary documents give, and the number of shards.

    Columns of a source: ord, source, source_size, target, passes, blocks, cut_block (blocks before it join the partial
    pass whole), need (words from cut_block), instances.
    """
    shards = shards or shards_for(sized.agg(F.sum("size")).first()[0] or 0)
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    src = targets(sizes, weights, cap)
    quota = F.round("target").cast("long")
    src = src.withColumn("passes", F.when(F.col("source_size") > 0, F.floor(quota / F.greatest("source_size", F.lit(1)))).otherwise(0).cast("long"))
    src = src.withColumn("rest", quota - F.col("passes") * F.col("source_size"))
    power = F.ceil(F.log2(F.greatest(F.col("n_docs") / DOCS_PER_BLOCK, F.lit(1.0))))
    src = src.withColumn("blocks", F.pow(F.lit(2.0), power).cast("long"))
    src = tables.stored(src.drop("weight", "n_docs"), "mix-sources")
    near = tables.small(src, SMALL_SOURCES)
    dealt = sized.join(near.select(F.col("source").alias("its"), "ord", "blocks", "rest"), sized["source"].eqNullSafe(F.col("its"))).withColumn("h", _hash(F.col("doc_id"))).withColumn("block", F.pmod("h", "blocks"))

    per_block = dealt.groupBy("ord", "rest", "block").agg(F.sum("size").alias("words"))
    in_order = Window.partitionBy("ord").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    per_block = per_block.withColumn("until", F.sum("words").over(in_order))
    cut = per_block.where((F.col("until") > F.col("rest")) & (F.col("until") - F.col("words") <= F.col("rest")) & (F.col("words") > 0))
    cut = cut.select("ord", F.col("block").alias("cut_block"), (F.col("rest") - F.col("until") + F.col("words")).alias("need"))
    src = src.join(cut, "ord", "left").withColumns({"cut_block": F.coalesce("cut_block", F.lit(0)), "need": F.coalesce("need", F.lit(0))})
    src = src.withColumn("instances", F.col("passes") * F.col("blocks") + F.when(F.col("rest") > 0, F.col("cut_block") + 1).otherwise(0))

    src = tables.keep(tables.stored(src.drop("rest"), "mix-plan"))
    given = src.where("instances > 0")
    wide = (given.agg(F.sum("instances")).first()[0] or 0) > MANY_BALLS
    placed = tables.keep(tables.stored(places(given, tables.stored(quotas(given, shards, wide), "mix-quotas"), wide), "mix-places"))

    ends = tables.small(src.select("ord", "cut_block", "need").where("need > 0"), SMALL_SOURCES)
    edge = dealt.select("doc_id", "size", "h", "ord", "block").join(ends, "ord").where(F.col("block") == F.col("cut_block"))
    before = Window.partitionBy("ord").orderBy("h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    room = F.col("need") - F.coalesce(F.sum("size").over(before), F.lit(0))
    edge = edge.withColumn("part", F.greatest(F.lit(0), F.least("size", room)))
    edge = edge.groupBy("ord", "doc_id").agg(F.floor(F.sum("part") / F.count("*")).cast("long").alias("part"))
    return src, placed, tables.keep(tables.stored(edge.where("part > 0"), "mix-edges")), shards


def draws(docs: DataFrame, sources: DataFrame, placed: DataFrame, edges: DataFrame, size: str = "size", source: str = "source", doc_id: str = "doc_id") -> DataFrame:
    """Adds source_size, target and draws: an array of (pass, words, shard, place, quota), one for each time a document is drawn; quota: blocks of its source in the shard."""
    near = tables.small(sources, SMALL_SOURCES).select([F.col(c).alias(f"_{c}") for c in sources.columns])
    block = tables.small(placed, SMALL_BLOCKS).select(F.col("ord").alias("_p_ord"), F.col("block").alias("_p_block"), F.col("at").alias("_at"))
    edge = tables.small(edges, SMALL_BLOCKS).select(F.col("ord").alias("_e_ord"), F.col("doc_id").alias("_e_doc"), F.col("part").alias("_part"))
    df = docs.join(near, docs[source].eqNullSafe(F.col("_source")))
    df = df.withColumn("_block", F.pmod(_hash(F.col(doc_id)), "_blocks"))
    df = df.join(block, (F.col("_ord") == F.col("_p_ord")) & (F.col("_block") == F.col("_p_block")), "left")
    df = df.join(edge, (F.col("_ord") == F.col("_e_ord")) & F.col(doc_id).eqNullSafe(F.col("_e_doc")), "left")
    whole = (F.col("_block") < F.col("_cut_block")).alias("_whole")
    words = lambda d: F.when((d["pass"] < F.col("_passes")) | whole, F.col(size)).when(F.col("_block") == F.col("_cut_block"), F.coalesce("_part", F.lit(0).cast("long"))).otherwise(F.lit(0).cast("long"))
    one = lambda d: F.struct(d["pass"].alias("pass"), words(d).alias("words"), d["shard"].alias("shard"), _keyed(F.lit("place"), F.col(doc_id), d["pass"]).alias("place"), d["quota"].alias("quota"))
    none = F.array().cast("array<struct<pass: bigint, words: bigint, shard: int, place: bigint, quota: bigint>>")
    drawn = F.coalesce(F.filter(F.transform("_at", one), lambda d: d["words"] > 0), none)
    return df.withColumns({"source_size": F.col("_source_size"), "target": F.col("_target"), "draws": drawn}).drop(*[c for c in df.columns if c.startswith("_")])


def mix(docs: DataFrame, shards: int | None = None, weights=WEIGHTS, cap: float = CAP) -> DataFrame:
    """docs (doc_id, text, source) to one row per document: doc_id, size, source_size, target, draws (see draws())."""
    sized = tables.stored(docs.select("doc_id", "source", words_of(F.col("text")).alias("size")), "mix-sizes")
    return draws(sized, *plan(sized, weights, cap, shards)[:3]).drop("source")


def mixed_documents(docs: DataFrame, shards: int | None = None, weights=WEIGHTS, cap: float = CAP) -> DataFrame:
    """The mix itself: rows of docs, as often as drawn, shard by shard and shuffled within each.

    A document drawn in part is cut: it keeps its first words, and the white space before them as it is.
    """
    kept = docs.columns
    sized = tables.stored(docs.select("doc_id", "source", words_of(F.col("text")).alias("size")), "mix-sizes")
    *planned, shards = plan(sized, weights, cap, shards)
    df = docs.select(F.struct(*[docs[c] for c in kept]).alias("row"), F.col("doc_id").alias("id"), F.col("source").alias("from"), words_of(F.col("text")).alias("words"))
    df = draws(df, *planned, "words", "from", "id").select("row", "words", F.explode("draws").alias("d"))
    text = F.when(F.col("d.words") < F.col("words"), F.expr(rf"array_join(slice(regexp_extract_all(row.text, '{tables.SPACE}{tables.WORD}', 0), 1, int(d.words)), '')".replace("\\", "\\\\"))).otherwise(F.col("row.text"))
    df = df.withColumn("row", F.col("row").withField("text", text))
    if "n_chars" in kept:
        df = df.withColumn("row", F.when(F.col("d.words") < F.col("words"), F.col("row").withField("n_chars", F.length("row.text").cast(docs.schema["n_chars"].dataType))).otherwise(F.col("row")))
    df = df.repartitionById(shards, F.col("d.shard")).sortWithinPartitions("d.place", "d.pass")  # a task for each shard
    return df.select("row.*")
