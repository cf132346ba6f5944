"""The pipeline's stages on the smallest tables, each held against what its operator must do, and on odd rows."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from almanac.llm import mixing, packing, tables, toxicity

from .test_corpus_ops import SPACED, _near, _quality

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "quality_rules", "near_dedup", "mixing", "packing"]
    docs = tables.read(spark, SF, "documents")
    seen = []
    for _, stage in corpus_pipeline.STAGES:
        docs = tables.stored(stage(spark, docs, SF), "test-stage")
        seen.append(docs)
    start = tables.read(spark, SF, "documents")
    assert all(df.columns == start.columns for df in seen[:-1])
    rows = [[r.asDict() for r in df.collect()] for df in seen]
    first = {r["doc_id"]: r["text"] for r in start.collect()}

    # toxicity: what goes is what the operator rejects
    rejected = {r["doc_id"] for r in toxicity.toxicity(start, tables.read(spark, SF, "labels")).where("rejected").collect()}
    assert {r["doc_id"] for r in rows[0]} == set(first) - rejected
    # quality: none that fails the base rule is left
    for r in rows[1]:
        n, _, _, _, again = _quality(r["text"])
        assert n >= 20 and 100 * again <= 30 * n
    # near-duplicates: the smallest of each component
    linked = _near({r["doc_id"]: r["text"] for r in rows[1]}, 5, 80)
    assert {r["doc_id"] for r in rows[2]} == {i for i, (_, c) in linked.items() if i == c}
    # mixing: words near each source's target, texts whole but for one of each source
    sizes, taken, cut = Counter(), Counter(), Counter()
    for r in rows[2]:
        sizes[r["source"]] += len(SPACED.findall(r["text"]))
    for r in rows[3]:
        taken[r["source"]] += len(SPACED.findall(r["text"]))
        cut[r["source"]] += r["text"] != first[r["doc_id"]]
    plan = {r["source"]: r["target"] for r in mixing.targets(seen[2].groupBy("source").agg(tables.F.sum(mixing.words_of(tables.F.col("text"))).alias("source_size"), tables.F.count("*").alias("n_docs"))).collect()}
    assert all(abs(taken[s] - plan[s]) <= 2 for s in sizes) and max(cut.values()) <= 1
    # packing: every id of every row once
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(packing.tokenizer_path())
    want = Counter()
    for r in rows[3]:
        ids = np.array(tok.encode(r["text"], add_special_tokens=False).ids + [2], "<u4")
        want[r["doc_id"], len(ids)] += len(ids)
    got = Counter()
    for p in rows[4]:
        got[p["doc_id"], p["doc_tokens"]] += p["length"]
    assert got == want


def test_run(spark):
    df = corpus_pipeline.run(spark, SF)
    assert df.count() > 0 and "sequence_id" in df.columns
    by = defaultdict(int)
    for r in df.collect():
        by[r["sequence_id"]] += r["length"]
    assert all(n <= 4096 and n & (n - 1) == 0 for n in by.values())
    assert corpus_pipeline.ORACLE_SQL is None


CLASHES = ("n", "h", "key", "keys", "ids", "size", "block", "draws", "slot", "ord", "rate", "kept", "score", "toxic", "n_words", "_gone", "_c0", "_lang", "_text", "label", "row", "words", "target", "d", "id", "from", "_score", "node", "component", "_whole_text", "at", "_at", "quota")


@pytest.fixture(scope="module")
def odd(spark):
    """Documents with nulls, empty, repeated and very long texts, several texts of one doc_id, and columns of clashing names."""
    rng = random.Random(41)
    prose = lambda n: " ".join(rng.choice("alpha beta gamma delta epsilon zeta eta theta".split()) + rng.choice(["", "s", "ing", ","]) + str(rng.randrange(40)) for _ in range(n))
    texts = [None, "", " \n\t ", "one", prose(50), prose(60_000), prose(120), "x" * 300_000, "東京 タワー " * 30, "same line of words\n" * 40] + [prose(rng.randrange(20, 200)) for _ in range(40)]
    rows = [(i, t, ["en", None, "de"][i % 3], ["a", None, "b"][i % 3], None if i % 5 == 0 else len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[4], rows[4], rows[6], (6, prose(80), "en", "a", 1), (None, prose(40), "en", "a", 2), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.withColumns({c: F.lit(f"own {c}") for c in CLASHES}).repartition(5)


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES[:-1], ids=[n for n, _ in corpus_pipeline.STAGES[:-1]])
def test_stages_on_odd_rows(spark, odd, name, stage):
    row = lambda r: (r["doc_id"], r["text"], r["lang"], r["source"])
    given = Counter(row(r) for r in odd.collect())
    out = stage(spark, odd, SF)
    assert out.columns == odd.columns and out.schema.simpleString() == odd.schema.simpleString()
    got = out.collect()
    assert all(r[c] == f"own {c}" for r in got for c in CLASHES)
    have = Counter(row(r) for r in got)
    sizes = {k: len(SPACED.findall(k[1] or "")) for k in given}
    if name == "toxicity":  # repeated rows stay or go together; the labels are of other texts, so few go
        assert all(n == given[k] for k, n in have.items())
        assert len(have) > 0.7 * len(given)
    elif name == "quality_rules":  # nulls, empty texts and repeated lines fail the base rule; what is kept is kept as often as it came
        assert all(sizes[k] >= 20 and n == given[k] for k, n in have.items()) and sum(have.values()) > 35
    elif name == "near_dedup":  # empty texts and null doc_ids are linked with nothing; copies of one doc_id stay with it
        assert all(n == given[k] for k, n in have.items())
        assert {k for k in given if k[0] is None or sizes[k] == 0} <= set(have)
        linked = _near({k[0]: k[1] for k in given if k[0] not in (None, 6)}, 5, 80)
        assert {k[0] for k in have} - {None, 6} == {i for i, (_, c) in linked.items() if i == c}
    else:  # documents without words are not drawn, others whole or as a prefix
        whole = Counter(k for k in have if k in given)
        assert not any(sizes[k] == 0 for k in whole) and max(have.values()) <= 4 * max(given.values())
        assert all(any(g[0] == k[0] and (g[1] or "").startswith(k[1]) for g in given) for k in have)
    again = Counter(row(r) for r in stage(spark, odd.repartition(3, "lang"), SF).collect())
    assert again == have
    none = stage(spark, odd.where("false"), SF)
    assert none.columns == odd.columns and none.count() == 0


def test_packing_of_odd_rows(spark, odd):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(packing.tokenizer_path())
    _, stage = corpus_pipeline.STAGES[-1]
    want = Counter()
    for r in odd.select("doc_id", "text").collect():
        n = len(tok.encode(r["text"] or "", add_special_tokens=False).ids) + 1
        want[r["doc_id"], n] += n
    got = Counter()
    for p in stage(spark, odd, SF).collect():
        got[p["doc_id"], p["doc_tokens"]] += p["length"]
    assert got == want
    assert stage(spark, odd.where("false"), SF).count() == 0


def test_a_source_of_one_long_document(spark):
    """One document that holds nearly all words: it is cut at its target, and counts once."""
    df = spark.createDataFrame([(i, "w " * (20_000 if i == 0 else 10), "en", "big" if i == 0 else "small", 0) for i in range(30)], "doc_id long, text string, lang string, source string, n_chars long")
    got = mixing.mix(df).selectExpr("doc_id", "size", "target", "aggregate(draws, 0L, (a, d) -> a + d.words) AS taken").collect()
    big = next(r for r in got if r["doc_id"] == 0)
    assert abs(big["taken"] - big["target"]) <= 1 and big["taken"] <= 3 * big["size"]
