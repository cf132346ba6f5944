"""The corpus operators on small fixtures, against brute force, with the odd rows that real tables have."""

import hashlib
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from almanac.llm import licenses, mixing, near_dup, packing, quality, sharding, tables, toxicity, url_filter, vector_search, warc, words

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def _prose(rng, n, alphabet="the of and one two three four five six seven eight nine ten zero".split()):
    return " ".join(rng.choice(alphabet) + rng.choice(["", "", "x", "ing", "é", ".", ","]) for _ in range(n))


def _texts():
    rng = random.Random(5)
    base = _prose(rng, 150)
    ws = base.split()
    near = [" ".join(ws[:k] + ["changed"] + ws[k + 1 :]) for k in (3, 70, 140)]
    odd = [None, "", " \n\t ", "one", "One", "two words", "\x1c\x85 nbsp a\xa0b", "É é ÉCOLE straße", "東京 タワー", "x" * 5000, "a\nb\n\na\na b\n", "<|endoftext|> end", "💩 ok", "'s it's"]
    long = " ".join(_prose(rng, 40) for _ in range(200))
    repeated = " ".join(["again and again it goes on like this"] * 12)
    lines = "\n".join(["same line here", "other line", "same line here", "", "  ", "same line here"] * 5)
    junk = " ".join(w + "%%%" for w in _prose(rng, 60).split())
    return [base, base, base.upper(), *near, *odd, long, repeated, lines, junk, *[_prose(rng, n) for n in (19, 20, 21, 30, 80, 200)]]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, ["en", "de", None][i % 3], ["a", "b", "a", None][i % 4], len(t or "")) for i, t in enumerate(_texts())]
    rows += [rows[0], rows[5], (None, "a row without number of some length", "en", "a", 1)]
    df = spark.createDataFrame(rows, DOCS)
    # names that the operators use themselves
    return df.withColumns({c: F.lit("clash") for c in ("n", "key", "ids", "h", "size", "block", "draws", "slot", "_slot", "ord", "rate", "kept", "score", "toxic", "n_words", "_gone", "_c0", "label", "row", "words", "target")})


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


def _by_id(df):
    out = defaultdict(list)
    for r in df.collect():
        out[r["doc_id"]].append(r)
    return out


def test_words_and_hashes():
    texts = [t or "" for t in _texts()]
    for member, pattern, fold in ((words.SPACED, SPACED, False), (words.ALNUM, re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), True)):
        seen = {}
        for piece in words.chunks(pa.chunked_array([pa.array(texts[:7]), pa.array(texts[7:])]), most_bytes=900, most_rows=3):
            w = piece.words(member, fold)
            for i in range(len(piece)):
                text = texts[piece.first + i].translate(LOW) if fold else texts[piece.first + i]
                own = w.hashes()[w.bounds[i] : w.bounds[i + 1]].tolist()
                assert len(own) == len(pattern.findall(text)) == w.counts[i]
                for word, h in zip(pattern.findall(text), own):
                    assert seen.setdefault(word, h) == h
        assert len(set(seen.values())) == len(seen)


def _thue_morse(n, letters):
    """A word that polynomial hashes modulo a power of two cannot tell from its complement."""
    return "".join(letters[bin(i).count("1") % 2] for i in range(n))


@pytest.mark.parametrize("n", [64, 512, 513, 1024, 2048, 8192])
def test_hashes_tell_thue_morse_words_apart(n):
    (texts,) = words.chunks(pa.array([" ".join(_thue_morse(n, x) for x in ("ab", "ba", "ab"))]))
    w = texts.words(words.SPACED)
    for seed in (0, 1):
        h = w.spans(w.starts, w.ends, seed)
        assert h[0] == h[2] != h[1]
    assert (w.spans(w.starts, w.ends, 1) != w.hashes()).all()


def test_packing_of_words_that_clash():
    from tokenizers import Tokenizer

    full = Tokenizer.from_file(packing.tokenizer_path())
    texts = [f"one {_thue_morse(2048, 'ab')} two {_thue_morse(2048, 'ba')} three", "plain words", _thue_morse(1024, "ba")]
    want = [full.encode(t, add_special_tokens=False).ids for t in texts]
    tok = packing.Tokens(packing.tokenizer_path())
    (piece,) = words.chunks(pa.array(texts))
    for _ in range(2):
        ids, sizes = tok.encode(piece)
        assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == want
    tok.table.check ^= np.uint64(1)  # as if all pieces clashed: every text goes through the tokenizer
    ids, sizes = tok.encode(piece)
    assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == want


def test_packing(spark, docs, empty):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(packing.tokenizer_path())
    ids = {i: np.array(tok.encode(t or "", add_special_tokens=False).ids + [2], "<u4") for i, t in enumerate(_texts())}
    ids[None] = np.array(tok.encode("a row without number of some length", add_special_tokens=False).ids + [2], "<u4")
    pieces = packing.pack(docs).collect()
    copies = Counter(r["doc_id"] for r in docs.select("doc_id").collect())
    found = defaultdict(Counter)
    for p in pieces:
        want = ids[p["doc_id"]]
        assert p["doc_tokens"] == len(want) and p["ids_crc32"] == zlib.crc32(want[p["start"] : p["start"] + p["length"]].tobytes())
        found[p["doc_id"]].update(range(p["start"], p["start"] + p["length"]))
    assert all(found[i] == Counter({k: copies[i] for k in range(len(ids[i]))}) for i in copies)
    by_sequence = defaultdict(list)
    for p in pieces:
        by_sequence[p["sequence_id"]].append((p["offset"], p["length"]))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096 and at & (at - 1) == 0  # powers of two need no padding
    # only what the last sequences cannot hold is short: at most one sequence for each power of two
    short = [max(o + n for o, n in parts) for parts in by_sequence.values() if max(o + n for o, n in parts) < 4096]
    assert len(short) == len(set(short))
    assert packing.pack(empty).count() == 0


def test_remainders_of_partitions_are_filled_up(spark, monkeypatch):
    monkeypatch.setattr(packing, "REST_PARTS", 3)
    rng = random.Random(7)
    df = spark.createDataFrame([(i, _prose(rng, rng.randrange(1, 300))) for i in range(200)], "doc_id long, text string").repartition(11)
    spark.conf.set("spark.sql.shuffle.partitions", "11")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        pieces = packing.pack(df, length=256).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    by_doc, ends = defaultdict(list), defaultdict(int)
    for p in pieces:
        by_doc[p["doc_id"], p["doc_tokens"]].append((p["start"], p["length"]))
        ends[p["sequence_id"]] = max(ends[p["sequence_id"]], p["offset"] + p["length"])
    for (_, n), parts in by_doc.items():
        at = 0
        for start, size in sorted(parts):
            assert start == at
            at += size
        assert at == n
    assert all(sum(p["length"] for p in pieces if p["sequence_id"] == s) == n for s, n in ends.items())
    groups = Counter(s >> 32 for s, n in ends.items() if n < 256)
    assert len(groups) <= 4 and all(n <= 8 for n in groups.values())


def test_tokens_with_a_small_table():
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(packing.tokenizer_path())
    small = packing.Tokens(packing.tokenizer_path(), 256)
    texts = _texts()
    for piece in words.chunks(pa.array(texts), 2000):
        ids, sizes = small.encode(piece)
        for i, own in enumerate(np.split(ids, np.cumsum(sizes)[:-1])):
            assert own.tolist() == tok.encode(texts[piece.first + i] or "", add_special_tokens=False).ids


@pytest.mark.parametrize("dimensions,bits", [(2, 4), (3, 3)])
def test_hilbert_curve(dimensions, bits):
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dimensions, indexing="ij"), -1).reshape(-1, dimensions)
    keys = packing.hilbert(grid, bits)
    assert sorted(keys.tolist()) == list(range(len(grid)))
    assert (np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(1) == 1).all()


def test_neighbours_lie_together(spark):
    rng = random.Random(1)
    kinds = [[f"{c}{i}" for i in range(30)] for c in ("al", "qu", "zy", "mo")]
    rows = [(i, _prose(rng, 300, kinds[i % 4])) for i in range(80)]
    packed = packing.pack(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).orderBy("sequence_id", "offset").collect()
    order = list(dict.fromkeys(p["doc_id"] for p in packed))
    changes = sum(a % 4 != b % 4 for a, b in zip(order, order[1:]))
    assert changes < 20  # at random it would be about 60


def test_sharding(spark, docs, empty):
    names = [f"s{i}" for i in range(7)]
    owner = sharding.lookup(names, 1009)
    # the plain algorithm, stated once more
    pref = [[(sharding._number(n, "offset") % 1009 + k * (sharding._number(n, "step") % 1008 + 1)) % 1009 for k in range(1009)] for n in names]
    table, at, turn = {}, [0] * 7, 0
    while len(table) < 1009:
        while pref[turn][at[turn]] in table:
            at[turn] += 1
        table[pref[turn][at[turn]]] = turn
        turn = (turn + 1) % 7
    assert owner == [table[i] for i in range(1009)]
    assert max(Counter(owner).values()) - min(Counter(owner).values()) <= 1
    fewer = sharding.lookup(names[:-1], 1009)
    moved = sum(a != b for a, b in zip(owner, fewer) if a != 6)
    assert moved < 0.1 * 1009
    placed = sharding.place(docs, ["doc_id"], names, 1009)
    assert placed.count() == docs.count() and placed.columns == [c for c in docs.columns if c != "slot"] + ["slot", "shard"]
    assert {r["_slot"] for r in placed.select("_slot").collect()} == {"clash"}
    for r in placed.where("doc_id IS NOT NULL").select("doc_id", "slot").collect():
        assert r["slot"] == struct.unpack("q", struct.pack("Q", xxhash.xxh64_intdigest(struct.pack("<q", r["doc_id"]), 42)))[0] % 1009
    assert all(r["shard"] == names[owner[r["slot"]]] for r in placed.select("slot", "shard").collect())
    assert len({r["slot"] for r in placed.where("doc_id = 0").collect()}) == 1
    assert sum(r["n_rows"] for r in sharding.balance(placed).collect()) == docs.count()
    assert sharding.place(empty, ["doc_id"], names, 1009).count() == 0
    for bad in (dict(shards=[], slots=7), dict(shards=["a", "a"], slots=7), dict(shards=["a"], slots=8), dict(shards=["a"], slots=(1 << 31) - 1)):
        with pytest.raises(ValueError):
            sharding.lookup(**bad)
    assert "Python" not in placed._jdf.queryExecution().executedPlan().toString()


URLS = [
    "http://a.example.net/en/1", "HTTP://A.EXAMPLE.NET/en/", "https://example.net", "https://example.net?x=/en/", "https://x.net/", "http://notexample.net/en/x", "https://example.com/de/a#b", "https://example.com/DE/a",
    "http://b.c.org/fr/?q", "http://org/fr/", "http://org/f", "no scheme", "", None, "://x.net/y", "a://b://c.net/", "http://spam-farm.example.org/fr/9", "http://w.spam-farm.example.org/en/9", "http://spam-farm.example.org",
    "http://net/", "http://.net/", "http://" + ".".join(["a"] * 500) + ".net/" + "y" * 5000, "http://ex\nample.net/en/\nz", "http://x.net:80/", "http://É.net/é",
]


def _judge(url, policy, listed):
    m = re.search(r"\A[\s\S]*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (m[1].translate(LOW), m[2]) if m else ("", "")
    fits = lambda r: (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith(r[r.index("/") :])
    if found := sorted((-len(r), r, v) for v, r in policy if fits(r)):
        return host, path, found[0][1], found[0][2]
    return host, path, None, "block" if any(fits(r) for r in listed) else "allow"


def test_url_filter(spark):
    rng = random.Random(2)
    hosts = ["example.net", "a.example.net", "example.com", "org", "x.org", "net", "com", "b.a.example.net"]
    urls = URLS + [f"http://{rng.choice(hosts)}/{rng.choice(['en', 'de', 'fr', ''])}/{rng.randrange(30)}" for _ in range(300)]
    policy = list(url_filter.RULES)
    listed = [*url_filter.LISTED, *[f"{rng.choice(hosts)}/{rng.choice(['en', 'de'])}/{k}" for k in range(20)]]
    rows = [(i, u) for i, u in enumerate(urls)] + [(0, urls[0]), (None, urls[4]), (None, None)]
    df = spark.createDataFrame(rows, "id long, url string").withColumns({c: F.lit(1) for c in ("host", "path", "h", "p", "block", "bits", "verdict")})
    judged = url_filter.judge(df, url_filter.rule_table(spark, policy, listed))
    assert "Python" not in judged._jdf.queryExecution().executedPlan().toString()
    got = sorted((repr(r["id"]), r["host"], r["path"], repr(r["rule"]), r["verdict"]) for r in judged.collect())
    want = sorted((repr(i), h, p, repr(r), v) for i, u in rows for h, p, r, v in [_judge(u, policy, listed)])
    assert got == want
    assert url_filter.judge(df.where("false"), url_filter.rule_table(spark, policy)).count() == 0
    none = url_filter.judge(df, url_filter.rule_table(spark, policy).where("false")).collect()
    assert len(none) == len(rows) and {(r["rule"], r["verdict"]) for r in none} == {(None, "allow")}
    with pytest.raises(Exception):
        url_filter.judge(df, url_filter.rule_table(spark, [("block", "nohost")])).collect()


CANONICAL = {
    "http://user:pw@spam-farm.example.org:8080/x": "block", "http://spam-farm.example.org./": "block", "http://SPAM-farm.example.org:/": "block", "http://spam-farm.example.org": "allow", "http://notspam-farm.example.org/": "allow",
    "http://blog.test/%7Euser/bad": "block", "http://blog.test/~user/./x/../bad/1": "block", "http://blog.test//~user//bad": "block", "http://blog.test/~user/good": "allow", "http://blog.test/~user/bad%2Fx": "block", "http://blog.test/%2": "allow",
    "http://blog.test/a/../../~user/bad?x#y": "block", "http://blog.test/~user/bad/..": "allow", "http://up.test/a%2fb": "block", "http://up.test/a/b": "allow",
}


def test_listed_urls_are_compared_in_canonical_form(spark, tmp_path):
    (tmp_path / "list.txt").write_text("# a list\n\nspam-farm.example.org/\n BLOG.test:80//~user/%62ad \nup.test/a%2Fb\n")
    listed = url_filter.listed_table(spark, f"file://{tmp_path}/list.txt")
    df = spark.createDataFrame(list(enumerate(CANONICAL)), "id long, url string")
    got = {r["id"]: (r["verdict"], r["rule"]) for r in url_filter.judge(df, listed).collect()}
    assert got == {i: (v, None) for i, v in enumerate(CANONICAL.values())}
    # the policy compares what is written
    policy = url_filter.rule_table(spark, [("block", "blog.test/~user/bad")])
    got = [r["id"] for r in url_filter.judge(df, policy).where("verdict = 'block'").collect()]
    assert sorted(list(CANONICAL)[i] for i in got) == ["http://blog.test/~user/bad%2Fx", "http://blog.test/~user/bad/.."]


def test_a_long_list(spark, monkeypatch):
    """100,000 listed URLs with many path lengths, one host with a third of them, with and without the filter."""
    listed = spark.range(100_000).selectExpr("concat(if(id % 3 = 0, 'big.test', concat('h', id % 5000, '.test')), '/p', repeat('x', int(id % 40)), id, '/') AS rule", "'block' AS verdict", "true AS listed")
    urls = spark.range(0, 120_000, 7).selectExpr("id", "concat('http://www.', if(id % 3 = 0, 'big.test', concat('h', id % 5000, '.test')), '/p', repeat('x', int(id % 40)), id, '/page') AS url")
    judged = url_filter.judge(urls, listed.union(url_filter.rule_table(spark, [("allow", "test/pxxx3/")])))
    blocked = {r["id"] for r in judged.where("verdict = 'block'").collect()}
    assert blocked == {i for i in range(0, 120_000, 7) if i < 100_000}
    plan = judged._jdf.queryExecution().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan
    monkeypatch.setattr(tables, "MOST_BYTES", 1000)
    assert {r["id"] for r in url_filter.judge(urls, listed).where("verdict = 'block'").collect()} == blocked


def test_packed_filter_holds_every_block(spark):
    keys = spark.range(9000).select(F.xxhash64("id").alias("_k"))
    bits = url_filter.bloom(keys, 5000)
    rows = {r["chunk"]: r["words"] for r in url_filter.packed(bits, 5000).collect()}
    assert [len(rows[i]) for i in range(2)] == [4096, 904]
    assert {r["block"]: r["bits"] for r in bits.collect()} == {c * 4096 + i: w for c, ws in rows.items() for i, w in enumerate(ws) if w}


def test_bloom_filter_has_no_false_negatives(spark):
    keys = spark.range(5000).select(F.xxhash64("id").alias("_k"))
    blocks = 5000 * url_filter.BITS_PER_KEY // 64
    bits = url_filter.bloom(keys, blocks)

    def passes(df):
        asked = df.withColumns({"block": url_filter._block(blocks), "m": url_filter._mask(F.col("_k"))})
        return asked.join(bits, "block").where(F.col("bits").bitwiseAND(F.col("m")) == F.col("m")).count()

    assert passes(keys) == 5000
    assert passes(spark.range(10_000, 20_000).select(F.xxhash64("id").alias("_k"))) < 500


def test_vector_search(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i), [float(x) for x in rng.normal(0, 0.3, 16).astype(np.float32)]) for i in range(400)]
    rows += [(400 + i, rows[7][1]) for i in range(40)] + [(50, rows[3][1])]  # ties; a second row of one number
    odd = [(450, None), (451, [1.0, None]), (452, [float("nan")]), (453, [float("inf")]), (454, []), (455, [1.0]), (None, [1.0] * 16), (500, [1e3] * 16), (-50, rows[7][1])]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").withColumns({"v": F.lit(1), "cells": F.lit(2), "rank": F.lit(3)}).repartition(5)
    whole = [(i, [int(np.floor(256 * x)) for x in e]) for i, e in rows + odd if i is not None and e is not None and all(x is not None and np.isfinite(x) for x in e)]
    width = max(len(v) for _, v in whole)
    vec = [(i, np.array(v + [0] * (width - len(v)), np.int64)) for i, v in whole]
    want = []
    for q in sorted({i for i, _ in vec if i % 50 == 0}):
        asks = min((tuple(raw) for (i, raw) in whole if i == q))
        asks = np.array(list(asks) + [0] * (width - len(asks)), np.int64)
        best = sorted((-int(v @ asks), i) for i, v in vec if i != q)[:5]
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert sorted(map(tuple, vector_search.search(df).collect())) == sorted(want)
    assert vector_search.search(df.where("false")).count() == 0
    few = vector_search.search(df.where("vec_id IN (0, 1, 2)"))
    assert [r["rank"] for r in few.orderBy("rank").collect()] == [1, 2]
    big = spark.createDataFrame([(0, [3e12, -1.0]), (1, [2e0, 1.0]), (2, [1e0, 5.0])], "vec_id long, embedding array<double>")
    assert [r["vec_id"] for r in vector_search.search(big).orderBy("rank").collect()] == [1, 2]


def test_vector_scores_beyond_64_bits(spark):
    rows = [(0, [2e7, 2e7]), (1, [2e7, 2e7]), (2, [-2e7, -2e7]), (3, [5e6, 1.0]), (4, [1.5e7, 2e7]), (5, [3e30, 0.0]), (6, [0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    top = (1 << 63) - 1
    ints = {i: [max(-top - 1, min(top, int(np.floor(256 * x)))) for x in v] for i, v in rows}
    clamped = {i: max(-top - 1, min(top, sum(a * b for a, b in zip(ints[0], ints[i])))) for i in ints if i}
    want = sorted(clamped.items(), key=lambda x: (-x[1], x[0]))[:5]
    assert clamped[1] == top and clamped[2] == -top - 1 and clamped[3] < top
    assert [(r["vec_id"], r["score"]) for r in vector_search.search(df).orderBy("rank").collect()] == want


def test_vector_search_in_blocks_of_queries_with_many_copies(spark, monkeypatch):
    monkeypatch.setattr(vector_search, "QUERY_BLOCK", 7)
    monkeypatch.setattr(vector_search, "BLOCK", 64)
    rng = np.random.default_rng(9)
    rows = [(i, [float(x) for x in rng.normal(0, 0.4, 8)]) for i in range(900)]
    rows = [(i, rows[100][1] if i % 3 == 1 else v) for i, v in rows]  # a third are copies of one
    rows += rows[40:60]  # repeated rows count each
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(6)
    vec = [(i, np.floor(256 * np.array(v)).astype(int)) for i, v in rows]
    want = [(q, n + 1, i, -s) for q in range(0, 900, 50) for n, (s, i) in enumerate(sorted((-int(v @ dict(vec)[q]), i) for i, v in vec if i != q)[:5])]
    assert sorted(map(tuple, vector_search.search(df).collect())) == want
    asked = df.where("vec_id IN (3, 100)").dropDuplicates(["vec_id"])
    assert sorted({r["query_id"] for r in vector_search.search(df, asked).collect()}) == [3, 100]


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(4)
    v = rng.integers(-300, 300, (3000, 24))
    shift = vector_search.shift_of(v)
    cells = (v >> shift).astype(np.int8)
    assert ((cells.astype(np.int64) << shift) <= v).all() and (v < (cells.astype(np.int64) + 1 << shift)).all()
    ids, exact = np.arange(3000), v[:20] @ v.T
    low, high = vector_search.bounds(v[:20], cells, shift)
    assert (low <= exact).all() and (exact <= high).all()
    best, read = np.full((20, 5), -np.inf), 0
    for a in range(0, 3000, 1000):
        query, vector, _, _ = vector_search.scan_block(ids[:20], v[:20], ids[a : a + 1000], cells[a : a + 1000], shift, best)
        near = {(q, a + i) for q, i in zip(query.tolist(), vector.tolist())}
        read += len(near)
        for q in range(20):
            order = [i for i in np.lexsort((ids, -exact[q])) if i != q][:5]
            assert {(q, i) for i in order if a <= i < a + 1000} <= near and (q, q) not in near
    assert read < 0.1 * 20 * 3000
    assert (np.sort(best) == np.sort(np.where(np.eye(20, 3000, dtype=bool), -np.inf, low), axis=1)[:, -5:]).all()
    huge = rng.integers(-(1 << 62), 1 << 62, (50, 6))
    low, high = vector_search.bounds(huge, (huge >> 55).astype(np.int8), 55)
    exact = huge.astype(object) @ huge.astype(object).T
    assert all(low[i, j] <= exact[i, j] <= high[i, j] for i in range(50) for j in range(50))


def test_the_scan_reads_cells_alone(spark):
    df = spark.createDataFrame([(i, [i / 100, 1.0]) for i in range(120)], "vec_id long, embedding array<double>")
    exact, cells = vector_search.index(df)
    assert "v" in exact.columns and "v" not in cells.columns
    assert {"rows", "ids", "signs", "cells", "shift", "n"} == set(cells.columns)


def _toxic_corpus(spark, n=500):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(n):
        lang = ["en", "de"][i % 2]
        bad = rng.random() < 0.3
        ws = _prose(rng, rng.randrange(5, 120)).split()
        if bad:
            for _ in range(3):
                ws.insert(rng.randrange(len(ws)), rng.choice(["vile", "nasty"]) if lang == "en" else "schlimm" + rng.choice(["e", "er", "es", "en", "em"]))
        rows.append((i, " ".join(ws), lang, "s", 0))
        labels.append((i, int(bad)))
    return spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels + [(5, None), (10**6, 1)], "doc_id long, toxic int"), dict(labels)


def test_toxicity(spark):
    df, labels, truth = _toxic_corpus(spark)
    got = toxicity.toxicity(df, labels).collect()
    assert len(got) == 500 and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    held = [(r["predicted"], truth[r["doc_id"]]) for r in got if r["held_out"]]
    assert sum(a == b for a, b in held) / len(held) > 0.95
    # the score is of the text alone
    other = toxicity.toxicity(df.withColumns({"lang": F.lit("xx"), "source": F.lit("y")}), labels).collect()
    assert sorted((r["doc_id"], r["score"]) for r in got) == sorted((r["doc_id"], r["score"]) for r in other)
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert sorted((r["doc_id"], r["score"]) for r in got) == sorted((r["doc_id"], r["score"]) for r in toxicity.toxicity(df, flipped).collect())
    kept = toxicity.clean_documents(df, labels)
    assert kept.columns == df.columns
    kept = {r["doc_id"] for r in kept.collect()}
    assert sum((i in kept) != bool(t) for i, t in truth.items()) > 0.95 * len(truth)


def test_toxicity_of_odd_rows(spark, docs, empty):
    _, labels, _ = _toxic_corpus(spark)
    got = toxicity.toxicity(docs, labels).collect()
    assert len(got) == docs.count() and all(r["score"] is not None for r in got)
    assert toxicity.toxicity(empty, labels).count() == 0
    none = toxicity.toxicity(docs, labels.where("false")).collect()
    assert {r["score"] for r in none} == {0.0}
    assert toxicity.clean_documents(docs, labels.where("false")).count() == docs.count()


def test_pooling_and_gradients_by_plain_loops():
    rng = np.random.default_rng(2)
    texts = ["one two three two", "", "nine", "ten ten eleven twelve " * 9]
    sample = toxicity.Sample.of(pa.array(texts))
    y = np.array([1, 0, 1, 0])
    m = toxicity.Model(rng.normal(0, 0.5, (1 << toxicity.BUCKET_BITS, toxicity.SIZE)).astype(np.float32), [rng.normal(0, 0.5, (w, toxicity.SIZE, toxicity.FILTERS)).astype(np.float32) for w in toxicity.WIDTHS], rng.normal(0, 0.1, 18).astype(np.float32), rng.normal(0, 0.5, 18).astype(np.float32), 0.1)
    m.embedding[0] = 0
    ids, bounds = sample.buckets()
    (piece,) = words.chunks(pa.array(texts))
    assert (ids == toxicity.features(piece)[0]).all() and bounds.tolist() == [0, 4, 4, 5, 41]

    def pooled(i):
        x = [m.embedding[row].sum(0) for row in ids[bounds[i] : bounds[i + 1]]] + [np.zeros(toxicity.SIZE)] * 3
        windows = max(1, bounds[i + 1] - bounds[i])
        return [max(sum(x[a + j] @ f[j, :, k] for j in range(len(f))) for a in range(windows)) + m.bias[q * toxicity.FILTERS + k] for q, f in enumerate(m.filters) for k in range(toxicity.FILTERS)]

    assert np.allclose(m.pooled(m.words(ids), bounds), [pooled(i) for i in range(4)], atol=1e-4)
    weight = np.array([0.5, 1.0, 2.0, 1.5])
    grad, rows, of_rows = toxicity.gradients(m, sample, y, weight)

    def loss():
        p = m.scores(ids, bounds)
        return -(weight * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum()

    def slope(array, at, step=1e-2):
        had = array[at]
        array[at] = had + step
        more = loss()
        array[at] = had - step
        less = loss()
        array[at] = had
        return (more - less) / (2 * step)

    for name, array in (("out", m.out), ("bias", m.bias), (1, m.filters[1]), (2, m.filters[2])):
        for at in [tuple(rng.integers(0, n) for n in array.shape) for _ in range(6)]:
            assert abs(slope(array, at) - grad[name][at]) < 0.02 + 0.02 * abs(grad[name][at])
    for i in rng.choice(len(rows), 12, replace=False):
        assert abs(slope(m.embedding, (rows[i], 3)) - of_rows[i, 3]) < 0.02 + 0.02 * abs(of_rows[i, 3])
    again = toxicity.Model.from_bytes(m.to_bytes())
    assert (again.scores(ids, bounds) == m.scores(ids, bounds)).all()


def test_toxicity_with_one_huge_text_and_repeated_ids(spark):
    df, labels, truth = _toxic_corpus(spark)
    n = toxicity.training_rows(df, labels).count()
    assert n == sum(zlib.crc32(str(i).encode()) % 5 != 0 for i in truth)
    # whichever labelled text is too long, it alone is not learned from
    huge = df.withColumn("text", F.when(F.col("doc_id") == 7, F.repeat(F.lit("long words here "), 20_000)).otherwise(F.col("text")))
    assert toxicity.training_rows(huge, labels).count() == n - 1
    assert toxicity.training_rows(df, labels, positive=10, negative=20).count() == 30
    got = {r["doc_id"]: r["predicted"] for r in toxicity.toxicity(huge, labels).collect()}
    assert sum(got[i] == t for i, t in truth.items() if i != 7) > 0.95 * len(truth)
    twice = df.union(df.withColumn("text", F.lit("another text of the same id"))).repartition(7)
    scores = [sorted((r["doc_id"], r["score"]) for r in toxicity.toxicity(twice.repartition(k, "lang"), labels).collect()) for k in (2, 5)]
    assert len(scores[0]) == 1000 and scores[0] == scores[1]
    assert toxicity.training_rows(twice, labels).count() == n
    none = toxicity.clean_documents(df.where("false"), labels)
    assert none.columns == df.columns and none.count() == 0


def _quality(text):
    ws = SPACED.findall(text or "")
    lines = [x for x in (text or "").split("\n") if SPACED.search(x)]
    n = Counter(tuple(ws[i : i + 8]) for i in range(len(ws) - 7))
    again = {j for i in range(len(ws) - 7) if n[tuple(ws[i : i + 8])] > 1 for j in range(i, i + 8)}
    return len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(again)


def test_quality(spark, docs, empty):
    got = _by_id(quality.rules(docs))
    texts = dict(enumerate(_texts())) | {None: "a row without number of some length"}
    for i, found in got.items():
        for r in found:
            n_words, *rest = _quality(texts[i])
            ws = SPACED.findall(texts[i] or "")
            assert r["n_echoes"] == sum(a == b for a, b in zip(ws, ws[1:]))
            assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (n_words, *rest)
            assert r["base_failed"] == (n_words < 20 or 100 * rest[3] > 30 * n_words) and not (r["base_failed"] and r["kept"])
    assert sum(map(len, got.values())) == docs.count()
    assert quality.rules(empty).count() == 0
    kept = quality.good_documents(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(i) for i, f in got.items() for r in f if r["kept"])


def test_quality_thresholds_follow_the_corpus(spark):
    rng = random.Random(9)
    rows = []
    for i in range(1500):
        source = ["plain", "tables", "rare"][0 if i % 2 else (2 if i % 100 == 0 else 1)]
        ws = _prose(rng, 60).split()
        if source == "tables":  # symbols are usual there
            ws = [w + "|" for w in ws]
        if i % 97 == 3:
            ws = [w + "%%%" for w in ws]
        rows.append((i, " ".join(ws), "en", source, 0))
    judged = {r["doc_id"]: r["kept"] for r in quality.rules(spark.createDataFrame(rows, DOCS)).collect()}
    for i, text, _, source, _ in rows:
        if i % 97 == 3 and source == "plain":
            assert not judged[i]
        elif i % 97 != 3:
            assert judged[i], (i, source, text)


def test_quality_of_small_sources(spark):
    """A source's own rates count at any size, and a few poor documents in a small source do not set its fence."""
    rng = random.Random(21)
    rows = []
    for source, n in (("plain", 1200), ("tables", 250), ("code", 40), ("few", 12)):
        for _ in range(n):
            ws = _prose(rng, 60).split()
            poor = source == "few" and rows[-1][3] != "few"
            rows.append((len(rows), " ".join([w + "|" for w in ws] if source in ("tables", "code") or poor else ws), "en", source, 0))
    kept = Counter(r["source"] for r in quality.rules(spark.createDataFrame(rows, DOCS)).where("kept").collect())
    assert kept == {"plain": 1200, "tables": 250, "code": 40, "few": 11}


def test_quality_thresholds_by_a_plain_recount(spark):
    """Sources of 30 documents with unlike rates get unlike thresholds, and all thresholds are those of the weighted quartiles."""
    rng = random.Random(31)
    rows = []
    for k, (lang, source, n, marks) in enumerate([("en", "forum", 30, 2), ("en", "notes", 30, 20), ("en", None, 300, 0), ("de", "forum", 5, 0)]):
        for _ in range(n):
            ws = _prose(rng, rng.randrange(25, 400)).split()
            text = " ".join(w + ("#" if rng.randrange(100) < marks else "") for w in ws)
            rows.append((len(rows), text + "\nsame line of words\n" * rng.randrange(3), lang, source, 0))
    counted = quality.counts(spark.createDataFrame(rows, DOCS), ["doc_id", "lang", "source"]).collect()
    found = {(r["lang"], r["source"]): r for r in quality.learned(tables.stored(quality.counts(spark.createDataFrame(rows, DOCS), ["lang", "source"]), "t")).collect()}

    def start(v):  # of the value's bin
        step = 1 if v < 64 else 1 << (v.bit_length() - 6)
        return v // step * step, step

    sound = [r for r in counted if r["n_words"] >= 20 and 100 * r["n_repeat_words"] <= 30 * r["n_words"]]
    names = {r: (lambda x, a=a, b=b: 1000 * x[a] // max(1, x[b])) for r, (a, b, *_) in quality.RATES.items()} | {c: (lambda x, c=c: x[c]) for c in quality.SIZES}
    for (lang, source), got in found.items():
        own = [r for r in sound if (r["lang"], r["source"]) == (lang, source)]
        wide = [r for r in sound if r["lang"] == lang]
        weights = [(own, 1.0), (wide, 30 / (len(wide) + 30)), (sound, 30 * 30 / (len(wide) + 30) / len(sound))]
        q = {}
        for name, value in names.items():
            mass = sorted((start(value(r))[0], w) for part, w in weights for r in part)
            upto = np.cumsum([w for _, w in mass])
            q[name] = [mass[int(np.searchsorted(upto, k / 4 * (len(own) + 30) - 1e-9))][0] for k in (1, 2, 3)]
        for name, (_, size, event, below, above) in quality.RATES.items():
            low, middle, high = q[name]
            one = 1000 * event // max(1, q[size][1])
            assert got[f"{name}_most"] == high + above * max(high - middle, start(high)[1], one)
            if below:
                assert got[f"{name}_least"] == low - below * max(middle - low, start(low)[1], one)
    assert len({r["symbol_rate_most"] for r in found.values()}) >= 3
    assert found["en", "notes"]["symbol_rate_most"] > 2 * found["en", "forum"]["symbol_rate_most"]
    assert 0 < min(r["repeat_rate_most"] for r in found.values()) < 300


def test_quality_bins(spark):
    values = [*range(0, 5000), 10**6, 10**9, 2**40 + 12345]
    df = spark.createDataFrame([(v,) for v in values], "v long").select("v", quality.bin_of(F.col("v")).alias("b")).select("v", "b", quality.bin_start(F.col("b")).alias("s"), quality.bin_start(F.col("b") + 1).alias("e"))
    assert all(r["s"] <= r["v"] < r["e"] and (r["e"] - r["s"]) * 32 <= max(32, r["v"]) for r in df.collect())


def _licenses(text):
    ws = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))
    at, labels = [], set()
    for label, phrase in licenses.PHRASES:
        p = phrase.split()
        found = [i for i in range(len(ws)) if ws[i : i + len(p)] == p]
        at += found
        labels |= {label} if found else set()
    return len(ws), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def test_licenses(spark, docs, empty):
    apache = licenses.NOTICES[1][1]
    cut = " ".join(w for i, w in enumerate(apache.split()) if i % 17)  # some words left out
    texts = ["the MIT License, cc-by cc by GNU general public license", "gnu general public", "Apache\nLicense apache license", "mit", "x " * 30_000 + "MIT LICENSE", apache.replace("Apache License", "A. L."), cut, "word " * 50 + licenses.NOTICES[12][1], None, "", "cc by cc by cc by", "É mit license é"]
    df = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(texts)] + [(1000, texts[0]), (None, texts[2])], "doc_id long, text string").unionByName(docs.select("doc_id", "text"))
    df = df.withColumns({c: F.lit(1) for c in ("h", "n", "gram", "label", "votes", "pos", "g")})
    got = _by_id(licenses.scan(df))
    known = {1000 + i: t for i, t in enumerate(texts)} | dict(enumerate(_texts()))
    assert sum(map(len, got.values())) == df.count()
    for i, t in known.items():
        for r in got[i]:
            assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == _licenses(t)
            assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1
    assert "apache" in got[1005][0]["labels"] and got[1005][0]["base_labels"] == ""
    assert "apache" in got[1006][0]["labels"]
    assert got[1001][0]["labels"] == "" and got[1007][0]["labels"] == "mit"
    span = next(s for s in got[1007][0]["spans"] if s["label"] == "mit" and s["covered"] == 1)
    assert (span["at"], span["end"]) == (50, 55)
    assert licenses.scan(empty).count() == 0


def test_every_notice_has_its_own_label_alone(spark):
    filler = "nothing to see here but plain words in a row"
    rows, want = [], {}

    def add(text, *labels):
        want[len(rows)] = set(labels)
        rows.append((len(rows), text))

    for label, text, _ in licenses.NOTICES:
        ws = text.split()
        add(text, label)
        add(f"{filler} {text.upper()} {filler}", label)
        if len(ws) > 20:
            add(" ".join(ws[: len(ws) // 3] + ["five", "words", "are", "put", "in"] + ws[len(ws) // 3 :]), label)
        add(" ".join(x for w in ws for x in (w, "zz")))  # no two words in a row
        add(text.replace("General Public", "Lesser General Public").replace("Apache", "Other").replace("Mozilla", "Other").replace("MIT", "XYZ"), *[label] * (label in ("bsd", "isc", "mit", "apache") and len(ws) > 20 or label.startswith("cc") or "WITHOUT ANY" in text))
    for text in ("under cc by " * 40, "licensed under cc " * 30, "by nc by sa by nd " * 30, "license version 2 0 " * 9, "Licensed under the EPL License, Version 2.0", "permission is hereby granted " * 20, "word " * 500):
        add(text)
    for (one, a, _), (two, b, _) in zip(licenses.NOTICES, licenses.NOTICES[1:]):
        add(f"{a} {filler} {b}", one, two)
    found = {r["doc_id"]: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in rows:
        base = set(filter(None, _licenses(text)[4].split(",")))
        assert set(filter(None, found[i]["labels"].split(","))) == want[i] | base, (i, text)
        for s in found[i]["spans"]:
            assert s["label"] in want[i] and s["covered"] >= licenses.COVERED


def test_words_of_votes_are_compared_whole():
    known = licenses.Vocabulary(["alpha merchantability be"])
    (texts,) = words.chunks(pa.array(["merchantability merchantabilitx merchantabilityy be bee b alpha"]))
    w = texts.words(words.ALNUM, fold=True)
    assert (known.numbers(w, w.hashes()) > 0).tolist() == [True, False, False, True, False, False, True]
    same = np.full(len(w), known.hashes[0])  # as if every word's hash clashed
    assert (known.numbers(w, same) > 0).sum() == 1


def test_mixing(spark, docs, empty):
    got = mixing.mix(docs).withColumn("taken", F.expr("aggregate(draws, 0L, (a, d) -> a + d.words)")).collect()
    texts = dict(enumerate(_texts())) | {None: "a row without number of some length"}
    source = {r["doc_id"]: r["source"] for r in docs.collect()}
    assert len(got) == docs.count()
    sizes = defaultdict(int)
    for r in got:
        assert r["size"] == len(SPACED.findall(texts[r["doc_id"]] or "")) and 0 <= r["taken"] <= 3 * r["size"]
        sizes[source[r["doc_id"]]] += r["size"]
    # the fixed point of resharing, step by step
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    target, rest, left = {s: 0.0 for s in order}, sum(sizes.values()), set(order)
    while rest > 1e-9 and left:
        total = sum(weight[s] for s in left)
        for s in left:
            target[s] += rest * weight[s] / total
        rest = sum(max(0.0, target[s] - 3 * sizes[s]) for s in left)
        full = {s for s in left if target[s] >= 3 * sizes[s]}
        for s in full:
            target[s] = 3.0 * sizes[s]
        left -= full
    taken = defaultdict(int)
    for r in got:
        assert abs(r["target"] - target[source[r["doc_id"]]]) < 1e-6 and r["source_size"] == sizes[source[r["doc_id"]]]
        taken[source[r["doc_id"]]] += r["taken"]
    assert all(abs(taken[s] - target[s]) <= 2 for s in order)
    assert mixing.mix(empty).count() == 0 and mixing.mixed_documents(empty).count() == 0


def test_mixing_of_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(mixing, "DOCS_PER_BLOCK", 8)
    rng = random.Random(11)
    rows = [(i, " ".join(["w"] * rng.randrange(0, 40)), "en", "abc"[min(2, i % 7)], 0) for i in range(900)]
    df = spark.createDataFrame(rows, DOCS)
    mixed = mixing.mix(df, shards=5)
    assert "Python" not in mixed._jdf.queryExecution().executedPlan().toString()
    got = {r["doc_id"]: r for r in mixed.collect()}
    again = {r["doc_id"]: r for r in mixing.mix(df.repartition(7), shards=5).collect()}
    assert {i: r["draws"] for i, r in got.items()} == {i: r["draws"] for i, r in again.items()}
    taken, per_shard = defaultdict(int), Counter()
    for i, *_ in rows:
        r = got[i]
        assert all(d["words"] <= r["size"] for d in r["draws"]) and len({d["pass"] for d in r["draws"]}) == len(r["draws"]) <= 3
        for d in r["draws"]:
            taken["abc"[min(2, i % 7)]] += d["words"]
            per_shard[d["shard"]] += 1
    for s in "abc":
        assert taken[s] == round(next(got[i]["target"] for i, _, _, x, _ in rows if x == s))
    assert set(per_shard) == set(range(5)) and max(per_shard.values()) < 2.5 * min(per_shard.values())
    out = mixing.mixed_documents(df, shards=5)
    assert out.columns == df.columns
    copies = Counter(r["doc_id"] for r in out.collect())
    assert copies == Counter({i: len(r["draws"]) for i, r in got.items() if r["draws"]})
    assert sum(len(SPACED.findall(r["text"])) for r in out.collect()) == sum(taken.values())


def test_mixing_cuts_texts_between_words_only(spark):
    text = "  one\ttwo\n\nthree  four\nfive six\r\nseven " * 9
    df = spark.createDataFrame([(i, text, "en", "ab"[i], len(text)) for i in range(2)], DOCS)
    out = mixing.mixed_documents(df, shards=2).collect()
    cut = [r for r in out if r["text"] != text]
    assert len(cut) == 2
    for r in out:
        assert text.startswith(r["text"]) and r["n_chars"] == len(r["text"])
    assert {text[len(r["text"])] for r in cut} <= set(" \t\n\r")


def test_urn_draws_every_ball(spark):
    quota = [(i, q) for i, q in enumerate((0, 1, 17, 400, 3))]
    nodes = spark.createDataFrame([(0, 6, i, k + 1) for i, q in quota for k in range(q)], "lo int, hi int, ord int, i bigint")
    for _ in range(3):
        nodes = mixing._split(nodes)
    of = Counter((r["lo"], r["hi"], r["ord"]) for r in nodes.collect())
    found = [(a, b, [of[a, b, k] for k in range(5)]) for a, b in sorted({x[:2] for x in of})]
    assert [(a, b) for a, b, _ in found] == [(i, i + 1) for i in range(6)]
    assert [sum(q[k] for _, _, q in found) for k in range(5)] == [0, 1, 17, 400, 3]
    assert all(min(q) >= 0 and abs(sum(q) - 421 / 6) <= 2 for _, _, q in found)


def _drawn_urn(balls, lo, hi):
    """A plain urn: the left half takes the balls of smallest key; for each shard its balls."""
    if hi - lo == 1 or not balls:
        return {lo: balls} if balls else {}
    mid = (lo + hi) // 2
    key = lambda b: (int(hashlib.md5(f"{mixing.SEED}:urn:{lo}:{hi}:{b[0]}:{b[1]}".encode()).hexdigest()[:15], 16), b)
    order = sorted(balls, key=key)
    n = (2 * len(balls) * (mid - lo) + hi - lo) // (2 * (hi - lo))
    return _drawn_urn(order[:n], lo, mid) | _drawn_urn(order[n:], mid, hi)


def test_quotas_and_places_by_plain_urns(spark):
    have = {1: (4, 9), 2: (1, 3), 3: (8, 29), 4: (2, 1)}
    sources = spark.createDataFrame([(k, b, n) for k, (b, n) in have.items()], "ord int, blocks bigint, instances bigint")
    for shards in (1, 2, 5, 16):
        quota = mixing.quotas(sources, shards)
        want = Counter((o, s) for s, balls in _drawn_urn([(k, i + 1) for k, (_, n) in have.items() for i in range(n)], 0, shards).items() for o, _ in balls)
        assert {(r["ord"], r["shard"]): r["quota"] for r in quota.collect()} == want
        at = [(r["ord"], r["block"], x["pass"], x["shard"], x["quota"]) for r in mixing.places(sources, quota).collect() for x in r["at"]]
        assert sorted((o, p * have[o][0] + b) for o, b, p, _, _ in at) == [(k, i) for k, (_, n) in have.items() for i in range(n)]  # each instance once
        assert Counter((o, s) for o, _, _, s, _ in at) == want and all(q == want[o, s] for o, _, _, s, q in at)
        if shards == 5:  # ranked in parts: the same
            wide = mixing.quotas(sources, shards, True)
            assert {(r["ord"], r["shard"]): r["quota"] for r in wide.collect()} == want
            assert sorted(at) == sorted((r["ord"], r["block"], x["pass"], x["shard"], x["quota"]) for r in mixing.places(sources, wide, True).collect() for x in r["at"])
    # the shares of a node vary as draws without replacement do
    firsts = [sum(1 for b in _drawn_urn([(k, i) for k in (1, 2) for i in range(20)], lo, lo + 2)[lo] if b[0] == 1) for lo in range(200)]
    mean, var = np.mean(firsts), np.var(firsts)
    assert abs(mean - 10) < 0.5 and abs(var - 20 * 0.25 * 20 / 39) < 0.8
    # a permutation, not a shift: neighbours in a source do not stay neighbours
    one = spark.createDataFrame([(1, 512, 512)], "ord int, blocks bigint, instances bigint")
    order = [r["block"] for r in mixing.places(one, mixing.quotas(one, 64)).selectExpr("block", "at[0].shard s").orderBy("s", "block").collect()]
    assert sum(abs(a - b) == 1 for a, b in zip(order, order[1:])) < 20


def test_shards_follow_the_words():
    assert [mixing.shards_for(n) for n in (0, 1, mixing.WORDS_PER_SHARD * 64, mixing.WORDS_PER_SHARD * 64 + 1, mixing.WORDS_PER_SHARD * 1000)] == [64, 64, 64, 128, 1024]


def test_warc(spark):
    rng = random.Random(4)
    body = [_prose(rng, 400) for _ in range(6)]
    rows = [(i, f"http://h/{i}?é \r\nX: y%", body[i % 6] if i % 3 else f"{i} {_prose(rng, 300)}") for i in range(200)]
    rows += [(300, None, None), (301, "u", ""), (302, "u", "short"), (303, "u", "short"), (None, "u", body[1]), (None, "u", "alone " * 300), (rows[-1][0], rows[-1][1], rows[-1][2]), (400, "u", "é" * 499), (401, "u", "é" * 499), (402, "u", "é" * 500), (403, "u", "é" * 500), (404, "u", "x" * 3_000_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit(1) for c in ("digest", "size", "kind", "payload", "kept")}).repartition(3)
    best = {}
    for i, _, h in rows:
        b = (h or "").encode()
        if len(b) >= 1000 and i is not None:
            best[b] = max(best.get(b, -1), i)
    want = []
    for i, u, h in rows:
        b = (h or "").encode()
        k = best.get(b, i) if len(b) >= 1000 else i
        want.append((repr(i), repr(u), len(b), hashlib.sha1(b).hexdigest(), "response" if k == i else "revisit", repr(None if k == i else k), repr(b if k == i else None)))
    manifest = warc.write(df)
    got = [(repr(r["page_id"]), repr(r["url"]), r["payload_bytes"], r["payload_digest"], r["record_type"], repr(r["refers_to"]), repr(None if r["payload"] is None else bytes(r["payload"]))) for r in warc.read(manifest, payloads=True).collect()]
    assert sorted(got) == sorted(want)
    path = manifest.first()["path"].removeprefix("file://")
    raw = open(path, "rb").read()
    assert raw[:4] == b"\x5d\x2a\x4d\x18"
    import io

    assert all(f.startswith(b"WARC/1.1\r\n") and f.endswith(b"\r\n\r\n") for f in warc.frames(io.BytesIO(raw)))
    for damaged in (raw[:-3], raw[: len(raw) // 2] + b"\x00\x01" + raw[len(raw) // 2 + 2 :], raw[:20]):
        with pytest.raises(warc.Damaged):
            for f in warc.frames(io.BytesIO(damaged)):
                warc.parse(f)
    assert warc.read(warc.write(df.where("false"))).count() == 0


def test_warc_validation():
    good = warc.record(1, "http://x/", b"payload", hashlib.sha1(b"payload").hexdigest(), "response", None, 7)
    assert warc.parse(good)["payload"] == b"payload"
    for a, b in ((b"WARC/1.1", b"WARC/9"), (b"WARC-Type: response", b"WARC-Type: other"), (b"Content-Length: 7", b"Content-Length: 8"), (b"payload\r\n", b"pay1oad\r\n"), (b"WARC-Date: ", b"WARC-Dote: "), (b"\r\n\r\npay", b"\r\npay"), (b"urn:page:1", b"urn:what:1")):
        with pytest.raises(warc.Damaged):
            warc.parse(good.replace(a, b))


def _near(texts, k, percent):
    sets = {}
    for i, t in texts.items():
        w = (t or "").translate(LOW).encode().split()
        sets[i] = frozenset(tuple(w[j : j + k]) for j in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[:x]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                p, q = find(a), find(b)
                parent[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), find(i)) for i in ids}


def test_near_duplicates(spark, docs, empty):
    rng = random.Random(12)
    texts = dict(enumerate(_texts()))
    vocabulary = [f"w{i}" for i in range(4000)]
    for group in range(4):  # copies of copies, so links chain and hubs do not link everything
        ws = [rng.choice(vocabulary) for _ in range(120)]
        for _ in range(25):
            own = list(ws)
            for _ in range(rng.randrange(0, 14)):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            texts[len(texts)] = " ".join(own)
            if rng.random() < 0.4:
                ws = own
    rows = list(texts.items())
    df = spark.createDataFrame(rows + [rows[3], (None, texts[0]), (None, "")], "doc_id long, text string").withColumns({c: F.lit(1) for c in ("n", "s1", "keys", "node", "job", "a", "_gone", "label")})
    for k in (2, 5):
        want = _near(texts, k, 80)
        got = _by_id(near_dup.near_duplicates(df, k))
        assert sum(map(len, got.values())) == df.count()
        for i, (n, c) in want.items():
            assert all((r["n_shingles"], r["component_id"], r["kept"]) == (n, c, i == c) for r in got[i])
        assert all(r["component_id"] is None and r["kept"] for r in got[None])
    kept = near_dup.distinct_documents(df)
    assert kept.columns == df.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, (_, c) in want.items() if i == c} | {None}
    assert near_dup.near_duplicates(empty).count() == 0 and near_dup.distinct_documents(empty).count() == 0


def test_rest_blocks_find_what_hubs_miss(spark, monkeypatch):
    """Small blocks, and a group in which neighbours are linked but few are linked with any one hub."""
    monkeypatch.setattr(near_dup, "STAR_BLOCK", 3)
    monkeypatch.setattr(near_dup, "LEFT_BLOCK", 4)
    monkeypatch.setattr(near_dup, "RIGHT_BLOCK", 5)
    rng = random.Random(13)
    ws = [f"v{rng.randrange(10**6)}" for _ in range(100)]
    texts = {}
    for i in range(40):
        texts[i] = " ".join(ws)
        for _ in range(3):
            ws[rng.randrange(100)] = f"v{rng.randrange(10**6)}"
    got = {r["doc_id"]: r["component_id"] for r in near_dup.near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), 2).collect()}
    assert got == {i: c for i, (_, c) in _near(texts, 2, 80).items()}


def test_near_duplicates_with_several_texts_of_one_document(spark):
    rng = random.Random(17)
    make = lambda n=60: [f"u{rng.randrange(10**6)}" for _ in range(n)]
    a, b, c, d = make(), make(), make(), make()
    near = lambda ws: " ".join(ws[:-1] + ["other"])
    rows = [(11, " ".join(a)), (11, " ".join(b)), (12, near(a)), (13, near(b)), (24, " ".join(c)), (25, " ".join(d)), (25, " ".join(c)), (25, ""), (33, near(d)), (40, " ".join(make())), (50, " ".join(make(3))), (51, None)]
    want = {11: 11, 12: 11, 13: 11, 24: 24, 25: 24, 33: 24, 40: 40, 50: 50, 51: 51}
    for k in (1, 3):
        got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(k), 2).collect()
        assert len(got) == len(rows)
        for r in got:
            assert r["component_id"] == (25 if r["doc_id"] == 25 and not r["n_shingles"] else want[r["doc_id"]]), r
    kept = near_dup.distinct_documents(spark.createDataFrame(rows, "doc_id long, text string"), 2)
    assert {r["doc_id"] for r in kept.collect()} == {11, 24, 40, 50, 51}


def test_bands_keep_what_can_be_linked(spark):
    for percent in (50, 80, 100):
        found = {r["n"]: r["b"] for r in spark.range(1, 3000).select(F.col("id").alias("n"), near_dup._band(F.col("id"), percent).alias("b")).collect()}
        assert all(abs(found[n] - found[m]) <= 1 for n in found for m in range(-(-n * percent // 100), n + 1) if m)


def test_tables_pair_by_similarity():
    """Of pairs at 0.8 none is missed, and few at 0.3 are candidates."""
    rng = np.random.default_rng(6)
    meet = {}
    for name, common in (("near", 400), ("half", 300), ("far", 207)):  # of 450 each: 0.8, 0.5, 0.3
        n, met = 300, 0
        for _ in range(n):
            both = rng.integers(0, 1 << 56, common, dtype=np.uint64)
            own = [rng.integers(0, 1 << 56, 450 - common, dtype=np.uint64) for _ in range(2)]
            v = np.concatenate([both, own[0], both, own[1]])
            one, two = near_dup.half_keys(v, np.array([0, 450, 900]))
            same = one == two
            met += same[: near_dup.SIDE].any() and same[near_dup.SIDE :].any()
        meet[name] = met / n
    assert meet["near"] == 1 and meet["half"] < 0.6 and meet["far"] < 0.05


def test_components(spark):
    rng = random.Random(14)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 200 + i) for i in range(50)] + [(rng.randrange(1000, 1400), rng.randrange(1000, 1400)) for _ in range(250)]
    edges = [(a, b) for a, b in edges if a != b]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        p, q = find(a), find(b)
        parent[max(p, q)] = min(p, q)
    rng.shuffle(edges)
    got = near_dup.components(spark.createDataFrame(edges, "a long, b long"))
    assert dict(map(tuple, got.collect())) == {x: find(x) for x in parent}


def test_stored_tables_survive_and_small_tables_are_broadcast(spark):
    df = tables.stored(spark.range(10), "test")
    assert "Scan parquet" in df._jdf.queryExecution().executedPlan().toString()
    assert tables.shared_dir(spark).startswith("file:")
    near = spark.range(100).join(tables.small(df, 10), "id")._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" in near
