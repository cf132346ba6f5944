"""Exact top-k by integer inner product over vector-approximation files.

Two stored tables make the index: the exact vectors (integers, by a row number), and the approximation file, whose rows are
blocks of up to BLOCK vectors: every component without its lowest bits, in one byte. For a query the inner product with the
cells bounds a score from both sides, and the distance of the bounds depends on the query alone.

Queries are a table too, dealt by a hash into blocks of about QUERY_BLOCK, of which one at a time is broadcast. First a scan
of the cells alone gives, for each query, the vectors whose upper bound reaches its k-th lower bound so far; the k-th largest
lower bound over all tasks then leaves the survivors. Their exact vectors are read by row number in the order of their upper
bounds: FIRST * k of each query, then those whose bound is not below the k-th score found, so that this is certain. Pairs of
query and survivor move, nothing is gathered on the driver.

Of equal vectors only the k + 1 of smallest vec_id can be among the k best (a query may be one of them), so others are left
out of a block, and of a query's survivors: a large group of copies costs no more than a small one.

Defined cases: vectors that are null or hold null or non-finite components, and rows without vec_id, take no part; missing
components of a shorter vector count as 0; rows with the query's own vec_id are not its candidates; repeated queries
are answered once (of several vectors of one vec_id, the smallest asks), repeated candidates count each; an empty table
gives no rows. Integers are 64-bit: components beyond that are clamped to its ends, and so are scores, which are worked out
without wrapping, and rank as clamped. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from almanac.llm import tables, words

TOP = 5
EVERY = 50
SCALE = 256
#: Queries of one broadcast, vectors of one row of the approximation file, and exact vectors of a query read first (times k).
QUERY_BLOCK = 16_384
BLOCK = 8_192
FIRST = 2
SMALL = 2_000_000
_ROWS = 128  # queries that are multiplied at once
_MOST = (1 << 63) - 1


def integers(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vectors (vec_id, embedding) to vec_id, v (floor(scale * x), as long) of those that take part."""
    sound = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.forall("embedding", lambda x: F.coalesce(F.abs(x.cast("double")) < F.lit(float("inf")), F.lit(False)))
    v = F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))
    return vectors.where(sound).select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column, filled up with zeros."""
    size = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(size), int(size.max(initial=0))), np.int64)
    out[np.arange(out.shape[1]) < size[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def shift_of(v: np.ndarray) -> int:
    """Lowest bits that cells leave out, so that what remains fits one signed byte."""
    most = max(int(v.max(initial=0)), -int(v.min(initial=0)) - 1, 0)
    return max(0, most.bit_length() - 7)


def first_copies(ids: np.ndarray, v: np.ndarray, most: int) -> np.ndarray:
    """Rows to keep: of equal vectors, the `most` of smallest id (then row)."""
    group = np.unique(v, axis=0, return_inverse=True)[1].ravel() if v.shape[1] else np.zeros(len(v), np.int64)
    order = np.lexsort((ids, group))
    begin = np.flatnonzero(np.diff(group[order], prepend=-1))
    rank = np.arange(len(order)) - np.repeat(begin, np.diff(begin, append=len(order)))
    return np.sort(order[rank < most])


def signature(v: np.ndarray) -> np.ndarray:
    """A hash of each vector that filling up with zeros does not change."""
    place = np.arange(1, v.shape[1] + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return np.where(v == 0, np.uint64(0), words.mix(words.mix(v.view(np.uint64)) + place)).sum(1, dtype=np.uint64).view(np.int64)


def _blocks(k: int):
    """For mapInArrow over (row, vec_id, v): rows of the approximation file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, BLOCK):
                part = batch.slice(a, BLOCK)
                rows, ids = (part.column(i).to_numpy(zero_copy_only=False) for i in range(2))
                v = matrix(part.column(2))
                keep = first_copies(ids, v, k + 1)
                v, s = np.ascontiguousarray(v[keep]), shift_of(v[keep])
                raw = [x.tobytes() for x in (rows[keep], ids[keep], signature(v), (v >> s).astype(np.int8))]
                yield pa.RecordBatch.from_arrays([*[pa.array([x], pa.binary()) for x in raw], pa.array([s], pa.int32()), pa.array([len(keep)], pa.int32())], ["rows", "ids", "signs", "cells", "shift", "n"])

    return run


def index(vectors: DataFrame, k: int = TOP, scale: int = SCALE) -> tuple[DataFrame, DataFrame]:
    """The exact vectors (row, vec_id, v) and the approximation file (rows, ids, signs, cells, shift, n), stored."""
    exact = tables.stored(integers(vectors, scale).select(F.monotonically_increasing_id().alias("row"), "vec_id", "v"), "vector-exact")
    return exact, tables.stored(exact.mapInArrow(_blocks(k), "rows binary, ids binary, signs binary, cells binary, shift int, n int"), "vector-cells")


def bounds(q: np.ndarray, cells: np.ndarray, shift: int) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the scores of queries (rows of q) with vectors of which cells and shift are known."""
    width = max(q.shape[1], cells.shape[1])
    q, cells = (np.pad(x.astype(np.float64), ((0, 0), (0, width - x.shape[1]))) for x in (q, cells))
    unit = float(1 << shift)
    inner = (q @ cells.T) * unit
    # what doubles may round off
    slack = np.abs(q).sum(1) * 128 * unit * (width + 8) * 2.0**-52
    up, down = np.maximum(q, 0).sum(1) * (unit - 1) + slack, np.minimum(q, 0).sum(1) * (unit - 1) - slack
    return inner + down[:, None], inner + up[:, None]


def scan_block(query_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, cells: np.ndarray, shift: int, best: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Pairs whose upper bound reaches the query's k-th lower bound so far: query, vector, bounds. best: the k largest lower bounds of each query, updated."""
    low, high = bounds(q, cells, shift)
    own = query_ids[:, None] == ids[None, :]
    low[own], high[own] = -np.inf, -np.inf
    k = best.shape[1]
    best[:] = np.partition(np.concatenate([best, low], axis=1), -k, axis=1)[:, -k:]
    query, vector = np.nonzero((high >= best.min(1)[:, None]) & ~own)
    return query, vector, low[query, vector], high[query, vector]


def _scan(k: int):
    """For mapInArrow over rows of the approximation file with `asked` (id, v): candidates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids = q = best = None
        for batch in batches:
            if q is None:  # every row of a task has the same queries
                asked = batch.column(6).slice(0, 1).flatten()
                query_ids, q = asked.field(0).to_numpy(zero_copy_only=False), matrix(asked.field(1))
                best = np.full((len(q), k), -np.inf)
            for i in range(batch.num_rows):
                rows, ids, signs = (np.frombuffer(batch.column(c)[i].as_py(), np.int64) for c in range(3))
                cells = np.frombuffer(batch.column(3)[i].as_py(), np.int8).reshape(len(ids), -1) if len(ids) else np.zeros((0, 0), np.int8)
                for a in range(0, len(q), _ROWS):
                    at = slice(a, a + _ROWS)
                    query, vector, low, high = scan_block(query_ids[at], q[at], ids, cells, batch.column(4)[i].as_py(), best[at])
                    if len(query):
                        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (query_ids[at][query], rows[vector], ids[vector], signs[vector], low, high)], ["query_id", "row", "vec_id", "sign", "low", "high"])

    return run


def exact_scores(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Inner products of rows, clamped to 64 bits."""
    width = max(q.shape[1], v.shape[1])
    q, v = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (q, v))
    wide = np.abs(q.astype(np.float64)).sum(1) * np.abs(v.astype(np.float64)).max(1, initial=0) >= 2.0**62
    out = (q * np.where(wide[:, None], 0, v)).sum(1)
    for i in np.flatnonzero(wide).tolist():
        total = sum(a * b for a, b in zip(q[i].tolist(), v[i].tolist()))
        out[i] = max(-_MOST - 1, min(_MOST, total))
    return out


def _scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        score = exact_scores(matrix(batch.column(3)), matrix(batch.column(4)))
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(score)], ["query_id", "row", "vec_id", "score"])


def _read(pairs: DataFrame, exact: DataFrame, asked: DataFrame) -> DataFrame:
    """pairs (query_id, row, vec_id), stored, with their scores, stored. The pairs' rows select the exact vectors to read."""
    wanted = tables.small(pairs.select("query_id", F.col("row").alias("_row")), SMALL)
    joined = exact.join(wanted, F.col("row") == F.col("_row")).join(asked.select(F.col("vec_id").alias("_q"), F.col("v").alias("qv")), F.col("query_id") == F.col("_q"))
    return tables.stored(joined.select("query_id", "row", "vec_id", "qv", "v").mapInArrow(_scores, "query_id long, row long, vec_id long, score long"), "vector-scores")


def _best(scored: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id", "row"))
    return scored.withColumn("rank", rank).where(F.col("rank") <= k)


@tables.tidy
def _answer(cells: DataFrame, exact: DataFrame, asked: DataFrame, part: int, k: int) -> DataFrame:
    """The k best of one block of queries (vec_id, v, part)."""
    packed = asked.groupBy("part").agg(F.sort_array(F.collect_list(F.struct("vec_id", "v"))).alias("asked"))  # QUERY_BLOCK queries or so
    file = cells.withColumn("part", F.lit(part).cast("long")).join(F.broadcast(packed), "part").select(*cells.columns, "asked")
    scanned = file.mapInArrow(_scan(k), "query_id long, row long, vec_id long, sign long, low double, high double")
    found = tables.stored(scanned, "vector-candidates")
    of = Window.partitionBy("query_id")
    kth = F.row_number().over(of.orderBy(F.col("low").desc()))
    floors = found.select("query_id", "low").withColumn("n", kth).where(F.col("n") <= k).groupBy(F.col("query_id").alias("_q")).agg(F.min("low").alias("floor"), F.count("*").alias("n"))
    floors = tables.small(tables.stored(floors, "vector-floors"), SMALL)
    near = found.join(floors, F.col("query_id") == F.col("_q")).where((F.col("n") < k) | (F.col("high") >= F.col("floor")))
    copy = F.row_number().over(Window.partitionBy("query_id", "sign", "high").orderBy("vec_id", "row"))
    near = near.withColumn("copy", copy).where(F.col("copy") <= k).withColumn("order", F.row_number().over(of.orderBy(F.col("high").desc(), "vec_id", "row")))
    near = tables.stored(near.select("query_id", "row", "vec_id", "high", "order"), "vector-survivors")
    scored = _read(near.where(F.col("order") <= FIRST * k), exact, asked)
    certain = _best(scored, k).groupBy(F.col("query_id").alias("_q")).agg(F.min("score").alias("least"))
    certain = tables.small(tables.stored(certain, "vector-certain"), SMALL)
    left = near.where(F.col("order") > FIRST * k).join(certain, F.col("query_id") == F.col("_q")).where(F.col("high") >= F.col("least").cast("double"))
    left = tables.stored(left.select("query_id", "row", "vec_id"), "vector-uncertain")
    return tables.keep(tables.stored(_best(scored.union(_read(left, exact, asked)), k).select("query_id", "rank", "vec_id", "score"), "vector-best"))


@tables.tidy
def search(vectors: DataFrame, queries: DataFrame | None = None, k: int = TOP, scale: int = SCALE) -> DataFrame:
    """vectors (vec_id, embedding) to query_id, rank, vec_id, score. queries: likewise; else the vectors with a vec_id divisible by EVERY."""
    tables.ship(vectors.sparkSession)
    exact, cells = index(vectors, k, scale)
    asked = exact.where(F.col("vec_id") % EVERY == 0).select("vec_id", "v") if queries is None else integers(queries, scale)
    asked = asked.groupBy("vec_id").agg(F.min("v").alias("v"))
    blocks = max(1, -(-exact.where(F.col("vec_id") % EVERY == 0).count() // QUERY_BLOCK)) if queries is None else max(1, -(-queries.count() // QUERY_BLOCK))
    asked = tables.stored(asked.withColumn("part", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("long")), "vector-queries")
    answers = [tables.keep(_answer(cells, exact, asked.where(F.col("part") == b), b, k)) for b in range(blocks)]
    found = answers[0]
    for more in answers[1:]:
        found = found.union(more)
    return found
