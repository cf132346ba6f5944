"""Toxicity scores of whole texts from a convolutional classifier over hashed word embeddings, trained here in numpy.

A word (letters, digits and all beyond ASCII, lower-cased) is the sum of the embeddings of its hash and of the hashes of
its first 3 to 8 bytes, so inflected forms of a stem share what is learned. Filters of one, two and three words slide over
a text, each is max-pooled and rectified, and a linear layer makes the score. The first embedding dimension starts from a
cautious log-odds of each hash; everything is then trained by stochastic gradients (Adagrad).

Training rows: labelled documents whose crc32(doc_id as text) mod 5 is not 0, in the order of a hash: of each label, rows
of at most LONGEST characters until MOST_POSITIVE or MOST_NEGATIVE rows, or MOST_CHARACTERS characters, are reached. The
sample is chosen from ids and lengths alone; only its texts then move, to one executor task, which trains and stores the
model. A quarter of the rows, apart from the others, sets the scale of scores (0.5 is where the two kinds of error balance
best) and, for each language with enough rows, the threshold at which clean_documents() rejects. Labels, language, source
and doc_id are never inputs of a score.

Defined cases: a null or empty text has the score of no words; a null doc_id counts as held out; a label that is null is
not used, and of repeated labels of a document the larger counts; of several texts of one doc_id the one of smallest hash
is learned from; a text of more than LONGEST characters is not learned from, and scored like any other; without training
rows of both kinds every score is 0 and nothing is rejected; an empty table gives no rows; repeated rows are scored each.
Other columns are not read.
"""

from __future__ import annotations

import dataclasses
import io
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from almanac.llm import tables, words

#: Bounds of the training sample: rows of label 1 and 0, characters of each label, characters of a text.
MOST_POSITIVE, MOST_NEGATIVE, MOST_CHARACTERS, LONGEST = 4_000, 6_000, 24_000_000, 240_000
BUCKET_BITS = 18
PREFIXES = (3, 4, 5, 6, 7, 8)
SIZE, FILTERS, WIDTHS = 8, 6, (1, 2, 3)
EPOCHS, BATCH, RATE = 4, 32, 0.05
LEAST_BY_LANGUAGE = 25
_PAD = max(WIDTHS)
_PARTS = 1 + len(PREFIXES)


def features(texts: words.Texts) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of each word (its hash and its prefixes'; 0 where the word is shorter), and the texts' bounds."""
    w = texts.words(words.ALNUM, fold=True)
    size = w.ends - w.starts
    out = np.zeros((len(w), _PARTS), np.int32)
    shift = np.uint64(64 - BUCKET_BITS)
    out[:, 0] = w.hashes() >> shift
    for j, p in enumerate(PREFIXES):
        at = np.flatnonzero(size >= p)
        out[at, j + 1] = words.mix(w.spans(w.starts[at], w.starts[at] + p) ^ np.uint64(p)) >> shift
    return out, w.bounds


class Sample:
    """Training texts as numbers of distinct words, whose buckets are worked out once."""

    def __init__(self, tokens: np.ndarray, bounds: np.ndarray, buckets: np.ndarray):
        self.tokens, self.bounds, self.vocabulary = tokens, bounds, buckets

    @classmethod
    def of(cls, texts: pa.ChunkedArray | pa.Array) -> "Sample":
        return cls.of_pieces(words.chunks(texts))

    @classmethod
    def of_pieces(cls, pieces: Iterator[words.Texts]) -> "Sample":
        """The sample of texts that come one after another; none is kept."""
        keys, rows, each, counts = [np.zeros(0, np.uint64)], [np.zeros((0, _PARTS), np.int32)], [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)]
        for piece in pieces:
            w = piece.words(words.ALNUM, fold=True)
            ids, h = features(piece)[0], w.hashes()
            own, first = np.unique(h, return_index=True)
            keys.append(own)
            rows.append(ids[first])
            each.append(h)
            counts.append(w.counts)
        key, first = np.unique(np.concatenate(keys), return_index=True)
        tokens = np.searchsorted(key, np.concatenate(each)).astype(np.int32)
        return cls(tokens, np.cumsum(np.concatenate(counts)), np.concatenate(rows)[first])

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def take(self, rows) -> "Sample":
        parts = [self.tokens[self.bounds[i] : self.bounds[i + 1]] for i in np.asarray(rows).tolist()]
        return Sample(np.concatenate([self.tokens[:0], *parts]), np.cumsum([0, *map(len, parts)]), self.vocabulary)

    def buckets(self) -> tuple[np.ndarray, np.ndarray]:
        """Buckets of each word, and the texts' bounds."""
        return self.vocabulary[self.tokens], self.bounds

    def batches(self, size: int = 64) -> Iterator[tuple[slice, "Sample"]]:
        for a in range(0, len(self), size):
            rows = slice(a, min(len(self), a + size))
            yield rows, self.take(range(rows.start, rows.stop))


@dataclasses.dataclass
class Model:
    embedding: np.ndarray  # bucket, SIZE; bucket 0 stands for nothing
    filters: list[np.ndarray]  # for each width: its place, SIZE, FILTERS
    bias: np.ndarray  # width * filter
    out: np.ndarray
    base: float
    scale: float = 1.0
    thresholds: dict = dataclasses.field(default_factory=dict)

    def words(self, ids: np.ndarray) -> np.ndarray:
        x = self.embedding[ids[:, 0]]
        for j in range(1, ids.shape[1]):
            x = x + self.embedding[ids[:, j]]
        return x

    def padded(self, x: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The words of all texts, each followed by _PAD empty ones so that none has no window, and where each text begins."""
        n = np.diff(bounds)
        out = np.zeros((len(x) + _PAD * len(n), x.shape[1]), np.float32)
        out[np.arange(len(x)) + _PAD * np.repeat(np.arange(len(n)), n)] = x
        return out, bounds[:-1] + _PAD * np.arange(len(n))

    def responses(self, padded: np.ndarray, begin: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each width: the responses of all windows, and the edges and largest ones of each text's windows."""
        edges = np.empty(2 * len(begin), np.int64)
        # windows of a text begin at its words, or at its first empty word if it has none
        edges[::2], edges[1::2] = begin, begin + np.maximum(np.diff(bounds), 1)
        for f in self.filters:
            z = padded @ f[0]
            for j in range(1, len(f)):
                z[:-j] += padded[j:] @ f[j]
            yield z, edges, np.maximum.reduceat(z, edges)[::2]

    def pooled(self, x: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Largest response of each filter in each text."""
        padded, begin = self.padded(x, bounds)
        return np.concatenate([best for _, _, best in self.responses(padded, begin, bounds)], axis=1) + self.bias

    def logits(self, ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        return (np.maximum(self.pooled(self.words(ids), bounds), 0) @ self.out + self.base) * self.scale

    def scores(self, ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(ids, bounds).astype(np.float64), -30, 30)))

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        head = json.dumps({"base": self.base, "scale": self.scale, "thresholds": self.thresholds})
        np.savez(out, embedding=self.embedding, bias=self.bias, out=self.out, head=np.array(head), **{f"filter{i}": f for i, f in enumerate(self.filters)})
        return out.getvalue()

    @classmethod
    def from_bytes(cls, raw: bytes) -> "Model":
        with np.load(io.BytesIO(raw)) as z:
            return cls(z["embedding"], [z[f"filter{i}"] for i in range(len(WIDTHS))], z["bias"], z["out"], **json.loads(str(z["head"])))


def _log_odds(docs: Sample, y: np.ndarray) -> np.ndarray:
    """For each bucket, how much likelier it is in a text of label 1: the log-odds less two standard errors, from 0 up."""
    n = np.zeros((2, 1 << BUCKET_BITS))
    for rows, part in docs.batches():
        ids, bounds = part.buckets()
        of = np.repeat(np.arange(len(part)), np.diff(bounds))
        once = np.unique(of[:, None] << BUCKET_BITS | ids)
        for label in (0, 1):
            own = once[y[rows][once >> BUCKET_BITS] == label]
            n[label] += np.bincount(own & (1 << BUCKET_BITS) - 1, minlength=1 << BUCKET_BITS)
    a, b = n[1] + 0.5, n[0] + 0.5
    odds = np.log(a / (y.sum() + 1)) - np.log(b / (len(y) - y.sum() + 1))
    odds = np.clip(odds - 2 * np.sqrt(1 / a + 1 / b), 0, 4)
    odds[0] = 0
    return odds


class _Adagrad:
    def __init__(self, value: np.ndarray):
        self.value, self.seen = value, np.full_like(value, 1e-3)

    def step(self, gradient: np.ndarray, at=slice(None)) -> None:
        self.seen[at] += gradient**2
        self.value[at] -= RATE * gradient / np.sqrt(self.seen[at])


def gradients(m: Model, part: Sample, y: np.ndarray, weight: np.ndarray) -> tuple[dict, np.ndarray, np.ndarray]:
    """Gradients of the weighted cross-entropy, summed over a batch: of the dense parameters, and of the embeddings of some buckets."""
    ids, bounds = part.buckets()
    padded, begin = m.padded(m.words(ids), bounds)
    end = begin + np.diff(bounds)
    at, best = [], []
    index = np.arange(len(padded))[:, None]
    for z, edges, top in m.responses(padded, begin, bounds):
        first = np.where(z == np.repeat(top, np.diff(bounds) + _PAD, axis=0), index, len(padded))
        at.append(np.minimum.reduceat(first, edges)[::2])
        best.append(top)
    h = np.concatenate(best, axis=1) + m.bias
    p = 1 / (1 + np.exp(-np.clip(np.maximum(h, 0) @ m.out + m.base, -30, 30)))
    g = ((p - y) * weight).astype(np.float32)
    gh = g[:, None] * m.out * (h > 0)
    grad = {"out": g @ np.maximum(h, 0), "base": np.array([g.sum()], np.float32), "bias": gh.sum(0)}
    rows, parts = [np.zeros((0, _PARTS), np.int32)], [np.zeros((0, SIZE), np.float32)]
    for i, f in enumerate(m.filters):
        own = gh[:, i * FILTERS : (i + 1) * FILTERS]
        grad[i] = np.empty_like(f)
        for j in range(len(f)):
            place = at[i] + j
            grad[i][j] = np.einsum("tfs,tf->sf", padded[place], own)
            text, k = np.nonzero((place < end[:, None]) & (own != 0))
            rows.append(ids[place[text, k] - _PAD * text])
            parts.append(own[text, k][:, None] * f[j].T[k])
    flat, inverse = np.unique(np.concatenate(rows), return_inverse=True)
    each = np.repeat(np.concatenate(parts), _PARTS, axis=0)
    total = np.stack([np.bincount(inverse.ravel(), each[:, d], len(flat)) for d in range(SIZE)], axis=1).astype(np.float32)
    return grad, flat[flat > 0], total[flat > 0]


def train(docs: Sample, y: np.ndarray, seed: int = 7) -> Model:
    """y: labels of the sample's texts."""
    rng = np.random.default_rng(seed)
    e = rng.normal(0, 0.01, (1 << BUCKET_BITS, SIZE)).astype(np.float32)
    e[:, 0] = _log_odds(docs, y)
    e[0] = 0
    filters = [rng.normal(0, 0.1, (w, SIZE, FILTERS)).astype(np.float32) for w in WIDTHS]
    for f in filters:
        f[:, 0, :] = rng.uniform(0.2, 0.6, (len(f), FILTERS)) / len(f)
    m = Model(e, filters, np.zeros(len(WIDTHS) * FILTERS, np.float32), np.full(len(WIDTHS) * FILTERS, 0.2, np.float32), float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1))))
    base = np.array([m.base], np.float32)
    steps = {k: _Adagrad(v) for k, v in (("e", e), ("bias", m.bias), ("out", m.out), ("base", base), *((i, f) for i, f in enumerate(filters)))}
    weight = np.where(y == 1, len(y) / max(1, 2 * y.sum()), len(y) / max(1, 2 * (len(y) - y.sum())))
    for _ in range(EPOCHS):
        for batch in np.array_split(rng.permutation(len(y)), max(1, len(y) // BATCH)):
            grad, ids, of_ids = gradients(m, docs.take(batch), y[batch], weight[batch] / len(batch))
            for k, g in grad.items():
                steps[k].step(g + 1e-4 * steps[k].value)
            steps["e"].step(of_ids, ids)
            m.base = float(base[0])
    return m


def _best_cut(z: np.ndarray, y: np.ndarray) -> float:
    """The value between neighbours at which F1 is best; the middle of the best stretch."""
    order = np.argsort(-z, kind="stable")
    hits = np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(z) + 1) + y.sum())
    f1[:-1][z[order][:-1] == z[order][1:]] = -1  # equal values go together
    i = int(f1.argmax())
    below = z[order][i + 1] if i + 1 < len(z) else z[order][i] - 2
    return float((z[order][i] + below) / 2)


def calibrate(m: Model, docs: Sample, y: np.ndarray, lang: list) -> None:
    """Sets base and scale so that 0.5 is the best cut, and a threshold for each language with rows enough."""

    def each(f) -> np.ndarray:
        return np.concatenate([f(*part.buckets()) for _, part in docs.batches()])

    z = each(m.logits)
    if len(set(y.tolist())) > 1:
        cut = _best_cut(z, y)
        m.base -= cut
        apart = np.median(z[y == 1]) - cut, cut - np.median(z[y == 0])
        m.scale = float(np.clip(3 / max(min(apart), 1e-3), 0.25, 4))
    p = each(m.scores)
    for code in sorted({x for x in lang if x is not None}):
        own = np.array([x == code for x in lang])
        if min(y[own].sum(), (1 - y[own]).sum()) >= LEAST_BY_LANGUAGE:
            m.thresholds[code] = float(np.clip(_best_cut(p[own], y[own]), 0.2, 0.8))


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0


def training_rows(docs: DataFrame, labels: DataFrame, positive: int = MOST_POSITIVE, negative: int = MOST_NEGATIVE, characters: int = MOST_CHARACTERS, longest: int = LONGEST) -> DataFrame:
    """toxic, lang, text of the bounded sample, in one partition and in order."""
    known = labels.where(F.col("toxic").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # of each document only its text's length and hash; of several texts the one of smallest hash
    mark = F.xxhash64("text").alias("mark")
    lengths = docs.select("doc_id", F.struct(mark, F.coalesce(F.length("text"), F.lit(0)).alias("n")).alias("t"))
    sized = lengths.join(known, "doc_id").groupBy("doc_id", "toxic").agg(F.min("t").alias("t")).where(F.col("t.n") <= longest)
    sized = sized.select("doc_id", "toxic", "t.mark", "t.n", F.xxhash64("doc_id").alias("h"))
    first = [sized.where(F.col("toxic") == y).orderBy("h", "doc_id").limit(most) for y, most in ((1, positive), (0, negative))]
    until = F.sum("n").over(Window.partitionBy("toxic").orderBy("h", "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    sample = first[0].union(first[1]).withColumn("until", until).where(F.col("until") <= characters)  # positive + negative rows at most, without texts
    sample = tables.stored(sample.select("doc_id", "mark", "toxic", "h"), "toxic-sample")
    rows = docs.select("doc_id", mark, "lang", "text").join(F.broadcast(sample), ["doc_id", "mark"])
    rows = rows.groupBy("doc_id", "toxic", "h").agg(F.min("lang").alias("lang"), F.min("text").alias("text"))  # equal texts
    return rows.repartition(1).sortWithinPartitions("h", "doc_id").select("toxic", "lang", "text")


def fitted(y: np.ndarray, lang: list, texts: Sample) -> Model:
    """A model trained on three quarters of the rows and calibrated on the others (on all, where either has one label only)."""
    apart = np.arange(len(y)) % 4 == 3 if min(y.sum(), len(y) - y.sum()) >= 8 else np.zeros(len(y), bool)
    fitting = np.flatnonzero(~apart)
    m = train(texts.take(fitting), y[fitting])
    check = np.flatnonzero(apart) if apart.any() and len(set(y[apart].tolist())) > 1 else fitting
    calibrate(m, texts.take(check), y[check], [lang[i] for i in check])
    return m


def _trainer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow over one partition (toxic, lang, text): one row, the model; none without rows of both kinds."""
    labels, lang = [], []

    def pieces() -> Iterator[words.Texts]:
        for batch in batches:
            labels.extend(batch.column(0).to_pylist())
            lang.extend(batch.column(1).to_pylist())
            yield from words.chunks(batch.column(2))

    sample = Sample.of_pieces(pieces())
    y = np.array(labels, np.int64)
    if len(set(labels)) > 1:
        model = fitted(y, lang, sample).to_bytes()
        del sample
        words.give_back()
        yield pa.RecordBatch.from_arrays([pa.array([model], pa.binary())], ["model"])


@tables.tidy
def fit(docs: DataFrame, labels: DataFrame) -> Model | None:
    """The model, trained in one executor task from the bounded sample; None without rows of both kinds."""
    tables.ship(docs.sparkSession)
    found = tables.stored(training_rows(docs, labels).mapInArrow(_trainer, "model binary"), "toxic-model").collect()
    return Model.from_bytes(found[0][0]) if found else None


def _scorer(model: Model | None, keep: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in words.chunks(batch.column(keep)):
                s = np.zeros(len(texts)) if model is None else model.scores(*features(texts))
                yield pa.RecordBatch.from_arrays([*batch.slice(texts.first, len(texts)).columns[:keep], pa.array(s, pa.float64())], [*batch.schema.names[:keep], "_score"])

    return run


def scored(docs: DataFrame, model: Model | None, keep: list[str], text: str = "text") -> DataFrame:
    """The columns `keep` of docs, and _score."""
    tables.ship(docs.sparkSession)
    df = docs.select(*keep, F.col(text).alias("_whole_text"))
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields[:-1]], "_score double"])
    return df.mapInArrow(_scorer(model, len(keep)), schema)


def threshold(model: Model | None, lang: Column) -> Column:
    """The score from which a document of this language is rejected."""
    out = F.lit(0.5)
    for code, t in (model.thresholds if model else {}).items():
        out = F.when(lang == code, F.lit(t)).otherwise(out)
    return out


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs (doc_id, text, lang) and labels (doc_id, toxic) to doc_id, held_out, score, predicted, threshold, rejected."""
    model = fit(docs, labels)
    df = scored(docs, model, ["doc_id", "lang"]).withColumn("threshold", threshold(model, F.col("lang")))
    cols = F.col("doc_id"), held_out(F.col("doc_id")).alias("held_out"), F.col("_score").alias("score")
    return df.select(*cols, (F.col("_score") >= 0.5).cast("int").alias("predicted"), "threshold", (F.col("_score") >= F.col("threshold")).alias("rejected"))


def clean_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs below their language's threshold, with their columns."""
    model = fit(docs, labels)
    names = [f"_c{i}" for i in range(len(docs.columns))]
    renamed = docs.select(*[F.col(c).alias(n) for c, n in zip(docs.columns, names)], F.col("lang").alias("_lang"), F.col("text").alias("_text"))
    kept = scored(renamed, model, [*names, "_lang"], "_text").where(F.col("_score") < threshold(model, F.col("_lang")))
    return kept.select(*[F.col(n).alias(c) for c, n in zip(docs.columns, names)])
