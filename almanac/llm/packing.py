"""Packing documents into training sequences along a space-filling curve.

Each document is tokenised once. Its hashed vector (weights of its token ids, summing to one) is projected to DIMENSIONS
numbers by signed hashes of the ids, and these are quantised and joined into a key on the Hilbert curve, so documents
whose vectors are near are near along the curve. Spark range-sorts by that key, with ties by doc_id and length, so a large
group of equal documents spreads over partitions; every partition fills sequences of LENGTH ids with neighbouring
documents, cutting where a sequence is full. What remains at the partitions' ends, less than a sequence each, is filled
up in the order of the curve, REST_PARTS partitions at a time; what remains of these goes to sequences whose lengths are
powers of two, which need no padding, so nothing is padded.

Tokenising: pieces between white space, and between letters, digits and ASCII signs, have ids of their own in this
vocabulary (its splitting pattern never joins them), so ids are looked up by a piece's 64-bit hash in a table that a worker
keeps between batches (CACHE_SLOTS at most, then emptied). A second, independent hash of the piece is kept beside and
compared: a text with a piece whose second hash differs goes through the tokenizer whole, as do texts that hold the string
of a special token. Pieces not seen before go through the tokenizer itself.

Defined cases: a null or empty text is the closing id alone; a null doc_id is kept; repeated rows are packed each; an
empty table gives no rows. Columns besides doc_id and text are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almanac.llm import tables, words

LENGTH = 4096
END_ID = 2
DIMENSIONS = 3
BITS = 16
CACHE_SLOTS = 1 << 21
#: Remainders of so many partitions are filled up together.
REST_PARTS = 1024
TOKENIZER = "word_bpe_49k.json"

_SPACE, _LETTER, _SIGN, _DIGIT, _OTHER = 0, 1, 2, 3, 4
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[[0x20, *range(0x09, 0x0E)]] = _SPACE
_CLASS[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = _LETTER
_CLASS[[i for i in range(0x21, 0x7F) if not chr(i).isalnum() and chr(i) != "'"]] = _SIGN
_CLASS[range(0x30, 0x3A)] = _DIGIT
#: Second bytes of the two-byte letters U+00C0 to U+00FF, without the signs among them.
_LATIN = np.zeros(256, bool)
_LATIN[[i for i in range(0x80, 0xC0) if i not in (0x97, 0xB7)]] = True
_NOT_SPACE = _CLASS != _SPACE


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Table:
    """Ids by a piece's hash: open addressing in numpy, so that a whole batch is looked up at once."""

    def __init__(self, slots: int = CACHE_SLOTS):
        self.slots, self.mask = slots, np.uint64(slots - 1)
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(self.slots, np.uint64)
        self.check = np.zeros(self.slots, np.uint64)
        self.start = np.zeros(self.slots, np.int32)
        self.size = np.zeros(self.slots, np.int32)
        self.ids = np.zeros(1 << 16, np.uint16)
        self.n_ids = self.n = 0

    def find(self, h: np.ndarray) -> np.ndarray:
        """Slots of the hashes, or -1."""
        found = np.full(len(h), -1, np.int64)
        left, at = np.arange(len(h)), (h & self.mask).astype(np.int64)
        while len(left):
            k = self.keys[at]
            hit = k == h[left]
            found[left[hit]] = at[hit]
            on = ~hit & (k != 0)
            left, at = left[on], (at[on] + 1) & (self.slots - 1)
        return found

    def add(self, h: np.ndarray, check: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        """New distinct hashes and the second hashes of their pieces, with their ids one after another."""
        while self.n_ids + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.n_ids : self.n_ids + len(ids)] = ids
        start = self.n_ids + np.cumsum(sizes) - sizes
        self.n_ids += len(ids)
        self.n += len(h)
        left, at = np.arange(len(h)), (h & self.mask).astype(np.int64)
        while len(left):
            free = self.keys[at] == 0
            self.keys[at[free]] = h[left[free]]
            won = free & (self.keys[at] == h[left])
            self.start[at[won]], self.size[at[won]], self.check[at[won]] = start[left[won]], sizes[left[won]], check[left[won]]
            left, at = left[~won], (at[~won] + 1) & (self.slots - 1)


def ragged(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Indexes start[i], start[i] + 1, ... of size[i] each, one after another."""
    end = np.cumsum(size)
    return np.repeat(start - end + size, size) + np.arange(end[-1] if len(end) else 0)


class Tokens:
    """The vocabulary in one worker."""

    def __init__(self, path: str, slots: int = CACHE_SLOTS):
        from tokenizers import Tokenizer

        self.full = Tokenizer.from_file(path)
        self.bare = Tokenizer(self.full.model)
        self.special = [t.content.lower().encode() for t in self.full.get_added_tokens_decoder().values()]
        if self.full.get_vocab_size() > 1 << 16:
            raise ValueError("ids are kept in two bytes")
        self.table = Table(slots)
        suffix = self.full.model.end_of_word_suffix
        self.closes = np.zeros(1 << 16, bool)
        self.closes[[i for token, i in self.full.get_vocab().items() if token.endswith(suffix)]] = True

    def _tokenise(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their number for each piece: plain ASCII goes to the merges, all else through the whole tokenizer."""
        plain = [p.isascii() and p.isalpha() for p in pieces]
        sizes, out = np.zeros(len(pieces), np.int64), [np.zeros(0, np.uint16)] * 2
        order = [[i for i, x in enumerate(plain) if x == want] for want in (True, False)]
        if at := order[0]:
            e = self.bare.encode_batch_fast([[pieces[i].decode() for i in at]], is_pretokenized=True, add_special_tokens=False)[0]
            out[0] = np.array(e.ids, np.uint16)
            ends = np.flatnonzero(self.closes[out[0]])  # every word's last id, and no other, has the suffix of word ends
            sizes[at] = np.diff(ends, prepend=-1)
        if at := order[1]:
            texts = [pieces[i].decode() for i in at]
            e = self.full.encode_batch([texts], is_pretokenized=True, add_special_tokens=False)[0]
            if None in (of := e.word_ids):  # the string of a special token has no piece's number
                each = [self.full.encode(t, add_special_tokens=False).ids for t in texts]
                out[1], sizes[at] = np.array([x for ids in each for x in ids], np.uint16), [len(x) for x in each]
            else:
                out[1], sizes[at] = np.array(e.ids, np.uint16), np.bincount(np.array(of, np.int64), minlength=len(at))
        at = np.array(order[0] + order[1], np.int64)
        begin = np.zeros(len(pieces), np.int64)
        begin[at] = np.cumsum(sizes[at]) - sizes[at]
        return np.concatenate(out)[ragged(begin, sizes)], sizes

    def _spans(self, w: words.Words, texts: words.Texts) -> tuple[np.ndarray, np.ndarray]:
        data = texts.data
        kind = _CLASS[data]
        if len(data) > 1:
            two = np.flatnonzero((data[:-1] == 0xC3) & _LATIN[data[1:]])
            kind[two] = kind[two + 1] = _LETTER
        change = np.zeros(len(data) + 1, bool)
        change[1:-1] = (kind[1:] != kind[:-1]) & (kind[1:] != _SPACE) & (kind[:-1] != _SPACE)
        if (kind == _OTHER).any():
            odd = np.concatenate([[0], np.cumsum(kind == _OTHER)])
            mixed = np.flatnonzero(odd[w.ends] > odd[w.starts])
            edge = np.zeros(len(data) + 1, np.int32)
            edge[w.starts[mixed]] += 1
            edge[w.ends[mixed]] -= 1
            change[:-1] &= np.cumsum(edge[:-1]) == 0
        begin, end = change.copy(), change
        begin[w.starts] = True
        end[w.ends] = True
        # a place inside a word where the kind changes both ends a piece and begins one
        return np.flatnonzero(begin), np.flatnonzero(end)

    def encode(self, texts: words.Texts) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, and their number for each text, without closing ids."""
        w = texts.words(_NOT_SPACE, fold=True)
        starts, ends = self._spans_of(w, texts)
        h, check = w.spans(starts, ends), w.spans(starts, ends, 1)
        h[h == 0] = 1
        slot = self.table.find(h)
        miss = np.flatnonzero(slot < 0)
        if len(miss):
            new, first = np.unique(h[miss], return_index=True)
            if self.table.n + len(new) > self.table.slots // 2:
                self.table.clear()
                miss = np.arange(len(h))
                new, first = np.unique(h, return_index=True)
            raw = w.bytes.tobytes()
            at = miss[first]
            ids, sizes = self._tokenise([raw[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist())])
            if len(new) > self.table.slots // 2:  # one text with more distinct pieces than the table holds
                return self._uncached(texts)
            self.table.add(new, check[at], ids, sizes)
            slot[miss] = self.table.find(h[miss])
        size = self.table.size[slot].astype(np.int64)
        ids = self.table.ids[ragged(self.table.start[slot].astype(np.int64), size)]
        per_text = words.totals(size, np.searchsorted(starts, texts.offsets))
        low = w.bytes.tobytes()
        whole = np.unique(np.searchsorted(texts.offsets, starts[np.flatnonzero(self.table.check[slot] != check)], "right") - 1).tolist()
        if b"<|" in low and any(s in low for s in self.special):
            o = texts.offsets.tolist()
            whole += [i for i, (a, b) in enumerate(zip(o, o[1:])) if any(s in low[a:b] for s in self.special)]
        return self._with_whole(texts, ids, per_text, sorted(set(whole))) if whole else (ids, per_text)

    def _spans_of(self, w: words.Words, texts: words.Texts) -> tuple[np.ndarray, np.ndarray]:
        if not len(w):
            return w.starts, w.ends
        return self._spans(w, texts)

    def _whole(self, text: bytes) -> np.ndarray:
        return np.array(self.full.encode(text.decode(), add_special_tokens=False).ids, np.uint16)

    def _uncached(self, texts: words.Texts) -> tuple[np.ndarray, np.ndarray]:
        raw, o = texts.data.tobytes(), texts.offsets.tolist()
        parts = [self._whole(raw[a:b]) for a, b in zip(o, o[1:])]
        return np.concatenate(parts), np.array([len(p) for p in parts], np.int64)

    def _with_whole(self, texts: words.Texts, ids: np.ndarray, per_text: np.ndarray, rows: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """The ids, with those of the texts in `rows` taken from the tokenizer itself."""
        raw, o = texts.data.tobytes(), texts.offsets.tolist()
        parts = np.split(ids, np.cumsum(per_text)[:-1])
        for i in rows:
            parts[i] = self._whole(raw[o[i] : o[i + 1]])
        return np.concatenate(parts), np.array([len(p) for p in parts], np.int64)


_workers: dict[str, Tokens] = {}


def tokens_of(path: str) -> Tokens:
    """The worker's vocabulary, loaded once."""
    if path not in _workers:
        _workers[path] = Tokens(path)
    return _workers[path]


def projection(n: int = 1 << 16, dimensions: int = DIMENSIONS) -> np.ndarray:
    """For each id, its hashed signs and weights: numbers from -1 to 1."""
    x = words.mix(np.arange(1, n * dimensions + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return ((x >> np.uint64(11)).astype(np.float64) / (1 << 52) - 1).astype(np.float32).reshape(n, dimensions)


def hilbert(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Places on the Hilbert curve of points (rows of unsigned coordinates below 2 ** bits)."""
    x = points.astype(np.uint64).T.copy()
    n = len(x)
    one = np.uint64(1)
    for q in range(bits - 1, 0, -1):  # undo the curve's turns, from the largest cells down
        low = (one << np.uint64(q)) - one
        for i in range(n):
            turned = (x[i] >> np.uint64(q)) & one == one
            swap = np.where(turned, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] ^= np.where(turned, low, swap)
            x[i] ^= swap
    for i in range(1, n):  # Gray code
        x[i] ^= x[i - 1]
    fix = np.zeros_like(x[0])
    for q in range(bits - 1, 0, -1):
        fix ^= np.where((x[n - 1] >> np.uint64(q)) & one == one, (one << np.uint64(q)) - one, np.uint64(0))
    x ^= fix
    key = np.zeros_like(x[0])
    for q in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << one) | ((x[i] >> np.uint64(q)) & one)
    return key.astype(np.int64)


def curve_keys(ids: np.ndarray, sizes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Keys of documents from their ids."""
    sums = np.zeros((len(ids) + 1, weights.shape[1]), np.float64)
    np.cumsum(weights[ids], axis=0, out=sums[1:], dtype=np.float64)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    mean = (sums[bounds[1:]] - sums[bounds[:-1]]) / np.maximum(sizes, 1)[:, None]
    cells = np.clip(((mean + 1) / 2 * (1 << BITS)).astype(np.int64), 0, (1 << BITS) - 1)
    return hilbert(cells)


def _long(batch_column: pa.Array) -> pa.Array:
    return batch_column.cast(pa.int64())


def encoder(path: str, end_id: int = END_ID):
    """For mapInArrow over (doc_id, text): doc_id, ids (two bytes each), n, key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, weights = tokens_of(path), projection()
        for batch in batches:
            doc_id = _long(batch.column(0))
            for texts in words.chunks(batch.column(1)):
                ids, sizes = tok.encode(texts)
                sizes = sizes + 1
                ends = np.cumsum(sizes)
                full = np.empty(ends[-1], np.uint16)
                inner = np.ones(len(full), bool)
                inner[ends - 1] = False
                full[inner], full[ends - 1] = ids, end_id
                offsets = np.concatenate([[0], ends * 2]).astype(np.int32)
                binary = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(full)])
                yield pa.RecordBatch.from_arrays([doc_id.slice(texts.first, len(texts)), binary, pa.array(sizes), pa.array(curve_keys(full, sizes, weights))], ["doc_id", "ids", "n", "key"])

    return run


def tokenised(docs: DataFrame, path: str | None = None, end_id: int = END_ID) -> DataFrame:
    """doc_id, ids, n, key of every row of docs (doc_id, text), stored: range-sorting reads its input twice."""
    coded = docs.select("doc_id", "text").mapInArrow(encoder(path or tokenizer_path(), end_id), "doc_id long, ids binary, n long, key long")
    return tables.stored(coded, "pack-ids")


def _halves(n: int) -> list[int]:
    """n as powers of two, largest first."""
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


class _Filler:
    """Cuts a run of documents into sequences; what is not yet a full sequence waits."""

    def __init__(self, length: int, first: int):
        self.length, self.next = length, first
        self.doc: list = []
        self.total = self.done = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint16)

    def add(self, doc: list, total: np.ndarray, done: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
        """doc, total: documents and their sizes; done: ids of each that come before those given."""
        self.doc += doc
        self.total = np.concatenate([self.total, total])
        self.done = np.concatenate([self.done, done])
        self.ids = np.concatenate([self.ids, ids])
        full = len(self.ids) // self.length
        return self._emit(np.full(full, self.length, np.int64))

    def close(self) -> pa.RecordBatch:
        return self._emit(np.array(_halves(len(self.ids)), np.int64))

    def rest(self, part: int) -> pa.RecordBatch:
        """What waits, as rows with their ids: doc_id, start and doc_tokens of each document, and its place after other partitions' remainders."""
        n, size = len(self.doc), self.total - self.done
        offsets = np.concatenate([[0], np.cumsum(size) * 2]).astype(np.int32)
        ids = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(self.ids))])
        none = pa.nulls(n, pa.int64())
        own = [pa.array(self.doc, pa.int64()), pa.array(self.done, pa.int64()), none, none, pa.array(self.total, pa.int64()), none, none, none]
        return pa.RecordBatch.from_arrays([*own, pa.array(np.full(n, part, np.int64)), pa.array(np.arange(n)), ids], _NAMES)

    def _emit(self, sizes: np.ndarray) -> pa.RecordBatch:
        """Fills sequences of the given sizes from the front."""
        seq_end = np.cumsum(sizes)
        used = int(seq_end[-1]) if len(seq_end) else 0
        doc_end = np.cumsum(self.total - self.done)
        doc_begin = doc_end - (self.total - self.done)
        cut = np.union1d(doc_end[doc_end <= used], seq_end).astype(np.int64)
        begin = np.concatenate([[0], cut[:-1]]).astype(np.int64) if len(cut) else cut
        d = np.searchsorted(doc_end, begin, "right")
        s = np.searchsorted(seq_end, begin, "right")
        start = self.done[d] + begin - doc_begin[d]
        raw = memoryview(self.ids[:used].astype("<u4").tobytes())
        crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(begin.tolist(), cut.tolist())]
        seq_begin = seq_end - sizes
        out = [
            pa.array([self.doc[i] for i in d.tolist()], pa.int64()), pa.array(start, pa.int64()), pa.array(cut - begin, pa.int64()), pa.array(crc, pa.int64()),
            pa.array(self.total[d], pa.int64()), pa.array(self.next + s, pa.int64()), pa.array(begin - seq_begin[s] if len(s) else begin, pa.int64()), pa.array(sizes[s] if len(s) else begin, pa.int64()),
        ]
        left = int(np.searchsorted(doc_end, used, "right"))
        self.next += len(sizes)
        self.done = self.done[left:].copy()
        if left < len(self.doc):
            self.done[0] += max(0, used - int(doc_begin[left]))
        self.doc, self.total, self.ids = self.doc[left:], self.total[left:], self.ids[used:]
        return pa.RecordBatch.from_arrays(out, [f.split()[0] for f in PIECES.split(", ")])


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, sequence_length long"


_REST = "part long, n long, ids binary"
_NAMES = [f.split()[0] for f in f"{PIECES}, {_REST}".split(", ")]


def packer(length: int = LENGTH):
    """For mapInArrow over (doc_id, ids, n): pieces of full sequences, and rows of what remains (part, n and ids are not null)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        fill = _Filler(length, part << 32)
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                own = batch.slice(a, 512)
                ids = np.frombuffer(b"".join(own.column(1).to_pylist()), np.uint16)
                total = own.column(2).to_numpy(zero_copy_only=False).astype(np.int64)
                found = fill.add(own.column(0).to_pylist(), total, np.zeros(len(total), np.int64), ids)
                nulls = [pa.nulls(found.num_rows, t) for t in (pa.int64(), pa.int64(), pa.binary())]
                yield pa.RecordBatch.from_arrays([*found.columns, *nulls], _NAMES)
        yield fill.rest(part)

    return run


def rest_packer(length: int = LENGTH):
    """For mapInArrow over packer()'s remainders (doc_id, start, doc_tokens, ids, group) in order: their pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fill = None
        for batch in batches:
            if fill is None:  # numbers beyond those of any partition
                fill = _Filler(length, 1 << 62 | batch.column(4)[0].as_py() << 32)
            for a in range(0, batch.num_rows, 512):
                own = batch.slice(a, 512)
                done, total = (own.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (1, 2))
                yield fill.add(own.column(0).to_pylist(), total, done, np.frombuffer(b"".join(own.column(3).to_pylist()), np.uint16))
        if fill is not None:
            yield fill.close()

    return run


@tables.tidy
def pack(docs: DataFrame, path: str | None = None, length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """docs (doc_id, text) to one row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, sequence_length."""
    coded = tokenised(docs, path, end_id)
    along = coded.repartitionByRange("key", "doc_id", "n").sortWithinPartitions("key", "doc_id", "n")
    cut = tables.keep(tables.stored(along.select("doc_id", "ids", "n").mapInArrow(packer(length), f"{PIECES}, {_REST}"), "pack-pieces"))
    left = cut.where(F.col("part").isNotNull()).withColumn("group", F.expr(f"part div {REST_PARTS}"))
    groups = (left.agg(F.max("group")).first()[0] or 0) + 1
    left = left.repartitionById(groups, F.col("group").cast("int")).sortWithinPartitions("part", "n")
    ends = left.select("doc_id", "start", "doc_tokens", "ids", "group").mapInArrow(rest_packer(length), PIECES)
    return cut.where(F.col("part").isNull()).drop("part", "n", "ids").union(ends)
