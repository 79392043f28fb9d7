"""Substring deduplication: a count-min prefilter, then exact groups of the windows it lets through.

A window is ``size`` consecutive words of one document. First pass: each chunk of documents counts
its windows in a count-min sketch, sparsely (the cells it has filled, in order, as differences);
chunks' sketches are merged by blocks of cells, and what the merged sketch estimates as repeated
goes back, by buckets of documents, to where it came from. Estimates are never too low, so no repeated window is lost;
those that are too high only cost work. The sketch has ``rows`` rows of ``2 ** bits`` cells; held
sparsely, a row costs about ``bits - log2(windows of a chunk)`` bits for each window, so one wide row
lets less through than several narrow ones of the same size, and one is the default.

Second pass: windows estimated as repeated are hashed to 96 bits and grouped exactly; of each group
the one that starts first (smaller id, then earlier) stays, and words covered by any other go.

Both passes settle what they can inside a chunk before the shuffle: a cell or window that comes twice in
a chunk is sent on once, so the most frequent passage costs one entry a chunk.

Defined cases: a null text has no words; texts shorter than a window keep all words; a null id comes after
all others; rows that repeat an id take the same place, so a window is removed if an equal one starts at a
smaller (id, start); an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm import words
from cadence.llm.tables import only, parallel, stage

SIZE = 20
ROWS = 1
BITS = 40
#: Words of a chunk: what a task holds at once (some 100 bytes a word).
CHUNK = 1_000_000
LAST = (1 << 63) - 1
_P = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))

def windows(h: np.ndarray, size: int, which: int) -> np.ndarray:
    """A 64-bit hash of each window of word hashes, by doubling."""
    p, n = int(_P[which]), len(h) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, done, run, width = None, 0, h, 1
    with np.errstate(over="ignore"):
        while True:
            if size & width:
                part = run[done : done + n] * np.uint64(pow(p, done, 1 << 64))
                out = part if out is None else out + part
                done += width
            if done == size:
                return words.mix(out, 20 + which)
            run = run[: len(run) - width] + run[width:] * np.uint64(pow(p, width, 1 << 64))
            width *= 2


class Chunk:
    """Whole documents' word hashes, up to about CHUNK words."""

    def __init__(self) -> None:
        self.h: list[np.ndarray] = []
        self.lengths: list[int] = []
        self.docs: list[int] = []
        self.n = 0
        self.extra: list = []

    def add(self, doc: int, h: np.ndarray, extra: object = None) -> None:
        self.h.append(h)
        self.lengths.append(len(h))
        self.docs.append(doc)
        self.extra.append(extra)
        self.n += len(h)

    def windows(self, size: int, *which: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        """Hashes of all windows; the number of each one's document in the chunk; its start."""
        h, lengths = np.concatenate(self.h), np.array(self.lengths)
        each = np.maximum(lengths - size + 1, 0)
        doc = np.repeat(np.arange(len(lengths)), each)
        start = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
        at = np.repeat(np.cumsum(lengths) - lengths, each) + start
        return [windows(h, size, w)[at] for w in which], doc, start


def cells_of(w: np.ndarray, row: int, bits: int) -> np.ndarray:
    return words.mix(w, 30 + row) >> np.uint64(64 - bits)


ROWS_OF = "kind int, key long, a binary, b binary, c binary, d binary, n long, sha string"
_SENT = pa.schema([("kind", pa.int32()), ("key", pa.int64()), *((c, pa.binary()) for c in "abcd"), ("n", pa.int64()), ("sha", pa.string())])
_zstd = pa.Codec("zstd", 1)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    rows = [(*r, *[None] * (8 - len(r))) for r in rows]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True) if rows else [[]] * 8, _SENT, strict=True)], schema=_SENT)


def bucket_of(docs: np.ndarray, buckets: int) -> np.ndarray:
    return (words.mix(docs.view(np.uint64), 60) % np.uint64(buckets)).astype(np.int64)


def _by_bucket(docs: np.ndarray, values: np.ndarray, buckets: int) -> Iterator[tuple[int, bytes, bytes]]:
    """(bucket, documents, their values), packed, of values with their documents."""
    bucket = bucket_of(docs, buckets)
    order = np.lexsort((docs, bucket))
    docs, values = docs[order], values[order]
    edge = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for b in np.flatnonzero(np.diff(edge)):
        i, j = edge[b], edge[b + 1]
        yield int(b), words.planes(docs[i:j]), words.planes(values[i:j])


def _pack_texts(docs: list[int], texts: list[bytes]) -> tuple[bytes, bytes, bytes]:
    raw = b"".join(texts)
    return words.planes(np.array(docs, np.int64)), words.planes(np.array([len(t) for t in texts], np.int64)), len(raw).to_bytes(8, "little") + _zstd.compress(raw, asbytes=True)


def _texts_of(row: dict) -> tuple[list[int], pa.Array]:
    """Documents and texts of a packed row."""
    lengths = words.unplanes(row["b"], np.int64)
    raw = _zstd.decompress(row["c"][8:], int.from_bytes(row["c"][:8], "little"))
    at = np.concatenate(([0], np.cumsum(lengths)))
    return words.unplanes(row["a"], np.int64).tolist(), pa.Array.from_buffers(pa.large_string(), len(lengths), [None, pa.py_buffer(at), raw])


def _blocks(rows: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[dict]]]:
    """Rows of one key after another, of batches sorted by it."""
    now, held = None, []
    for batch in rows:
        for r in batch.to_pylist():
            if r["key"] != now:
                if held:
                    yield now, held
                now, held = r["key"], []
            held.append(r)
    if held:
        yield now, held


def _split(batches: Iterator[pa.RecordBatch], passed: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of kind 0, which come first; the others are put aside to be passed on."""
    for batch in batches:
        own = pc.equal(batch["kind"], 0)
        if (rest := batch.filter(pc.invert(own))).num_rows:
            passed.append(rest)
        yield batch.filter(own)


def _sketch(docs: DataFrame, size: int, rows: int, bits: int, blocks: int, buckets: int) -> DataFrame:
    """Kind 0: a block of a chunk's sketch (cells, documents); 1: documents of a bucket and their cells that come twice in
    the chunk; 2: a document's words and digest."""
    block_bits = blocks.bit_length() - 1

    def flush(chunk: Chunk) -> Iterator[tuple]:
        (w,), doc, _ = chunk.windows(size, 0)
        ids = np.array(chunk.docs, np.int64)
        for row in range(rows):
            cell = cells_of(w, row, bits)
            order = np.argsort(cell, kind="stable")
            cell, of = cell[order], ids[doc[order]]
            first = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1]))) if len(cell) else np.zeros(0, int)
            each = np.diff(np.append(first, len(cell)))
            twice = np.repeat(each > 1, each)
            for b, d, c in _by_bucket(of[twice], cell[twice], buckets):
                yield 1, b, d, c, None, None, row
            cell, of = cell[first], of[first]
            edge = np.searchsorted(cell >> np.uint64(bits - block_bits), np.arange(blocks + 1, dtype=np.uint64))
            for b in np.flatnonzero(np.diff(edge)):
                i, j = edge[b], edge[b + 1]
                yield 0, row * blocks + int(b), words.planes(np.diff(cell[i:j], prepend=np.uint64(0))), words.planes(of[i:j])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = Chunk()
        for batch in batches:
            ids = batch["doc_id"].to_pylist()
            data, at = words.buffers(batch["text"])
            out: list[tuple] = []
            for row, end, h, first in words.batch_hashes(batch["text"]):
                for i in range(row, end):
                    own = h[first[i - row] : first[i - row + 1]]
                    sha = hashlib.sha256(b" ".join(data[at[i] : at[i + 1]].tobytes().split())).hexdigest()
                    out.append((2, ids[i], None, None, None, None, len(own), sha))
                    chunk.add(ids[i], own)
                if chunk.n >= CHUNK:
                    out += flush(chunk)
                    chunk = Chunk()
            yield _batch(out)
        if chunk.docs:
            yield _batch(list(flush(chunk)))

    return docs.mapInArrow(of, ROWS_OF)


def _suspects(sketch: DataFrame, blocks: int, buckets: int) -> DataFrame:
    """The merged sketch: kind 1 for cells that several chunks have filled, beside what was of kinds 1 and 2 before."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passed: list[pa.RecordBatch] = []
        held: list[tuple[np.ndarray, np.ndarray]] = []
        now = None

        def flush() -> Iterator[pa.RecordBatch]:
            if held:
                doc, cell = (np.concatenate(x) for x in zip(*held, strict=True))
                held.clear()
                yield _batch([(1, b, d, c, None, None, now) for b, d, c in _by_bucket(doc, cell, buckets)])

        for key, rows in _blocks(_split(batches, passed)):
            if key // blocks != now or sum(len(x[0]) for x in held) >= CHUNK:
                yield from flush()
            now = key // blocks
            cell = np.concatenate([np.cumsum(words.unplanes(r["a"], np.uint64), dtype=np.uint64) for r in rows])
            doc = np.concatenate([words.unplanes(r["b"], np.int64) for r in rows])
            order = np.argsort(cell, kind="stable")
            cell, doc = cell[order], doc[order]
            same = cell[1:] == cell[:-1]
            hit = np.concatenate(([False], same)) | np.concatenate((same, [False]))
            held.append((doc[hit], cell[hit]))
            yield from passed
            passed.clear()
        yield from flush()
        yield from passed

    return sketch.repartition("kind", "key").sortWithinPartitions("kind", "key").mapInArrow(merge, ROWS_OF)


def _packed_texts(docs: DataFrame, buckets: int) -> DataFrame:
    """Texts by buckets of documents (kind 1), compressed together."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = words.buffers(batch["text"])
            ids = batch["doc_id"].to_numpy().astype(np.int64)
            bucket = bucket_of(ids, buckets)
            for b in np.unique(bucket):
                own = np.flatnonzero(bucket == b)
                yield _batch([(1, int(b), *_pack_texts(ids[own].tolist(), [data[at[i] : at[i + 1]].tobytes() for i in own]))])

    return docs.mapInArrow(of, ROWS_OF)


def _candidates(rows: DataFrame, size: int, sketch_rows: int, bits: int, blocks: int, buckets: int) -> DataFrame:
    """Of (-1: a copy's id; 0: cells; 1: texts) by bucket: kind 0: windows estimated as repeated, each once a chunk; 1: marks of
    windows whose equal stands earlier in the chunk; 2: texts that have such windows."""
    shift = np.uint64(64 - (blocks.bit_length() - 1))

    def flush(chunk: Chunk) -> Iterator[tuple]:
        (w1, w2), doc, start = chunk.windows(size, 0, 1)
        keep = np.ones(len(w1), bool)
        edges = np.searchsorted(doc, np.arange(len(chunk.docs) + 1))
        for row in range(sketch_rows):
            cell = cells_of(w1, row, bits)
            for i, had in enumerate(chunk.extra):
                span = slice(edges[i], edges[i + 1])
                keep[span] &= np.isin(cell[span], had[row])
        w1, w2, start, of = w1[keep], w2[keep] >> np.uint64(32), start[keep].astype(np.uint64), np.array(chunk.docs, np.int64)[doc[keep]]
        w1, w2, start, of, first, later = _ordered(w1, w2, start, of)
        for b, d, m in _by_bucket(of[later], _mark(start[later], w1[later]), buckets):
            yield 1, b, d, m
        w1, w2, start, of = w1[first], w2[first].astype(np.uint32), start[first].astype(np.uint32), of[first]
        edge = np.searchsorted(w1 >> shift, np.arange(blocks + 1, dtype=np.uint64))
        for b in np.flatnonzero(np.diff(edge)):
            i, j = edge[b], edge[b + 1]
            yield 0, int(b), words.planes(np.diff(w1[i:j], prepend=np.uint64(0))), words.planes(w2[i:j]), words.planes(of[i:j]), words.planes(start[i:j])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = Chunk()
        now, copies, lists, table = None, set(), [], None
        for batch in batches:
            out: list[tuple] = []
            for r in batch.to_pylist():
                if r["key"] != now:
                    now, copies, lists, table = r["key"], set(), [], None
                if r["kind"] == -1:
                    copies.add(r["n"])
                elif r["kind"] == 0:
                    lists.append((r["n"], words.unplanes(r["a"], np.int64), words.unplanes(r["b"], np.uint64)))
                else:
                    table = table or [_sorted([x[1:] for x in lists if x[0] == k]) for k in range(sketch_rows)]
                    ids, texts = _texts_of(r)
                    kept: list[int] = []
                    for row, end, h, first in words.batch_hashes(texts):
                        for i in range(row, end):
                            had = [c[np.searchsorted(d, ids[i]) : np.searchsorted(d, ids[i], "right")] for d, c in table]
                            if len(had[0]) and ids[i] not in copies:
                                chunk.add(ids[i], h[first[i - row] : first[i - row + 1]], had)
                                kept.append(i)
                        if chunk.n >= CHUNK:
                            out += flush(chunk)
                            chunk = Chunk()
                    if kept:
                        out.append((2, now, *_pack_texts([ids[i] for i in kept], [texts[i].as_buffer().to_pybytes() for i in kept])))
            yield _batch(out)
        if chunk.docs:
            yield _batch(list(flush(chunk)))

    return rows.repartition("key").sortWithinPartitions("key", "kind").mapInArrow(of, ROWS_OF)


def _sorted(lists: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if not lists:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    docs, values = (np.concatenate(x) for x in zip(*lists, strict=True))
    order = np.argsort(docs, kind="stable")
    return docs[order], values[order]


def _ordered(w1: np.ndarray, w2: np.ndarray, start: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, ...]:
    """Windows sorted by hash, document and start; which is the first of its hash; which an equal one precedes."""
    order = np.lexsort((start, of, w2, w1))
    w1, w2, start, of = w1[order], w2[order], start[order], of[order]
    first = np.concatenate(([True], (w1[1:] != w1[:-1]) | (w2[1:] != w2[:-1]))) if len(w1) else np.zeros(0, bool)
    at = np.flatnonzero(first)[np.cumsum(first) - 1] if len(w1) else np.zeros(0, int)
    return w1, w2, start, of, first, ~first & ((of != of[at]) | (start != start[at]))


def _mark(start: np.ndarray, w: np.ndarray) -> np.ndarray:
    """A window's start and a part of its hash, so that rows repeating an id take their own marks only."""
    return (start.astype(np.uint64) << np.uint64(32)) | (w >> np.uint64(32))


def _later(candidates: DataFrame, buckets: int) -> DataFrame:
    """Kind 1: marks of all windows that an equal one precedes, exactly; 2: texts, as they came."""

    def group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passed: list[pa.RecordBatch] = []
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def flush() -> Iterator[pa.RecordBatch]:
            if held:
                doc, mark = (np.concatenate(x) for x in zip(*held, strict=True))
                held.clear()
                yield _batch([(1, b, d, m) for b, d, m in _by_bucket(doc, mark, buckets)])

        for _, rows in _blocks(_split(batches, passed)):
            w1 = np.concatenate([np.cumsum(words.unplanes(r["a"], np.uint64), dtype=np.uint64) for r in rows])
            w2, start = (np.concatenate([words.unplanes(r[c], np.uint32) for r in rows]) for c in "bd")
            of = np.concatenate([words.unplanes(r["c"], np.int64) for r in rows])
            w1, _, start, of, _, later = _ordered(w1, w2, start, of)
            held.append((of[later], _mark(start[later], w1[later])))
            if sum(len(x[0]) for x in held) >= CHUNK:
                yield from flush()
            yield from passed
            passed.clear()
        yield from flush()
        yield from passed

    return candidates.repartition("kind", "key").sortWithinPartitions("kind", "key").mapInArrow(group, ROWS_OF)


def _removed(rows: DataFrame, size: int) -> DataFrame:
    """doc_id, n_words, n_removed, kept of the texts (kind 2) with the marks (kind 1) of their bucket."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.binary())])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, lists, table = None, [], None
        for batch in batches:
            for r in batch.to_pylist():
                if r["key"] != now:
                    now, lists, table = r["key"], [], None
                if r["kind"] == 1:
                    lists.append((words.unplanes(r["a"], np.int64), words.unplanes(r["b"], np.uint64)))
                    continue
                table = table or _sorted(lists)
                ids, texts = _texts_of(r)
                for row, end, h, first in words.batch_hashes(texts):
                    out = []
                    for i in range(row, end):
                        own = h[first[i - row] : first[i - row + 1]]
                        w = windows(own, size, 0)
                        marks = table[1][np.searchsorted(table[0], ids[i]) : np.searchsorted(table[0], ids[i], "right")]
                        start = (marks >> np.uint64(32)).astype(np.int64)
                        fits = start < len(w)
                        start, marks = start[fits], marks[fits]
                        start = np.unique(start[(w[start] >> np.uint64(32)) == (marks & np.uint64(0xFFFFFFFF))])
                        cover = np.zeros(len(own) + 1, np.int64)
                        cover[start] += 1
                        np.subtract.at(cover, start + size, 1)
                        keep = np.cumsum(cover[:-1]) == 0
                        text = texts[i].as_buffer().to_pybytes().split()
                        out.append((ids[i], len(own), int((~keep).sum()), b" ".join(text[k] for k in np.flatnonzero(keep))))
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    return rows.repartition("key").sortWithinPartitions("key", "kind").mapInArrow(of, "doc_id long, n_words long, n_removed long, kept binary")


def remove_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text", size: int = SIZE, rows: int = ROWS, bits: int = BITS) -> tuple[DataFrame, DataFrame]:
    """(what may have changed, digests of the rest).

    The first: doc_id, n_words, n_removed, kept (the words left, joined by one space, UTF-8). The rest:
    doc_id, n_words, kept_sha256 of documents that keep all words.
    """
    docs = only(docs, doc_id=id, text=text).select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc_id"), "text")
    # some blocks and buckets for each task: one is what a task merges at once
    blocks = buckets = 1 << (4 * parallel(docs.sparkSession) - 1).bit_length()
    suspects = stage(_suspects(_sketch(docs, size, rows, bits, blocks, buckets), blocks, buckets), "suspects")
    whole = suspects.filter("kind = 2").select(F.col("key").alias("doc_id"), F.col("n").alias("n_words"), F.col("sha").alias("kept_sha256"))

    # whole copies: all their windows start earlier, so they need no search (unless rows repeat their id)
    firsts = stage(whole.groupBy("kept_sha256").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("of")).filter("of > 1"), "firsts")
    single = whole.groupBy("doc_id").agg(F.count("*").alias("rows")).filter("rows = 1").select("doc_id")
    copies = whole.join(firsts.hint("merge"), "kept_sha256").filter((F.col("doc_id") > F.col("first_id")) & (F.col("n_words") >= size))
    copies = stage(copies.join(single.hint("merge"), "doc_id", "left_semi").select("doc_id", "n_words"), "copies")

    def flags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch["doc_id"].to_numpy().astype(np.int64)
            yield _batch([(-1, int(b), None, None, None, None, int(d)) for b, d in zip(bucket_of(ids, buckets), ids, strict=True)])

    cells = suspects.filter("kind = 1").withColumn("kind", F.lit(0))
    by_bucket = cells.unionByName(_packed_texts(docs, buckets)).unionByName(copies.select("doc_id").mapInArrow(flags, ROWS_OF))
    later = stage(_later(_candidates(by_bucket, size, rows, bits, blocks, buckets), buckets), "later")
    changed = stage(_removed(later, size), "changed")
    gone = copies.select("doc_id", "n_words", F.col("n_words").alias("n_removed"), F.lit(b"").alias("kept"))
    rest = whole.join(changed.select("doc_id").union(copies.select("doc_id")).distinct().hint("merge"), "doc_id", "left_anti")
    back = lambda df: df.withColumn("doc_id", F.when(F.col("doc_id") != LAST, F.col("doc_id")))
    return back(changed.unionByName(gone)), back(rest)
