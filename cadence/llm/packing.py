"""Pack tokenised documents into sequences: dominance reduction, then best fit.

The whole instance is its histogram: how many pieces there are of each length, at most ``capacity``
numbers however large the corpus is. That histogram alone goes to the driver, where it is solved
into patterns (a multiset of lengths, and how many sequences follow it), whose number is bounded by
the capacity too.

Reduction (Martello and Toth): for the longest piece left, if one set of pieces beside it is
provably at least as good as any other, it is fixed for good: nothing fits beside it; a piece fills
the gap exactly; no two pieces fit together, so the longest that fits is best; or no three do, and
the longest single piece is no shorter than any fitting pair. Where nothing dominates, the piece is
left to best fit, which takes pieces from the longest and fills each gap with the longest that fits.

Pieces then find their places without a central list: each is numbered among those of its length
(numbers per length and salt, prefix sums over salts, so a hot length is spread), and the number
falls into the interval of one pattern.

Defined cases: a null or empty text is the end token alone; repeated rows are packed each on its own,
and pieces that are alike may change places; a null id is kept; an empty table gives no rows; further
columns are not read; a text may have any length.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadence.llm.tables import only, parallel, stage

CAPACITY = 2048
END = 0
RANKS = "byte_bpe_50k.tiktoken"
VOCABULARY = "byte_bpe_50k.json"
CACHED_WORDS = 300_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_EDGE = re.compile(r" \s|\s ")


def tokenizer_path(name: str = RANKS) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Token ids of whole texts as little-endian 32-bit numbers, with the ids of common words kept.

    A space between two other characters always begins a token of this vocabulary's pattern, so the text
    may be cut there and each part encoded by itself; texts where a space meets other white space are
    encoded whole. The ids are those that the tokenizers library gives for the same vocabulary as loaded: the
    strings of its added tokens, wherever they stand in a text, are those tokens, and the text is cut at them first.
    """

    def __init__(self, path: str | None = None, vocabulary: str | None = None) -> None:
        import public_tokenizers
        import tiktoken

        with open(path or tokenizer_path(), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        with open(vocabulary or tokenizer_path(VOCABULARY), encoding="utf-8") as lines:
            self.added = {t["content"]: np.array([t["id"]], np.uint32).tobytes() for t in json.load(lines)["added_tokens"]}
        self.cut = re.compile("|".join(f"({re.escape(t)})" for t in sorted(self.added, key=len, reverse=True)) or "(?!)")
        self.plain = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

        class Words(dict):
            def __missing__(cache, word: str) -> bytes:
                ids = self.whole(" " + word)
                if len(word) <= 64:
                    if len(cache) >= CACHED_WORDS:
                        cache.clear()
                    cache[word] = ids
                return ids

        self.words = Words()

    def whole(self, text: str) -> bytes:
        return np.array(self.plain.encode_ordinary(text), np.uint32).tobytes()

    def __call__(self, text: str) -> bytes:
        if not any(t in text for t in self.added):
            return self.ordinary(text)
        return b"".join(self.added.get(part) or self.ordinary(part) for part in self.cut.split(text) if part)

    def ordinary(self, text: str) -> bytes:
        if _EDGE.search(text):
            return self.whole(text)
        first, *rest = text.split(" ")
        return self.whole(first) + b"".join(map(self.words.__getitem__, rest))


_encoders: dict[str | None, Encoder] = {}


def pieces(docs: DataFrame, id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of each piece; with_ids adds the ids (binary, little-endian 32 bits).

    A document is its tokens and the end token; only longer ones are cut, and the first piece takes the remainder.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _encoders:
            _encoders[path] = Encoder(path)
        encode, end = _encoders[path], np.uint32(END).tobytes()
        for batch in batches:
            out: list[list] = [[], [], [], [], [], []]
            for doc, t in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                ids = memoryview(encode(t.as_py() or "") + end)
                n = len(ids) // 4
                at, k = 0, 0
                while at < n:
                    size = (n - at) % capacity or capacity
                    part = ids[4 * at : 4 * (at + size)]
                    for column, v in zip(out, (doc, k, at, size, zlib.crc32(part), bytes(part) if with_ids else None), strict=True):
                        column.append(v)
                    at, k = at + size, k + 1
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()][: 5 + with_ids]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: 5 + with_ids]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=False)], names)

    return only(docs, doc_id=id, text=text).mapInArrow(cut, PIECES + ", ids binary" * with_ids)


Pattern = tuple[int, list[tuple[int, int]]]


def reduce_instance(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[Pattern], dict[int, int]]:
    """(patterns fixed for good, the pieces left). A pattern: how often, and (length, how many) each."""
    left = {s: n for s, n in counts.items() if n > 0}
    sizes = sorted(left)
    fixed: list[Pattern] = []

    def take(n: int, *lengths: int) -> None:
        fixed.append((n, sorted(((s, lengths.count(s)) for s in set(lengths)), reverse=True)))
        for s in set(lengths):
            left[s] -= n * lengths.count(s)
            if not left[s]:
                del left[s]
                sizes.remove(s)

    for w in sorted(left, reverse=True):
        while n := left.get(w, 0):
            # longer pieces that stay undecided still count as company
            gap = capacity - w
            small = [s for s in sizes[:3] for _ in range(min(3, left[s] - (s == w)))][:3]
            k = bisect_right(sizes, gap) - 1
            if k >= 0 and sizes[k] == w and n == 1:
                k -= 1
            if k < 0:
                take(n, w)
                break
            best = sizes[k]
            dominant = best == gap or len(small) < 2 or small[0] + small[1] > gap
            if not dominant and (len(small) < 3 or sum(small) > gap):
                dominant = best >= _best_pair(sizes, left, gap, w)
            if not dominant:
                break
            take(n // 2 if best == w else min(n, left[best]), w, best)
    return fixed, left


def _best_pair(sizes: list[int], left: dict[int, int], gap: int, w: int) -> int:
    """The largest sum of two pieces (besides one of length w) that fits the gap; 0 without any."""
    i, j, best = 0, len(sizes) - 1, 0
    while i <= j:
        total = sizes[i] + sizes[j]
        if total > gap or (i == j and left[sizes[i]] - (sizes[i] == w) < 2):
            j -= 1
        else:
            best = max(best, total)
            i += 1
    return best


def best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    """Best fit from the longest piece down, alike sequences at once."""
    left = {s: n for s, n in counts.items() if n > 0}
    sizes = sorted(left)
    out: list[Pattern] = []
    while sizes:
        pattern: list[tuple[int, int]] = []
        gap, k = capacity, len(sizes)
        while k:
            s = sizes[k - 1]
            n = min(left[s], gap // s)
            pattern.append((s, n))
            gap -= s * n
            k = bisect_right(sizes, gap, 0, k - 1)
        often = min(left[s] // n for s, n in pattern)
        out.append((often, pattern))
        for s, n in pattern:
            left[s] -= often * n
            if not left[s]:
                del left[s]
                sizes.remove(s)
    return out


def solve(counts: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    fixed, rest = reduce_instance(counts, capacity)
    return fixed + best_fit(rest, capacity)


def placed(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to the rows of :func:`pieces` (which are read twice, so stage them)."""
    spark = pieces.sparkSession
    salts = 4 * parallel(spark)
    salted = pieces.withColumn("salt_", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)))
    sums = salted.groupBy("length", "salt_").agg(F.count("*").alias("n_"))
    counts = {r["length"]: r["n"] for r in sums.groupBy("length").agg(F.sum("n_").alias("n")).collect()}
    table = intervals(solve(counts, capacity))
    before = Window.partitionBy("length").orderBy("salt_").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("length", "salt_", F.coalesce(F.sum("n_").over(before), F.lit(0)).alias("base_"))
    own = Window.partitionBy("length", "salt_").orderBy("doc_id", "piece", "start")
    ranked = salted.withColumn("rank_", F.row_number().over(own)).join(sums, ["length", "salt_"])
    ranked = ranked.select(*pieces.columns, (F.col("base_") + F.col("rank_") - 1).alias("rank_"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length, low, first, each, offset = table
        # one ascending key for (length, number): lengths are below 2 ** 20, numbers below 2 ** 43
        key = (length << 43) + low
        for batch in batches:
            size = batch["length"].to_numpy(zero_copy_only=False).astype(np.int64)
            rank = batch["rank_"].to_numpy(zero_copy_only=False).astype(np.int64)
            at = np.searchsorted(key, (size << 43) + rank, "right") - 1
            i = rank - low[at]
            columns = [*batch.columns[:-1], pa.array(first[at] + i // each[at]), pa.array(offset[at] + i % each[at] * size)]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], "sequence_id", "offset"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return ranked.mapInArrow(place, f"{kinds}, sequence_id long, offset long")


def intervals(patterns: list[Pattern]) -> tuple[np.ndarray, ...]:
    """For each length and pattern: the first number, the first sequence, how many a sequence takes, where they begin."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for often, pattern in patterns:
        offset = 0
        for s, n in pattern:
            rows.append((s, used.get(s, 0), sequence, n, offset))
            used[s] = used.get(s, 0) + often * n
            offset += s * n
        sequence += often
    rows.sort()
    return tuple(np.array(c, np.int64) for c in zip(*rows, strict=True)) if rows else tuple(np.zeros(0, np.int64) for _ in range(5))


def pack(docs: DataFrame, id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of each piece."""
    return placed(stage(pieces(docs, id, text, capacity, path), "pieces"), capacity)
