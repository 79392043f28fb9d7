"""N-gram Jaccard join: count vectors in a tree of boxes, overlap bounds, exact verification.

A document's set of shingles is hashed into groups, and the counts of the groups are a point. Two
sets whose Jaccard similarity is at least t have sizes within t of each other, share at least
``t / (1 + t)`` of their joint size, and so their points differ by at most ``(a + b) (1 - t) / (1 + t)``
in all coordinates together; the overlap of two sets is at most the sum of the smaller of each pair
of coordinates, and of two boxes of points the sum of the smaller upper corners.

Levels of the tree:

1. Sizes, in classes half as wide again each. Documents near a class's lower end also enter the class below.
2. Bands of groups. A class has more bands than two linked points of it can differ in, so some band is
   equal in both: its counts are a degenerate box. A band without shingles says nothing; a class
   has spare bands for those, as many as chance leaves empty and a margin, and a document with more of
   them than spare ones enters again under other bands. No linked pair is lost.
3. Inside a cell of points with one such band, leaves of ``LEAF`` points, whose boxes and then points are compared in the tasks.
   ``LEAVES`` of them travel together. Two points that share several cells are reported in the first of these.

Cells hold whole families of near copies, so their pairs are not listed. Each member is first verified
against the cell's centre (the member that lies in most cells). Only cells whose members then still
belong to several components go on, to leaves whose boxes allow a link, then to points, and every remaining
pair between different components is verified, in blocks of sets that have many pairs in common.

The result is exact up to collisions of 52-bit shingle hashes within two documents.

Defined cases: null and white-space texts have the empty set, which links with nothing; texts shorter
than a shingle are one shingle; equal sets are one point; a null id links with nothing and has no
component; rows repeating an id stand for themselves; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Callable, Iterator
from fractions import Fraction
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.llm import words
from cadence.llm.components import components
from cadence.llm.tables import numbered, only, parallel, release, stage

#: Coordinates of the points that bound overlaps, and of the finer points (a multiple) for pairs that these allow.
GROUPS = 64
FINER = 1024
#: Groups that a band's counts tell apart.
FINE = np.uint64((1 << 40) - 1)
LEAF = 32
#: Leaves that travel together, pairs whose finer points are compared at a time, and cells of a point that tell where a pair was met first.
LEAVES = 4
PAIRS = 2048
FIRST = 16
#: Sets that are verified against each other at a time, shingles from which a set is held alone, and columns of their product.
TOGETHER = 64
LARGE = 1 << 16
COLUMNS = 1 << 14
PERMUTATIONS = 6
SETS = "doc_id long, n_shingles long, f1 long, f2 long"
#: Cells that a task gathers before it sends them, and about as many in a bucket.
BLOCK = 2_000_000
BUCKET_CELLS = 1_000_000


class Bound:
    """What a similarity of at least ``percent`` in a hundred implies, in whole numbers."""

    def __init__(self, percent: int) -> None:
        t = Fraction(percent, 100)
        self.percent, self.share = percent, t / (1 + t)
        self.starts = [1]

    def differ(self, joint: int) -> int:
        """The most elements in which two linked sets of this joint size differ."""
        return int(joint * (1 - 2 * self.share))

    def links(self, overlap: np.ndarray, joint: np.ndarray | int) -> np.ndarray:
        return 100 * overlap >= self.percent * (joint - overlap)

    def classes(self, n: int) -> list[tuple[int, int, int]]:
        """(class, elements in which its linked sets differ at most, size of its smallest set) that a set of n elements enters."""
        while self.starts[-1] <= n:
            self.starts.append(self.starts[-1] * 3 // 2 + 1)
        own = max(i for i, s in enumerate(self.starts) if s <= n)
        out = [c for c in range(own + 1) if c == own or (self.starts[c + 1] - 1) * 100 >= n * self.percent]
        # the largest set of a class meets others up to its size over t
        return [(c, self.differ(top + top * 100 // self.percent), self.starts[c]) for c in out for top in [self.starts[c + 1] - 1]]


@lru_cache(maxsize=4096)
def spare_bands(differ: int, least: int) -> int:
    """Bands beside the differing ones and one equal one, so that a set of this size seldom leaves more empty.

    A set of n elements leaves about ``b * exp(-n / b)`` of b bands empty; two deviations are the margin. Where the
    bands would more than triple, the sets are too small for the bound, and few spare ones do.
    """

    def enough(spare: int) -> bool:
        bands = differ + 1 + spare
        each = least / bands
        empty, both = math.exp(-each), (1 + each) * math.exp(-2 * each)
        return spare >= bands * empty + 2 * math.sqrt(bands * max(empty - both, 0))

    most = 2 * differ + 10
    spare = bisect_left(range(most), True, lo=1, key=enough)
    return spare if spare < most else 1 + (differ + 1) // 128


def shingles(h: np.ndarray, n: int) -> np.ndarray:
    """The sorted distinct shingles of n words; a shorter text is one shingle."""
    if not len(h):
        return h
    n = min(n, len(h))
    with np.errstate(over="ignore"):
        s = np.zeros(len(h) - n + 1, np.uint64)
        for i in range(n):
            s = s * words.BASE + words.mix(h[i : len(h) - n + 1 + i], 2)
    return np.unique(words.mix(s, 3 + n))


def cells(s: np.ndarray, bound: Bound) -> np.ndarray:
    """The keys (48 bits) of the cells that a set enters."""
    out = []
    if not len(s):
        return s  # the empty set links with nothing
    with np.errstate(over="ignore"):
        for c, differ, least in bound.classes(len(s)):
            if not differ:
                continue  # linked sets of this class are equal
            spare = spare_bands(differ, least)
            bands = differ + 1 + spare
            for p in range(PERMUTATIONS + 1):
                if p == PERMUTATIONS:
                    out.append(words.mix(np.array([c], np.uint64), 900))  # sparse under all of them
                    break
                g = s if not p else np.sort(words.mix(s, 50 + p))
                band = ((g >> np.uint64(32)) * np.uint64(bands)) >> np.uint64(32)
                first = np.flatnonzero(np.concatenate(([True], band[1:] != band[:-1])))
                point = np.add.reduceat(words.mix(g & FINE, 40), first)
                out.append(words.mix(point + words.mix(band[first] + np.uint64(bands * 16 + p << 20), 41), 42 + c))
                if bands - len(first) <= spare:
                    break
    return np.concatenate(out) >> np.uint64(16) if out else np.zeros(0, np.uint64)


def point_sets(docs: DataFrame, n: int) -> DataFrame:
    """Each document's set size and fingerprint (f1, f2)."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for row, end, h, at in words.batch_hashes(batch["text"], lower=True):
                for i in range(end - row):
                    rows.append(_fingerprint(shingles(h[at[i] : at[i + 1]], n)))
            columns = zip(*rows, strict=True) if rows else [[]] * 3
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *(pa.array(c, pa.int64()) for c in columns)], ["doc_id", "n_shingles", "f1", "f2"])

    return only(docs, doc_id="doc_id", text="text").mapInArrow(of, SETS)


def _fingerprint(s: np.ndarray) -> tuple[int, int, int]:
    with np.errstate(over="ignore"):
        return len(s), *(int(words.mix(s, k).sum().view(np.int64)) for k in (11, 12))


def _packed_cells(docs: DataFrame, n: int, bound: Bound, buckets: int) -> DataFrame:
    """(bucket, sure, cells, known, place, tags): the cells of a batch's sets by ranges of cells; a tag is a set's first fingerprint.

    A batch gives the cells of equal sets once. Where different sets of a batch meet in a cell, one of them goes to the
    cell's bucket, marked as known to share, and the rest go to any bucket (sure), so a cell that holds much of the
    corpus sends one entry of each batch to its bucket.
    """

    def rows(held: list[tuple[np.ndarray, int]]) -> pa.RecordBatch:
        cell = np.concatenate([c for c, _ in held])
        tags = np.array([t for _, t in held], np.int64)
        place = np.repeat(np.arange(len(held), dtype=np.uint32), [len(c) for c, _ in held])
        order = np.lexsort((place, cell))
        cell, place = cell[order], place[order]
        first = np.concatenate(([True], cell[1:] != cell[:-1]))
        known = ~first | np.concatenate((~first[1:], [False]))
        parts = []
        for sure, chosen in ((False, first), (True, ~first)):
            c, p, k = cell[chosen], place[chosen], known[chosen]
            bucket = ((c >> np.uint64(16)) * np.uint64(buckets)) >> np.uint64(32)
            cuts = np.arange(0, len(c), BLOCK // 8) if sure else np.flatnonzero(np.concatenate((np.ones(min(len(c), 1), bool), bucket[1:] != bucket[:-1])))
            for at, end in zip(cuts, np.append(cuts, len(c))[1:], strict=True):
                used, where = np.unique(p[at:end], return_inverse=True)
                key = int(tags[used[0]]) % buckets if sure else int(bucket[at])
                parts.append((key, sure, words.planes(np.diff(c[at:end], prepend=np.uint64(0))), words.planes(k[at:end]), words.planes(where.astype(np.uint32)), words.planes(tags[used])))
        kinds = (pa.int64(), pa.bool_(), pa.binary(), pa.binary(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*parts, strict=True), kinds, strict=True)], ["bucket", "sure", "cells", "known", "place", "tags"])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple] = set()
        held, size = [], 0
        for batch in batches:
            for row, end, h, at in words.batch_hashes(batch["text"], lower=True):
                for i in range(end - row):
                    s = shingles(h[at[i] : at[i + 1]], n)
                    key = _fingerprint(s)
                    if key not in seen and len(own := cells(s, bound)):
                        seen.add(key)
                        held.append((own, key[1]))
                        size += len(own)
                if size > BLOCK:
                    yield rows(held)
                    seen, held, size = set(), [], 0
        if held:
            yield rows(held)

    return only(docs, doc_id="doc_id", text="text").filter("doc_id is not null").select("text").mapInArrow(of, "bucket long, sure boolean, cells binary, known binary, place binary, tags binary")


def _shared_cells(packed: DataFrame, buckets: int) -> DataFrame:
    """(cell, tag) of the cells in which different sets meet; a row may repeat. Every cell is sent once."""
    names = ["cell", "tag"]

    def entries(part: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        cell = np.cumsum(words.unplanes(part["cells"], np.uint64)).view(np.int64)
        return cell, words.unplanes(part["tags"], np.int64)[words.unplanes(part["place"], np.uint32)], words.unplanes(part["known"], bool)

    def met(held: list[tuple]) -> pa.RecordBatch:
        cell, tag, known = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.lexsort((~known, tag, cell))
        cell, tag, known = cell[order], tag[order], known[order]
        new = np.concatenate(([True], (cell[1:] != cell[:-1]) | (tag[1:] != tag[:-1])))
        cell, tag, known = cell[new], tag[new], known[new]
        same = cell[1:] == cell[:-1]
        keep = known | np.concatenate(([False], same)) | np.concatenate((same, [False]))
        return pa.RecordBatch.from_arrays([pa.array(cell[keep]), pa.array(tag[keep])], names)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held = None, []
        for batch in batches:
            for k in range(batch.num_rows):
                part = batch.slice(k, 1).to_pylist()[0]
                if part["sure"]:
                    cell, tag, _ = entries(part)
                    yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(tag)], names)
                    continue
                if part["bucket"] != bucket and held:
                    yield met(held)
                    held = []
                bucket = part["bucket"]
                held.append(entries(part))
        if held:
            yield met(held)

    return packed.repartition(buckets, "bucket").sortWithinPartitions("sure", "bucket").mapInArrow(of, "cell long, tag long")


def _with_sets(docs: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """tag, doc_id, n, counts, finer counts, set of the wanted (doc_id, tag)."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, h, at in words.batch_hashes(batch["text"], lower=True):
                sets = [shingles(h[at[i] : at[i + 1]], n) for i in range(end - row)]
                with np.errstate(over="ignore"):
                    keep = [i for i, (s, tag) in enumerate(zip(sets, batch["tag"].to_pylist()[row:end], strict=True)) if int(words.mix(s, 11).sum().view(np.int64)) == tag]
                finer = [np.bincount((sets[i] % np.uint64(FINER)).astype(np.int64), minlength=FINER).astype(np.int32) for i in keep]
                counts = [_coarse(x) for x in finer]
                part = batch.slice(row, end - row).take(pa.array(keep, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [part["tag"], part["doc_id"], pa.array([len(sets[i]) for i in keep], pa.int64()), pa.array(counts, pa.list_(pa.int32())), pa.array([words.planes(x) for x in finer], pa.binary()), pa.array([words.planes(np.diff(sets[i] >> np.uint64(12), prepend=np.uint64(0))) for i in keep], pa.binary())],
                    ["tag", "doc_id", "n", "counts", "finer", "members"],
                )

    rows = only(docs, doc_id="doc_id", text="text").filter("doc_id is not null").join(wanted.hint("merge"), "doc_id")
    return rows.select("tag", "doc_id", "text").mapInArrow(of, "tag long, doc_id long, n long, counts array<int>, finer binary, members binary")


def _coarse(finer: np.ndarray) -> np.ndarray:
    """Counts of ``GROUPS`` groups from those of ``FINER``, along the last axis."""
    return finer.reshape(*finer.shape[:-1], FINER // GROUPS, GROUPS).sum(-2, dtype=np.int32)


def _overlap(a: Column, b: Column) -> Column:
    """The sum of the smaller of each two coordinates."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.least(x, y)), F.lit(0).cast("long"), lambda x, y: x + y)


def _verified(pairs: DataFrame, sets: DataFrame, bound: Bound) -> DataFrame:
    """The pairs (a, b) of tags: linked, and between which lo and hi their Jaccard distance lies.

    Where the bound by counts rules a link out, it stands for the overlap, the distance has no upper limit, and no set is
    sent. Of the rest, the sets of b are dealt to a's, in salted blocks of about 64 members.
    """
    light = sets.select("tag", "n", "counts")
    for s in "ab":
        pairs = pairs.hint("merge").join(light.select(F.col("tag").alias(s), F.col("n").alias(f"n_{s}"), F.col("counts").alias(f"counts_{s}")), s)
    overlap, joint = F.col("overlap"), F.col("joint")
    pairs = pairs.select("a", "b", _overlap(F.col("counts_a"), F.col("counts_b")).alias("overlap"), (F.col("n_a") + F.col("n_b")).alias("joint"))
    pairs = stage(pairs.select("a", "b", (100 * overlap >= bound.percent * (joint - overlap)).alias("may"), (1 - overlap / F.greatest(joint - overlap, F.lit(1))).alias("lo")), "bounded")
    apart = pairs.filter("not may").select("a", "b", F.lit(False).alias("linked"), "lo", F.lit(1.0).alias("hi"))
    pairs = pairs.filter("may").select("a", "b")
    many = stage(pairs.groupBy("a").agg(F.count("*").alias("of_a")), "many")
    pairs = pairs.join(many, "a").withColumn("salt", F.pmod(F.xxhash64("b"), F.ceil(F.col("of_a") / 64)))
    pairs = stage(pairs.select("a", "b", "salt"), "dealt")
    whole = sets.select("tag", "members")
    left = pairs.select("a", "salt").distinct().hint("merge").join(whole.withColumnRenamed("tag", "a"), "a").select("a", "salt", F.lit(0).alias("kind"), F.col("a").alias("own"), "members")
    right = pairs.hint("merge").join(whole.withColumnRenamed("tag", "b"), "b").select("a", "salt", F.lit(1).alias("kind"), F.col("b").alias("own"), "members")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, centres = None, []
        for batch in batches:
            found: list[tuple] = []
            columns = [batch[c].to_pylist() for c in ("a", "salt", "kind", "own", "members")]
            for a, salt, kind, own, raw in zip(*columns, strict=True):
                if (a, salt) != key:
                    key, centres = (a, salt), []
                s = np.cumsum(words.unplanes(raw, np.uint64))
                if kind == 0:
                    centres.append(s)
                    continue
                for c in centres:
                    joint = len(c) + len(s)
                    overlap = joint - len(np.union1d(c, s))
                    lo = 1 - overlap / max(joint - overlap, 1)
                    found.append((a, own, bool(bound.links(overlap, joint)), lo, lo))
            kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found, strict=True) if found else [[]] * 5, kinds, strict=True)], ["a", "b", "linked", "lo", "hi"])

    dealt = left.unionByName(right).repartition("a", "salt").sortWithinPartitions("a", "salt", "kind")
    rows = dealt.mapInArrow(check, "a long, b long, linked boolean, lo double, hi double").unionByName(apart)
    return rows.groupBy("a", "b").agg(F.max("linked").alias("linked"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))


def _met_before(x: np.ndarray, y: np.ndarray, cell: int) -> np.ndarray:
    """Of each two rows of first cells, whether they share a cell below this one, where the pair is met as well."""
    out = np.zeros(len(x), bool)
    for k in range(0, len(x), PAIRS):
        p, q = x[k : k + PAIRS], y[k : k + PAIRS]
        out[k : k + PAIRS] = ((p[:, :, None] == q[:, None, :]) & (p < cell)[:, :, None]).any((1, 2))
    return out


def _pairs_of_leaves(bound: Bound, far: float, one: bool, steps: tuple[str, ...] = ("counts",)) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task: (a, b) of the points of two bundles of leaves, or of one, that labels, distances to the centre and counts allow."""

    def points(column: pa.Array) -> dict[str, np.ndarray]:
        flat = column.flatten()
        out = {c: flat.field(c).to_numpy(zero_copy_only=False) for c in ("tag", "label", "size", "lo", "hi")}
        if steps[-1] == "finer":
            out["finer"] = np.stack([words.unplanes(x, np.int32) for x in flat.field("finer").to_pylist()])
            out["counts"] = _coarse(out["finer"])
        else:
            out["counts"] = flat.field("counts").flatten().to_numpy().reshape(-1, GROUPS)
        first = flat.field("first")
        at = np.concatenate(([0], np.cumsum(first.value_lengths().to_numpy())))
        own = first.flatten().to_numpy()
        out["first"] = np.full((len(flat), FIRST), np.iinfo(np.int64).max)
        out["first"][np.arange(FIRST) < np.diff(at)[:, None]] = own
        return out

    def met(x: dict, y: dict, cell: int, same: bool) -> np.ndarray:
        """The pairs of two leaves."""
        low = np.minimum(x["counts"].max(0), y["counts"].max(0)).sum()
        if not same and not bound.links(low, x["size"].min() + y["size"].min()):
            return np.zeros((0, 2), np.int64)  # the boxes' upper corners allow no link
        may = (x["label"][:, None] != y["label"]) & (x["lo"][:, None] - y["hi"] <= far) & (y["lo"] - x["hi"][:, None] <= far)
        if same:
            may &= np.triu(np.ones_like(may), 1)
        a, b = np.nonzero(may)
        for c in steps:
            parts = [np.minimum(x[c][a[k : k + PAIRS]], y[c][b[k : k + PAIRS]]).sum(1, dtype=np.int64) for k in range(0, len(a), PAIRS)]
            overlap = np.concatenate([np.zeros(0, np.int64), *parts])
            fit = bound.links(overlap, x["size"][a] + y["size"][b])
            a, b = a[fit], b[fit]
        new = ~_met_before(x["first"][a], y["first"][b], cell)
        return np.sort(np.stack((x["tag"][a[new]], y["tag"][b[new]]), 1), 1)

    def leaves(side: dict) -> list[dict]:
        return [{c: v[k : k + LEAF] for c, v in side.items()} for k in range(0, len(side["tag"]), LEAF)]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                cell = batch["cell"][k].as_py()
                p = leaves(points(batch["points_a"].slice(k, 1)))
                q = p if one else leaves(points(batch["points_b"].slice(k, 1)))
                found = [met(x, y, cell, one and i == j) for i, x in enumerate(p) for j, y in enumerate(q) if not one or i <= j]
                pairs = np.concatenate(found)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    return of


def _gathered(rest: DataFrame, checked: DataFrame) -> DataFrame:
    """``rest`` (a, tag, cell, label, lo, hi, n), with crowded cells that hold much the same members put together.

    The cells of a large family of near copies differ by a few members each, and compared one by one they compare the same points in
    every cell. A crowded cell goes with the largest one that holds any of its members; such cells become one (numbered below zero)
    where its members make fewer pairs than those of the single cells together, so the work never grows by it. No two members of a
    cell are parted. Distances are those to the centre of the largest cell, where they were verified, and any otherwise.
    """
    crowded = rest.groupBy("cell").agg(F.count("*").cast("double").alias("in_cell")).filter(F.col("in_cell") > LEAF * LEAVES)
    crowded = stage(crowded, "crowded")
    if crowded.isEmpty():
        return rest
    rows = stage(rest.join(crowded, "cell").select("cell", "in_cell", "tag", "a", "label", "n"), "rows")
    top = rows.groupBy("tag").agg(F.max(F.struct("in_cell", "cell", "a")).alias("top"))
    leader = rows.select("cell", "in_cell", "tag").join(top, "tag").groupBy("cell", "in_cell").agg(F.max("top").alias("top"))
    leader = stage(leader.select("cell", "in_cell", F.col("top.cell").alias("family"), F.col("top.a").alias("centre")), "leaders")
    whole = rows.join(leader.drop("in_cell"), "cell").groupBy("family", "centre", "tag").agg(F.first("label").alias("label"), F.first("n").alias("n"))
    whole = stage(whole, "families")
    single = leader.groupBy("family").agg(F.sum(F.col("in_cell") * F.col("in_cell")).alias("pairs"))
    fewer = whole.groupBy("family").agg(F.count("*").cast("double").alias("in_family")).join(single, "family").filter("in_family * in_family < pairs").select("family")
    fewer = stage(fewer, "fewer")
    verified = checked.select(F.col("a").alias("centre"), F.col("b").alias("tag"), "lo", "hi")
    one = whole.join(fewer, "family").join(verified, ["centre", "tag"], "left")
    one = one.select(F.col("centre").alias("a"), "tag", (-1 - F.col("family")).alias("cell"), "label", F.coalesce("lo", F.lit(0.0)).alias("lo"), F.coalesce("hi", F.lit(1.0)).alias("hi"), "n")
    other = rest.join(leader.join(fewer, "family").select("cell"), "cell", "left_anti")
    return stage(other.select(*one.columns).unionByName(one), "gathered")


def _boxed_pairs(members: DataFrame, counts: DataFrame, bound: Bound) -> DataFrame:
    """Pairs of tags in one cell, of different components, that the boxes and then the points allow.

    members: cell, tag, label, n, and lo and hi, the limits of the distance to the cell's centre; counts: tag, and
    finer counts (packed) or counts. Jaccard distance is a metric, so two points whose distances to the centre differ by more than a link allows don't link. Leaves travel whole in
    bundles, once for each other bundle that they have to meet, and points are compared in the task. Near copies share many cells; a
    point carries the ``FIRST`` smallest of its cells, and a pair that shares one of them below the present cell is left to that. The
    number of pairs of bundles in one cell still grows with the square of those that no bound tells apart.
    """
    far = 1 - bound.percent / 100 + 1e-9
    # leaves of one component lie together, so most pairs of boxes can be told to hold nothing new
    ranked = numbered(members.withColumnRenamed("n", "size"), "cell", "label", "lo", "size", "tag")
    own = "finer" if "finer" in counts.columns else "counts"
    steps = ("counts", "finer") if own == "finer" else ("counts",)
    first = members.groupBy("tag").agg(F.slice(F.sort_array(F.collect_set("cell")), 1, FIRST).alias("first"))
    points = stage(first.join(counts.hint("merge"), "tag"), "bounds")
    point = F.struct("rank", "tag", "label", "size", "lo", "hi", "first", own)
    limits = [F.min("size").alias("least"), F.max("size").alias("most"), F.min("label").alias("low"), F.max("label").alias("high"), F.min("lo").alias("lo"), F.max("hi").alias("hi")]
    placed = ranked.select("cell", F.floor(F.col("rank") / (LEAF * LEAVES)).alias("leaf"), "rank", "tag", "label", "size", "lo", "hi", F.col("n").alias("in_cell"))
    leaf = placed.join(points.hint("merge"), "tag").groupBy("cell", "leaf").agg(F.sort_array(F.collect_list(point)).alias("points"), *limits, F.first("in_cell").alias("in_cell"))
    leaf = stage(leaf, "leaves")
    inner = leaf.filter("low < high").select("cell", F.col("points").alias("points_a")).mapInArrow(_pairs_of_leaves(bound, far, True, steps), "a long, b long")

    split = leaf.filter(F.col("in_cell") > LEAF * LEAVES)
    a, b = (split.select("cell", *(F.col(c).alias(f"{c}_{s}") for c in ("leaf", "least", "most", "low", "high", "lo", "hi"))) for s in "ab")
    several = (F.col("low_a") < F.col("high_a")) | (F.col("low_b") < F.col("high_b")) | (F.col("low_a") != F.col("low_b"))
    close = (F.col("lo_a") - F.col("hi_b") <= far) & (F.col("lo_b") - F.col("hi_a") <= far)
    sizes = (100 * F.col("most_a") >= bound.percent * F.col("least_b")) & (100 * F.col("most_b") >= bound.percent * F.col("least_a"))
    # each two once, and each on either side about as often
    once = (F.col("leaf_a") != F.col("leaf_b")) & ((F.col("leaf_a") < F.col("leaf_b")) == ((F.col("leaf_a") + F.col("leaf_b")) % 2 == 0))
    near = a.join(b, "cell").filter(once & several & close & sizes).select("cell", "leaf_a", "leaf_b")
    for s in "ab":
        near = near.join(split.select("cell", F.col("leaf").alias(f"leaf_{s}"), F.col("points").alias(f"points_{s}")).hint("merge"), ["cell", f"leaf_{s}"])
    outer = near.select("cell", "points_a", "points_b").mapInArrow(_pairs_of_leaves(bound, far, False, steps), "a long, b long")
    return inner.unionByName(outer).distinct()


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """How many elements each two of the sets share: products of their membership vectors, over ``COLUMNS`` elements at a time."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    element = np.concatenate(sets)
    order = np.argsort(element, kind="stable")
    element, owner = element[order], owner[order]
    column = np.cumsum(np.concatenate(([0], element[1:] != element[:-1])))
    out = np.zeros((len(sets), len(sets)), np.int64)
    for start in range(0, int(column[-1]) + 1, COLUMNS):
        i, j = np.searchsorted(column, (start, start + COLUMNS))
        member = np.zeros((len(sets), int(column[j - 1]) + 1 - start), np.float32)
        member[owner[i:j], column[i:j] - start] = 1
        out += (member @ member.T).astype(np.int64)
    return out


def _linked(pairs: DataFrame, homes: DataFrame, sets: DataFrame, bound: Bound) -> DataFrame:
    """The pairs (a, b) that link. homes (staged): tag, size, home, where tags of one home are likely to pair.

    Tags lie in blocks of ``TOGETHER`` of one home, large sets in blocks of their own; a set is sent once for each two
    blocks that have a pair, not once a pair.
    """
    alone = F.when(F.col("size") > LARGE, F.col("tag"))
    places = numbered(homes, "home", "tag").select("tag", F.xxhash64("home", F.floor(F.col("rank") / TOGETHER), alone).alias("block"))
    places = stage(places, "places")
    for s in "ab":
        pairs = pairs.join(places.select(F.col("tag").alias(s), F.col("block").alias(f"block_{s}")).hint("merge"), s)
    blocks = ["block_a", "block_b"]
    # which of two tags comes first says nothing
    turned = F.col("block_a") > F.col("block_b")
    pairs = pairs.select(F.least(*blocks).alias("block_a"), F.greatest(*blocks).alias("block_b"), F.when(turned, F.col("b")).otherwise(F.col("a")).alias("a"), F.when(turned, F.col("a")).otherwise(F.col("b")).alias("b"))
    met = stage(pairs.groupBy(*blocks).agg(F.collect_list(F.struct("a", "b")).alias("p")).select(*blocks, "p.a", "p.b"), "met")
    need = met.select(*blocks, F.explode(F.array_union("a", "b")).alias("tag")).join(sets.select("tag", "members").hint("merge"), "tag")
    none = F.lit(None).cast("array<long>")
    rows = need.select(*blocks, "tag", "members", none.alias("a"), none.alias("b"))
    rows = rows.unionByName(met.select(*blocks, F.lit(None).cast("long").alias("tag"), F.lit(None).cast("binary").alias("members"), "a", "b"))

    def links(a: list[int], b: list[int], held: dict[int, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        place = {tag: k for k, tag in enumerate(held)}
        x, y = (np.array([place[t] for t in side]) for side in (a, b))
        size = np.array([len(s) for s in held.values()])
        linked = bound.links(_overlaps(list(held.values()))[x, y], size[x] + size[y])
        return np.array(a)[linked], np.array(b)[linked]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: tuple | None = None

        def closed() -> Iterator[pa.RecordBatch]:
            if now:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in links(*now)], ["a", "b"])

        for batch in batches:
            for k in range(batch.num_rows):
                tag = batch["tag"][k].as_py()
                if tag is None:
                    yield from closed()
                    now = (batch["a"][k].as_py(), batch["b"][k].as_py(), {})
                else:
                    now[2][tag] = np.cumsum(words.unplanes(batch["members"][k].as_py(), np.uint64))
        yield from closed()

    return rows.repartition(*blocks).sortWithinPartitions(*blocks, F.col("tag").asc_nulls_first()).mapInArrow(of, "a long, b long")


def jaccard_components(docs: DataFrame, id: str = "doc_id", text: str = "text", n: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links) of each document."""
    bound = Bound(percent)
    docs = only(docs, doc_id=id, text=text)
    docs = docs.withColumn("doc_id", F.col("doc_id").cast("long"))
    sets = stage(point_sets(docs, n), "points")
    classes = sets.filter("n_shingles > 0 and doc_id is not null").groupBy("n_shingles", "f1", "f2").agg(F.min("doc_id").alias("rep"))
    classes = stage(classes, "classes")

    # cells in which different sets meet
    total = sets.agg(F.sum("n_shingles")).first()[0] or 0
    buckets = max(parallel(docs.sparkSession), total * 2 * (100 - percent) // 100 // BUCKET_CELLS)
    shared = stage(_shared_cells(_packed_cells(docs, n, bound, buckets), buckets).distinct(), "shared")
    release(docs.sparkSession)
    # of cells with the same members, which say the same, one stays
    signed = shared.groupBy("cell").agg(F.bit_xor(F.xxhash64("tag")).alias("s1"), F.bit_xor(F.xxhash64("tag", F.lit(1))).alias("s2"), F.count("*").alias("size"))
    one = signed.groupBy("s1", "s2", "size").agg(F.min("cell").alias("cell")).select("cell")
    members = stage(shared.join(stage(one, "one").hint("merge"), "cell"), "members")
    degree = members.groupBy("tag").agg(F.count("*").alias("degree"))
    ranked = stage(members.join(degree, "tag"), "ranked")
    centre = stage(ranked.groupBy("cell").agg(F.max(F.struct("degree", "tag")).alias("top")).select("cell", F.col("top.tag").alias("a")), "centres")
    star = members.join(centre, "cell").filter("a != tag").select("a", F.col("tag").alias("b")).distinct()
    star = stage(star, "star")

    wanted = stage(classes.select(F.col("rep").alias("doc_id"), F.col("f1").alias("tag")).join(degree.select("tag"), "tag"), "wanted")
    known = stage(_with_sets(docs, wanted, n), "sets")
    release(docs.sparkSession)
    checked = stage(_verified(star, known, bound), "checked")
    links = checked.filter("linked").select("a", "b")

    # cells that still hold several components, beyond the pairs just verified
    label = components(links)
    labelled = members.join(label, F.col("tag") == F.col("node"), "left").select("cell", "tag", F.coalesce("label", "tag").alias("label"))
    labelled = stage(labelled, "labelled")
    open_ = labelled.join(centre, "cell").filter("a != tag").groupBy("cell").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high").select("cell")
    rest = labelled.join(stage(open_, "open"), "cell").join(centre, "cell").filter("a != tag")
    rest = rest.join(checked.select("a", F.col("b").alias("tag"), "lo", "hi"), ["a", "tag"]).join(known.select("tag", "n"), "tag")
    rest = stage(rest, "rest")
    crowds = _gathered(rest, checked)
    release(docs.sparkSession)
    pairs = stage(_boxed_pairs(crowds, known.select("tag", "finer"), bound).join(star.select("a", "b").union(star.select("b", "a")), ["a", "b"], "left_anti"), "pairs")
    release(docs.sparkSession)
    if not pairs.isEmpty():
        homes = stage(rest.groupBy("tag").agg(F.first("n").alias("size"), F.min_by("a", F.struct("lo", "a")).alias("home")), "homes")
        links = stage(links.union(_linked(pairs, homes, known, bound)), "links")
        label = components(links)

    reps = classes.join(label, F.col("f1") == F.col("node"), "left").select("n_shingles", "f1", "f2", "rep", F.coalesce("label", "f1").alias("label"))
    reps = stage(reps, "reps")
    low = stage(reps.groupBy("label").agg(F.min("rep").alias("component_id")), "low")
    named = stage(reps.join(low, "label").select("n_shingles", "f1", "f2", "component_id"), "named")
    linked = sets.filter("n_shingles > 0 and doc_id is not null").select("doc_id", "n_shingles", "f1", "f2").join(named.hint("merge"), ["n_shingles", "f1", "f2"])
    alone = sets.filter("not (n_shingles > 0 and doc_id is not null)")
    return linked.select("doc_id", "n_shingles", "component_id").unionByName(alone.select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))


def first_of_each(docs: DataFrame, id: str = "doc_id", text: str = "text", n: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the one with the smallest id, and every row without an id."""
    stay = jaccard_components(docs, id, text, n, percent).filter("doc_id = component_id").select(F.col("doc_id").alias("stay_own")).distinct()
    names = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.select(F.struct(*names).alias("row_own"), F.col(f"`{id}`").cast("long").alias("id_own"))
    rows = rows.join(stay.hint("merge"), F.col("id_own") == F.col("stay_own"), "left").filter("id_own is null or stay_own is not null")
    return rows.select("row_own.*")
