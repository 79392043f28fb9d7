"""Approximate nearest neighbours by inner product: NN-descent builds a graph, queries walk it greedily.

Equal vectors are one node. Nodes are put on a unit sphere (one more coordinate e makes their lengths equal, so
that the largest inner product is the nearest point) and held as 32-bit floats, with 1 - e in place of e, so that short
vectors beside a long one keep their digits; products between nodes are in double precision, and the whole beam of a query
is scored anew, in double precision, on the original vectors.

Start: a few random-hyperplane forests deal nodes into blocks of about ``BLOCK``, and each node takes its best
``START`` of its block. Descent: each node sends its vector to its neighbours; nodes that meet at one are neighbours of a
neighbour and are offered to each other where they would improve the other's list. That is one shuffle of nodes x ``K``
vectors and one of the offers, which are merged inside each task first. A node's visitors are met in blocks, so a hub costs in
proportion to its visitors, who are at most one row in ``K``. There are ``ROUNDS`` rounds at every size.

Search: a query begins at its own node, if it has one, and at the best of ``PIVOTS`` sample nodes, and in each hop expands the best
``EXPAND`` candidates that it hasn't. Queries go in blocks by hash: nodes to expand, their neighbours' ids and then the vectors of these are
joined once a block, however many of its queries want them, and each query of the block is compared with all of them, in pieces.

Defined cases: vectors that are null, zero, hold null or non-finite numbers, or have another length than most take no part;
fewer candidates than asked for: all found; ties go to the smaller id; a null id takes no part; rows that repeat an id are
further candidates of that id (equal rows count once), and a query's own id is never its candidate; queries that are equal rows
count once, different vectors under one query id are searched each and the id gets the ``k`` best candidates of all of them; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadence.llm.tables import only, stage

K = 48
BLOCK = 512
TREES = 12
START = 16
ROUNDS = 4
PIVOTS = 256
EXPAND = 16
HOPS = 3
BEAM = 160
MEET = 160
OFFER = 12
#: Queries of a block, about; they share the vectors that any of them needs. Few enough that their needs grow with them, not with the table.
ASKED = 8
PIECE = 2_048

LISTS = "id long, vec binary, near binary, sims binary"
_LISTS = pa.schema([("id", pa.int64()), ("vec", pa.binary()), ("near", pa.binary()), ("sims", pa.binary())])


def valid(vectors: DataFrame, id: str, vector: str) -> DataFrame:
    """vec_id and vec (array of doubles) of the rows that take part."""
    rows = only(vectors, vec_id=id, vec=vector).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("vec").cast("array<double>").alias("vec"))
    sound = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf))) & F.exists("vec", lambda x: x != 0)
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("vec").isNotNull()).filter(sound)
    most = rows.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.filter(F.size("vec") == (most["d"] if most else 0))


def _key() -> list[Column]:
    return [F.xxhash64("vec").alias("k1"), F.xxhash64(F.lit("second"), "vec").alias("k2")]


def _matrix(column: pa.Array, kind: type) -> np.ndarray:
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, kind).reshape(len(column), -1) if len(column) else np.zeros((0, 1), kind)


def _products(v: np.ndarray) -> np.ndarray:
    """Inner products on the sphere, less 1, of rows that end with 1 - e; a row with itself: -inf."""
    v = v.astype(np.float64)
    sim = v @ v.T - v[:, -1:] - v[:, -1]
    np.fill_diagonal(sim, -np.inf)
    return sim


def _top(own: np.ndarray, near: np.ndarray, sims: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The k best distinct neighbours of each id: (ids, where each begins, near, sims); better first, ties to smaller ids."""
    order = np.lexsort((-sims, near, own))
    own, near, sims = own[order], near[order], sims[order]
    keep = np.concatenate(([True], (own[1:] != own[:-1]) | (near[1:] != near[:-1]))) & (own != near)
    own, near, sims = own[keep], near[keep], sims[keep]
    order = np.lexsort((near, -sims, own))
    own, near, sims = own[order], near[order], sims[order]
    first = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1]))) if len(own) else np.zeros(0, int)
    rank = np.arange(len(own)) - np.repeat(first, np.diff(np.append(first, len(own))))
    own, near, sims = own[rank < k], near[rank < k], sims[rank < k]
    first = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1]))) if len(own) else np.zeros(0, int)
    return own[first], np.append(first, len(own)), near, sims


def _offers(ids: np.ndarray, edge: np.ndarray, near: np.ndarray, sims: np.ndarray) -> pa.RecordBatch:
    lists = [(near[i:j].tobytes(), sims[i:j].tobytes()) for i, j in zip(edge[:-1], edge[1:], strict=True)]
    n = len(lists)
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.nulls(n, pa.binary()), pa.array([x[0] for x in lists], pa.binary()), pa.array([x[1] for x in lists], pa.binary())], schema=_LISTS)


class _Offers:
    """Collects (id, near, sim) and gives them out merged."""

    def __init__(self, k: int) -> None:
        self.k, self.parts, self.n = k, [], 0

    def add(self, own: np.ndarray, near: np.ndarray, sims: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.parts.append((own, near, sims))
        self.n += len(own)
        if self.n >= 4_000_000:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.n:
            own, near, sims = (np.concatenate(x) for x in zip(*self.parts, strict=True))
            self.parts, self.n = [], 0
            yield _offers(*_top(own, near, sims.astype(np.float32), self.k))


def _best_of(sim: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k largest of each row."""
    k = min(k, sim.shape[1])
    return np.argpartition(-sim, k - 1, axis=1)[:, :k]


def _merge(rows: DataFrame) -> DataFrame:
    """Lists and offers of each id into one list of its K best."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush(rows: pa.Table) -> pa.RecordBatch:
            ids = rows["id"].to_numpy()
            vec = {i: v for i, v in zip(ids, rows["vec"].to_pylist(), strict=True) if v is not None}
            near, sims = rows["near"].to_pylist(), rows["sims"].to_pylist()
            each = np.array([len(x or b"") // 8 for x in near])
            a, b = np.frombuffer(b"".join(x or b"" for x in near), np.int64), np.frombuffer(b"".join(x or b"" for x in sims), np.float32)
            own, edge, near_, sims_ = _top(np.repeat(ids, each), a, b, K)
            lists = {int(o): (near_[i:j], sims_[i:j]) for o, i, j in zip(own, edge[:-1], edge[1:], strict=True)}
            out = []
            for i, v in vec.items():
                n, s = lists.get(i, (np.zeros(0, np.int64), np.zeros(0, np.float32)))
                out.append((i, v, n.tobytes(), s.tobytes()))
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _LISTS, strict=True)], schema=_LISTS)

        for batch in batches:
            held.append(batch)
            table = pa.Table.from_batches(held)
            if table.num_rows >= 20_000:
                ids = table["id"].to_numpy()
                cut = int(np.searchsorted(ids, ids[-1]))  # the last id may go on in the next batch
                if cut:
                    yield flush(table.slice(0, cut))
                    held = table.slice(cut).to_batches()
        if held and (table := pa.Table.from_batches(held)).num_rows:
            yield flush(table)

    return rows.repartition("id").sortWithinPartitions("id").mapInArrow(of, LISTS)


def _start(nodes: DataFrame, count: int, width: int) -> DataFrame:
    """Offers from blocks of a random-hyperplane forest."""
    bits = max(0, round(math.log2(max(1, count / BLOCK))))
    planes = np.random.default_rng(7).standard_normal((TREES, bits, width)).astype(np.float32)[:, :, :-1]  # through directions

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _matrix(batch["vec"], np.float32)[:, :-1]
            for t in range(TREES):
                code = ((v @ planes[t].T > 0) @ (1 << np.arange(bits))).astype(np.int64) if bits and len(v) else np.zeros(len(v), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(v), t, np.int32)), pa.array(code), batch["id"], batch["vec"]], ["tree", "code", "id", "vec"])

    rows = stage(nodes.select("id", "vec").mapInArrow(dealt, "tree int, code long, id long, vec binary"), "forest")
    counts = stage(rows.groupBy("tree", "code").agg(F.ceil(F.count("*") / (2 * BLOCK)).alias("parts")), "blocks")
    rows = rows.join(counts.hint("merge"), ["tree", "code"]).withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")))
    rows = rows.select("tree", "code", "part", "id", "vec").repartition("tree", "code", "part").sortWithinPartitions("tree", "code", "part")

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Offers(START * 2)
        for ids, vec in _blocks(batches, ("tree", "code", "part"), 4 * BLOCK):
            sim = _products(vec)
            if len(ids) > 1:
                top = _best_of(sim, min(START, len(ids) - 1))
                yield from out.add(np.repeat(ids, top.shape[1]), ids[top].ravel(), np.take_along_axis(sim, top, 1).ravel())
        yield from out.flush()

    return rows.mapInArrow(best, LISTS)


def _blocks(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...], most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, vectors) of the rows of one key after another, in blocks of at most ``most``."""
    now, ids, vecs = None, [], []
    for batch in batches:
        columns = [batch[k].to_pylist() for k in (*keys, "id", "vec")]
        for row in zip(*columns, strict=True):
            if row[:-2] != now or len(ids) >= most:
                if ids:
                    yield np.array(ids), np.frombuffer(b"".join(vecs), np.float32).reshape(len(ids), -1)
                now, ids, vecs = row[:-2], [], []
            ids.append(row[-2])
            vecs.append(row[-1])
    if ids:
        yield np.array(ids), np.frombuffer(b"".join(vecs), np.float32).reshape(len(ids), -1)


def _met(graph: DataFrame) -> DataFrame:
    """Offers between nodes that meet at a common neighbour."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch["id"].to_numpy()
            near = [np.frombuffer(x, np.int64) for x in batch["near"].to_pylist()]
            worst = [np.frombuffer(x, np.float32)[-1] if len(x) == 4 * K else -np.inf for x in batch["sims"].to_pylist()]
            each = np.array([1 + len(x) for x in near])
            to = np.concatenate([np.append(x, i) for x, i in zip(near, ids, strict=True)]) if len(ids) else ids
            at = np.repeat(np.arange(len(ids)), each)
            # the row's vector ends with its worst similarity: four more bytes
            vec = pa.array([v + np.float32(w).tobytes() for v, w in zip(batch["vec"].to_pylist(), worst, strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(to, pa.int64()), pa.array(ids[at], pa.int64()), vec.take(pa.array(at, pa.int64()))], ["at", "id", "vec"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Offers(K)
        for ids, raw in _blocks(batches, ("at",), MEET):
            if len(ids) < 2:
                continue
            worst, sim = raw[:, -1], _products(raw[:, :-1]).astype(np.float32)
            top = _best_of(sim, min(OFFER, len(ids) - 1))
            own, s = np.repeat(np.arange(len(ids)), top.shape[1]), np.take_along_axis(sim, top, 1).ravel()
            better = s > worst[own]
            yield from out.add(ids[own[better]], ids[top.ravel()[better]], s[better])
        yield from out.flush()

    sent = graph.select("id", "vec", "near", "sims").mapInArrow(send, "at long, id long, vec binary")
    return sent.repartition("at").sortWithinPartitions("at", F.xxhash64("id", "at")).mapInArrow(meet, LISTS)


def _next(near: bytes, done: bytes) -> np.ndarray:
    """The best nodes of a beam that it hasn't expanded."""
    ids = np.frombuffer(near, np.int64)
    return ids[~np.isin(ids, np.frombuffer(done, np.int64))][:EXPAND]


def _pairs(blocks: list[np.ndarray], ids: list[np.ndarray]) -> pa.RecordBatch:
    pairs = (np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64) for x in (blocks, ids))
    return pa.RecordBatch.from_arrays([pa.array(x) for x in pairs], ["block", "id"])


class Graph:
    """The neighbour graph of a table of vectors."""

    def __init__(self, vectors: DataFrame, id: str = "vec_id", vector: str = "embedding") -> None:
        rows = stage(valid(vectors, id, vector).select(*_key(), "vec_id", "vec"), "vectors")
        # the rank filter keeps few rows of a class in each task before the shuffle
        rank = F.row_number().over(Window.partitionBy("k1", "k2").orderBy("vec_id"))
        self.members = stage(rows.select("k1", "k2", "vec_id").distinct().withColumn("place", rank).filter(F.col("place") <= 64), "members")
        reps = self.members.filter("place = 1").select("k1", "k2", "vec_id")
        self.rows = rows
        # a node has a number of its own: one vec_id may stand first in several classes
        nodes = rows.join(reps, ["k1", "k2", "vec_id"]).dropDuplicates(["k1", "k2"]).sortWithinPartitions("k1", "k2")
        self.nodes = stage(nodes.select("k1", "k2", F.monotonically_increasing_id().alias("id"), "vec"), "nodes")
        # the largest number goes first, so that squares of very large or very small ones neither overflow nor vanish
        big = self.nodes.agg(F.max(F.array_max(F.transform("vec", F.abs))).alias("b")).first()["b"] or 1.0
        norm = F.aggregate("vec", F.lit(0.0), lambda s, x: s + (x / big) * (x / big))
        most = self.nodes.agg(F.max(norm).alias("m"), F.count("*").alias("n"), F.max(F.size("vec")).alias("d")).first()
        self.count, self.width = most["n"], (most["d"] or 0) + 1
        length = math.sqrt(most["m"] or 1.0)

        def floats_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                v = batch["vec"].flatten().to_numpy().reshape(batch.num_rows, -1) / big / length
                square = np.minimum(1.0, (v * v).sum(1, keepdims=True))
                small = np.concatenate([v, square / (1.0 + np.sqrt(1.0 - square))], axis=1).astype(np.float32)
                n = batch.num_rows
                yield pa.RecordBatch.from_arrays([batch["id"], pa.array([x.tobytes() for x in small], pa.binary()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary())], schema=_LISTS)

        own = stage(self.nodes.select("id", "vec").mapInArrow(floats_of, LISTS), "floats")
        graph = stage(_merge(own.unionByName(_start(own, self.count, self.width))), "graph")
        for _ in range(ROUNDS):
            graph = stage(_merge(graph.unionByName(_met(graph))), "graph")
        self.graph = graph

    def search(self, queries: DataFrame, k: int, id: str = "query_id", vector: str = "vec") -> DataFrame:
        """query_id, rank, vec_id, score of the k best found for each query (rows of an id and a vector); k is 40 at most."""
        if k > 40:
            raise ValueError("the beam and the members kept of equal vectors are made for k up to 40")
        queries = only(queries, asked=id, vec=vector).select(F.col("asked").cast("long").alias("asked"), F.col("vec").cast("array<double>").alias("vec")).distinct()
        queries = queries.select("asked", "vec", *_key()).join(self.nodes.select("k1", "k2", F.col("id").alias("node")), ["k1", "k2"], "left")
        # until the last step a query goes by a number of its own; staged, so that it stays
        queries = stage(queries.select(F.monotonically_increasing_id().alias("query_id"), "asked", "vec", "node"), "queries")
        pivots = self.graph.select("id", "vec").orderBy(F.xxhash64("id"), "id").limit(PIVOTS).collect()  # PIVOTS rows
        pivot_ids = np.array([r["id"] for r in pivots], np.int64)
        pivot_vecs = np.array([np.frombuffer(r["vec"], np.float32) for r in pivots], np.float32) if pivots else np.zeros((0, self.width), np.float32)
        schema = pa.schema([("query_id", pa.int64()), ("q", pa.binary()), ("near", pa.binary()), ("sims", pa.binary()), ("done", pa.binary())])
        state = "query_id long, q binary, near binary, sims binary, done binary"
        blocks = max(1, -(-queries.count() // ASKED))

        def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                q = np.array(batch["vec"].to_pylist(), np.float64).reshape(batch.num_rows, -1)
                q /= np.maximum(np.abs(q).max(1, keepdims=True, initial=0.0), 5e-324)
                q = (q / np.maximum(np.sqrt((q * q).sum(1, keepdims=True)), 1e-300)).astype(np.float32)  # a query's length doesn't matter
                q = np.concatenate([q, np.zeros((len(q), 1), np.float32)], axis=1)
                sim = q @ pivot_vecs.T
                out = []
                for i, (query, node) in enumerate(zip(batch["query_id"].to_pylist(), batch["node"].to_pylist(), strict=True)):
                    top = np.argsort(-sim[i])[:8]
                    ids, s = pivot_ids[top], sim[i][top]
                    if node is not None:
                        ids, s = np.insert(ids[ids != node], 0, node), np.insert(s[ids != node], 0, np.float32(np.inf))
                    out.append((query, q[i].tobytes(), ids.tobytes(), s.astype(np.float32).tobytes(), b""))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True) if out else [[]] * 5, schema, strict=True)], schema=schema)

        def frontier(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at, block = [], []
                for b, near, done in zip(*(batch[c].to_pylist() for c in ("block", "near", "done")), strict=True):
                    at.append(_next(near, done))
                    block.append(np.full(len(at[-1]), b))
                yield _pairs(block, at)

        def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                near = [np.frombuffer(x, np.int64) for x in batch["near"].to_pylist()]
                yield _pairs([np.full(len(x), b) for x, b in zip(near, batch["block"].to_pylist(), strict=True)], near)

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """Every query of a block against the block's nodes, which come after the queries and in pieces."""
            now, held, ids, vecs, best = None, [], [], [], []

            def nodes() -> None:
                if ids and held:
                    sim = np.array([np.frombuffer(r[1], np.float32) for r in held]) @ np.frombuffer(b"".join(vecs), np.float32).reshape(len(ids), -1).T
                    top = _best_of(sim, BEAM)
                    best.append((np.array(ids)[top], np.take_along_axis(sim, top, 1)))
                    if len(best) > 8:
                        near, sims = (np.concatenate(x, axis=1) for x in zip(*best, strict=True))
                        top = _best_of(sims, BEAM)
                        best[:] = [(np.take_along_axis(near, top, 1), np.take_along_axis(sims, top, 1))]
                ids.clear()
                vecs.clear()

            def settled() -> pa.RecordBatch:
                nodes()
                out = []
                for i, (query, q, near, sims, done) in enumerate(held):
                    n = np.concatenate([np.frombuffer(near, np.int64), *(x[0][i] for x in best)])
                    s = np.concatenate([np.frombuffer(sims, np.float32), *(x[1][i] for x in best)])
                    order = np.lexsort((-s, n))
                    n, s = n[order], s[order]
                    keep = np.concatenate(([True], n[1:] != n[:-1])) if len(n) else np.zeros(0, bool)
                    n, s = n[keep], s[keep]
                    order = np.lexsort((n, -s))[:BEAM]
                    out.append((query, q, n[order].tobytes(), s[order].astype(np.float32).tobytes(), done + _next(near, done).tobytes()))
                held.clear()
                best.clear()
                return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True) if out else [[]] * 5, schema, strict=True)], schema=schema)

            for batch in batches:
                for row in zip(*(batch[c].to_pylist() for c in ("block", "kind", "query_id", "q", "near", "sims", "done")), strict=True):
                    if row[0] != now:
                        yield settled()
                        now = row[0]
                    if row[1] == 0:
                        held.append(row[2:])
                    else:
                        ids.append(row[2])
                        vecs.append(row[3])
                        if len(ids) >= PIECE:
                            nodes()
            yield settled()

        block = F.pmod(F.xxhash64("query_id", F.lit("block")), F.lit(blocks)).alias("block")
        beam = stage(queries.mapInArrow(enter, state), "beam")
        none = F.lit(None).cast("binary")
        for _ in range(HOPS):
            asked = beam.select(block, F.lit(0).alias("kind"), "query_id", "q", "near", "sims", "done")
            reached = asked.select("block", "near", "done").mapInArrow(frontier, "block long, id long").distinct()
            lists = reached.join(self.graph.select("id", "near").hint("merge"), "id").select("block", "near")
            wanted = lists.mapInArrow(spread, "block long, id long").distinct()
            found = wanted.join(self.graph.select("id", "vec").hint("merge"), "id")
            found = found.select("block", F.lit(1).alias("kind"), F.col("id").alias("query_id"), F.col("vec").alias("q"), none.alias("near"), none.alias("sims"), none.alias("done"))
            beam = stage(asked.unionByName(found).repartition("block").sortWithinPartitions("block", "kind").mapInArrow(score, state), "beam")

        def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                near = [np.frombuffer(x, np.int64) for x in batch["near"].to_pylist()]
                own = np.repeat(batch["query_id"].to_numpy(), [len(x) for x in near])
                yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(np.concatenate(near) if near else [], pa.int64())], ["query_id", "id"])

        def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                n = batch.num_rows
                a, b = (batch[c].flatten().to_numpy().reshape(n, -1) if n else np.zeros((0, 1)) for c in ("q", "v"))
                yield pa.RecordBatch.from_arrays([batch["asked"], batch["id"], pa.array(np.einsum("ij,ij->i", a, b))], ["query_id", "id", "score"])

        near = beam.select("query_id", "near").mapInArrow(candidates, "query_id long, id long")
        near = near.join(self.nodes.select("id", F.col("vec").alias("v")), "id").join(queries.select("query_id", "asked", F.col("vec").alias("q")), "query_id")
        near = near.select("asked", "id", "q", "v").mapInArrow(scores, "query_id long, id long, score double").groupBy("query_id", "id").agg(F.max("score").alias("score"))
        # each class's smallest ids stand for it: more than k + 1 of them can't be among a query's k
        shown = self.members.filter(F.col("place") <= k + 1).join(self.nodes.select("k1", "k2", "id"), ["k1", "k2"]).select("id", "vec_id")
        near = near.join(shown.hint("merge"), "id").filter("vec_id != query_id")
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
        return near.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
