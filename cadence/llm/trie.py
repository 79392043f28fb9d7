"""Prefix trie of conversations by van Emde Boas recursion over depth.

A piece is a slice of sequences below one cut prefix: it covers 2 ** k depths. Each round cuts all pieces at half
their depth: the upper half stays below the same prefix; the prefix that ends at the cut gets a name, and the lower half
becomes a piece below that name. Equal pieces (same prefix, same slice) are one row with the number of their members and the
smallest of them, so copies are folded at the first cut and never unfolded. After log2(depth) rounds pieces are single
turns, the nodes of the trie. Slices are compared by digests, which are doubled from single turns up beforehand.

Totals (childless nodes, saved tokens) go up the same recursion: the total of an upper trie is its own plus those of the
lower forests grafted at its cut nodes (``_spans``), and what lies below the end of a span is grafted to the one cut
prefix that the span hangs from, longest spans first (``_below``). Each prefix takes part in as many spans as it is cut
in, two on average, so work grows with the number of nodes, not with node times depth.

No row holds a whole conversation, and no group is gathered: sums and minima are combined before the shuffle. The
digest of the members that end at a node is sequential by definition; ids are joined to long strings where
they are sorted, in parallel, and only those strings pass through the node's task.

Exact up to collisions of 128-bit digests. Defined cases: rows without a conversation id belong to none and are left out; a null
role or text is empty; a null turn comes first; ties of turn stand by role, then text; repeated rows are turns of their own; a
conversation may have any length; without conversations there are no nodes, not even the root; further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.llm.tables import numbered, only, stage

#: Characters of joined ids that travel in one row.
JOINED = 1 << 16


def _name(*parts: Column) -> Column:
    return F.substring(F.sha2(F.concat_ws(">", *parts), 256), 1, 32)


def turns(conversations: DataFrame, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, pos (from 1), item: the turns in order; an item is the digest of role and text, followed by the bytes of the text."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = only(conversations, conv_id=id, turn=turn, role=role, text=text).filter("conv_id is not null")
    rows = rows.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", said("role").alias("role"), said("text").alias("text"))
    size = F.octet_length("text").cast("string")
    item = F.concat(F.substring(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256), 1, 32), size)
    return numbered(rows.withColumn("item", item), "conv_id", "turn", "role", "text").select("conv_id", (F.col("rank") + 1).alias("pos"), "item")


def joined_ids(members: DataFrame) -> DataFrame:
    """d, ends_sha256 of (d, conv_id): the digest of the ids in ascending order, joined by commas."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts: list[list] = []
            for d, c in zip(batch["d"].to_pylist(), batch["conv_id"].to_pylist(), strict=True):
                if not parts or parts[-1][0] != d or parts[-1][3] > JOINED:
                    parts.append([d, c, [], 0])
                parts[-1][2].append(str(c))
                parts[-1][3] += len(parts[-1][2][-1])
            yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in parts], pa.string()), pa.array([p[1] for p in parts], pa.int64()), pa.array([",".join(p[2]) for p in parts], pa.string())], ["d", "low", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, said = None, hashlib.sha256()
        for batch in batches:
            out = []
            for d, ids in zip(batch["d"].to_pylist(), batch["ids"].to_pylist(), strict=True):
                if d != now:
                    out += [] if now is None else [(now, said.hexdigest())]
                    now, said = d, hashlib.sha256()
                else:
                    said.update(b",")
                said.update(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], pa.string()) for k in (0, 1)], ["d", "ends_sha256"])
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now]), pa.array([said.hexdigest()])], ["d", "ends_sha256"])

    parts = members.select("d", "conv_id").repartitionByRange("d", "conv_id").sortWithinPartitions("d", "conv_id").mapInArrow(join, "d string, low long, ids string")
    return parts.repartition("d").sortWithinPartitions("d", "low").mapInArrow(digest, "d string, ends_sha256 string")


def slices(rows: DataFrame) -> list[DataFrame]:
    """Level k: conv_id, j, d, n, up, lo: the slice of depths j * 2 ** k on (from 0), its digest, its length, its halves' digests."""
    low = stage(rows.select("conv_id", (F.col("depth") - 1).alias("j"), F.col("item").alias("d"), F.lit(1).cast("long").alias("n")), "slices")
    deep = low.agg(F.max("j")).first()[0] or 0
    out = [low]
    for _ in range(int(deep).bit_length()):
        half = lambda odd, name: F.max(F.when(F.col("j") % 2 == odd, F.col("d"))).alias(name)
        up = out[-1].groupBy("conv_id", F.shiftright("j", 1).alias("i")).agg(half(0, "up"), half(1, "lo"), F.sum("n").alias("n")).withColumnRenamed("i", "j")
        out.append(stage(up.withColumn("d", _name(F.col("up"), F.coalesce("lo", F.lit("")))), "slices"))
    return out


def cut(levels: list[DataFrame]) -> list[DataFrame]:
    """Level k: the distinct pieces (root, d, j, n, conv_id, members) of 2 ** k depths, and for each distinct sequence its end.

    root names the prefix above a piece (the empty name: none), conv_id is its smallest member. Rows with seq (the digest of a
    whole sequence) and last (the place of its last turn) are no pieces: they follow a sequence down to the piece that ends it.
    """
    top = levels[-1].groupBy("d", "j", "n").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("members")).withColumn("root", F.lit(""))
    no = F.lit(None)
    piece = top.select("root", "d", "j", "n", "conv_id", "members", no.cast("string").alias("seq"), no.cast("long").alias("last"))
    end = top.select("root", "d", "j", "n", "conv_id", F.lit(0).cast("long").alias("members"), F.col("d").alias("seq"), (F.col("n") - 1).alias("last"))
    out = [stage(piece.unionByName(end), "pieces")]
    for k in range(len(levels) - 1, 0, -1):
        half = 1 << (k - 1)
        x = out[-1].join(levels[k].select("conv_id", "j", "up", "lo"), ["conv_id", "j"])
        upper = F.struct("root", F.col("up").alias("d"), (2 * F.col("j")).alias("j"), F.least("n", F.lit(half)).alias("n"))
        lower = F.struct(_name(F.col("root"), F.col("up")).alias("root"), F.col("lo").alias("d"), (2 * F.col("j") + 1).alias("j"), (F.col("n") - half).alias("n"))
        both = F.when(F.col("lo").isNull(), F.array(upper)).otherwise(F.array(upper, lower))
        way = F.when(F.shiftright("last", k - 1) % 2 == 1, F.array(lower)).otherwise(F.array(upper))
        x = x.select(F.explode(F.when(F.col("seq").isNull(), both).otherwise(way)).alias("p"), "conv_id", "members", "seq", "last")
        x = x.select("p.*", "conv_id", "members", "seq", "last").groupBy("root", "d", "j", "n", "seq", "last")
        out.append(stage(x.agg(F.min("conv_id").alias("conv_id"), F.sum("members").alias("members")), "pieces"))
    return out[::-1]


SUMS = ("leaves", "saved")


def _summed(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(*(F.sum(s).alias(s) for s in SUMS))


def _spans(nodes: DataFrame, names: DataFrame, rounds: int) -> list[DataFrame]:
    """Level k: name, at (its depth), and the sums of the nodes at most 2 ** k below it, for names at multiples of 2 ** k."""
    out = [stage(_summed(nodes.select(F.col("root").alias("name"), (F.col("depth") - 1).alias("at"), *SUMS), "name", "at"), "spans")]
    for k in range(rounds):
        grafted = names.filter(F.col("level") == k).select("name", F.col("root"), F.col("at").alias("up")).join(out[-1], "name")
        grafted = grafted.select(F.col("root").alias("name"), F.col("up").alias("at"), *SUMS)
        own = out[-1].filter(F.col("at") % (2 << k) == 0)
        out.append(stage(_summed(own.unionByName(grafted), "name", "at"), "spans"))
    return out


def _below(spans: list[DataFrame], hung: DataFrame) -> DataFrame:
    """name and the sums of all nodes below it; hung: level, root, name of each prefix that a full span of the root ends in."""
    out = spans[-1].filter("name = ''").select("name", *SUMS)
    for k in range(len(spans) - 2, -1, -1):
        own = spans[k].filter(F.col("at") % (2 << k) == (1 << k)).select("name", *SUMS)
        deeper = hung.filter(F.col("level") == k).join(out, "name").select(F.col("root").alias("name"), *SUMS)
        out = out.unionByName(stage(_summed(own.unionByName(deeper), "name"), "below"))
    return out


def prefix_trie(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """The nodes of the trie of the sequences (conv_id, depth from 1 without gaps, item); convs: every conv_id once, also the empty ones.

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    levels = slices(rows)
    pieces = cut(levels)
    rounds = len(levels) - 1
    full = reduce(DataFrame.unionByName, [p.filter(F.col("seq").isNull() & (F.col("n") == 1 << k)).withColumn("level", F.lit(k)) for k, p in enumerate(pieces[: max(rounds, 1)])])
    up = lambda c: F.expr(f"shiftleft({c}, level)")
    full = full.select("level", "root", "d", "j", "conv_id", up("j + 1").alias("depth"), up("j").alias("at"))
    names = stage(full.filter("j % 2 = 0").select("level", "root", "at", "conv_id", "depth", _name(F.col("root"), F.col("d")).alias("name")), "names")
    known = names.select("conv_id", "depth", "name")
    hung = stage(full.filter("j % 2 = 1").select("level", "root", "conv_id", "depth").join(known, ["conv_id", "depth"]), "hung")

    nodes = pieces[0].filter("seq is null").select("root", "d", "conv_id", (F.col("j") + 1).alias("depth"), F.col("members").alias("n_convs"))
    children = stage(nodes.groupBy(F.col("root").alias("name")).agg(F.count("*").alias("n_children")), "children")
    nodes = nodes.join(known, ["conv_id", "depth"], "left").join(children, "name", "left")
    saved = (F.col("n_convs") - 1) * F.substring("d", 33, 20).cast("long")
    nodes = stage(nodes.withColumn("leaves", F.col("n_children").isNull().cast("long")).withColumn("saved", saved), "nodes")

    below = _below(_spans(nodes, names, rounds), hung)
    below = below.select("name", *(F.col(s).alias(f"{s}_below") for s in SUMS))
    members = convs.select("conv_id").join(levels[-1].select("conv_id", "d"), "conv_id", "left").select("conv_id", F.coalesce("d", F.lit("")).alias("d"))
    ends = stage(joined_ids(members), "ends")
    at_end = pieces[0].filter("seq is not null").select("root", "d", "seq").join(ends.withColumnRenamed("d", "seq"), "seq").drop("seq")
    whole = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).first()
    nothing = hashlib.sha256(b"").hexdigest()
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")

    out = nodes.join(below, "name", "left").join(at_end, ["root", "d"], "left")
    out = out.join(names.select(F.col("name").alias("root"), F.col("conv_id").alias("above")), "root", "left")
    parent = F.when(F.col("depth") == 1, F.lit(whole["conv_id"])).otherwise(F.col("above"))
    out = out.select(
        "conv_id", "depth", parent.alias("parent_conv_id"), "n_convs", zero(F.col("n_children")).alias("n_children"),
        (F.col("leaves") + zero(F.col("leaves_below"))).alias("n_leaves"), (F.col("saved") + zero(F.col("saved_below"))).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"),
    )
    if not whole["n_convs"]:
        return out
    one = out.sparkSession.createDataFrame([("", whole["conv_id"], whole["n_convs"])], "name string, conv_id long, n_convs long")
    one = one.join(children, "name", "left").join(below, "name", "left").join(ends.withColumnRenamed("d", "name"), "name", "left")
    root = one.select(
        "conv_id", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), "n_convs", zero(F.col("n_children")).alias("n_children"),
        F.coalesce("leaves_below", F.lit(1)).cast("long").alias("n_leaves"), zero(F.col("saved_below")).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"),
    )
    return out.unionByName(root)
