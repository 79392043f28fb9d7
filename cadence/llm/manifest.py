"""Merkle manifest of a data set: a tree a source, a tree of the sources' roots, and a proof for every document.

Leaves are hashes of whole rows. Inside a source they stand by id; every ``FANOUT`` consecutive nodes become
their hash until one is left, the source's root, and the roots of the sources in order become the manifest's root alike.

A superblock is ``FANOUT ** LEVELS`` (4,096) consecutive nodes, a whole subtree. On the way up superblocks are folded to one node each,
tier by tier (a tier has a 4,096th of the nodes below it), until each source has one. On the way down the nodes of a
superblock are cogrouped with the outer nodes that its proofs need: the siblings of its own root and of all nodes above
that, of which there are a few a level. One function then finishes the local reduction, joins the inner siblings
to the outer ones, and folds each leaf up to the root. No group has more than 4,096 rows, however large a source is.

Defined cases: a null field is hashed as ``-``, so it differs from an empty one; a null source is a source and comes
first, as do null ids inside a source; rows of one id stand by their leaves, equal rows next to each other; a lone leaf
is its source's root, and a lone source's root the manifest's; proofs without siblings are the hash of nothing; an
empty table has no rows and no root; further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.llm.tables import numbered, only, stage

FANOUT = 16
LEVELS = 3
SIDES = "left array<string>, right array<string>"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*fields: Column) -> Column:
    """The hash of a row's fields, each ``-`` if null, else its length in bytes, a colon and itself."""
    said = (F.coalesce(F.concat(F.octet_length(x).cast("string"), F.lit(":"), x), F.lit("-")) for f in fields for x in [f.cast("string")])
    return F.sha2(F.concat(*said), 256)


def leaves(docs: DataFrame, changed: Column | None = None, when: Column | None = None) -> DataFrame:
    """doc_id, g (the source, so that a null comes first), leaf, and tampered: the leaf with the text ``changed``, where ``when`` holds."""
    rows = only(docs, **{name: name for name in FIELDS})
    leaf = digest(*(F.col(name) for name in FIELDS))
    other = F.lit(None).cast("string") if changed is None else F.when(when, digest(*(changed if name == "text" else F.col(name) for name in FIELDS)))
    group = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))
    return rows.select("doc_id", group.alias("g"), leaf.alias("leaf"), other.alias("tampered"))


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _levels(nodes: list[str], n: int, levels: int) -> list[list[str]]:
    """The joined runs of each level of a superblock, and its root last; a group of one superblock ends where one node is left."""
    out = []
    while len(nodes) > 1 or (n > FANOUT**levels and len(out) < levels):
        runs = ["".join(nodes[i : i + FANOUT]) for i in range(0, len(nodes), FANOUT)]
        out.append(runs)
        nodes = [_sha(r) for r in runs]
    return [*out, nodes]


def _siblings(levels: list[list[str]], i: int) -> Iterator[tuple[str, str]]:
    """What stands left and right of node i and of each of its ancestors in the superblock."""
    for runs in levels[:-1]:
        i, k = divmod(i, FANOUT)
        yield runs[i][: 64 * k], runs[i][64 * k + 64 :]


def _sides(columns: dict, found: Iterator) -> pd.DataFrame:
    paths = list(found)
    sides = {side: [[step[k] for step in path] for path in paths] for k, side in enumerate(("left", "right"))}
    return pd.DataFrame({name: c.to_numpy() for name, c in columns.items()} | sides)


def climb(nodes: DataFrame, levels: int = LEVELS) -> list[DataFrame]:
    """Tiers (g, rank, digest, n) from ``nodes`` up; a group ends in the tier where its n is 1."""

    span = FANOUT**levels

    def fold(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        (top,) = _levels(rows.sort_values("rank")["digest"].tolist(), n := int(rows["n"].iloc[0]), levels)[-1]
        return pd.DataFrame({"g": [key[0]], "rank": [key[1]], "digest": [top], "n": [-(-n // span)]})

    tiers = [nodes.select("g", "rank", "digest", "n")]
    while not tiers[-1].filter("n > 1").isEmpty():
        open_ = tiers[-1].filter("n > 1").withColumn("block", F.expr(f"rank div {span}"))
        tiers.append(stage(open_.groupBy("g", "block").applyInPandas(fold, "g string, rank long, digest string, n long"), "tier"))
    return tiers


def roots(tiers: list[DataFrame]) -> DataFrame:
    """g and digest of each group's root."""
    return reduce(DataFrame.unionByName, [t.filter("n = 1").select("g", "digest") for t in tiers])


def exchange(nodes: DataFrame, outer: DataFrame, each: Callable, schema: str, levels: int = LEVELS) -> DataFrame:
    """Superblocks of nodes (g, rank, n, digest, ...) cogrouped with their outer nodes (g, block, left, right, ...).

    left and right hold what stands beside the superblock's root and each node above it, from below.
    """

    def finish(key: tuple, rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("rank")
        runs = _levels(rows["digest"].tolist(), int(rows["n"].iloc[0]), levels)
        top = above.iloc[0]
        path = list(zip(top["left"], top["right"], strict=True))
        return each(rows, ([*_siblings(runs, i), *path] for i in range(len(rows))), top)

    nodes = nodes.withColumn("block", F.expr(f"rank div {FANOUT**levels}"))
    return nodes.groupBy("g", "block").cogroup(outer.groupBy("g", "block")).applyInPandas(finish, schema)


def outer_nodes(tiers: list[DataFrame], tops: DataFrame, levels: int = LEVELS) -> DataFrame:
    """(g, block, left, right) of the first tier's superblocks; tops: the same of each group's root, as g, left, right."""

    def paths(nodes: pd.DataFrame, found: Iterator, top: pd.Series) -> pd.DataFrame:
        return _sides({"g": nodes["g"], "block": nodes["rank"]}, found)

    out = None
    for tier in reversed(tiers):
        own = tier.filter(F.col("n") <= FANOUT**levels).select("g").distinct().join(tops, "g").select("g", F.lit(0).cast("long").alias("block"), "left", "right")
        out = stage(own if out is None else own.unionByName(out), "outer")
        if tier is not tiers[0]:
            # a single node of a higher tier is a root: its superblock below is among that tier's own
            open_ = tier.filter("n > 1")
            out = exchange(open_, out.join(open_.select("g").distinct(), "g"), paths, f"g string, block long, {SIDES}", levels)
    return out


def manifest(docs: DataFrame, changed: Column | None = None, when: Column | None = None, levels: int = LEVELS) -> DataFrame:
    """doc_id, leaf, subroot, root, proof (the siblings from the leaf to the root, left to right, from below), folded_root.

    folded_root is folded from the tampered leaf where there is one (see :func:`leaves`), else from the leaf, with the
    siblings of the untampered tree; it equals the root just where nothing was changed.
    """
    rows = stage(numbered(leaves(docs, changed, when), "g", "doc_id", "leaf").withColumnRenamed("leaf", "digest"), "leaves")
    tiers = climb(rows, levels)
    subroots = roots(tiers).select(F.lit("all").alias("g"), F.col("g").alias("own"), "digest")
    subroots = stage(numbered(subroots, "g", "own"), "subroots")
    upper = climb(subroots, levels)
    top = roots(upper).first()
    root = top["digest"] if top else None
    none = F.array().cast("array<string>")
    above = subroots.select("g", none.alias("left"), none.alias("right")).limit(1)

    def beside(nodes: pd.DataFrame, found: Iterator, top: pd.Series) -> pd.DataFrame:
        return _sides({"g": nodes["own"]}, found)

    tops = stage(exchange(subroots, outer_nodes(upper, above, levels), beside, f"g string, {SIDES}", levels), "tops")

    def proofs(nodes: pd.DataFrame, found: Iterator, top: pd.Series) -> pd.DataFrame:
        proof, folded = [], []
        for leaf, other, path in zip(nodes["digest"], nodes["tampered"], found, strict=True):
            at, said = other or leaf, hashlib.sha256()
            for left, right in path:
                said.update((left + right).encode())
                at = _sha(left + at + right)
            proof.append(said.hexdigest())
            folded.append(at)
        return pd.DataFrame({"doc_id": nodes["doc_id"], "leaf": nodes["digest"], "subroot": top["subroot"], "root": root, "proof": proof, "folded_root": folded})

    # ids pass through pandas as text, since nulls would turn numbers to floats
    outer = outer_nodes(tiers, tops, levels).join(subroots.select(F.col("own").alias("g"), F.col("digest").alias("subroot")), "g")
    nodes = rows.select(F.col("doc_id").cast("string").alias("doc_id"), "g", "rank", "n", "digest", "tampered")
    out = exchange(nodes, outer, proofs, "doc_id string, leaf string, subroot string, root string, proof string, folded_root string", levels)
    return out.withColumn("doc_id", F.col("doc_id").cast(rows.schema["doc_id"].dataType))
