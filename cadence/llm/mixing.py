"""Mix sources to target weights along a time-varying curriculum.

Each source has a weight schedule of its own over training time t in [0, 1]: its target times a
ramp ``1 + tilt * (2 t - 1)``, whose integral over the run is 1. Tilts are ``drift`` times the source's
lean: sources of large weight lead and fall, those of small weight trail and rise (``leans``). Leans sum to 0 over the
targets, so the weights of all sources add up to the same budget at every t, and t is the share of
the mix trained so far. Without two weights among the sources that take words, no share changes.
The cumulative demand of a source is the integral ``target * (t + tilt * (t * t - t))``; a document
that starts at word c of its source's stream is trained at the t where the demand reaches c, and
positions are range-sorted by t. Documents of the last pass start after those taken before them in it.

Targets: sources share the budget by weight; a target stops at ``cap`` times its source's size,
and the excess is shared again by weight until none is above.

A source's stream repeats it in passes, each in an order by hash. Whole passes take every
document; in the last one documents are taken while they fit, then smaller ones fill what is left
(three rounds), so that the words taken come within a small document of the target. Where that still
misses the target by more than ``NEAR`` of it, which takes a source of few and large documents, its last pass is
drawn again from the largest that fits downwards (size classes by powers of two, the order by hash inside one),
until nothing fits, and the closer of the two draws counts. Texts are never cut.

Prefix sums run over slices of a source by hash: as many slices as the square root of the rows,
so neither the sums by slice nor the rows of one slice gather a hot source in one task.

Defined cases: a null text has size 0; a null source is a source of its own and comes last; equal
rows are taken as separate documents and may share a position; documents of size 0 are taken in
each whole pass; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadence.llm.tables import only, stage
from cadence.llm.words import WORD

SHARE = 1.5
CAP = 2.0
WEIGHTS = (5.0, 2.0, 1.0)
DRIFT = 0.5
ROUNDS = 3
NEAR = 0.02


def targets(sizes: Sequence[tuple[str | None, int]], weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> list[tuple[str | None, float, float]]:
    """(source, weight, target) for each (source, size): weights repeat over sources by code point, null last."""
    order = sorted(sizes, key=lambda x: (x[0] is None, x[0] or ""))
    weight = {s: weights[i % len(weights)] for i, (s, _) in enumerate(order)}
    size = dict(order)
    open_, left, out = dict(weight), share * sum(size.values()), {}
    while open_:
        unit = left / sum(open_.values())
        over = [s for s in open_ if open_[s] * unit > cap * size[s]]
        if not over:
            out |= {s: w * unit for s, w in open_.items()}
            break
        for s in over:
            out[s] = cap * size[s]
            left -= out[s]
            del open_[s]
    return [(s, weight[s], out[s]) for s, _ in order]


def leans(shares: Sequence[tuple[str | None, float, float]]) -> dict[str | None, float]:
    """The lean in [-1, 1] of each (source, weight, target): weights from large to small run from falling to rising.

    The mean over the targets is 0 and the steepest lean 1 or -1, or all are 0.
    """
    rank = {w: i for i, w in enumerate(sorted({w for _, w, t in shares if t > 0}, reverse=True))}
    total = sum(t for _, w, t in shares if t > 0)
    mean = sum(rank[w] * t for _, w, t in shares if t > 0) / total if total else 0.0
    own = {s: rank[w] - mean if t > 0 and len(rank) > 1 else 0.0 for s, w, t in shares}
    most = max(map(abs, own.values()), default=0.0)
    return {s: x / most if most else 0.0 for s, x in own.items()}


def time_of(demand: Column, target: Column, tilt: Column) -> Column:
    """The t at which ``target * (t + tilt * (t * t - t))`` reaches ``demand``, for a tilt in [-1, 1]."""
    part = F.least(F.lit(1.0), F.when(target > 0, demand / target).otherwise(F.lit(0.0)))
    flat = F.lit(1.0) - tilt
    root = F.sqrt(F.greatest(F.lit(0.0), flat * flat + part * tilt * 4))
    # this form of the root holds for a tilt of 0 too
    return F.when(part > 0, F.least(F.lit(1.0), part * 2 / (flat + root))).otherwise(F.lit(0.0))


def _before(df: DataFrame, slices: int) -> DataFrame:
    """Adds start: words of the same source that lie before the row in the order by u."""
    df = df.withColumn("slice", F.floor(F.col("u") * slices))
    sums = df.groupBy("source", "slice").agg(F.sum("size").alias("n"))
    over = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("source").alias("s_"), F.col("slice").alias("k_"), F.coalesce(F.sum("n").over(over), F.lit(0)).alias("base"))
    inside = Window.partitionBy("source", "slice").orderBy("u", "doc_id", "mark").rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumn("in_slice", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    return df.join(sums, F.col("source").eqNullSafe(F.col("s_")) & (F.col("slice") == F.col("k_"))).withColumn("start", F.col("base") + F.col("in_slice")).drop("s_", "k_", "base", "in_slice", "slice")


def measured(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """doc_id, source, mark (of the text), size (words of the whole text) and u, the document's place in the order by hash."""
    size = F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD)).cast("long")
    bits = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit("mix")), 11)
    rows = only(docs, doc_id=id, text=text, source=source).withColumn("text", F.col("text").cast("string"))
    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.xxhash64("text").alias("mark"), size.alias("size"), (bits / F.lit(float(1 << 53))).alias("u"))


def plan_mix(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, lean, start (its word in the source's pass), copies,
    passes (whole ones), last (its word in the last pass, where it is taken there).

    The number of sources must be small: their sizes come to the driver to be shared out.
    """
    spark = docs.sparkSession
    rows = stage(measured(docs, id, text, source), "mix")
    by = rows.groupBy("source").agg(F.sum("size").alias("n"), F.count("*").alias("rows")).collect()
    total = sum(r["rows"] for r in by)
    slices = max(16, math.isqrt(total))
    size = {r["source"]: r["n"] for r in by}
    goals = targets(list(size.items()), weights, share, cap)
    shares = [(s, int(size[s]), float(t), int(t // size[s]) if size[s] else 0) for s, _, t in goals]
    lean = leans(goals)
    goal = spark.createDataFrame([(*x, lean[x[0]]) for x in shares], "g_ string, source_size long, target double, passes int, lean double")
    # one row per source, as bounded as the collect above
    goal = F.broadcast(goal)
    rows = _before(rows.join(goal, F.col("source").eqNullSafe(F.col("g_"))).drop("g_"), slices)
    need = F.col("target") - F.col("passes") * F.col("source_size")
    rows = rows.withColumn("need", need).withColumn("extra", (F.col("size") > 0) & (F.col("start") + F.col("size") <= F.col("need")))
    for _ in range(ROUNDS):
        rows = stage(rows, "mixed")
        taken = {r["source"]: r["n"] for r in rows.filter("extra").groupBy("source").agg(F.sum("size").alias("n")).collect()}
        left = spark.createDataFrame([(s, t - p * n - (taken.get(s) or 0)) for s, n, t, p in shares], "g_ string, left double")
        rest = rows.filter(~F.col("extra")).join(F.broadcast(left), F.col("source").eqNullSafe(F.col("g_"))).drop("g_")
        small = (F.col("size") > 0) & (F.col("size") <= F.col("left") / 2)
        more = _before(rest.filter(small).withColumnRenamed("start", "own"), slices)
        more = more.withColumn("extra", F.col("start") + F.col("size") <= F.col("left")).drop("start").withColumnRenamed("own", "start")
        rows = rows.filter("extra").unionByName(rest.filter(~small).drop("left")).unionByName(more.drop("left"))
    rows = stage(_nearer(stage(rows, "mixed"), shares, slices), "taken")
    # the last pass is a stream of its own: only what is taken in it counts
    last = _before(rows.filter("extra").withColumnRenamed("start", "own"), slices).withColumnsRenamed({"start": "last", "own": "start"})
    rows = last.unionByName(rows.filter("not extra").withColumn("last", F.lit(None)))
    return rows.select("doc_id", "source", "mark", "size", "source_size", "target", "lean", "start", (F.col("passes") + F.col("extra").cast("int")).alias("copies"), "passes", "last")


def _nearer(rows: DataFrame, shares: list[tuple], slices: int) -> DataFrame:
    """Rows with the last pass (``extra``) drawn again for sources that missed their target, where that comes closer."""
    spark = rows.sparkSession

    def words_of(df: DataFrame, taken: str) -> dict:
        return {r["source"]: int(r["n"]) for r in df.filter(taken).groupBy("source").agg(F.sum("size").alias("n")).collect()}

    taken = words_of(rows, "extra")
    short = {s: t - p * n - taken.get(s, 0) for s, n, t, p in shares}
    need = {s: t - p * n for s, n, t, p in shares if short[s] > NEAR * t}
    if not need:
        return rows
    flag = lambda d, name: F.broadcast(spark.createDataFrame(list(d.items()), f"g_ string, {name} double"))
    here = F.col("source").eqNullSafe(F.col("g_"))
    redo = rows.join(flag(need, "need_"), here).drop("g_", "need_").withColumnsRenamed({"start": "own", "u": "hash"})
    # the largest come first: a class for each power of two, by hash inside it
    falling = (F.lit(63) - F.floor(F.log2(F.col("size"))) + F.col("hash")) / 64
    redo = stage(redo.withColumn("again", F.lit(False)), "redo")
    got: dict = {}
    while True:
        left = {s: n - got.get(s, 0) for s, n in need.items()}
        tried = redo.join(flag(left, "left_"), here).drop("g_").withColumn("fits", ~F.col("again") & (F.col("size") > 0) & (F.col("size") <= F.col("left_")))
        if tried.filter("fits").isEmpty():
            break
        drawn = _before(tried.filter("fits").withColumn("u", falling), 64 * slices).withColumn("again", F.col("start") + F.col("size") <= F.col("left_"))
        redo = stage(tried.filter("not fits").select(*redo.columns).unionByName(drawn.select(*redo.columns)), "redo")
        got = words_of(redo, "again")
    closer = {s: 1.0 for s, n in need.items() if n - got.get(s, 0) < short[s]}
    if not closer:
        return rows
    redo = redo.withColumn("extra", F.col("again")).withColumnsRenamed({"own": "start", "hash": "u"})
    return rows.join(flag(closer, "c_"), here, "left_anti").unionByName(redo.join(flag(closer, "c_"), here, "left_semi").select(*rows.columns))


def curriculum(plan: DataFrame, drift: float = DRIFT) -> DataFrame:
    """The plan with times: the training time of each copy taken; range-sorted by the first, documents not taken last.

    ``drift`` in [0, 1] is the steepest tilt of a source's schedule; 0 keeps all shares as they are.
    """
    each = F.sequence(F.lit(0), F.col("copies") - 1)
    place = lambda p: F.when(p < F.col("passes"), F.col("start")).otherwise(F.col("last"))
    tilt = F.col("lean") * F.lit(float(drift))
    times = F.transform(each, lambda p: time_of(p * F.col("source_size") + place(p), F.col("target"), tilt))
    times = F.when(F.col("copies") > 0, times).otherwise(F.array().cast("array<double>"))
    plan = plan.withColumn("times", times).withColumn("first_", F.coalesce(F.get("times", F.lit(0)), F.lit(2.0)))
    return plan.repartitionByRange("first_", "doc_id").sortWithinPartitions("first_", "doc_id").drop("first_")


def mixed(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The rows of ``docs`` (all their columns), each as often as the mix takes it, in training order.

    Rows that repeat an id and a text are all taken as the first of them is.
    """
    plan = curriculum(plan_mix(docs, id, text, source))
    plan = plan.dropDuplicates(["doc_id", "mark", "source"]).select(*(F.col(c).alias(f"{c}_own") for c in ("doc_id", "mark", "source", "times")))
    names = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.select(F.struct(*names).alias("row_own"), F.col(f"`{id}`").cast("long").alias("i_own"), F.xxhash64(F.col(f"`{text}`").cast("string")).alias("m_own"), F.col(f"`{source}`").cast("string").alias("s_own"))
    same = F.col("i_own").eqNullSafe(F.col("doc_id_own")) & (F.col("m_own") == F.col("mark_own")) & F.col("s_own").eqNullSafe(F.col("source_own"))
    rows = rows.join(plan.filter(F.size("times_own") > 0), same).select("row_own", "i_own", F.explode("times_own").alias("t_own"))
    return rows.repartitionByRange("t_own", "i_own").sortWithinPartitions("t_own", "i_own").select("row_own.*")
