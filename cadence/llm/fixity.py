"""Merkle fixity audit of an archive of web records and its replica.

Each record is rendered as an archive record and hashed. Records stand in the order of their ids;
a node of the tree covers a range of ids (``FANOUT`` ids, then ``FANOUT`` nodes, ...), and carries the
hash of its children's hashes in order, the number of records and their bytes. Two replicas are
compared at the root, and only children of nodes that differ are compared next, level by level;
byte offsets are summed on the way down, from the sizes of earlier siblings.

Defined cases: null urls and bodies are empty; records of one id (repeats, or all with a null id) are
one leaf whose hash adds up their hashes, so that it needs no order and no long list; null ids come
first; an empty replica makes every record missing; two empty ones differ in nothing; further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from cadence.llm.tables import only, stage

FANOUT = 16


def record(id: Column, url: Column, body: Column) -> Column:
    body = F.coalesce(body, F.lit(""))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")),
        F.lit("\r\nWARC-Record-ID: <urn:page:"), F.coalesce(id.cast("string"), F.lit("")),
        F.lit(">\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"),
    )
    return F.concat(head, body, F.lit("\r\n\r\n"))


def leaves(pages: DataFrame, id: str = "page_id", url: str = "url", body: str = "html") -> DataFrame:
    """key (the id), digest, records, bytes."""
    rows = only(pages, key=id, url=url, body=body).withColumn("key", F.col("key").cast("long"))
    rows = rows.select("key", record(F.col("key"), F.col("url"), F.col("body")).alias("r")).select("key", F.sha2("r", 256).alias("d"), F.octet_length("r").cast("long").alias("b"))
    part = lambda i: F.sum(F.conv(F.substring("d", 1 + 16 * i, 16), 16, 10).cast("decimal(20,0)")).alias(f"s{i}")
    sums = rows.groupBy("key").agg(F.count("*").alias("records"), F.sum("b").alias("bytes"), *(part(i) for i in range(4)))
    return sums.select("key", F.sha2(F.concat_ws(":", "records", "bytes", *(f"s{i}" for i in range(4))), 256).alias("digest"), "records", "bytes")


def tree(a: DataFrame, b: DataFrame) -> list[DataFrame]:
    """The levels of both replicas' trees, leaves first: replica, key, parent, digest, records, bytes."""
    level = stage(a.withColumn("replica", F.lit("a")).unionByName(b.withColumn("replica", F.lit("b"))), "leaves")
    reach = level.agg(F.max(F.abs("key")).alias("m")).first()["m"] or 0
    out, top = [], False
    while not top:
        top = reach <= 1  # the nodes null, -1, 0 and 1 at most
        level = level.withColumn("parent", F.lit(0).cast("long") if top else F.shiftright("key", FANOUT.bit_length() - 1))
        out.append(level)
        children = F.array_sort(F.collect_list(F.struct(F.coalesce(F.col("key").cast("string"), F.lit("")).alias("name"), "digest")))
        level = level.groupBy("replica", "parent").agg(
            F.sha2(F.concat_ws("\n", F.transform(children, lambda x: F.concat_ws(":", x["name"], x["digest"]))), 256).alias("digest"),
            F.sum("records").alias("records"), F.sum("bytes").alias("bytes"),
        ).withColumnRenamed("parent", "key")
        level = stage(level, "nodes")
        reach = -(-reach // FANOUT)
    return [*out, level.withColumn("parent", F.lit(0).cast("long"))]


def differing(level: DataFrame, above: DataFrame | None) -> DataFrame:
    """key, offset, digests and sizes of the nodes that differ, among the children of ``above``."""
    if above is None:
        level = level.withColumn("base", F.lit(0).cast("long"))
    else:
        above = above.select(F.col("key").alias("p_"), F.col("offset").alias("base"))
        level = level.join(above, F.col("parent").eqNullSafe(F.col("p_"))).drop("p_")
    side = lambda r, c: F.max(F.when(F.col("replica") == r, F.col(c))).alias(f"{c}_{r}")
    nodes = level.groupBy("parent", "key", "base").agg(*(side(r, c) for r in "ab" for c in ("digest", "records", "bytes")))
    earlier = Window.partitionBy("parent").orderBy(F.col("key").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    nodes = nodes.withColumn("offset", F.col("base") + F.coalesce(F.sum("bytes_a").over(earlier), F.lit(0)))
    return nodes.filter(~F.col("digest_a").eqNullSafe(F.col("digest_b"))).drop("base", "parent")


def audit(primary: DataFrame, replica: DataFrame, id: str = "page_id", url: str = "url", body: str = "html") -> tuple[DataFrame, DataFrame]:
    """(leaves of the primary, what differs): key, offset and bytes in the primary, status changed / missing / extra."""
    levels = tree(leaves(primary, id, url, body), leaves(replica, id, url, body))
    found = None
    for level in reversed(levels):
        found = stage(differing(level, found), "differing")
    status = F.when(F.col("digest_b").isNull(), "missing").when(F.col("digest_a").isNull(), "extra").otherwise("changed")
    found = found.select("key", "offset", F.col("bytes_a").alias("bytes"), status.alias("status"))
    return levels[0].filter("replica = 'a'").select("key", "digest", "records", "bytes"), found
