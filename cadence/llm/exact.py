"""Exact deduplication against a persistent digest index (DataFrame functions only).

The index is a table bucketed and sorted by digest. A batch is reduced to one row per digest,
anti-joined with the index (sort-merge; the index is read in its buckets and not shuffled), and
the digests that are new are appended. Running a batch again appends nothing.

Defined cases: a null text counts as empty; texts are equal after each run of white space has
become one space, so empty and null texts form one group; of rows with the same id and text one
stays for all of them; a null id comes after all others; an empty batch gives no rows; further
columns of the input are not read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence.llm.tables import only, parallel, stage
from cadence.llm.words import SPACE


def normalised(text: str) -> F.Column:
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), SPACE, " ")


class DigestIndex:
    """Digest -> id of the document that stays, as a bucketed and sorted table.

    One writer at a time. ``buckets`` is fixed when the table is made: choose it so that a
    bucket of the largest index expected fits a task (at 10**11 digests of 100 bytes, 50,000
    buckets of 200 MB).
    """

    def __init__(self, spark: SparkSession, name: str, buckets: int | None = None) -> None:
        self.spark, self.name = spark, name
        self.buckets = buckets or parallel(spark)
        if not spark.catalog.tableExists(name):
            self._append(spark.createDataFrame([], "digest string, keep_id long"))

    def _append(self, rows: DataFrame) -> None:
        rows.write.bucketBy(self.buckets, "digest").sortBy("digest").format("parquet").mode("append").saveAsTable(self.name)

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def add(self, docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
        """Enter a batch; one row per document of it: doc_id, digest, keep_id, group_size (in the batch), kept.

        A document whose digest an earlier batch has entered is not kept, and its keep_id is the earlier one's.
        """
        rows = stage(only(docs, doc_id=id, text=text).select("doc_id", F.sha2(normalised("text").cast("binary"), 256).alias("digest")), "digests")
        # min() leaves nulls out, so a null id stays only where there is no other
        groups = rows.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("group_size"))
        groups = stage(groups.repartition(self.buckets, "digest"), "groups")
        fresh = groups.join(self.table().hint("merge"), "digest", "left_anti")
        # the new rows lie in the buckets' own order, so each bucket gets one file
        self._append(fresh.select("digest", F.col("first_id").alias("keep_id")).repartition(self.buckets, "digest"))
        held = groups.join(self.table().hint("merge"), "digest").select("digest", "keep_id", "group_size", F.col("first_id").eqNullSafe(F.col("keep_id")).alias("ours"))
        # staged, so that both sides of the last join come straight from a shuffle and a hot digest can be split
        held = stage(held, "held")
        return rows.join(held.hint("merge"), "digest").select(
            "doc_id", "digest", "keep_id", "group_size", (F.col("doc_id").eqNullSafe(F.col("keep_id")) & F.col("ours")).alias("kept")
        )


def exact_dedup(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One batch against an index of its own; see :meth:`DigestIndex.add`."""
    return DigestIndex(docs.sparkSession, f"digest_index_{uuid.uuid4().hex}").add(docs, id, text)


def keep_first(docs: DataFrame, id: str = "doc_id", text: str = "text", index: DigestIndex | None = None) -> DataFrame:
    """The rows of ``docs`` that stay (all their columns): one of each group of equal texts that the index has not held before."""
    index = index or DigestIndex(docs.sparkSession, f"digest_index_{uuid.uuid4().hex}")
    stay = index.add(docs, id, text).filter("kept").select(F.col("doc_id").alias("stay_id"), F.col("digest").alias("stay_digest")).distinct()
    names = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.select(F.struct(*names).alias("row_own"), F.col(f"`{id}`").alias("id_own"), normalised(f"`{text}`").alias("t_own"))
    rows = rows.select("row_own", "id_own", F.sha2(F.col("t_own").cast("binary"), 256).alias("digest_own"))
    rows = rows.join(stay, F.col("id_own").eqNullSafe(F.col("stay_id")) & (F.col("digest_own") == F.col("stay_digest")), "left_semi")
    # rows that repeat an id and a text
    return rows.dropDuplicates(["digest_own"]).select("row_own.*")
