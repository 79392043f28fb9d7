"""Versioned marts on plain Parquet.

A mart version is an immutable directory ``<root>/<mart>/v=<n>/attempt-<id>``. A commit is one
small JSON file in ``<root>/_commits`` whose rows say which directory each mart
points at from now on. Readers follow the newest row of their mart, so publishing,
rolling back and emptying are commits, never rewrites in place, and several marts
move together in one commit. One publisher writes at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cadence.sources.files import TARGET_FILE_BYTES, compact

COMMIT = (
    "commit bigint, mart string, version bigint, operation string, "
    "summary map<string,string>, path string, fields string, committed_at timestamp"
)
RECORDS = "total-records"  # summary key


class StaleVersion(RuntimeError):
    """A mart moved on between its check and its publication."""


@dataclass(frozen=True)
class Placed:
    """A written version without its commit; ``table`` reads it back."""

    path: str
    records: int
    fields: str
    table: DataFrame


class MartStore:
    """Marts under one root. Any session that can read the root sees the same heads."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        # A first use creates the empty commit folder; later uses leave it alone.
        spark.createDataFrame([], COMMIT).write.mode("ignore").json(f"{self.root}/_commits")

    # -- reading ---------------------------------------------------------------

    def commits(self) -> DataFrame:
        return (
            self.spark.read.schema(COMMIT)
            .json(f"{self.root}/_commits")
            .withColumn("records", F.col("summary")[RECORDS].try_cast("bigint"))
        )

    def heads(self) -> DataFrame:
        """Current commit row per mart."""
        rest = [c for c in COMMIT_COLUMNS if c != "mart"]
        return (
            self.commits()
            .groupBy("mart")
            .agg(F.max_by(F.struct(*rest), "commit").alias("r"))
            .select("mart", "r.*")
        )

    def marts(self) -> DataFrame:
        return self.heads().select("mart", "version", "records").orderBy("mart")

    def history(self, mart: str, limit: int = 15) -> DataFrame:
        """Newest commits of a mart."""
        return (
            self.commits()
            .where(F.col("mart") == mart)
            .orderBy(F.desc("commit"))
            .limit(limit)
            .select("committed_at", "version", "operation", F.col("records").alias("total_records"))
        )

    def read(self, mart: str, version: int | None = None) -> DataFrame:
        row = self._row(mart, version)
        return self.spark.read.schema(row["fields"]).parquet(row["path"])

    # -- writing ---------------------------------------------------------------

    def write(self, mart: str, df: DataFrame, operation: str = "replace") -> int:
        """Write a new version and point the mart at it; returns the version."""
        return self.write_all({mart: df}, operation)[mart]

    def write_all(self, marts: Mapping[str, DataFrame | Placed], operation: str = "replace") -> dict[str, int]:
        """Write new versions of several marts, then move all of them in one commit."""
        number = self.next_version()
        rows, versions = [], {}
        for mart, df in marts.items():
            done = df if isinstance(df, Placed) else self.place(mart, df, number)
            rows.append((mart, number, operation, done.records, done.path, done.fields))
            versions[mart] = number
        self._commit(number, rows)
        return versions

    def place(self, mart: str, df: DataFrame, version: int) -> Placed:
        """Write a version that no reader sees before a commit names it; it can be read back meanwhile."""
        path, seen = self._attempt(mart, version), Observation()
        df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("errorifexists").parquet(path)
        fields = _ddl(df)
        return Placed(path, seen.get["n"], fields, self.spark.read.schema(fields).parquet(path))

    def publish(self, moves: Mapping[str, str], versions: Mapping[str, int] | None = None) -> None:
        """Point each key mart at the version its value mart points at, all in one commit.

        ``versions`` (of the value marts) are those that were checked: where a mart has moved
        on since, nothing is published.
        """
        number = self.next_version()
        rows = []
        for target, source in moves.items():
            r = self._row(source, None)
            if versions is not None and r["version"] != versions[source]:
                raise StaleVersion(f"{source} is at version {r['version']}, version {versions[source]} was checked")
            rows.append((target, r["version"], "publish", r["records"], r["path"], r["fields"]))
        self._commit(number, rows)

    def empty(self, mart: str) -> tuple[int, int]:
        """A new version without rows, same columns; row counts before and after."""
        head = self._row(mart, None)
        self.write(mart, self.read(mart).limit(0), "delete")
        return head["records"], 0

    def rollback(self, mart: str, version: int) -> tuple[int, int]:
        """Point the mart at an older version; row counts before and after."""
        head, old = self._row(mart, None), self._row(mart, version)
        self._commit(
            self.next_version(),
            [(mart, old["version"], "rollback", old["records"], old["path"], old["fields"])],
        )
        return head["records"], old["records"]

    def compact(self, mart: str, target_bytes: int = TARGET_FILE_BYTES) -> DataFrame:
        """Rewrite the current version into fewer files as a new version."""
        head, number = self._row(mart, None), self.next_version()
        path = self._attempt(mart, number)
        stats = compact(self.read(mart), path, target_bytes=target_bytes)
        done = stats.first()
        if not done["rows_unchanged"]:
            raise RuntimeError(f"compaction of {mart} changed its rows: {done}")
        self._commit(number, [(mart, number, "compact", head["records"], path, head["fields"])])
        return stats

    # -- commits ---------------------------------------------------------------

    def _row(self, mart: str, version: int | None):
        rows = self.commits().where(F.col("mart") == mart)
        if version is not None:
            rows = rows.where(F.col("version") == version)
        row = rows.orderBy(F.desc("commit")).first()
        if row is None:
            raise LookupError(f"no version {version if version is not None else ''} of mart {mart}")
        return row

    def _attempt(self, mart: str, version: int) -> str:
        """A folder of its own for each attempt: what a crash left before its commit is in nobody's way."""
        return f"{self.root}/{mart}/v={version}/attempt-{uuid.uuid4().hex}"

    def next_version(self) -> int:
        """The number that the next commit and all versions in it get."""
        return (self.commits().agg(F.max("commit")).first()[0] or 0) + 1

    def _commit(self, number: int, rows: list[tuple]) -> None:
        def moved_row(mart, version, operation, records, path, fields):
            summary = F.create_map(F.lit(RECORDS), F.lit(str(records)))
            values = (mart, version, operation, summary, path, fields)
            return F.struct(
                *((v if n == "summary" else F.lit(v)).alias(n) for n, v in zip(MOVED, values))
            )

        moved = [moved_row(*r) for r in rows]
        (
            self.spark.range(1)
            .select(F.inline(F.array(*moved)))
            .select(F.lit(number).alias("commit"), "*", F.current_timestamp().alias("committed_at"))
            .coalesce(1)
            .write.mode("append")
            .json(f"{self.root}/_commits")
        )


COMMIT_COLUMNS = ("commit", "mart", "version", "operation", "records", "path", "fields", "committed_at")
MOVED = ("mart", "version", "operation", "summary", "path", "fields")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
