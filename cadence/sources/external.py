"""Served marts as external tables: another session reads the files that were published, without a copy.

The reading session follows the commits of a mart store. Each mart is a table over the folder its newest commit points at;
:meth:`ExternalMarts.refresh` moves the tables whose mart has moved. Dropping such a table leaves the files alone.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from cadence.sources.staging import shared_folder
from cadence.sources.store import MartStore


class ExternalMarts:
    """The marts under ``root`` in the schema ``database`` of a session that publishes nothing."""

    def __init__(self, session: SparkSession, root: str, database: str):
        self.session, self.database = session, database
        self.store = MartStore(session, root)
        session.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{shared_folder(session)}/cadence-external/{database}'")
        self.refresh()

    def name(self, mart: str) -> str:
        return f"`{self.database}`.`{re.sub('[^a-z0-9_]', '_', mart.lower())}`"

    def refresh(self) -> list[str]:
        """Point every table at what is published now; the marts that had moved, or were new."""
        moved = []
        for r in self.store.heads().orderBy("mart").collect():  # one row per mart
            name = self.name(r["mart"])
            if not self.session.catalog.tableExists(name.replace("`", "")):
                self.session.sql(f"CREATE TABLE {name} ({r['fields']}) USING parquet LOCATION '{r['path']}'")
            elif self._path(name) != r["path"]:
                self.session.sql(f"DROP TABLE {name}")
                self.session.sql(f"CREATE TABLE {name} ({r['fields']}) USING parquet LOCATION '{r['path']}'")
            else:
                continue
            moved.append(r["mart"])
        return moved

    def _path(self, name: str) -> str:
        rows = self.session.sql(f"DESCRIBE EXTENDED {name}").where("col_name = 'Location'")
        return re.sub("^file:/*", "/", rows.first()["data_type"])

    def table(self, mart: str) -> DataFrame:
        return self.session.table(self.name(mart))
