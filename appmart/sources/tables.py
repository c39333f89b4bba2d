"""Table storage: two namespaces (raw and modelled), snapshots of all tables, full-refresh and append sinks.

Tables live either in the session catalog (a database per namespace) or, when a
root folder is given, as Parquet folders under ``root/<namespace>/<table>``, e.g.
a folder in the cluster-shared ``spark.checkpoint.dir``. Either way a written
table cuts the lineage: the next step reads the stored files, not the plan that
produced them.

Every write makes a new version and never touches an old one. What readers see
is a *snapshot*, one version of each table:

* under a root folder, a manifest file ``root/_manifests/m-<number>`` that names
  the versions of all tables. The newest one counts. It appears by one rename,
  so a run's tables switch together or not at all;
* in the catalog, a view per table over its version's table. The views switch
  one after the other, in a few statements without data, after all is written.

A job that dies in between leaves the last snapshot whole. Publishing removes
versions that neither the new snapshot nor the one before names, those of failed
writes among them. One job writes to a store at a time; readers need no care.
"""

from __future__ import annotations

import json
import threading
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from appmart.session import write_once

MANIFESTS = "_manifests"
#: Properties of a catalog view: the version it shows and the one before.
CURRENT, PREVIOUS = "appmart.version", "appmart.previous"

Name = tuple[str, str]


def qualify(name: str, default_db: str) -> Name:
    """``db.table`` stays as given; a bare name goes to ``default_db``."""
    parts = name.split(".")
    if len(parts) == 2:
        return parts[0], parts[1]
    if len(parts) == 1:
        return default_db, name
    raise ValueError(f"table name {name!r} has more than one dot")


class Snapshot:
    """Versions being written; readers of the store see none of them before ``publish``."""

    def __init__(self, store: TableStore):
        self.store = store
        self.versions: dict[Name, list[str]] = {}

    def write(self, df: DataFrame, db: str, table: str) -> int:
        """Write a full new version (A5); the number of rows, counted in the same pass."""
        version, rows = self.store.write_version(df, db, table)
        self.versions[db, table] = [version]
        return rows

    def read(self, db: str, table: str) -> DataFrame:
        """The version written here, else the published one."""
        if (db, table) in self.versions:
            return self.store.read_versions(self.versions[db, table], db, table)
        return self.store.read(db, table)

    def publish(self) -> None:
        """All versions written here become the published ones."""
        self.store.publish(self.versions)
        self.versions = {}

    def abandon(self) -> None:
        """Nothing of this is published; the next publishing removes what it wrote."""
        self.store.forget(self.versions)
        self.versions = {}


class TableStore:
    """Read, replace and append tables by (namespace, name)."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = root.rstrip("/") if root else None
        self._lock = threading.Lock()
        self._writing: set[str] = set()

    def location(self, db: str, table: str) -> str:
        """The table's name, or the folder that holds its versions."""
        return f"{self.root}/{db}/{table}" if self.root else f"{db}.{table}"

    def snapshot(self) -> Snapshot:
        return Snapshot(self)

    # --- reading ----------------------------------------------------------------

    def exists(self, db: str, table: str) -> bool:
        if self.root is None:
            return self.spark.catalog.tableExists(f"{db}.{table}")
        return f"{db}.{table}" in self.manifest()

    def read(self, db: str, table: str) -> DataFrame:
        if self.root is None:
            return self.spark.table(f"{db}.{table}")
        versions = self.manifest().get(f"{db}.{table}")
        if not versions:
            raise FileNotFoundError(f"no published version of {self.location(db, table)}")
        return self.read_versions(versions, db, table)

    def read_versions(self, versions: Sequence[str], db: str, table: str) -> DataFrame:
        if self.root is None:
            return write_once(self.spark.table(f"{db}.{versions[0]}"))
        return write_once(self.spark.read.parquet(*[f"{self.location(db, table)}/{v}" for v in versions]))

    def manifest(self) -> dict[str, list[str]]:
        """Versions of all tables in the newest snapshot (root folder only)."""
        names = self._manifests()
        return self._load(names[-1]) if names else {}

    # --- writing ----------------------------------------------------------------

    def write_full(self, df: DataFrame, db: str, table: str) -> int:
        """Truncate-and-load (A5) of one table, published by itself; the number of rows."""
        snapshot = self.snapshot()
        rows = snapshot.write(df, db, table)
        snapshot.publish()
        return rows

    def append(self, df: DataFrame, db: str, table: str) -> None:
        """Append rows (A7): a further part of the published version; a failed write raises."""
        if not self.exists(db, table):
            self.write_full(df, db, table)
        elif self.root is None:
            df.write.mode("append").format("parquet").saveAsTable(f"{db}.{self._shown(db, table)[0]}")
            self.spark.catalog.refreshTable(f"{db}.{table}")
        else:
            part, _ = self.write_version(df, db, table)
            with self._lock:
                self._switch({(db, table): [*self.manifest()[f"{db}.{table}"], part]})
            self._writing.discard(part)

    def ensure(self, db: str, table: str, schema: T.StructType, keep: bool = False) -> None:
        """Create the table with ``schema``; replace it unless ``keep`` and it exists (A4)."""
        if keep and self.exists(db, table):
            return
        self.write_full(self.spark.createDataFrame([], schema), db, table)

    def write_version(self, df: DataFrame, db: str, table: str) -> tuple[str, int]:
        """Write a version that no snapshot names yet; its name and the number of rows written."""
        seen = Observation()
        counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        version = f"v-{uuid.uuid4().hex}" if self.root else f"{table}__v_{uuid.uuid4().hex[:12]}"
        self._writing.add(version)
        try:
            if self.root is None:
                self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
                counted.write.format("parquet").saveAsTable(f"{db}.{version}")
            else:
                counted.write.parquet(f"{self.location(db, table)}/{version}")
        except BaseException:
            self._writing.discard(version)
            raise
        return version, seen.get["rows"]

    def publish(self, versions: dict[Name, list[str]]) -> None:
        """One switch to ``versions``; tables not named keep theirs."""
        with self._lock:
            if self.root is None:
                for (db, table), (version,) in versions.items():
                    self._show(db, table, version)
            else:
                self._switch(versions)
                self._sweep(set(versions))
            self.forget(versions)

    def forget(self, versions: dict[Name, list[str]]) -> None:
        """These versions are no longer being written."""
        self._writing -= {v for own in versions.values() for v in own}

    # --- manifests (root folder) --------------------------------------------------

    def _fs(self, path: str):
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()), place

    def _entries(self, path: str) -> list[str]:
        fs, folder = self._fs(path)
        return sorted(e.getPath().getName() for e in fs.listStatus(folder)) if fs.exists(folder) else []

    def _manifests(self) -> list[str]:
        return [n for n in self._entries(f"{self.root}/{MANIFESTS}") if n.startswith("m-")]

    def _load(self, name: str) -> dict[str, list[str]]:
        fs, path = self._fs(f"{self.root}/{MANIFESTS}/{name}")
        stream = fs.open(path)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _switch(self, versions: dict[Name, list[str]]) -> None:
        names = self._manifests()
        tables = {**(self._load(names[-1]) if names else {}),
                  **{f"{db}.{table}": list(own) for (db, table), own in versions.items()}}
        number = int(names[-1].split("-")[1]) + 1 if names else 1
        fs, draft = self._fs(f"{self.root}/{MANIFESTS}/draft-{uuid.uuid4().hex}")
        out = fs.create(draft, False)
        out.write(bytearray(json.dumps(tables, sort_keys=True), "utf-8"))
        out.close()
        _, final = self._fs(f"{self.root}/{MANIFESTS}/m-{number:08d}")
        if fs.exists(final) or not fs.rename(draft, final):
            raise RuntimeError(f"another job published {final.getName()}; its tables stand")

    def _sweep(self, tables: set[Name]) -> None:
        """Remove what neither this snapshot nor the one before names, of the tables just published."""
        names = self._manifests()
        kept = [self._load(n) for n in names[-2:]]
        for db, table in tables:
            used = {v for m in kept for v in m.get(f"{db}.{table}", [])} | self._writing
            for version in self._entries(self.location(db, table)):
                if version.startswith("v-") and version not in used:
                    fs, path = self._fs(f"{self.location(db, table)}/{version}")
                    fs.delete(path, True)
        for name in names[:-2]:
            fs, path = self._fs(f"{self.root}/{MANIFESTS}/{name}")
            fs.delete(path, False)

    # --- views (catalog) ------------------------------------------------------------

    def _shown(self, db: str, table: str) -> tuple[str | None, str | None]:
        """The version a view shows and the one before."""
        if not self.spark.catalog.tableExists(f"{db}.{table}"):
            return None, None
        found = {r["key"]: r["value"] for r in self.spark.sql(f"SHOW TBLPROPERTIES {db}.{table}").collect()}
        return found.get(CURRENT), found.get(PREVIOUS) or None

    def _show(self, db: str, table: str, version: str) -> None:
        current, previous = self._shown(db, table)
        if current is None:  # a plain table of that name gives way
            self.spark.sql(f"DROP TABLE IF EXISTS {db}.{table}")
        self.spark.sql(f"CREATE OR REPLACE VIEW {db}.{table} TBLPROPERTIES ('{CURRENT}' = '{version}', "
                       f"'{PREVIOUS}' = '{current or ''}') AS SELECT * FROM {db}.{version}")
        for row in self.spark.sql(f"SHOW TABLES IN {db} LIKE '{table}__v_*'").collect():
            if row["tableName"] not in {version, current, *self._writing}:
                self.spark.sql(f"DROP TABLE IF EXISTS {db}.{row['tableName']}")
