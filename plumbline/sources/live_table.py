"""The target table: Parquet folders by month, listed by manifests that are committed one after the other.

A manifest names the folders of each month. Attaching staged rows adds folders (no data is copied); a
delete rewrites only the months that it touches and leaves the others' folders in place. Readers see one manifest, so a
commit of many months is atomic, and old manifests are free rollbacks.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.values import month_of
from plumbline.schema import ROW, ROW_COLUMNS
from plumbline.sources.files import Store

TABLE = f"collection string, {ROW}, ts_ms bigint, cd_ms bigint"
COLUMNS = ["collection", *ROW_COLUMNS, "ts_ms", "cd_ms"]


class ConflictError(RuntimeError):
    """Another writer committed first."""


class LiveTable:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.store = spark, root.rstrip("/"), Store(spark, root)

    def version(self) -> int:
        names = [n for n in self.store.names("manifests") if n.endswith(".json")]
        return int(names[-1].split(".")[0]) if names else 0

    def manifest(self, version: int | None = None) -> dict[str, list[str]]:
        v = self.version() if version is None else version
        return json.loads(self.store.read(f"manifests/{v:012d}.json")) if v else {}

    def _commit(self, base: int, months: dict[str, list[str]]) -> int:
        try:
            self.store.create(f"manifests/{base + 1:012d}.json", json.dumps({m: d for m, d in sorted(months.items()) if d}))
        except Exception as e:
            if "exist" in str(e):
                raise ConflictError(f"version {base + 1} is taken") from e
            raise
        return base + 1

    def _read(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], f"{TABLE}, month string")
        parts = [self.spark.read.schema(TABLE).parquet(*[f"{self.root}/{d}" for d in folders[k : k + 1000]]) for k in range(0, len(folders), 1000)]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out.withColumn("month", month_of(F.col("ts")))

    def read(self, version: int | None = None, months: list[str] | None = None) -> DataFrame:
        """Rows of a version, of some months only if asked: other folders aren't opened."""
        found = self.manifest(version)
        return self._read([d for m, folders in found.items() if months is None or m in months for d in folders])

    # Staging

    def stage(self, rows: DataFrame, name: str) -> None:
        """Write rows to a staging folder of their own, sorted for scans by scope; what was there goes."""
        self.drop_staging(name)
        dealt = rows.select(*COLUMNS, month_of(F.col("ts")).alias("month")).sortWithinPartitions("month", "a", "e", "n", "ts")
        dealt.write.partitionBy("month").parquet(f"{self.root}/staging/{name}")

    def staged(self, name: str) -> DataFrame:
        if f"{name}" not in self.store.names("staging") or not self.staged_months(name):
            return self._read([])
        return self._read([f"staging/{name}/month={m}" for m in self.staged_months(name)])

    def staged_months(self, name: str) -> list[str]:
        return [n.split("=")[1] for n in self.store.names(f"staging/{name}") if n.startswith("month=")]

    def drop_staging(self, name: str) -> None:
        self.store.delete(f"staging/{name}")

    def orphans(self, keep: list[str]) -> list[str]:
        """Staging folders that no manifest and no running chunk uses."""
        used = {d.split("/")[1] for folders in self.manifest().values() for d in folders if d.startswith("staging/")}
        return [n for n in self.store.names("staging") if n not in used and n not in keep]

    # Commits

    def attach(self, name: str) -> int:
        """Add the staged folders to their months."""
        base, months = self.version(), self.manifest()
        for m in self.staged_months(name):
            months.setdefault(m, []).append(f"staging/{name}/month={m}")
        return self._commit(base, months)

    def append(self, rows: DataFrame) -> int:
        name = f"direct-{uuid.uuid4().hex}"
        self.stage(rows, name)
        return self.attach(name)

    def rewrite(self, keep, months: list[str], extra: list[str] = ()) -> int:
        """Replace the given months by keep(their rows), and add folders named by extra (month folders of staging)."""
        base, found = self.version(), self.manifest()
        touched = [m for m in months if m in found]
        if touched:
            folder = f"data/{uuid.uuid4().hex}"
            keep(self.read(base, touched)).select(*COLUMNS, "month").sortWithinPartitions("month", "a", "e", "n", "ts").write.partitionBy("month").parquet(f"{self.root}/{folder}")
            there = {n.split("=")[1] for n in self.store.names(folder) if n.startswith("month=")}
            found |= {m: [f"{folder}/month={m}"] if m in there else [] for m in touched}
        for d in extra:
            found.setdefault(d.split("month=")[1], []).append(d)
        return self._commit(base, found)

    def delete_pairs(self, pairs: DataFrame) -> int:
        """Delete rows by (collection, _id, cd_ms). Only months that hold such a row are rewritten."""
        key = ["collection", "_id", "cd_ms"]
        hit = self.read().join(pairs.select(*key), key, "left_semi").select("month").distinct()
        return self.rewrite(lambda rows: rows.join(pairs.select(*key), key, "left_anti"), [r.month for r in hit.collect()])

    def delete_window(self, collection: str, low: int, high: int) -> int:
        gone = (F.col("collection") == collection) & (F.col("cd_ms") >= low) & (F.col("cd_ms") < high)
        months = [r.month for r in self.read().filter(gone).select("month").distinct().collect()]
        return self.rewrite(lambda rows: rows.filter(~gone), months)

    def row_counts(self) -> DataFrame:
        """Rows and folders of each month."""
        folders = self.spark.createDataFrame([(m, len(d)) for m, d in self.manifest().items()], "month string, folders int")
        return folders.join(self.read().groupBy("month").agg(F.count("*").alias("rows")), "month", "left")
