"""The ledger that persists: versions of a small table, and run documents, each committed by compare-and-set.

A version is a Parquet folder and a manifest that only one writer can create, so a writer that read an older version
fails and tries again on the newer one. Old versions stay: a rollback commits one of them anew. Run documents (bound, lease,
gates, prune journal, estimates) are numbered JSON files under the same rule.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators import grid, ledger
from plumbline.schema import CHUNK
from plumbline.sources.files import Store
from plumbline.sources.live_table import ConflictError
from plumbline.sources.shared import written

KEY = ["run_id", "collection", "idx"]
#: After so long an apply marker no longer counts.
MARKER_MS = 600_000


class LedgerStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.store = spark, root.rstrip("/"), Store(spark, root)

    # Chunks

    def version(self) -> int:
        names = [n for n in self.store.names("versions") if n.endswith(".json")]
        return int(names[-1].split(".")[0]) if names else 0

    def read(self, version: int | None = None) -> DataFrame:
        v = self.version() if version is None else version
        if not v:
            return self.spark.createDataFrame([], CHUNK)
        folder = json.loads(self.store.read(f"versions/{v:012d}.json"))["folder"]
        return self.spark.read.schema(CHUNK).parquet(f"{self.root}/{folder}")

    def commit(self, base: int, chunks: DataFrame) -> int:
        """chunks as the version after base; fails if another writer made that one."""
        folder = f"chunks/{uuid.uuid4().hex}"
        have = set(chunks.columns)
        columns = [f.name for f in self.read(0).schema]
        chunks.select(*[F.col(c) if c in have else F.lit(None).alias(c) for c in columns]).to(self.read(0).schema).coalesce(1).write.parquet(f"{self.root}/{folder}")
        try:
            self.store.create(f"versions/{base + 1:012d}.json", json.dumps({"folder": folder}))
        except Exception as e:
            self.store.delete(folder)
            if "exist" in str(e):
                raise ConflictError(f"ledger version {base + 1} is taken") from e
            raise
        return base + 1

    def change(self, edit: Callable[[DataFrame], DataFrame], tries: int = 5) -> int:
        """Commit edit(chunks), again from the newer version if another writer was first."""
        for k in range(tries):
            base = self.version()
            try:
                return self.commit(base, edit(self.read(base)))
            except ConflictError:
                if k == tries - 1:
                    raise
        raise AssertionError("unreachable")

    def init(self, run_id: str, windows: DataFrame, now: int) -> bool:
        """windows (collection, idx, lower_cd, upper_cd) as pending chunks; nothing happens if the run has chunks. The first writer wins."""
        base = self.version()
        there = self.read(base)
        if not there.filter(F.col("run_id") == run_id).isEmpty():
            return False
        try:
            self.commit(base, there.unionByName(self._pending(run_id, windows, now), allowMissingColumns=True))
        except ConflictError:
            return False
        return True

    def append(self, run_id: str, windows: DataFrame, now: int) -> int:
        """New windows of a run; those whose number is taken are left out, and those beyond the stored bound are pruned."""
        bound = self.bound()

        def edit(chunks: DataFrame) -> DataFrame:
            fresh = self._pending(run_id, windows, now).join(chunks.select(*KEY), KEY, "left_anti")
            if bound is not None:
                fresh = grid.prune(fresh, bound).filter("action <> 'deleted'").withColumn("upper_cd", F.col("new_upper_cd")).drop("action", "new_upper_cd")
            return chunks.unionByName(fresh, allowMissingColumns=True)

        return self.change(edit)

    def replace_run(self, run_id: str, chunks: DataFrame) -> int:
        """All chunks of a run anew; other runs stay."""
        return self.change(lambda old: old.filter(F.col("run_id") != run_id).unionByName(chunks.withColumn("run_id", F.lit(run_id)), allowMissingColumns=True))

    def _pending(self, run_id: str, windows: DataFrame, now: int) -> DataFrame:
        zero = F.lit(0).cast("long")
        return windows.select(F.lit(run_id).alias("run_id"), "collection", F.col("idx").cast("int").alias("idx"), "lower_cd", "upper_cd", F.lit("pending").alias("status"), zero.alias("docs_read"), zero.alias("docs_skipped"), zero.alias("rows_expected"), F.lit(0).alias("attempts"), F.lit(0).alias("fence_gen"), F.lit(now).cast("long").alias("updated_at"))

    def claim(self, run_id: str, pod: str, now: int, lease_ms: int, most: int = 1, sentinels: bool = False) -> DataFrame:
        """Up to `most` chunks claimed in order (collections by name, newest window first); sentinels only of collections without
        open windows. Returned as they are after the claim."""
        taken: list[DataFrame] = []

        def edit(chunks: DataFrame) -> DataFrame:
            own = chunks.filter(F.col("run_id") == run_id)
            if sentinels:
                busy = own.filter(~grid.is_sentinel() & ~F.col("status").isin("done", "superseded")).select("collection").distinct()
                ready = own.filter(grid.is_sentinel() & (F.col("status") == "pending")).join(busy, "collection", "left_anti").orderBy("collection").limit(most)
            else:
                ready = grid.claim_order(own).filter(F.col("place") <= most)
            events = written(ready.select("collection", "idx", F.lit("in_progress").alias("to_status"), F.lit(pod).alias("pod_id"), "attempts", F.lit(now + lease_ms).cast("long").alias("lease_until")))
            taken[:] = [events.select("collection", "idx")]
            return ledger.apply_events(own, events, now).drop("applied").unionByName(chunks.filter(F.col("run_id") != run_id))

        version = self.change(edit)
        return self.read(version).filter(F.col("run_id") == run_id).join(taken[0], ["collection", "idx"], "left_semi")

    def transition(self, run_id: str, events: DataFrame, now: int) -> int:
        """events (collection, idx, to_status, pod_id, attempts, lease_until[, docs_read, docs_skipped, rows_expected, last_error]), fenced."""
        figures = [c for c in ("docs_read", "docs_skipped", "rows_expected", "last_error") if c in events.columns]

        def edit(chunks: DataFrame) -> DataFrame:
            own = ledger.apply_events(chunks.filter(F.col("run_id") == run_id), events, now)
            news = events.select("collection", "idx", *[F.col(c).alias(f"_{c}") for c in figures])
            both = own.join(news, ["collection", "idx"], "left")
            for c in figures:
                both = both.withColumn(c, F.when(F.col("applied"), F.coalesce(f"_{c}", c)).otherwise(F.col(c)))
            return both.drop("applied", *[f"_{c}" for c in figures]).unionByName(chunks.filter(F.col("run_id") != run_id))

        return self.change(edit)

    # Run documents

    def document(self, name: str) -> tuple[int, dict]:
        """The newest version of a document and its number; (0, {}) if there is none."""
        names = [n for n in self.store.names(f"config/{name}") if n.endswith(".json")]
        v = int(names[-1].split(".")[0]) if names else 0
        return v, json.loads(self.store.read(f"config/{name}/{v:012d}.json")) if v else {}

    def put(self, name: str, value: dict, base: int | None = None) -> bool:
        """Write a document if its newest version is base (by default: the one there now). False if another writer was first."""
        base = self.document(name)[0] if base is None else base
        try:
            self.store.create(f"config/{name}/{base + 1:012d}.json", json.dumps(value))
        except Exception as e:
            if "exist" in str(e):
                return False
            raise
        return True

    def bound(self) -> int | None:
        return self.document("bound")[1].get("ms")

    def set_bound_if(self, expected: int | None, ms: int | None) -> bool:
        base, now = self.document("bound")
        return now.get("ms") == expected and self.put("bound", {"ms": ms}, base)

    def first_time(self, name: str, now: int) -> int:
        """The time of the first call for a name (a run's start, its gate): the first writer wins, later ones read it."""
        if not self.document(name)[0]:
            self.put(name, {"at": now}, 0)
        return self.document(name)[1]["at"]

    def lease(self, holder: str, now: int, ms: int) -> bool:
        """Take or renew the maintenance lease; False while another holds it."""
        base, held = self.document("lease")
        if held.get("holder") not in (None, holder) and held.get("until", 0) > now:
            return False
        return self.put("lease", {"holder": holder, "until": now + ms}, base)

    def release(self, holder: str) -> bool:
        base, held = self.document("lease")
        return held.get("holder") == holder and self.put("lease", {"holder": None, "until": 0}, base)

    def mark_apply(self, now: int) -> bool:
        base, mark = self.document("apply")
        return mark.get("at", 0) <= now - MARKER_MS and self.put("apply", {"at": now}, base)

    def clear_apply(self) -> None:
        self.put("apply", {"at": 0})

    def apply_running(self, now: int) -> bool:
        return self.document("apply")[1].get("at", 0) > now - MARKER_MS

    def estimates(self) -> dict[str, int]:
        return self.document("estimates")[1]

    def merge_estimates(self, news: dict[str, int], add: bool = False) -> dict[str, int]:
        """Frozen estimates: what a collection has stays, unless add raises it by the given number."""
        while True:
            base, old = self.document("estimates")
            merged = {c: old.get(c, 0) + n if add else old.get(c, n) for c, n in news.items()}
            if self.put("estimates", old | merged, base):
                return old | merged
