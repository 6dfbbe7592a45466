"""Verified loading: a chunk's documents are staged, counted, and attached month by month without double rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.operators.normalize import insertable, normalize
from plumbline.schema import ROW_COLUMNS
from plumbline.sources.live_table import LiveTable
from plumbline.sources.shared import written

KEY = ["collection", "_id", "cd_ms"]


@dataclass(frozen=True)
class Tally:
    read: int
    skipped: int
    rejected: int
    staged: int
    attached: tuple[str, ...]
    method: str

    @property
    def expected(self) -> int:
        return self.read - self.skipped - self.rejected


class CountMismatch(RuntimeError):
    """Staged rows don't equal what the documents should give."""


def staging_name(run_id: str, collection: str, idx: int, generation: int) -> str:
    return f"{run_id}-{collection}-{idx}-{generation}"


def split_rows(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows to insert, and dead letters (collection, source_id, reason, error, ts_ms, cd_ms).

    A predicate on each row finds what the table would refuse in one pass; halving refused batches
    down to single documents finds the same, since refusal is by row. Documents that are marked already are no dead letters.
    """
    # Written first: a filter on what was found wrong would be pushed into the normalisation, which is far larger than its result.
    return _split(written(insertable(normalize(docs))))


def _split(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    good = checked.filter("skip_reason is null and size(problems) = 0").select("collection", *ROW_COLUMNS, "ts_ms", "cd_ms")
    reason = F.when(F.col("skip_reason") == "transform_error", "transform_error").when(F.col("skip_reason").isNotNull(), "skipped").otherwise("insert_rejected")
    error = F.when(F.col("skip_reason").isNotNull(), F.concat(F.lit("skip:"), "skip_reason")).otherwise(F.concat(F.lit("refused:"), F.array_join("problems", ",")))
    bad = checked.filter("(skip_reason is not null and skip_reason <> 'already_marked_migrated') or size(problems) > 0").select("collection", "source_id", reason.alias("reason"), error.alias("error"), "ts_ms", "cd_ms")
    return good, bad


def promote(table: LiveTable, name: str) -> tuple[tuple[str, ...], str]:
    """Attach a staging folder so that each of its (collection, _id, cd_ms) is live once as staged.

    A month whose staged pairs are all live as often as staged is recorded; one with none is attached; any
    other one is healed: its pairs are deleted and the folder attached, in the same commit.
    """
    staged = table.staged(name)
    months = table.staged_months(name)
    if not months:
        return (), "empty"
    live = table.read(months=months)
    counts = lambda df, n: df.groupBy("month").agg(F.count("*").alias(n))
    both = counts(staged, "staged").join(counts(live.join(staged.select(*KEY).distinct(), KEY, "left_semi"), "live"), "month", "left").fillna(0).collect()
    heal = [r.month for r in both if r.live not in (0, r.staged)]
    fresh = [r.month for r in both if r.live == 0]
    if heal or fresh:
        gone = staged.select(*KEY).distinct()
        table.rewrite(lambda rows: rows.join(gone, KEY, "left_anti"), heal, [f"staging/{name}/month={m}" for m in [*fresh, *heal]])
    return tuple(sorted(r.month for r in both)), "heal" if heal else "attach" if fresh else "recorded"


def load_chunk(table: LiveTable, docs: DataFrame, name: str) -> tuple[Tally, DataFrame]:
    """Load a chunk's documents under a staging name of its own; returns the tally and the dead letters.

    The documents are normalised once, to a table; rows, letters and counts are read from it.
    """
    checked = written(insertable(normalize(docs)))
    good, bad = _split(checked)
    seen = checked.agg(F.count("*").alias("read"), F.count("skip_reason").alias("skipped"), F.count_if(F.col("skip_reason").isNull() & (F.size("problems") > 0)).alias("rejected")).first()
    table.stage(good, name)
    staged = table.staged(name).count()
    if staged != seen.read - seen.skipped - seen.rejected:
        table.drop_staging(name)
        raise CountMismatch(f"{name}: {staged} rows staged, {seen.read - seen.skipped - seen.rejected} expected")
    months, method = promote(table, name)
    return Tally(seen.read, seen.skipped, seen.rejected, staged, months, method), bad


def dry_run(docs: DataFrame, grid: DataFrame, percent: int) -> DataFrame:
    """Per sampled chunk (every k-th): documents read, skipped and refused; nothing is written."""
    from plumbline.operators.grid import place_points

    step = max(1, -(-100 // percent))
    checked = insertable(normalize(docs)).select("collection", "cd_ms", "skip_reason", F.size("problems").alias("problems"))
    placed = place_points(checked.filter("cd_ms is not null"), grid.filter(F.col("idx") % step == 0))
    return placed.groupBy("collection", "idx").agg(F.count("*").alias("read"), F.count("skip_reason").alias("skipped"), F.count_if(F.col("skip_reason").isNull() & (F.col("problems") > 0)).alias("refused"))
