"""One interpreted verdict over all audits."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class Facts:
    """What the audits found, as numbers; None for what was not asked."""

    chunks: int = 0
    done: int = 0
    failed: int = 0
    superseded: int = 0
    pending_letters: int = 0
    waived_letters: int = 0
    verify_mismatches: int = 0
    copied_duplicates: int = 0
    deep: bool = True
    scoped_pending: int = 0
    unscoped_windows: int = 0
    accept_unscoped: bool = False
    mismatches: int = 0
    checksum_mismatches: int = 0
    ids_missing: int = 0
    drift_windows: int = 0
    drift_missing: int = 0
    unaudited: list[str] = field(default_factory=list)
    content_sampled: int = 0
    content_missing: int = 0
    content_different: int = 0
    source_moved: list[str] = field(default_factory=list)
    ledger_moved: bool = False
    target_moved: bool = False
    lease_lost: bool = False
    cutover: int | None = None
    excluded: int = 0


@dataclass(frozen=True)
class Verdict:
    verdict: str
    problems: list[str]
    notes: list[str]
    passes: list[str]


def judge(f: Facts) -> Verdict:
    """FAIL with any problem, PASS_WITH_NOTES with any note, else PASS. A quick check always has a note."""
    open_ = f.chunks - f.done - f.superseded - f.failed
    problems = [
        (f.failed, f"{f.failed} chunks failed"),
        (open_, f"{open_} chunks are not done"),
        (f.chunks == 0, "the ledger is empty"),
        (f.pending_letters, f"{f.pending_letters} dead letters are pending"),
        (f.verify_mismatches, f"{f.verify_mismatches} windows hold other counts than the ledger recorded"),
        (f.copied_duplicates, f"{f.copied_duplicates} documents were copied more than once"),
        (f.deep and f.scoped_pending, f"{f.scoped_pending} windows of the source are absent from the target"),
        (f.deep and f.unscoped_windows and not f.accept_unscoped, f"{f.unscoped_windows} windows can't be recounted and weren't accepted"),
        (f.deep and f.mismatches, f"{f.mismatches} windows hold less than the source"),
        (f.deep and f.ids_missing, f"{f.ids_missing} windows lack sampled identities"),
        (f.deep and f.checksum_mismatches, f"{f.checksum_mismatches} windows hold the right number of other documents"),
        (f.deep and f.drift_missing, f"{f.drift_missing} windows with surplus rows lack current documents"),
        (f.deep and f.unaudited, f"collections with done chunks are gone from the source: {', '.join(f.unaudited)}"),
        (f.content_missing or f.content_different, f"of {f.content_sampled} sampled documents {f.content_missing} are missing and {f.content_different} differ"),
        (f.deep and f.source_moved, f"the source changed during the check: {', '.join(f.source_moved)}"),
        (f.ledger_moved, "the ledger changed during the check"),
        (f.target_moved, "the target changed during the check"),
        (f.lease_lost, "the maintenance lease was lost during the check"),
    ]
    notes = [
        (f.waived_letters, f"{f.waived_letters} dead letters were waived"),
        (not f.deep, "quick check: windows weren't recounted against the source"),
        (f.deep and f.unscoped_windows and f.accept_unscoped, f"{f.unscoped_windows} windows were accepted without a recount"),
        (f.deep and f.drift_windows and not f.drift_missing, f"{f.drift_windows} windows hold more than the source, whose current documents are all there"),
        (f.deep and f.cutover is not None, f"documents from the cutover on were left out ({f.excluded})"),
    ]
    passes = [
        (f.chunks and not f.failed and not open_, f"all {f.done} chunks are done"),
        (not f.pending_letters and not f.waived_letters, "no dead letters"),
        (not f.verify_mismatches and not f.copied_duplicates, "the target holds what the ledger recorded"),
        (f.deep and not (f.mismatches or f.checksum_mismatches or f.scoped_pending or f.ids_missing), "every window's count, checksum and sampled identities agree"),
        (f.content_sampled and not f.content_missing and not f.content_different, f"{f.content_sampled} sampled documents agree field by field"),
    ]
    found, noted, good = ([text for hit, text in part if hit] for part in (problems, notes, passes))
    return Verdict("FAIL" if found else "PASS_WITH_NOTES" if noted else "PASS", found, noted, good)


def audit_facts(windows: DataFrame, sentinels: DataFrame, coverage: DataFrame) -> dict:
    """Facts of a source audit from its three results, each reduced to one row."""
    w = windows.agg(
        F.count_if((F.col("status") == "pending") & F.col("scoped")).alias("scoped_pending"),
        F.count_if(~F.col("scoped")).alias("unscoped_windows"),
        F.count_if(F.col("finding") == "mismatch").alias("mismatches"),
        F.count_if(F.col("finding") == "checksum mismatch").alias("checksum_mismatches"),
        F.count_if(F.col("finding") == "deletion drift").alias("drift_windows"),
    ).first()
    s = sentinels.agg(F.count_if(F.col("status") == "failed").alias("failed"), F.count_if(F.col("status") == "pending").alias("pending")).first()
    drift = windows.filter("finding = 'deletion drift'").select("collection", "idx", F.lit(True).alias("drift"))
    c = coverage.filter("missing > 0").join(drift, ["collection", "idx"], "left").agg(F.count_if(F.col("drift").isNull()).alias("clean"), F.count("drift").alias("drift")).first()
    return {**w.asDict(), "scoped_pending": w.scoped_pending + s.pending, "mismatches": w.mismatches + s.failed, "ids_missing": c.clean, "drift_missing": c.drift}


def render(v: Verdict) -> str:
    mark = lambda title, lines: [title, *[f"  - {x}" for x in lines]] if lines else []
    return "\n".join([f"verdict: {v.verdict}", *mark("problems", v.problems), *mark("notes", v.notes), *mark("passed", v.passes)])
