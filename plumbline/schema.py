"""Schemas and enumerations of documents, rows and state tables."""

from __future__ import annotations

#: Document fields hold canonical Extended JSON text (null where absent), so each value keeps its runtime type.
TEXT_FIELDS = ("_id", "a", "e", "n", "uid", "uid_canon", "did", "lsid", "ts", "cd", "lu", "up", "custom", "cmp", "sg", "c", "s", "dur", "migrated")
DOCUMENT = "collection string, " + ", ".join(f"{f} string" for f in TEXT_FIELDS)
ROW = "_id string, a string, e string, n string, uid string, uid_canon string, did string, lsid string, ts timestamp, up string, custom string, cmp string, sg string, c bigint, s double, dur double, lu timestamp, cd timestamp"
ROW_COLUMNS = tuple(f.split()[0] for f in ROW.split(", "))
CHUNK = "run_id string, collection string, scope_a string, scope_e string, scope_n string, idx int, lower_cd bigint, upper_cd bigint, status string, pod_id string, lease_until bigint, staging_table string, docs_read bigint, docs_skipped bigint, rows_expected bigint, partitions array<string>, attached array<string>, attach_method string, attempts int, last_error string, fence_gen int, updated_at bigint"
DEAD_LETTER = "run_id string, collection string, chunk_id string, source_id string, raw_doc string, reason string, error string, cd_ms bigint, replay_inserted boolean, status string, resolved_by_version string, created_at bigint, updated_at bigint"

CHUNK_STATUSES = ("pending", "in_progress", "written", "attaching", "done", "failed", "superseded")
TERMINAL = ("done", "failed", "superseded")
SKIP_REASONS = ("already_marked_migrated", "missing_a", "missing_e", "missing_uid", "missing__id", "invalid_ts", "transform_error")
#: Bounds of the sentinel chunk that stands for documents without cd.
SENTINEL = (-1, 0)

UINT32_MAX = 4294967295
#: 1900-01-01T00:00:00.000Z and 2299-12-31T23:59:59.999Z in epoch ms.
TIME_MIN, TIME_MAX = -2208988800000, 10413791999999
#: Below: not a time; from here seconds; from MILLIS_FROM milliseconds.
SECONDS_FROM, MILLIS_FROM = 9.5e8, 9.5e11
INTERNAL_PREFIX, CUSTOM_EVENT = "[CLY]_", "[CLY]_custom"
CHECKSUM_MODULUS = 1 << 32
SNAPSHOT_MODULUS = 1 << 26
