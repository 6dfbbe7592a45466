"""WARC fixity audit by Merkle trees.

Every record is hashed. A record is placed by its file and byte offset: consecutive stretches of a file form ranges, `fanout`
of them a larger one, up to the whole file; files are gathered by the digest of their name, digit by digit, to one
root. A range's digest is that of its children's names and digests in order. Two replicas whose roots are equal hold
the same records. Else only the children of ranges that differ are compared, level by level, down to the records:
a handful of rows for each place of damage.

The lowest ranges are as wide as `fanout` records take on average, so sparse byte offsets add no levels of single
records, and a lost record moves no other one to another range. Each level is a table cut in the shared folder, a small
part of the one below; no task holds more than a range.

Defined cases: a null file is the file "", a null offset the offset -1, in the file's first range; records that share file and
offset are one leaf, hashed as a bag (count, sum, xor, least and greatest digest) by partial aggregation; null url or
body counts as empty; two empty replicas agree; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import look_up
from plumbline.sources.shared import cut

FANOUT = 64
NODE = ["file", "node"]


@dataclass(frozen=True)
class Step:
    """How a level's nodes come together: places of a file by division, or files by the first digits of their name's digest."""

    width: int | None = None
    digits: int | None = None
    named: bool = False

    def parent(self) -> list[Column]:
        if self.width is not None:
            return [F.col("file").alias("pfile"), F.expr(f"node div {self.width}").alias("pnode")]
        name = F.sha1(F.encode("file", "UTF-8")) if self.named else F.col("file")
        return [F.substring(name, 1, self.digits).alias("pfile"), F.lit(0).cast("long").alias("pnode")]


def warc_record(url: Column, body: Column) -> Column:
    """A WARC/1.1 response record's bytes."""
    url, data = F.coalesce(url, F.lit("")), F.encode(F.coalesce(body, F.lit("")), "UTF-8")
    head = F.concat(F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: "), url, F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(data).cast("string"), F.lit("\r\n\r\n"))
    return F.concat(F.encode(head, "UTF-8"), data, F.encode(F.lit("\r\n\r\n"), "UTF-8"))


def leaves(records: DataFrame) -> DataFrame:
    """records (file, offset, record) as leaves: file, node, digest, count, low, high (least and greatest record digest)."""
    part = lambda at: F.conv(F.substring("sha", at, 15), 16, 10).cast("long")
    hashed = records.select(F.coalesce("file", F.lit("")).alias("file"), F.coalesce("offset", F.lit(-1)).cast("long").alias("node"), F.sha2("record", 256).alias("sha"))
    bags = hashed.groupBy(*NODE).agg(F.count("*").alias("count"), F.bit_xor(part(1)).alias("x"), F.sum(part(16).cast("decimal(38,0)")).alias("s"), F.min("sha").alias("low"), F.max("sha").alias("high"))
    return bags.select(*NODE, F.sha2(F.concat_ws(":", "count", "x", "s", "low", "high"), 256).alias("digest"), "count", "low", "high")


def steps(ours: DataFrame, theirs: DataFrame, fanout: int = FANOUT) -> list[Step]:
    """The levels above the leaves of two replicas, from one row of sizes of each."""
    each = ours.select(*NODE).unionByName(theirs.select(*NODE)).groupBy("file").agg(F.count("*").alias("n"), F.max("node").alias("last"))
    n, files, last, reach = each.agg(F.sum("n"), F.count("*"), F.max("last"), F.sum(F.col("last") + 1)).first()
    if not n:
        return []
    width = max(1, fanout * max(1, reach) * 2 // n)
    out = [Step(width=width)]
    at = max(0, last) // width
    while at:
        out.append(Step(width=fanout))
        at //= fanout
    digits = 0
    while 16 ** (digits + 1) * fanout < files * 16:
        digits += 1
    return out + [Step(digits=d, named=d == digits) for d in range(digits, -1, -1)]


def tree(bottom: DataFrame, levels: list[Step]) -> list[DataFrame]:
    """The leaves and, for each step, the level that it makes of the one below."""
    out = [bottom]
    for step in levels:
        own = F.sort_array(F.collect_list(F.struct(*NODE, "digest")))
        children = out[-1].select(*NODE, "digest", *step.parent()).groupBy("pfile", "pnode").agg(own.alias("own"))
        joined = F.concat_ws(",", F.transform("own", lambda c: F.concat_ws("=", F.hex(F.encode(c["file"], "UTF-8")), c["node"].cast("string"), c["digest"])))
        out.append(cut(children.select(F.col("pfile").alias("file"), F.col("pnode").alias("node"), F.sha2(joined, 256).alias("digest"))))
    return out


def audit(primary: DataFrame, replica: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """Damaged records: file, offset, status (corrupt; missing or extra in the replica), primary_sha256, replica_sha256 (the least of a place that holds several)."""
    bottoms = [cut(leaves(r)) for r in (primary, replica)]
    levels = steps(*bottoms, fanout)
    ours, theirs = (tree(b, levels) for b in bottoms)
    suspects = None
    for level in range(len(levels), -1, -1):
        a, b = ours[level], theirs[level]
        if suspects is not None:
            a, b = (look_up(t.select("*", *levels[level].parent()), suspects, ["pfile", "pnode"], "left_semi").drop("pfile", "pnode") for t in (a, b))
        # Levels hold one row for each node, so the full join has no hot key.
        both = a.alias("a").join(b.alias("b"), NODE, "full").filter(~F.col("a.digest").eqNullSafe(F.col("b.digest")))
        if level:
            suspects = cut(both.select(F.col("file").alias("pfile"), F.col("node").alias("pnode")))
    status = F.when(F.col("b.digest").isNull(), "missing").when(F.col("a.digest").isNull(), "extra").otherwise("corrupt")
    return both.select("file", F.col("node").alias("offset"), status.alias("status"), F.col("a.low").alias("primary_sha256"), F.col("b.low").alias("replica_sha256"))
