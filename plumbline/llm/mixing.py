"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in DataFrame functions only.

A source's target is its weight's share of all words, at most `max_epochs` times its size; what is
above goes to the others by weight (a water level, found over the sources sorted by cap / weight).
A source first takes every document whole epochs often; the rest of the target is a weighted sample
without replacement: each document has the key -ln(u) / quality, smaller keys first, and a prefix sum
of sizes in that order fills the budget. The document at the cut is taken if that is nearer the target.

The prefix sum has three levels, so that no source is sorted in one task: the keys' logarithms are counted in steps of
1 / FIRST_BINS by partial aggregation, those of the step that holds the cut in SECOND_BINS finer ones, and only the
rows of the fine step at the cut are sorted. In log space keys spread over many steps whatever the qualities are: the
densest step of one quality holds 0.6 % of its rows, a fine step some millionths of them.

What comes out is one row for each source (epochs, and the key up to which documents are taken once more), so
each document is decided where it is: no document is joined by its id and no text is shuffled.

Defined cases: null texts and texts without words have size 0 and take 0; a null source is a source of its own,
the last one, and not the empty one; rows that repeat doc_id and text get the same key and are taken together
(at the cut they count as one); an empty table gives no rows; extra columns are ignored. u is a hash of seed,
doc_id and text, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import SPACE, look_up, whole
from plumbline.sources.shared import cut

#: Steps of a key's logarithm: FIRST_BINS for each unit, each of them in SECOND_BINS.
FIRST_BINS, SECOND_BINS = 64, 4096
#: Fixed value: weights by the source's place in code point order, repeating.
WEIGHTS = (1, 2, 3)
KEY = ["_source", "_named"]
NO_ID = -(1 << 63)


def text_quality() -> Column:
    """A weight from 0.05 to 1 that falls with the share of digits and symbols in the text."""
    marks = "0123456789#*$%&|<>{}[]=_\\/^~"
    size = F.length(whole())
    share = (size - F.length(F.translate(whole(), marks, ""))) / F.greatest(size, F.lit(1))
    return F.greatest(F.lit(0.05), 1 - 4 * share)


def word_count() -> Column:
    """Number of words: gaps between words of the trimmed text, plus one."""
    spaced = F.trim(F.regexp_replace(whole(), SPACE, " "))
    return F.when(spaced == "", 0).otherwise(F.length(spaced) - F.length(F.translate(spaced, " ", "")) + 1).cast("long")


def keyed(docs: DataFrame, quality: Column | None = None, seed: int = 42) -> DataFrame:
    """docs with _source and _named (null and empty sources differ), and _spot, their place in the order of their source."""
    unit = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id", whole()), 11) + 0.5) / float(1 << 53)
    place = F.log(-F.log(unit)) - F.log(F.greatest(quality if quality is not None else text_quality(), F.lit(1e-6)))
    own = docs.withColumn("_source", F.coalesce("source", F.lit(""))).withColumn("_named", F.col("source").isNotNull()).withColumn("_place", place)
    first = F.floor(F.col("_place") * FIRST_BINS).cast("int")
    fine = F.floor((F.col("_place") * FIRST_BINS - first) * SECOND_BINS).cast("int")
    return own.withColumn("_spot", F.struct(first.alias("bin"), fine.alias("fine"), F.col("_place").alias("place"), F.coalesce("doc_id", F.lit(NO_ID)).cast("long").alias("doc_id"), F.xxhash64(whole()).alias("text_hash"))).drop("_place")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_epochs: int = 3) -> DataFrame:
    """sizes (source, source_size) with weight and target. One row for each source: a table far smaller than the corpus."""
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    table = sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * float(max_epochs)).withColumn("ratio", F.col("cap") / F.col("weight"))
    order = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before, all_rows = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    full = F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    spent = F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    level = (F.sum("source_size").over(all_rows) - full) / (F.sum("weight").over(all_rows) - spent)
    table = table.withColumn("level", level)
    water = F.first(F.when(F.col("ratio") > F.col("level"), F.col("level")), ignorenulls=True).over(all_rows)
    target = F.least(F.col("cap"), F.coalesce(water, F.lit(0.0)) * F.col("weight"))
    return table.select("source", "source_size", "weight", target.alias("target"))


def _at_cut(counted: DataFrame, marks: DataFrame, step: str) -> DataFrame:
    """The step of each source in which its budget is reached. counted: (source, step, words); marks: (source, before, budget)."""
    upto = Window.partitionBy(*KEY).orderBy(step).rowsBetween(Window.unboundedPreceding, -1)
    filled = counted.withColumn("_upto", F.coalesce(F.sum("words").over(upto), F.lit(0))).join(marks, KEY).withColumn("before", F.col("before") + F.col("_upto"))
    kept = [c for c in marks.columns if c not in ("before", "budget")]
    return cut(filled.filter((F.col("before") < F.col("budget")) & (F.col("budget") <= F.col("before") + F.col("words"))).select(*kept, step, "before", "budget"))


def mix_plan(rows: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_epochs: int = 3) -> DataFrame:
    """rows (_source, _named, _spot, size): for each source source_size, target, epochs and last, the spot up to which documents are taken once more."""
    counted = cut(rows.groupBy(*KEY, F.col("_spot.bin").alias("bin")).agg(F.sum("size").alias("words")))
    sizes = counted.groupBy(*KEY).agg(F.sum("words").alias("source_size"))
    named = source_targets(sizes.select(F.when(F.col("_named"), F.col("_source")).alias("source"), "source_size"), weights, max_epochs)
    whole_epochs = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(max_epochs))).otherwise(0).cast("long")
    targets = named.withColumn("epochs", whole_epochs).withColumn("budget", F.col("target") - F.col("epochs") * F.col("source_size"))
    targets = cut(targets.withColumn("_named", F.col("source").isNotNull()).withColumn("_source", F.coalesce("source", F.lit(""))))

    first = _at_cut(counted, targets.select(*KEY, F.lit(0).cast("long").alias("before"), "budget"), "bin")
    near = look_up(rows.withColumn("bin", F.col("_spot.bin")), first.select(*KEY, "bin"), [*KEY, "bin"], "inner").withColumn("fine", F.col("_spot.fine"))
    fine = _at_cut(near.groupBy(*KEY, "fine").agg(F.sum("size").alias("words")), first, "fine")
    here = look_up(near.drop("bin"), fine, [*KEY, "fine"], "inner")
    # Rows that repeat a document have one spot: they are one step of the prefix sum, however many they are.
    spots = here.groupBy(*KEY, "_spot", "before", "budget").agg(F.sum("size").alias("size"))
    running = Window.partitionBy(*KEY).orderBy("_spot").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    nearer = F.col("end") - F.col("budget") < F.col("budget") - (F.col("end") - F.col("size"))
    last = spots.withColumn("end", F.col("before") + F.sum("size").over(running)).filter(nearer).groupBy(*KEY).agg(F.max("_spot").alias("last"))
    # Where not even the first document of the fine step is taken, those before the step are.
    start = F.struct(F.col("bin"), F.col("fine"), F.lit(float("-inf")).alias("place"), F.lit(NO_ID).alias("doc_id"), F.lit(NO_ID).alias("text_hash"))
    ends = fine.select(*KEY, start.alias("start")).join(last, KEY, "left").select(*KEY, F.coalesce("last", "start").alias("last"))
    return cut(targets.join(ends, KEY, "left").select(*KEY, "source_size", "target", "epochs", "last"))


def _times() -> Column:
    return F.col("epochs") + F.when(F.col("_spot") <= F.col("last"), 1).otherwise(0)


def mix(docs: DataFrame, quality: Column | None = None, weights: tuple[float, ...] = WEIGHTS, max_epochs: int = 3, seed: int = 42) -> DataFrame:
    """One row for each document: doc_id, source, text_hash, size, source_size, target, epochs (times it is taken), taken."""
    rows = cut(keyed(docs, quality, seed).select("doc_id", *KEY, "_spot", word_count().alias("size")))
    out = look_up(rows, mix_plan(rows, weights, max_epochs), KEY)
    return out.select("doc_id", F.when(F.col("_named"), F.col("_source")).alias("source"), "_spot.text_hash", "size", "source_size", "target", _times().alias("epochs"), (F.col("size") * _times()).alias("taken"))


def apply_mix(docs: DataFrame, quality: Column | None = None, weights: tuple[float, ...] = WEIGHTS, max_epochs: int = 3, seed: int = 42) -> DataFrame:
    """docs as the mix takes them, each row as often as its epochs say; columns as they are.

    The texts are read twice, once for their sizes and once to be decided in place by the plan, one row a source.
    """
    columns = [f"`{c}`" for c in docs.columns]
    rows = cut(keyed(docs, quality, seed).select(*KEY, "_spot", word_count().alias("size")))
    own = keyed(docs.withColumn("_all", F.struct(*columns)), quality, seed).select(*KEY, "_spot", "_all")
    taken = look_up(own, mix_plan(rows, weights, max_epochs), KEY).select("_all", _times().cast("int").alias("_times")).filter("_times > 0")
    return taken.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times")))).select("_all.*")
