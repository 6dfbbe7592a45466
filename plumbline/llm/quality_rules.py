"""Quality rules: robust multivariate outliers by the minimum covariance determinant, in DataFrame functions only.

Each text gives counts (words, their characters, symbols, repeated lines, words in repeated three-word windows: hashes
find the windows that may be equal, their words decide). Their transformed rates form a vector in fixed point, so that
all sums are exact and reruns agree.
For each language and source, concentration steps from two starts (medians with quartile ranges; plain mean
and covariance) approach the subset of `share` of the vectors whose covariance has the smallest determinant; a document is
rejected if its squared Mahalanobis distance from that estimate is above the cutoff, by default the
99.9 % quantile of the chi-square distribution with as many degrees of freedom as the vector has rates.

A step is one partial aggregation of moments by group and distance bin: the bins up to the quantile give the
next estimate, so a hot group is never gathered in a task. Groups of fewer than `least` documents are pooled by
language, and pools that are still smaller in one pool. Each group and start is stepped until its own determinant stays; the
subset of a step is rounded up to whole distance bins. `floor` is the least spread that counts in each
direction: a group without any symbols doesn't reject a text for one.

Defined cases: null and empty texts have zero counts, fail the base rules and take no part in the estimates; null
language or source is a value like any other; repeated rows count as rows; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import SPACE, bounded, look_up, whole
from plumbline.sources.shared import cut, written

#: Fixed point: a vector's unit is 1 / ONE.
ONE = 256
#: Fixed value: characters that count as symbols.
SYMBOLS = "#*$%&|<>"
DIMS = 4
#: Median of the chi-square distribution with DIMS degrees of freedom, to which distances are scaled.
CHI2_MEDIAN = 3.3567
#: Its 99.9 % quantile: x with exp(-x / 2) * (1 + x / 2) = 0.001.
CHI2_999 = 18.4668
#: Distance bins: equal steps of log(1 + squared distance).
BINS_PER_LOG, MOST_BIN = 64, 1023
#: Least standard deviation that counts for each rate. An angle of a rate over n draws has 1 / (2 * sqrt(n)) by chance alone: for repetition
#: the 50 words of the shortest text that passes, three to a window, give 0.12; for symbols some 250 characters, two or three to a run, 0.05.
FLOOR = (0.05, 0.05, 0.12, 0.12)
X = [f"x{i}" for i in range(DIMS)]
PAIRS = [(i, j) for i in range(DIMS) for j in range(i + 1)]


def _beside(array: str, value: str) -> str:
    """The places of a sorted array whose value is that of a neighbour."""
    own = value.format(f"{array}[j]")
    before, after = value.format(f"{array}[greatest(j - 1, 0)]"), value.format(f"{array}[least(j + 1, size({array}) - 1)]")
    return f"if(size({array}) < 2, cast(array() as array<int>), filter(sequence(0, size({array}) - 1), j -> (j > 0 and {before} = {own}) or (j < size({array}) - 1 and {after} = {own})))"


def text_counts(docs: DataFrame) -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_lines, n_dup_lines and n_repeat_words of the whole text."""
    base = docs.withColumn("_text", whole()).withColumn("_spaced", F.trim(F.regexp_replace("_text", SPACE, " ")))
    base = base.withColumn("_words", F.when(F.col("_spaced") == "", F.array().cast("array<string>")).otherwise(F.split("_spaced", " ")))
    base = base.withColumn("_lines", F.filter(F.split("_text", "\n"), lambda x: F.length(F.regexp_replace(x, SPACE, "")) > 0))
    base = base.withColumn("_bits", F.expr("length(bin(size(_words)))"))
    # A window's hash in the high bits and its place in the low ones: sorting brings windows that may be equal together.
    base = base.withColumn("_packed", F.expr("if(size(_words) < 3, cast(array() as array<bigint>), sort_array(transform(sequence(0, size(_words) - 3), i -> shiftleft(xxhash64(_words[i], _words[i + 1], _words[i + 2]), _bits) | i)))"))
    base = base.withColumn("_found", F.expr(_beside("_packed", "shiftright({}, _bits)")))
    # Those that share their hash bits are compared by their words, which hold no space.
    at = "cast(_packed[j] & (shiftleft(1L, _bits) - 1) as int)"
    base = base.withColumn("_maybe", F.expr(f"sort_array(transform(transform(_found, j -> {at}), i -> struct(concat_ws(' ', _words[i], _words[i + 1], _words[i + 2]) as w, i as i)))"))
    base = base.withColumn("_equal", F.expr(_beside("_maybe", "{}.w")))
    base = base.withColumn("_places", F.expr("sort_array(transform(_equal, j -> _maybe[j].i))"))
    repeated = F.expr("if(size(_places) < 2, 0, 3 + aggregate(sequence(1, size(_places) - 1), 0, (n, j) -> n + least(3, _places[j] - _places[j - 1])))")
    counts = {
        "n_words": F.size("_words"),
        "word_chars": F.length("_spaced") - F.greatest(F.size("_words") - 1, F.lit(0)),
        "n_symbols": F.length("_text") - F.length(F.translate("_text", SYMBOLS, "")),
        "n_lines": F.size("_lines"),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_repeat_words": repeated,
    }
    kept = [c for c in docs.columns if c not in counts]
    return base.select(*[f"`{c}`" for c in kept], *[v.cast("long").alias(k) for k, v in counts.items()])


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _vector() -> list[Column]:
    """log of mean word length, and the angles of three rates, in fixed point."""
    rate = "asin(sqrt(least(1d, {} / greatest({}, 1L))))".format
    values = ["ln((word_chars + 1) / (n_words + 1))", rate("n_symbols", "word_chars"), rate("n_dup_lines", "n_lines"), rate("n_repeat_words", "n_words")]
    return [F.expr(f"cast(round({v} * {ONE}) as long)").alias(x) for x, v in zip(X, values, strict=True)]


def _groups(rows: DataFrame, least: int) -> DataFrame:
    """The group in which each language and source is estimated."""
    size = rows.groupBy("_lang", "_source").count()
    big = F.col("count") >= least
    pool = F.when(big, F.to_json(F.struct(F.lit("both").alias("by"), "_lang", "_source"))).otherwise(F.to_json(F.struct(F.lit("lang").alias("by"), "_lang")))
    pooled = size.withColumn("grp", pool).withColumn("total", F.sum("count").over(Window.partitionBy("grp")))
    return pooled.select("_lang", "_source", F.when(F.col("total") >= least, F.col("grp")).otherwise(F.lit("rest")).alias("grp"))


#: The squared distance of a row (x0..) from its group's estimate (m0.., p00..), in SQL, and the bin of a distance.
DISTANCE = "(" + " + ".join(f"{1 if i == j else 2} * p{i}{j} * (x{i} - m{i}) * (x{j} - m{j})" for i, j in PAIRS) + ")"
BIN = f"cast(least(floor(log1p(greatest({DISTANCE}, 0d)) * {BINS_PER_LOG}), {MOST_BIN}) as int) as bin"
#: The moments of rows, in SQL.
MOMENTS = ["count(*) as n", *[f"sum({x}) as s{i}" for i, x in enumerate(X)], *[f"sum(x{i} * x{j}) as s{i}{j}" for i, j in PAIRS]]
SUMS = [m.rpartition(" ")[2] for m in MOMENTS]


def _expr(statements: list[str]) -> list[Column]:
    return [F.expr(x) for x in statements]


def _dot(terms: list[str]) -> str:
    return " + ".join(terms) or "0d"


def _precision(moments: DataFrame, floor: tuple[float, ...]) -> DataFrame:
    """From n, s0.. and s00.. the mean m, the inverse p of the covariance, and log_det, by Cholesky factors l and their inverse r."""
    t = moments.selectExpr("*", *[f"s{i} / n as m{i}" for i in range(DIMS)])
    for j in range(DIMS):
        left = {i: f"(s{i}{j} / n - m{i} * m{j} + {(floor[i] * ONE) ** 2 if i == j else 0.0!r}d - ({_dot([f'l{i}{k} * l{j}{k}' for k in range(j)])}))" for i in range(j, DIMS)}
        t = t.selectExpr("*", f"sqrt(greatest({left.pop(j)}, 1e-6d)) as l{j}{j}")
        t = t.selectExpr("*", *[f"{x} / l{j}{j} as l{i}{j}" for i, x in left.items()]) if left else t
    for i in range(DIMS):
        t = t.selectExpr("*", *[f"({1.0 if i == j else 0.0}d - ({_dot([f'l{i}{k} * r{k}{j}' for k in range(j, i)])})) / l{i}{i} as r{i}{j}" for j in range(i + 1)])
    inverse = [f"{_dot([f'r{k}{i} * r{k}{j}' for k in range(i, DIMS)])} as p{i}{j}" for i, j in PAIRS]
    log_det = _dot([f"2 * ln(l{i}{i})" for i in range(DIMS)])
    return t.selectExpr("grp", "start", *[f"m{i}" for i in range(DIMS)], *inverse, f"{log_det} as log_det")


def _starts(rows: DataFrame, floor: tuple[float, ...]) -> DataFrame:
    """Estimates to start from: 0 medians and quartile ranges, 1 mean and covariance."""
    values = rows.select("grp", F.explode(F.array(*[F.struct(F.lit(i).alias("dim"), F.col(f"x{i}").alias("x")) for i in range(DIMS)])).alias("v")).groupBy("grp", "v.dim", "v.x").agg(F.count("*").alias("n"))
    order = Window.partitionBy("grp", "dim").orderBy("x")
    ranked = values.withColumn("upto", F.sum("n").over(order)).withColumn("total", F.sum("n").over(Window.partitionBy("grp", "dim")))
    at = lambda q: f"min(if(upto >= {q} * total, x, null))"
    quartiles = ranked.groupBy("grp", "dim").agg(*_expr([f"{at(0.5)} as mid", f"({at(0.75)} - {at(0.25)}) / 1.349d as spread"]))
    pick = lambda i, c: f"max(if(dim = {i}, {c}, null))"
    means = [f"cast({pick(i, 'mid')} as double) as m{i}" for i in range(DIMS)]
    scales = [f"{f'1 / (pow({pick(i, "spread")}, 2) + {(floor[i] * ONE) ** 2!r}d)' if i == j else '0d'} as p{i}{j}" for i, j in PAIRS]
    robust = quartiles.groupBy("grp").agg(*_expr([*means, *scales, "0 as start", "0d as log_det"]))
    robust = robust.select("grp", "start", *[f"m{i}" for i in range(DIMS)], *[f"p{i}{j}" for i, j in PAIRS], "log_det")
    return robust.unionByName(_precision(rows.groupBy("grp").agg(*_expr(MOMENTS)).withColumn("start", F.lit(1)), floor))


def _upto(binned: DataFrame, share: float) -> DataFrame:
    """Bins (grp, start, bin, n, ...) up to the one in which the share of the rows is reached."""
    own = Window.partitionBy("grp", "start")
    before = F.coalesce(F.sum("n").over(own.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return binned.withColumn("before", before).withColumn("total", F.sum("n").over(own)).filter(F.col("before") < share * F.col("total"))


def robust_estimates(rows: DataFrame, share: float, steps: int, floor: tuple[float, ...]) -> DataFrame:
    """rows (grp, x0..): one estimate for each group, with `scale` that brings the median squared distance to its chi-square value.

    A group's start whose determinant stays is at its end: its next step would take the same bins. So it takes part in no more steps,
    and its rows meet no estimate. After `steps` all end.
    """
    now, ended = cut(_starts(rows, floor)), []
    beside = F.broadcast if bounded(now) else lambda t: t.hint("merge")
    for _ in range(steps):
        was = now.select("grp", "start", F.col("log_det").alias("was"))
        binned = rows.join(beside(now), "grp").selectExpr("grp", "start", *X, BIN).groupBy("grp", "start", "bin").agg(*_expr(MOMENTS))
        sums = _upto(binned, share).groupBy("grp", "start").agg(*_expr([f"sum({c}) as {c}" for c in SUMS]))
        moves = F.coalesce(F.abs(F.col("log_det") - F.col("was")) >= 1e-9, F.lit(False))
        stepped = cut(_precision(sums, floor).join(was, ["grp", "start"]).withColumn("moves", moves).drop("was"))
        ended.append(stepped.filter("not moves").drop("moves"))
        now = stepped.filter("moves").drop("moves")
        if now.isEmpty():
            break
    for part in ended:
        now = now.unionByName(part)
    best = cut(now.withColumn("place", F.row_number().over(Window.partitionBy("grp").orderBy("log_det", "start"))).filter("place = 1").drop("place"))
    binned = rows.join(beside(best), "grp").selectExpr("grp", "start", BIN).groupBy("grp", "start", "bin").agg(F.count("*").alias("n"))
    median = _upto(binned, 0.5).groupBy("grp").agg(F.max("bin").alias("bin"))
    # Distances are scaled down to the chi-square median, never up: a group that lies within the floor stays within it.
    scale = F.least(F.lit(1.0), CHI2_MEDIAN / F.expm1((F.col("bin") + 0.5) / BINS_PER_LOG))
    return cut(best.join(median, "grp").withColumn("scale", scale).drop("bin", "log_det", "start"))


def _measured(docs: DataFrame) -> DataFrame:
    """docs with the counts, base_failed, the vector, and lang and source as JSON, in which null is a value."""
    named = lambda c: F.to_json(F.struct(F.col(c).cast("string").alias(c))).alias(f"_{c}")
    counted = text_counts(docs.select("*", named("lang"), named("source")))
    return counted.withColumn("base_failed", base_failed()).select("*", *_vector())


def _estimated(rows: DataFrame, share: float, steps: int, least: int, floor: tuple[float, ...]) -> tuple[DataFrame, DataFrame]:
    """rows (_lang, _source, n_words, x0..), cut: the group of each language and source, and the estimate of each group."""
    groups = cut(_groups(rows.filter("n_words > 0"), least))
    # Written: each step reads the group beside the vector, and no step looks it up again.
    known = written(look_up(rows, groups, ["_lang", "_source"]).filter("n_words > 0").select("grp", *X))
    return groups, robust_estimates(known, share, steps, floor)


def _judged(rows: DataFrame, groups: DataFrame, estimates: DataFrame, cutoff: float) -> DataFrame:
    """rows with distance and kept, each decided where it is."""
    out = look_up(look_up(rows, groups, ["_lang", "_source"]), estimates, ["grp"]).withColumn("distance", F.when(F.col("n_words") > 0, F.expr(f"scale * {DISTANCE}")))
    return out.withColumn("kept", ~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= cutoff))


def judge(docs: DataFrame, cutoff: float = CHI2_999, share: float = 0.75, steps: int = 20, least: int = 50, floor: tuple[float, ...] = FLOOR) -> DataFrame:
    """One row for each document: doc_id, the counts, base_failed, distance (squared; null without words), kept."""
    kinds = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    rows = cut(_measured(docs.select("doc_id", "text", "lang", "source")).select("doc_id", "_lang", "_source", *kinds, *X))
    return _judged(rows, *_estimated(rows, share, steps, least, floor), cutoff).select("doc_id", *kinds, "kept", "distance")


def drop_rejected(docs: DataFrame, cutoff: float = CHI2_999, share: float = 0.75, steps: int = 20, least: int = 50, floor: tuple[float, ...] = FLOOR) -> DataFrame:
    """docs without the rejected ones, columns as they are.

    The documents are written once beside their measures, so each is decided in place by the estimates: none is joined by its id.
    """
    columns = [f"`{c}`" for c in docs.columns]
    beside = docs.select("text", "lang", "source", F.struct(*columns).alias("_all"))
    rows = written(_measured(beside).select("_all", "_lang", "_source", "n_words", "base_failed", *X))
    return _judged(rows, *_estimated(rows.drop("_all"), share, steps, least, floor), cutoff).filter("kept").select("_all.*")
