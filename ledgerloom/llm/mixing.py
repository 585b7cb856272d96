"""Mixing sources to target weights by entropy balancing.

Every document starts at rate 1. The rates that meet each source's token constraint and stay closest to 1 in relative
entropy are exp(tilt x size), held to [0, 3]; the tilts solve a convex dual by Newton's method. Sources are disjoint, so
the Hessian is diagonal; each iteration joins the written table of sources, one row each, with the sums of a table of (source,
size, count). The rates are then rounded to whole copies. Only sums over all sources reach the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import Scratch, WORD, fresh, read_table, settled, text_or_empty

#: No document, and so no source, is taken more often than this.
MOST = 3
#: Weights of the sources in their order, repeating.
WEIGHTS = (1, 2, 3)
#: Newton steps; a source that has not stopped by then, within TOLERANCE of its target, is finished by bisection of its bracket.
STEPS = 60
TOLERANCE = 1e-7
#: Passes that make up what rounding left, of either kind; they end once no source comes closer.
PASSES = 12
#: Rows of one source and size that are ranked together, so many on average.
RANKED = 2000


def _rate(tilt: Column, x: Column, most: int) -> Column:
    """Rate of a document of scaled size x; without words the rate has no effect and stays 1."""
    return F.when(x == 0, F.lit(1.0)).otherwise(F.least(F.exp(F.least(tilt * x, F.lit(50.0))), F.lit(float(most))))


def targets(sources: DataFrame, scratch: Scratch, most: int = MOST, weights: tuple = WEIGHTS) -> DataFrame:
    """sources (source_key, source_size, ...) with a column target, a double.

    Sources by code point, null ("n") last, weigh 1, 2, 3 and so on in turn, and share all words; a target stops at `most` times
    its source's size and the rest is shared again by weight until none is above. No sources give none.
    """
    order = W.orderBy(F.col("source_key") == "n", "source_key")  # one row a source
    weight = F.element_at(F.array(*(F.lit(w) for w in weights)), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    table = scratch.write(sources.withColumn("weight", weight).withColumn("target", F.lit(None).cast("double")))
    left = float(table.agg(F.sum("source_size")).first()[0] or 0)
    while True:
        open_ = table.where("target is null")
        total = open_.agg(F.sum("weight")).first()[0]
        if not total:
            return table.drop("weight")
        share = F.lit(left) * F.col("weight") / F.lit(float(total))
        limit = F.lit(float(most)) * F.col("source_size")
        closed = open_.where(share > limit).agg(F.sum(limit)).first()[0]
        now = share if closed is None else F.when(share > limit, limit)
        following = scratch.write(table.withColumn("target", F.coalesce("target", now)))
        scratch.drop(table)
        table, left = following, left - (closed or 0.0)


def _solve(histogram: DataFrame, sources: DataFrame, scratch: Scratch, most: int = MOST) -> DataFrame:
    """(source_key, source_size, target, tilt, unit): the dual's solution.

    histogram: (source_key, size, n); sources: (source_key, source_size, target). Sizes are measured in their source's mean size
    per word, unit, so that tilts are near 1 at any scale. At the limit a source has one feasible solution, an infinite tilt.
    """
    moments = histogram.groupBy("source_key").agg(F.sum(F.col("n") * F.pow("size", F.lit(2.0))).alias("square"))
    unit = F.col("square") / F.greatest("source_size", F.lit(1))
    full = (F.col("source_size") > 0) & (F.col("target") >= F.lit(most * (1 - TOLERANCE)) * F.col("source_size"))
    state = sources.join(moments, "source_key").select(
        "source_key", "source_size", "target", F.when(full, F.lit(math.inf)).otherwise(0.0).alias("tilt"), F.when(unit > 0, unit).otherwise(1.0).alias("unit"),
        F.lit(-math.inf).alias("low"), F.lit(math.inf).alias("high"), (~full & (F.col("source_size") > 0)).alias("open"),
    )
    state = scratch.write(state)
    step = 0
    while not state.where("open").isEmpty():
        x = F.col("size") / F.col("unit")
        rate = _rate(F.col("tilt"), x, most)
        sums = histogram.join(state.where("open"), "source_key").groupBy("source_key").agg(
            F.sum(F.col("n") * F.col("size") * rate).alias("words"),
            F.sum(F.when(rate < most, F.col("n") * F.col("size") * x * rate).otherwise(0.0)).alias("slope"),
        )
        gap, tilt = F.col("target") - F.col("words"), F.col("tilt")
        done = F.abs(gap) <= F.lit(TOLERANCE) * F.greatest("target", F.lit(1.0))
        # The gradient's sign brackets the tilt; a Newton step that leaves the bracket is replaced by its middle.
        low, high = F.when(gap > 0, tilt).otherwise(F.col("low")), F.when(gap > 0, F.col("high")).otherwise(tilt)
        newton = tilt + F.when(F.col("slope") > 0, F.try_divide(gap, F.col("slope"))).otherwise(F.signum(gap))
        both = (F.col("low") > -math.inf) & (F.col("high") < math.inf)
        middle = F.when(both, (F.col("low") + F.col("high")) / 2).otherwise(tilt + F.signum(gap) * (1.0 + F.abs(tilt)))
        going = F.col("open") & ~done
        at = state.join(sums, "source_key", "left").withColumn("going", F.coalesce(going, F.lit(False)))
        at = at.withColumn("low", F.when(F.col("going"), low).otherwise(F.col("low"))).withColumn("high", F.when(F.col("going"), high).otherwise(F.col("high")))
        inside = (F.col("low") < newton) & (newton < F.col("high")) & F.lit(step < STEPS)
        at = at.withColumn("next", F.when(F.col("going"), F.when(inside, newton).otherwise(middle)).otherwise(tilt))
        following = scratch.write(at.select("source_key", "source_size", "target", F.col("next").alias("tilt"), "unit", "low", "high", (F.col("going") & (F.col("next") != tilt)).alias("open")))
        scratch.drop(state)
        state, step = following, step + 1
    return state.drop("low", "high", "open")


def _round(histogram: DataFrame, scratch: Scratch, most: int, pairs: bool = True) -> DataFrame:
    """Adds copies, the whole number that the n documents of a (source, size) get together.

    Rates are accumulated from the longest size down and rounded, so that errors of neighbouring sizes cancel. What a source
    still lacks, or has too much, is made up at the one size that fits it best, again and again; where no one size helps, at
    the two sizes, each with a copy more or less, that come nearest to it; without `pairs` it stays there. It ends when neither helps
    any source, or after PASSES.
    """
    wanted = F.col("n") * _rate(F.col("tilt"), F.col("size") / F.col("unit"), most)
    down = W.partitionBy("source_key").orderBy(F.desc("size"))
    h = histogram.withColumn("sum", F.floor(F.sum(wanted).over(down) + 0.5))
    h = h.withColumn("copies", F.col("sum") - F.coalesce(F.lag("sum").over(down), F.lit(0)))
    h = scratch.write(h.withColumn("copies", F.least(F.greatest("copies", F.lit(0)), F.col("n") * most).cast("long")).drop("sum"))
    off, kinds = _off(h), [_one_size, _two_sizes] if pairs else [_one_size]
    for _ in range(PASSES):
        if not off or not kinds:
            break
        moves = kinds[0](h, most).select(F.col("source_key").alias("of"), F.explode("moves").alias("move"))
        moves = moves.groupBy("of", F.col("move.at").alias("at")).agg(F.sum("move.more").alias("more"))
        following = h.join(moves, (F.col("source_key") == F.col("of")) & (F.col("size") == F.col("at")), "left")
        following = scratch.write(following.withColumn("copies", F.col("copies") + F.coalesce("more", F.lit(0))).drop("of", "at", "more"))
        scratch.drop(h)
        h, before, off = following, off, _off(following)
        if not off < before:
            kinds = kinds[1:]
        elif kinds[0] is _two_sizes:
            kinds = [_one_size, _two_sizes]
    return h


def _off(h: DataFrame) -> float:
    """By how many words all sources together miss their targets."""
    return h.groupBy("source_key").agg(F.abs(F.first("target") - F.sum(F.col("copies") * F.col("size"))).alias("off")).agg(F.sum("off")).first()[0] or 0.0


def _lacking(h: DataFrame) -> DataFrame:
    lacks = h.groupBy("source_key").agg((F.first("target") - F.sum(F.col("copies") * F.col("size"))).alias("lack"))
    return h.where("size > 0").select("source_key", "size", "n", "copies").join(lacks.where("lack <> 0"), "source_key")


def _one_size(h: DataFrame, most: int) -> DataFrame:
    """(source_key, moves): for each source that comes closer by it, copies more or less of the one size that brings it closest."""
    fit = _lacking(h)
    more = F.least(F.greatest(F.round(F.col("lack") / F.col("size")), -F.col("copies")), F.col("n") * most - F.col("copies")).cast("long")
    off = F.struct(F.abs(F.col("lack") - more * F.col("size")).alias("off"), F.col("size").alias("at"), more.alias("more"))
    best = fit.where(more != 0).groupBy("source_key").agg(F.min(off).alias("best"), F.first(F.abs("lack")).alias("was")).where("best.off < was")
    return best.select("source_key", F.array(F.struct("best.at", "best.more")).alias("moves"))


def _two_sizes(h: DataFrame, most: int) -> DataFrame:
    """(source_key, moves): for each source that comes closer by it, one copy more or less of each of two sizes that bring it closest.

    With a copy more or less of the one size, the other one's wanted size is known; wanted sizes and the source's own meet in one line, where each
    looks for its neighbours. A source has no more rows there than a few for each of its sizes.
    """
    fit = _lacking(h)
    can = {1: F.col("copies") < F.col("n") * most, -1: F.col("copies") > 0}
    have = fit.select("source_key", "lack", F.col("size").cast("double").alias("value"), *(F.when(c, F.col("size")).alias(f"have{k}") for k, c in can.items()))
    pairs = [(a, b) for a in (1, -1) for b in (1, -1)]
    ask = F.array_compact(F.array(*(F.when(can[a], F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), ((F.col("lack") - a * F.col("size")) * b).alias("value"))) for a, b in pairs)))
    asked = fit.select("source_key", "lack", F.col("size").alias("at"), F.explode(ask).alias("ask")).select("source_key", "lack", "at", "ask.*")
    line = have.unionByName(asked, allowMissingColumns=True)
    by = W.partitionBy("source_key").orderBy("value", F.col("at").isNotNull())
    near = {}
    for k in can:
        near[f"low{k}"] = F.last(f"have{k}", ignorenulls=True).over(by.rowsBetween(W.unboundedPreceding, 0))
        near[f"high{k}"] = F.first(f"have{k}", ignorenulls=True).over(by.rowsBetween(0, W.unboundedFollowing))
    found = line.withColumns(near).where("at is not null")
    others = F.array(*(F.when(F.col("b") == k, F.col(f"{side}{k}")) for k in can for side in ("low", "high")))
    found = found.withColumn("other", F.explode(F.array_compact(others))).where("other <> at")
    off = F.struct(F.abs(F.col("lack") - F.col("a") * F.col("at") - F.col("b") * F.col("other")).alias("off"), "at", "other", "a", "b")
    best = found.groupBy("source_key").agg(F.min(off).alias("best"), F.first(F.abs("lack")).alias("was")).where("best.off < was")
    move = lambda at, more: F.struct(F.col(f"best.{at}").alias("at"), F.col(f"best.{more}").cast("long").alias("more"))
    return best.select("source_key", F.array(move("at", "a"), move("other", "b")).alias("moves"))


def _copies(rows: DataFrame, plan: DataFrame, widest: int, key: str, size: str, order: list[str], out: str) -> DataFrame:
    """rows with the column `out`: how many copies each row gets. plan: (source_key, size, n, copies).

    The copies of a (source, size) are dealt evenly over its rows; the odd ones go by rank within salted parts, so that no
    part is large. Rows that agree in all of `order` are ranked as they come, and each has a rank of its own.
    """
    salt, rank = fresh(rows, "salt", "rank")
    salts = max(1, math.ceil(widest / max(RANKED, math.sqrt(widest))))
    rows = rows.withColumn(salt, F.pmod(F.shiftright(order[0], 8), F.lit(salts)))
    parts = rows.groupBy(F.col(key).alias("source_key"), F.col(size).alias("size"), F.col(salt).alias("salt")).agg(F.count("*").alias("part"))
    up = W.partitionBy("source_key", "size").orderBy("salt")
    parts = parts.withColumn("until", F.sum("part").over(up)).join(plan.select("source_key", "size", "n", "copies"), ["source_key", "size"])
    share = lambda until: F.floor(F.col("copies") % F.col("n") * until / F.col("n"))
    names = fresh(rows, "to_source", "to_size", "to_salt", "base", "odd")
    parts = parts.select("source_key", "size", "salt", F.expr("copies div n"), share(F.col("until")) - share(F.col("until") - F.col("part"))).toDF(*names)
    rows = rows.withColumn(rank, F.row_number().over(W.partitionBy(key, size, salt).orderBy(*order)))
    a, b, c, base, odd = names
    found = rows.join(parts, (F.col(key) == F.col(a)) & (F.col(size) == F.col(b)) & (F.col(salt) == F.col(c)))
    return found.withColumn(out, (F.col(base) + (F.col(rank) <= F.col(odd)).cast("long")).cast("long")).drop(salt, rank, *names)


def _keyed(docs: DataFrame, text_col: str, source_col: str, key: str, size: str) -> DataFrame:
    text = text_or_empty(F.col(f"`{text_col}`"))
    named = F.coalesce(F.concat(F.lit("s"), F.col(f"`{source_col}`").cast("string")), F.lit("n"))
    return docs.select("*", named.alias(key), F.regexp_count(text, F.lit(WORD)).cast("long").alias(size))


def _plan(sized: DataFrame, scratch: Scratch, most: int, pairs: bool = True) -> tuple[DataFrame, int]:
    """(source_key, size, n, source_size, target, copies) from rows (source_key, size), and the most rows of one such pair."""
    histogram = scratch.write(sized.groupBy("source_key", "size").agg(F.count("*").alias("n")))
    widest = histogram.agg(F.max("n")).first()[0] or 0
    sources = histogram.groupBy("source_key").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"))
    solved = _solve(histogram, targets(sources, scratch, most), scratch, most)
    return _round(histogram.join(solved, "source_key"), scratch, most, pairs), widest


def mix(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", most: int = MOST, pairs: bool = True) -> DataFrame:
    """Per row of docs: doc_id, source, size, source_size, target, copies, taken (copies x size).

    Size is the number of words; a null text has none, and such rows get one copy of nothing. A null source is a source.
    Sources of equal weight and documents of equal size tie by the hash of the id, so that reruns agree; rows that agree
    in id, source and size are alike and may differ by one copy. Other columns are not read. An empty table gives an empty one.
    With `pairs` the last words are made up at two sizes at once; otherwise a source may miss its target by half its smallest size.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), F.col(text_col).alias("text"))
    rows = scratch.write(_keyed(rows, "text", "source", "source_key", "size").drop("text").withColumn("order", F.xxhash64("doc_id")))
    plan, widest = _plan(rows.select("source_key", "size"), scratch, most, pairs)
    out = _copies(rows, plan, widest, "source_key", "size", ["order", "doc_id"], "copies")
    sources = plan.groupBy("source_key").agg(F.first("source_size").alias("source_size"), F.first("target").alias("target"))
    out = out.join(sources, "source_key").select("doc_id", "source", "size", "source_size", "target", "copies")
    return out.withColumn("taken", F.col("copies") * F.col("size"))


def repeat_documents(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", most: int = MOST, pairs: bool = False) -> DataFrame:
    """docs with each row repeated as often as the mix takes it; rows without a copy go. Columns stay as they are.

    Every row counts for itself, also where rows repeat: those that agree in id, source and text are ranked one after the other, so
    that together they get the copies that the mix has for them. Null and empty texts have no words and stay once; a null id or
    source is a value like any other. An empty table gives an empty one. `pairs` is as in mix; whole documents go on here, so that half
    the smallest size is near enough unless it is asked for.
    """
    key, size, order, content, copies, copy = fresh(docs, "source_key", "size", "order", "content", "copies", "copy")
    keyed = _keyed(docs, text_col, source_col, key, size)
    sized = scratch.write(keyed.select(F.col(key).alias("source_key"), F.col(size).alias("size")))
    plan, widest = _plan(sized, scratch, most, pairs)
    doc = F.col(f"`{id_col}`")
    keyed = keyed.withColumn(order, F.xxhash64(doc)).withColumn(content, F.xxhash64(F.col(f"`{text_col}`")))
    out = _copies(keyed, plan, widest, key, size, [order, f"`{id_col}`", content], copies).where(F.col(copies) > 0)
    out = out.withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies))))
    return out.select(*(F.col(f"`{c}`") for c in docs.columns))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return settled(spark, "mix", lambda scratch: mix(read_table(spark, sf_dir, "documents"), scratch))
