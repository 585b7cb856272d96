"""Nearest past texts: similarity of distinct keys, staged prediction, candidates as of a day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.text import indel_ratio, indel_ratio_arrow, normalize, rate, sanitize, strip
from . import history as H

#: A fuzzy best match below this is no candidate.
FUZZY_FLOOR = 70.0


#: Keys of the right side that a left key meets in one task, about, and left keys that meet them there.
KEYS_PER_BLOCK, ASKED_PER_BLOCK = 2000, 128


def _blocks(keys: DataFrame, size: int):
    """How many blocks of about `size` the rows of keys make, as a column that is computed when the plan runs."""
    return keys.agg(F.greatest(F.lit(1), F.ceil(F.count("*") / size)).cast("int").alias("n")).scalar()


def nearest(asked: DataFrame, pool: DataFrame, k: int) -> DataFrame:
    """(a, before, rank, b, score, since, tie): for each (a, before) of asked the k most similar other keys of pool (b, since, tie) with since < before.

    Equal scores go to the least (since, tie, b). before and since are whole numbers, days for instance. b is unique in pool. The keys of either side
    are dealt into blocks, and each pair of blocks is one group: within it a bound from character counts leaves few pairs to be scored, 128 at a time,
    and the block's k best go on. A null or absent key neither looks nor matches.
    """
    parts = int(pool.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    left = asked.where("a is not null and before is not null").groupBy("a").agg(F.array_sort(F.collect_set("before")).alias("before"))
    right = pool.where("b is not null").select("b", "since", "tie")
    n_left, n_right = _blocks(left, ASKED_PER_BLOCK), _blocks(right, KEYS_PER_BLOCK)
    each = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    left = left.withColumn("_l", F.pmod(F.xxhash64("a"), n_left).cast("int")).withColumn("_r", each(n_right))
    right = right.withColumn("_r", F.pmod(F.xxhash64("b"), n_right).cast("int")).withColumn("_l", each(n_left))
    # A fixed number of partitions, as the work is in the pairs: the sizes of the rows would make one task of all blocks.
    left, right = (x.repartition(parts, "_l", "_r").groupBy("_l", "_r") for x in (left, right))
    tie = pool.schema["tie"].dataType.simpleString()
    found = left.cogroup(right).applyInArrow(_nearest_in_block(k), f"a string, before long, b string, since long, tie {tie}, score double")
    w = W.partitionBy("a", "before").orderBy(F.desc("score"), "since", "tie", "b")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _nearest_in_block(k: int):
    def run(left, right):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        from ..functions.block_similarity import TextBlock

        right = right.take(pc.sort_indices(right, sort_keys=[("since", "ascending"), ("tie", "ascending"), ("b", "ascending")], null_placement="at_start"))
        block, since = TextBlock(right.column("b").to_pylist()), right.column("since").to_numpy()
        rows, days, places, scores = [], [], [np.zeros(0, np.int64)], [np.zeros(0)]
        for i, (text, before) in enumerate(zip(left.column("a").to_pylist(), left.column("before").to_pylist(), strict=True)):
            for day, (at, score) in zip(before, block.nearest(text, k, np.searchsorted(since, before).tolist()), strict=True):
                rows += [i] * len(at)
                days += [day] * len(at)
                places.append(at)
                scores.append(score)
        at = pa.array(np.concatenate(places))
        there = [right.column(c).take(at) for c in ("b", "since", "tie")]
        return pa.table([left.column("a").take(pa.array(rows, pa.int64())), pa.array(days, pa.int64()), *there, pa.array(np.concatenate(scores))], names=["a", "before", "b", "since", "tie", "score"])

    return run


def pair_scores(left: DataFrame, right: DataFrame, arrow: bool = False, floor: float = 0.0) -> DataFrame:
    """(a, b, score) of every key a of left with every key b of right, or those that reach `floor`: keys are scored once, not rows.

    left meets right block by block over an equi-join; blocks are as many as right's keys ask for, so that tasks grow in
    number and not in size. A floor f leaves lengths within f / (200 - f) of each other only: they join on the length.
    """
    r = right.select("b").distinct()
    blocks = max(1, -(-r.count() // KEYS_PER_BLOCK))
    l = left.select("a").distinct().withColumn("_b", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    r = r.withColumn("_b", F.pmod(F.hash("b"), F.lit(blocks)))
    keys = ["_b"]
    if floor > 0:
        near, size = floor / (200 - floor), F.length("a")
        lengths = F.sequence(F.ceil(size * near - 1e-9), F.floor(size / near + 1e-9))
        l, r, keys = l.withColumn("_len", F.explode(lengths)), r.withColumn("_len", F.length("b").cast("long")), ["_b", "_len"]
    score = (indel_ratio_arrow if arrow else indel_ratio)(F.col("a"), F.col("b"))
    out = l.join(r, keys).where("a <> b").select("a", "b", score.alias("score"))
    return out.where(F.col("score") >= floor) if floor > 0 else out


#: After any day.
ALWAYS = 1 << 40


def top_similar(left: DataFrame, right: DataFrame, k: int = 3) -> DataFrame:
    """(a, b, score, rank): the k most similar keys b of right for each key a of left; equal scores by b."""
    pool = right.select("b").distinct().select("b", F.lit(0).cast("long").alias("since"), F.lit(0).cast("long").alias("tie"))
    return nearest(left.select("a", F.lit(ALWAYS).alias("before")), pool, k).select("a", "b", "score", "rank")


def _keyed(obs: DataFrame, level: str, ascii_only: bool) -> DataFrame:
    return H.usable(obs).withColumn("raw", strip(F.col("content"))).withColumn("key", normalize(F.col("content"), level, ascii_only))


def _with_keys(grouped: DataFrame, level: str, ascii_only: bool, whole: Column) -> DataFrame:
    """Adds raw and key to groups of equal content. `whole` holds for every group and names what the groups counted: without it Spark would push filters
    on the key below the grouping, and normalize row by row."""
    return grouped.withColumns({"raw": F.when(whole, strip(F.col("content"))), "key": F.when(whole, normalize(F.col("content"), level, ascii_only))})


def _uses(obs: DataFrame, level: str, ascii_only: bool) -> DataFrame:
    """The daily uses of the usable rows with raw text and key: a text is normalized once for a label and day, not for every row. All counts are
    named, so that the readers of the frame share its exchange."""
    return _with_keys(H.daily_uses(H.usable(obs)), level, ascii_only, (F.col("n") > 0) | (F.col("first_id") > F.col("last_id")))


def _first_seen(uses: DataFrame) -> DataFrame:
    """(key, seen): struct(day, id) of each key's first use; a use without a day is none."""
    return uses.groupBy("key").agg(F.min(F.when(F.col("day").isNotNull(), F.struct("day", F.col("first_id").alias("id")))).alias("seen"))


def fuzzy_before(targets: DataFrame, keys: DataFrame, k: int) -> DataFrame:
    """(key, day, match, score, rank): for each distinct (key, day) the k most similar keys first seen before the day.

    keys has (key, seen) with seen = struct(day, id) of its first use; equal scores go to the key seen first. Empty keys
    neither look nor match.
    """
    days = lambda c: F.unix_date(c).cast("long")
    asked = targets.where("key <> ''").select(F.col("key").alias("a"), days("day").alias("before"))
    pool = keys.where("key <> ''").select(F.col("key").alias("b"), days("seen.day").alias("since"), F.col("seen.id").alias("tie"))
    return nearest(asked, pool, k).select(F.col("a").alias("key"), F.date_from_unix_date(F.col("before").cast("int")).alias("day"), F.col("b").alias("match"), "score", "rank")


def staged_predictions(obs: DataFrame, level: str = "n4", ascii_only: bool = False, fuzzy: bool = True) -> DataFrame:
    """Per observation: stage (raw_exact, norm_exact, fuzzy, none), pred, score, hist_n, agreement, days_since_last, top3.

    The raw text's own past hides a longer one of its normalized form; only what neither stage answers is scored.
    """
    o, uses = H.usable(obs), _uses(obs, level, ascii_only)
    texts = uses.select("content", "day", "raw", "key").distinct()
    # What a row gets depends on its text and day only. Raw texts and keys are counted together, as contents of two kinds.
    kinds = F.explode(F.array(*(F.struct(F.lit(by).alias("by"), F.col(by).alias("text")) for by in ("raw", "key"))))
    past = H.modes_of_uses(uses.withColumn("content", kinds)).select(F.col("content").alias("_kind"), "block", F.struct("mode", "hist_n", "mode_n", "last_day").alias("_p"))
    t = texts.select("content", "day", "key", F.unix_date("day").alias("block"), kinds.alias("_kind")).join(past, ["_kind", "block"], "left")
    t = t.groupBy("content", "day", "key").agg(*(F.max(F.when(F.col("_kind.by") == by, F.col("_p"))).alias(f"_{by}") for by in ("raw", "key")))
    if fuzzy:
        seen = _first_seen(uses)
        # A raw text's past is part of its key's: rows without either are those of the key's first day.
        open_ = texts.join(seen, "key").where(F.col("day") <= F.col("seen.day")).select("key", "day")
        best = fuzzy_before(open_, seen, 3)
        # The matched key's past as of the day: its counts up to the last use before it.
        top = best.join(H.label_counts_at(uses, best), ["match", "day"]).groupBy("key", "day").agg(F.array_sort(F.collect_list(F.struct("rank", "match", "score", "mode", "hist_n", "mode_n", "last_day"))).alias("top3"))
        t = t.join(top, ["key", "day"], "left")
    else:
        t = t.withColumn("top3", F.lit(None).cast("array<struct<rank:int,match:string,score:double,mode:string,hist_n:bigint,mode_n:bigint,last_day:date>>"))
    t = t.withColumn("_f", F.when(F.col("_raw").isNull() & F.col("_key").isNull(), F.get("top3", F.lit(0))))
    stage = F.when(F.col("_raw").isNotNull(), "raw_exact").when(F.col("_key").isNotNull(), "norm_exact").when(F.col("_f").isNotNull(), "fuzzy").otherwise("none")
    pick = lambda f: F.coalesce(F.col(f"_raw.{f}"), F.col(f"_key.{f}"), F.col(f"_f.{f}"))
    answers = t.select(
        F.col("content").alias("_content"), F.col("day").alias("_day"), "key", stage.alias("stage"), pick("mode").alias("pred"), F.when(stage == "fuzzy", F.col("_f.score")).when(stage != "none", 100.0).alias("score"),
        pick("hist_n").alias("hist_n"), rate(pick("mode_n"), pick("hist_n")).alias("agreement"), F.datediff("day", pick("last_day")).alias("days_since_last"),
        F.when(stage == "fuzzy", F.transform("top3", lambda x: x["match"])).alias("top3_keys"),
    )
    out = o.join(answers, (F.col("content") == F.col("_content")) & F.col("day").eqNullSafe(F.col("_day")), "left")
    return out.select(*obs.columns, *answers.columns[2:], (F.col("pred") == F.col("label")).alias("correct"))


def apply_threshold(preds: DataFrame, threshold: float | None) -> DataFrame:
    """Fuzzy predictions below the threshold (all if None) become none."""
    low = (F.col("stage") == "fuzzy") & (F.lit(True) if threshold is None else F.col("score") < threshold)
    return preds.withColumns({"pred": F.when(~low, F.col("pred")), "correct": F.when(~low, F.col("correct")), "stage": F.when(low, "none").otherwise(F.col("stage"))})


def stage_summary(preds: DataFrame) -> DataFrame:
    """By year and stage, and for the total of a year: n, share, accuracy, simple and complex accuracy."""
    both = preds.unionByName(preds.where("stage <> 'none'").withColumn("stage", F.lit("total")))
    n = preds.groupBy("fy").agg(F.count("*").alias("test"))
    ok, s = F.coalesce("correct", F.lit(False)), ~F.col("complex")
    g = both.groupBy("fy", "stage").agg(F.count("*").alias("n"), F.count_if(ok).alias("ok"), F.count_if(s).alias("simple_n"), F.count_if(ok & s).alias("simple_ok"), F.count_if(~s).alias("complex_n"), F.count_if(ok & ~s).alias("complex_ok"))
    g = g.join(n, "fy")
    known = lambda c: F.when(F.col("stage") != "none", c)
    return g.select("fy", "stage", "n", rate(F.col("n"), F.col("test")).alias("share"), known(rate(F.col("ok"), F.col("n"))).alias("accuracy"), "simple_n", known(rate(F.col("simple_ok"), F.col("simple_n"))).alias("simple_accuracy"), "complex_n", known(rate(F.col("complex_ok"), F.col("complex_n"))).alias("complex_accuracy"))


def candidates_before(obs: DataFrame, level: str = "n4", limit: int = 8, ascii_only: bool = False) -> DataFrame:
    """(key, day, rank, match, similarity, occurrences, last_used, labels) for each distinct (key, day) of obs.

    The key's own past comes first at 100, then the most similar keys; similarity is rounded half to even. labels lists the
    three most used labels, equal counts by first use.
    """
    daily = _uses(obs, level, ascii_only)
    seen, t = _first_seen(daily), daily.select("key", "day").distinct()
    own = t.join(seen, "key").where(F.col("seen.day") < F.col("day")).select("key", "day", F.col("key").alias("match"), F.lit(100.0).alias("score"), F.lit(0).alias("rank"))
    all_ = own.unionByName(fuzzy_before(t, seen, limit))
    w = W.partitionBy("key", "day").orderBy("rank")
    all_ = all_.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= limit)
    uses = H.label_counts_at(daily, all_)
    return all_.join(uses, ["match", "day"]).select("key", "day", "rank", "match", F.bround("score").cast("long").alias("similarity"), F.col("hist_n").alias("occurrences"), F.col("last_day").alias("last_used"), "labels")


def _modes(uses: DataFrame, by: str) -> DataFrame:
    use = uses.groupBy(by, "label").agg(F.sum("n").alias("n"), F.max("last").alias("last"))
    return use.groupBy(by).agg(F.struct(F.max_by("label", F.struct("n", "last")).alias("mode"), F.sum("n").alias("hist_n"), F.max("n").alias("mode_n"), F.max("last.day").alias("last_day")).alias(f"_{by}"))


def static_predictions(history: DataFrame, targets: DataFrame, level: str = "n4", ascii_only: bool = False) -> DataFrame:
    """Targets against a fixed history: raw, then normalized, then the most similar key; targets do not join it.

    Adds stage, pred, score, hist_n, agreement, days_since_last (if targets have a day), and account_seen: whether the exact history has the target's account, null
    without an exact history.
    """
    # The history by text, label and account, the targets by text and account: neither is looked at row by row again.
    counted = [F.count("*").alias("n"), F.min(F.struct("day", "id")).alias("first"), F.max(F.struct("day", "id")).alias("last")]
    h = _with_keys(H.usable(history).groupBy("content", "label", "account").agg(*counted), level, ascii_only, (F.col("n") > 0) | (F.col("first") > F.col("last")))
    asked = _with_keys(targets.groupBy("content", "account").agg(F.count("*").alias("_n")), level, ascii_only, F.col("_n") > 0).drop("_n")
    t = asked.join(_modes(h, "raw"), "raw", "left").join(_modes(h, "key"), "key", "left")
    for by in ("raw", "key"):
        t = t.join(h.select(by, "account").distinct().withColumn(f"_seen_{by}", F.lit(True)), [by, "account"], "left")
    seen = h.where("key <> ''").groupBy("key").agg(F.min("first").alias("seen"))
    open_ = asked.select(F.col("key").alias("a")).where("a <> ''").distinct().join(seen.withColumnRenamed("key", "a"), "a", "left_anti")
    pool = seen.select(F.col("key").alias("b"), F.unix_date("seen.day").cast("long").alias("since"), F.col("seen.id").alias("tie"))
    best = nearest(open_.withColumn("before", F.lit(ALWAYS)), pool, 1).select(F.col("a").alias("key"), F.col("b").alias("_match"), F.col("score").alias("_score"))
    best = best.join(_modes(h, "key").withColumnsRenamed({"key": "_match", "_key": "_fuzzy"}), "_match")
    t = t.join(best, "key", "left")
    stage = F.when(F.col("_raw").isNotNull(), "raw_exact").when(F.col("_key").isNotNull(), "norm_exact").when(F.col("_fuzzy").isNotNull(), "fuzzy").otherwise("none")
    pick = lambda f: F.when(stage == "raw_exact", F.col(f"_raw.{f}")).when(stage == "norm_exact", F.col(f"_key.{f}")).otherwise(F.col(f"_fuzzy.{f}"))
    known = F.when(stage == "raw_exact", F.coalesce("_seen_raw", F.lit(False))).when(stage == "norm_exact", F.coalesce("_seen_key", F.lit(False)))
    answers = t.select(
        F.col("content").alias("_content"), F.col("account").alias("_account"), stage.alias("stage"), pick("mode").alias("pred"), F.when(stage == "fuzzy", F.col("_score")).when(stage != "none", 100.0).alias("score"),
        pick("hist_n").alias("hist_n"), rate(pick("mode_n"), pick("hist_n")).alias("agreement"), pick("last_day").alias("_last_day"), known.alias("account_seen"),
    )
    out = targets.join(answers, F.col("content").eqNullSafe(F.col("_content")) & F.col("account").eqNullSafe(F.col("_account")), "left")
    days = [F.datediff("day", "_last_day").alias("days_since_last")] if "day" in targets.columns else []
    return out.select(*targets.columns, "stage", "pred", "score", "hist_n", "agreement", *days, "account_seen")


def raw_only(preds: DataFrame) -> DataFrame:
    """Predictions by the raw text's own past alone: all others become none."""
    other = F.col("stage") != "raw_exact"
    return preds.withColumns({"pred": F.when(~other, F.col("pred")), "correct": F.when(~other, F.col("correct")), "stage": F.when(other, "none").otherwise(F.col("stage"))})


def latest_texts(candidates: DataFrame, obs: DataFrame, level: str = "n4", ascii_only: bool = False) -> DataFrame:
    """candidates (key, day, match, ...) with `content`, the masked text of the match's last observation before the day."""
    o = _keyed(obs, level, ascii_only)
    daily = o.groupBy(F.col("key").alias("match"), "day").agg(F.max_by("content", "id").alias("_text"))
    asked = candidates.select("match", "day").distinct().withColumn("_asked", F.lit(True))
    line = daily.join(asked, ["match", "day"], "full")
    past = W.partitionBy("match").orderBy(F.unix_date("day")).rangeBetween(W.unboundedPreceding, -1)
    line = line.withColumn("_last", F.last("_text", ignorenulls=True).over(past)).where("_asked").withColumn("content", F.when(F.col("_last").isNotNull(), sanitize(F.col("_last"))))
    return candidates.join(line.select("match", "day", "content"), ["match", "day"], "left")
