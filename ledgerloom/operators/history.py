"""What a key's past says, with nothing from the same day or later.

`obs` has (id, day, content, label, complex, fy, ...); (day, id) orders a content's observations. A block is the unit that
is blind to itself: `day` for rolling histories, `fy` for year blocks. Everything is cumulative over blocks, so that a
key's history is never listed per row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

#: Weights of observations by years back: 1, 2, 3 and older.
FY_WEIGHTS = {"weighted": (1.0, 0.7, 0.5, 0.3), "weighted_steep": (1.0, 0.5, 0.25, 0.1)}


def usable(obs: DataFrame) -> DataFrame:
    """Rows with a non-empty content, a label and a fiscal year."""
    return obs.where("content is not null and content <> '' and label is not null and label <> '' and fy is not null")


def in_years(df: DataFrame, first: int, last: int, column: str = "fy") -> DataFrame:
    """Rows of the years first to last, both included; rows without a year are out."""
    return df.where(F.col(column).between(first, last))


def target_rows(obs: DataFrame, year: int) -> DataFrame:
    """The rows that a year's predictions are judged on: usable ones of that year."""
    return usable(obs).where(F.col("fy") == year)


def _block(block: str):
    return F.unix_date("day") if block == "day" else F.col("fy").cast("long")


def label_counts_before(obs: DataFrame, block: str = "day", years: list[int] | None = None) -> DataFrame:
    """(content, block, label, n, last_day, last_id[, y<year>...]): each label's use before each block of its content.

    Counts are made per block first; a content's blocks times its labels are what the windows run over.
    """
    b = obs.withColumn("block", _block(block))
    per_year = [F.count_if(F.col("fy") == y).alias(f"y{y}") for y in years or []]
    use = b.groupBy("content", "label", "block").agg(F.count("*").alias("c"), F.max(F.struct("day", "id")).alias("last"), *per_year)
    return _counts_before(use, years)


def _counts_before(use: DataFrame, years: list[int] | None = None) -> DataFrame:
    """label_counts_before from the blocks' counts: (content, label, block, c, last[, y<year>...])."""
    grid = use.select("content", "block").distinct().join(use.select("content", "label").distinct(), "content")
    grid = grid.join(use, ["content", "label", "block"], "left")
    past = W.partitionBy("content", "label").orderBy("block").rangeBetween(W.unboundedPreceding, -1)
    out = grid.select("content", "block", "label", F.sum("c").over(past).alias("n"), F.max("last").over(past).alias("last"), *(F.coalesce(F.sum(f"y{y}").over(past), F.lit(0)).alias(f"y{y}") for y in years or []))
    return out.where("n is not null").select("content", "block", "label", "n", F.col("last.day").alias("last_day"), F.col("last.id").alias("last_id"), *(f"y{y}" for y in years or []))


def daily_uses(obs: DataFrame) -> DataFrame:
    """(content, label, day, n, first_id, last_id): each label's use of a content by day, from which a text's histories follow without its rows."""
    return obs.groupBy("content", "label", "day").agg(F.count("*").alias("n"), F.min("id").alias("first_id"), F.max("id").alias("last_id"))


def modes_of_uses(uses: DataFrame) -> DataFrame:
    """(content, block, mode, hist_n, mode_n, last_day) before each day of a content, from daily uses; contents of several rows a day meet."""
    use = uses.withColumn("block", _block("day")).groupBy("content", "label", "block").agg(F.sum("n").alias("c"), F.max(F.struct("day", F.col("last_id").alias("id"))).alias("last"))
    mode = F.max_by("label", F.struct("n", "last_day", "last_id")).alias("mode")
    return _counts_before(use).groupBy("content", "block").agg(mode, F.sum("n").alias("hist_n"), F.max("n").alias("mode_n"), F.max("last_day").alias("last_day"))


def modes_before(obs: DataFrame, block: str = "day", years: list[int] | None = None) -> DataFrame:
    """(content, block, mode, hist_n, agreement, labels[, weighted...]): most used label, ties to the one used last."""
    counts = label_counts_before(obs, block, years)
    order = lambda c: F.struct(c, F.col("last_day"), F.col("last_id"))
    weighted = []
    if years:
        fy = F.col("block") if block == "fy" else F.col("_fy")
        if block == "day":
            counts = counts.join(obs.select(F.unix_date("day").alias("block"), F.col("fy").alias("_fy")).distinct(), "block")
        for name, (one, two, three, older) in FY_WEIGHTS.items():
            back = lambda y: F.greatest(fy - y, F.lit(1))
            score = sum((F.col(f"y{y}") * F.when(back(y) == 1, one).when(back(y) == 2, two).when(back(y) == 3, three).otherwise(older) for y in years), F.lit(0.0))
            weighted.append(F.max_by("label", order(F.round(score, 6))).alias(name))
    return counts.groupBy("content", "block").agg(F.max_by("label", order(F.col("n"))).alias("mode"), F.sum("n").alias("hist_n"), F.max("n").alias("mode_n"), F.count("*").alias("labels"), *weighted)


def _stretch_start():
    """What the last stretch of one label began with, if it began on the row's day: a turn within the day, or at its first row."""
    inner = F.struct((F.col("_n") + F.col("turn_at")).alias("at"), F.col("day"), F.col("turn_from").alias("before"))
    first = F.struct((F.col("_n") + 1).alias("at"), F.col("day"), F.col("_label").alias("before"))
    return F.when(F.col("turn_at").isNotNull(), inner).when((F.col("_n") == 0) | F.coalesce(F.col("_label") != F.col("first_label"), F.lit(False)), first)


def _within_days(b: DataFrame, with_account: bool) -> DataFrame:
    """(content, day, block, id, ...): the day's observations up to the last one of each block, the first pass of a segmented scan.

    n, label, first_label, turn_at and turn_from (place of the last turn to another label and the label before it), complex_at (place of the last complex one),
    any_complex, all_complex, tail (the last five labels, null ones too), fy. Places count from 1 within the day.
    """
    seq = W.partitionBy("content", "day").orderBy("id")
    upto = seq.rowsBetween(W.unboundedPreceding, 0)
    s = b.withColumn("n", F.row_number().over(seq)).withColumn("_from", F.lag("label").over(seq))
    turn = F.last(F.when(F.col("_from") != F.col("label"), F.struct(F.col("n").alias("at"), F.col("_from").alias("before"))), ignorenulls=True).over(upto)
    state = {
        "n": F.col("n").cast("long"), "label": F.col("label"), "first_label": F.first("label").over(upto), "turn": turn, "complex_at": F.max(F.when(F.col("complex"), F.col("n"))).over(upto),
        "any_complex": F.bool_or("complex").over(upto), "all_complex": F.bool_and("complex").over(upto), "fy": F.col("fy"),
        "tail": F.slice(F.array(*(F.lag("label", k).over(seq) if k else F.col("label") for k in (4, 3, 2, 1, 0))), F.greatest(6 - F.col("n"), F.lit(1)), F.least("n", F.lit(5))),
    }
    if with_account:
        from ..functions.text import amount_band

        state |= {"last_account": F.col("account"), "last_band": amount_band(F.col("value"))}
    s = s.select("content", "day", "block", "id", F.struct(*(c.alias(k) for k, c in state.items())).alias("_s"))
    s = s.groupBy("content", "day", "block").agg(F.max("id").alias("id"), F.max_by("_s", "id").alias("_s")).select("content", "day", "block", "id", "_s.*")
    return s.withColumns({"turn_at": F.col("turn.at"), "turn_from": F.col("turn.before")}).drop("turn")


def snapshots_before(obs: DataFrame, block: str = "day") -> DataFrame:
    """(content, block, ...): the state of each content's history just before each of its blocks.

    n, last_*, run (length of the last stretch of one label), previous (the label before it), change_day, since_complex
    (observations since the last complex one, n if none), any_complex, all_complex, distinct_labels, tail (last five labels),
    first_day, last_account and last_band where obs has account and value. See year_modes_before for the years of a history, and
    seen_before for what it has seen.

    A segmented scan: the observations of a content's day are folded into one state, on their own, then the states are scanned over days,
    and a day's own part is put behind what was before it. So a content with a third of all rows spreads over as many tasks as it has days.
        """
    b = obs.withColumn("block", _block(block))
    ends = _within_days(b, {"account", "value"} <= set(obs.columns))
    # The last row of a content's day closes it; its scan over days has no more rows than there are days.
    past = W.partitionBy("content").orderBy("day").rowsBetween(W.unboundedPreceding, -1)
    closing = ends if block == "day" else ends.withColumn("_last", F.max("id").over(W.partitionBy("content", "day"))).where("id = _last").drop("_last")
    scan = closing.withColumn("_n", F.coalesce(F.sum("n").over(past), F.lit(0))).withColumn("_label", F.lag("label").over(W.partitionBy("content").orderBy("day")))
    scan = scan.withColumn("_start", _stretch_start())
    lags = [F.coalesce(F.lag("tail", k).over(W.partitionBy("content").orderBy("day")), F.expr("cast(array() as array<string>)")) for k in (5, 4, 3, 2, 1)]
    before_day = {
        "_begin": F.last("_start", ignorenulls=True).over(past), "_complex": F.max(F.col("_n") + F.col("complex_at")).over(past), "_any": F.bool_or("any_complex").over(past),
        "_all": F.bool_and("all_complex").over(past), "_tail": F.concat(*lags), "_first": F.min("day").over(past),
    }
    scan = scan.withColumns(before_day)
    if block != "day":
        known = ["_n", "_label", *before_day]
        scan = ends.join(scan.select("content", "day", *known), ["content", "day"]).withColumn("_start", _stretch_start())
    n = F.col("_n") + F.col("n")
    start = F.coalesce("_start", "_begin")
    five = F.concat("_tail", "tail")
    both = lambda f, x, y: F.when(F.col(x).isNull(), F.col(y)).when(F.col(y).isNull(), F.col(x)).otherwise(f(F.col(x), F.col(y)))
    state = {
        "n": n.cast("long"), "last_label": F.col("label"), "last_day": F.col("day"), "last_fy": F.col("fy"), "run": (n - start["at"] + 1).cast("long"),
        "previous": start["before"], "change_day": F.when(start["before"].isNotNull(), start["day"]),
        "since_complex": (n - F.coalesce(F.col("_n") + F.col("complex_at"), F.col("_complex"), F.lit(0))).cast("long"),
        "any_complex": both(lambda x, y: x | y, "_any", "any_complex"), "all_complex": both(lambda x, y: x & y, "_all", "all_complex"),
        "tail": F.array_compact(F.slice(five, F.greatest(F.size(five) - 4, F.lit(1)), 5)), "first_day": F.coalesce("_first", "day"),
    }
    state |= {c: F.col(c) for c in ("last_account", "last_band") if c in ends.columns}
    s = scan.select("content", "block", "day", "id", F.struct(*(c.alias(k) for k, c in state.items())).alias("state"))
    ends = s if block == "day" else s.groupBy("content", "block").agg(F.max_by("state", F.struct("day", "id")).alias("state"))
    # Labels that a content has by a block: how many began before it.
    began = b.groupBy("content", "label").agg(F.min("block").alias("block")).groupBy("content", "block").agg(F.count("*").alias("_began"))
    blocks = W.partitionBy("content").orderBy("block")
    known = F.sum("_began").over(blocks.rowsBetween(W.unboundedPreceding, -1)).cast("int")
    out = ends.join(began, ["content", "block"], "left").select("content", "block", F.lag("state").over(blocks).alias("state"), known.alias("distinct_labels"))
    return out.where("state is not null").select("content", "block", "distinct_labels", "state.*")


def seen_before(rows: DataFrame, obs: DataFrame, columns: dict, block: str = "day") -> DataFrame:
    """rows (content, block, ...) with a column a name: whether an observation of the content before the block has the value of
    the row's column expression; null where a value is missing. One first block a (content, value) is joined, no list is built."""
    b = obs.withColumn("block", _block(block))
    for name, value in columns.items():
        first = b.groupBy("content", value.alias("_value")).agg(F.min("block").alias("_since"))
        rows = rows.withColumn("_value", value).join(first, ["content", "_value"], "left")
        rows = rows.withColumn(name, F.when(F.col("_value").isNotNull(), F.coalesce(F.col("_since") < F.col("block"), F.lit(False)))).drop("_value", "_since")
    return rows


def year_modes_before(obs: DataFrame, block: str = "day") -> DataFrame:
    """(content, block, fy_count, fy_label_change): in how many years a content occurs before each of its blocks, and whether
    the most used label (ties to the one used first) is not the same in all of them.

    Counts are made per block and year first; a content's blocks times its (year, label) pairs are what the windows run over.
    """
    b = obs.withColumn("block", _block(block))
    use = b.groupBy("content", "fy", "label", "block").agg(F.count("*").alias("c"), F.min(F.struct("day", "id")).alias("first"))
    grid = use.select("content", "block").distinct().join(use.select("content", "fy", "label").distinct(), "content")
    grid = grid.join(use, ["content", "fy", "label", "block"], "left")
    past = W.partitionBy("content", "fy", "label").orderBy("block").rangeBetween(W.unboundedPreceding, -1)
    seen = grid.select("content", "block", "fy", "label", F.sum("c").over(past).alias("n"), F.min("first").over(past).alias("first")).where("n is not null")
    top = seen.groupBy("content", "block", "fy").agg(F.min(F.struct((-F.col("n")).alias("m"), "first", "label")).alias("top"))
    return top.groupBy("content", "block").agg(F.count("*").alias("fy_count"), (F.count_distinct("top.label") > 1).alias("fy_label_change"))


def tail_mode(tail, k: int):
    """Most frequent of the last k of a tail, ties to the latest."""
    t = F.slice(tail, F.greatest(F.size(tail) - k + 1, F.lit(1)), k)
    ranked = F.transform(t, lambda x, i: F.struct(F.size(F.filter(t, lambda y: y == x)).alias("n"), i.alias("i"), x.alias("x")))
    return F.array_max(ranked)["x"]


def before(obs: DataFrame, block: str = "day", years: list[int] | None = None) -> DataFrame:
    """Each observation with its content's history before its block; without one the history columns are null."""
    h = snapshots_before(obs, block).join(modes_before(obs, block, years), ["content", "block"])
    return obs.withColumn("block", _block(block)).join(h, ["content", "block"], "left")


def content_stats(obs: DataFrame) -> DataFrame:
    """By content: count, distinct labels, the top label (ties to the first used), its share, the latest label and day, histograms."""
    use = obs.groupBy("content", "label").agg(F.count("*").alias("n"), F.min(F.struct("day", "id")).alias("first"), F.max(F.struct("day", "id")).alias("last"))
    top = F.min(F.struct((-F.col("n")).alias("m"), "first", "label"))
    out = use.groupBy("content").agg(
        F.sum("n").alias("count"), F.count("*").alias("distinct_labels"), top.alias("_t"), F.max(F.struct("last", "label")).alias("_l"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("label", "n")))).alias("labels"),
    )
    return out.select("content", "count", "distinct_labels", F.col("_t.label").alias("top_label"), F.round(-F.col("_t.m") / F.col("count"), 4).alias("top_ratio"), F.col("_l.label").alias("latest_label"), F.col("_l.last.day").alias("latest_day"), "labels")


def label_counts_at(uses: DataFrame, asked: DataFrame) -> DataFrame:
    """(match, day, mode, hist_n, mode_n, last_day, labels) for each distinct (match, day) of asked: the past of a key as of
    any day, not only days on which the key itself occurs. uses are daily_uses with their key; labels: the three most used, 'label:n'.
    """
    q = asked.select("match", "day").distinct()
    daily = uses.groupBy(F.col("key").alias("match"), "label", "day").agg(F.sum("n").alias("c"), F.min("first_id").alias("_a"), F.max("last_id").alias("_z"))
    daily = daily.select("match", "label", "day", "c", F.struct(F.col("day").alias("_d"), "_a").alias("f"), F.struct(F.col("day").alias("_d"), "_z").alias("l"), F.lit(False).alias("asked"))
    # The asked days join the timeline of each of the key's labels; counts run along it, and never meet day by day.
    grid = q.join(daily.select("match", "label").distinct(), "match").withColumn("asked", F.lit(True))
    line = daily.unionByName(grid, allowMissingColumns=True)
    past = W.partitionBy("match", "label").orderBy(F.unix_date("day")).rangeBetween(W.unboundedPreceding, -1)
    past = line.select("match", "label", "day", "asked", F.sum("c").over(past).alias("n"), F.min("f").over(past).alias("first"), F.max("l").over(past).alias("last")).where("asked and n is not null")
    top = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), "first", "label"))), 1, 3)
    out = past.groupBy("match", "day").agg(F.max_by("label", F.struct("n", "last")).alias("mode"), F.sum("n").alias("hist_n"), F.max("n").alias("mode_n"), F.max("last").alias("_l"), top.alias("_t"))
    labels = F.array_join(F.transform("_t", lambda x: F.concat(x["label"], F.lit(":"), (-x["m"]).cast("string"))), ",")
    return out.select("match", "day", "mode", "hist_n", "mode_n", F.col("_l._d").alias("last_day"), labels.alias("labels"))


def content_years(obs: DataFrame) -> DataFrame:
    """(content, count, years, fy_label_change): in how many years each content occurs, and whether its most used label (ties to
    the one used first) changes between them."""
    use = obs.groupBy("content", "fy", "label").agg(F.count("*").alias("n"), F.min(F.struct("day", "id")).alias("first"))
    top = use.groupBy("content", "fy").agg(F.min(F.struct((-F.col("n")).alias("m"), "first", "label")).alias("top"), F.sum("n").alias("n"))
    return top.groupBy("content").agg(F.sum("n").alias("count"), F.count("*").alias("years"), (F.count_distinct("top.label") > 1).alias("fy_label_change"))


def labels_by_year(obs: DataFrame) -> DataFrame:
    """(content, fy, labels): each year's histogram of a content's labels, as 'label:n' texts, most used first, ties to the first used."""
    use = obs.groupBy("content", "fy", "label").agg(F.count("*").alias("n"), F.min(F.struct("day", "id")).alias("first"))
    order = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), "first", "label")))
    return use.groupBy("content", "fy").agg(F.array_join(F.transform(order, lambda x: F.concat(x["label"], F.lit(":"), (-x["m"]).cast("string"))), ",").alias("labels"))


def window_stats(obs: DataFrame, sizes: tuple = (None, 10, 5, 3, 2)) -> DataFrame:
    """(content, window, n, mode, agreement, changed) of each content's last k observations by (day, id); window 0 is all of them.

    mode is the most used label, ties to the one used last; changed tells whether the window has several labels. A content's
    last observations are ranked; at most the largest k of them are kept for the windows, all of them only as counts.
    """
    most = max(k for k in sizes if k)
    rank = F.row_number().over(W.partitionBy("content").orderBy(F.desc("day"), F.desc("id")))
    last = obs.select("content", "label", "day", "id", rank.alias("_r")).where(F.col("_r") <= most)
    windows = F.explode(F.array(*(F.lit(k) for k in sizes if k)))
    part = last.withColumn("window", windows).where("_r <= window").groupBy("content", "window", "label").agg(F.count("*").alias("n"), F.max(F.struct("day", "id")).alias("last"))
    if None in sizes:
        whole = obs.groupBy("content", F.lit(0).alias("window"), "label").agg(F.count("*").alias("n"), F.max(F.struct("day", "id")).alias("last"))
        part = part.unionByName(whole)
    g = part.groupBy("content", "window").agg(F.sum("n").alias("n"), F.max(F.struct("n", "last", "label")).alias("top"), F.count("*").alias("labels"))
    return g.select("content", "window", "n", F.col("top.label").alias("mode"), F.round(F.col("top.n") / F.col("n"), 4).alias("agreement"), (F.col("labels") > 1).alias("changed"))


def window_report(stats: DataFrame) -> DataFrame:
    """By window: contents with several observations, their mean agreement, how many agree in full, have changed, or have another
    mode than over all observations."""
    whole = stats.where("window = 0").select("content", F.col("n").alias("_n"), F.col("mode").alias("_mode")).where("_n >= 2")
    s = stats.join(whole, "content")
    return s.groupBy("window").agg(
        F.count("*").alias("contents"), F.round(F.avg("agreement"), 4).alias("agreement"), F.count_if(F.col("agreement") == 1).alias("unanimous"),
        F.count_if("changed").alias("changed"), F.count_if(F.col("mode") != F.col("_mode")).alias("other_mode"),
    )


def mode_changes(obs: DataFrame, year: int) -> DataFrame:
    """One row: contents of a year with a past, and how many have another most used label in it (ties to the first used) than in
    their past (ties to the last used)."""
    past = obs.where(F.col("fy") < year).groupBy("content", "label").agg(F.count("*").alias("n"), F.max(F.struct("day", "id")).alias("last"))
    past = past.groupBy("content").agg(F.max(F.struct("n", "last", "label")).alias("p"))
    now = obs.where(F.col("fy") == year).groupBy("content", "label").agg(F.count("*").alias("n"), F.min(F.struct("day", "id")).alias("first"))
    now = now.groupBy("content").agg(F.min(F.struct((-F.col("n")).alias("m"), "first", "label")).alias("q"))
    both = now.join(past, "content")
    return both.agg(F.count("*").alias("contents"), F.count_if(F.col("p.label") != F.col("q.label")).alias("changed"))
