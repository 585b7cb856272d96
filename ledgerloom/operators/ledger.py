"""Journals, line items and the label on the other side of a journal.

Frames: `lines` has one row a journal branch (journal_id, transaction_id, branch_index, debit_account, debit_sub, credit_account,
credit_sub, value, tax_value); `tx` one row a line item (transaction_id, date, value, side, connected_sub_account_id,
connected_account_id). An account key is (account, sub), compared null-safely.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.text import rate

MIN_SUPPORT = 3


def explode_branches(journals: DataFrame) -> DataFrame:
    """One row a branch of nested journals, numbered from 1; tags joined; journals without branches vanish."""
    b = journals.select("*", F.posexplode("branches").alias("_at", "_branch"), F.size("branches").alias("branch_count"))
    side = lambda s: [F.col(f"_branch.{s}.{f}").alias(f"{'debit' if s == 'debitor' else 'credit'}_{f}") for f in b.select(f"_branch.{s}.*").columns]
    head = [c for c in journals.columns if c not in ("branches", "tags", "voucher_file_ids")]
    more = [F.array_join(F.coalesce("tags", F.array().cast("array<string>")), "|").alias("tags")] if "tags" in journals.columns else []
    if "voucher_file_ids" in journals.columns:
        more.append(F.coalesce(F.size(F.coalesce("voucher_file_ids", F.array().cast("array<string>"))), F.lit(0)).alias("voucher_file_count"))
    return b.select(*head, *more, (F.col("_at") + 1).alias("branch_index"), "branch_count", F.col("_branch.remark").alias("remark"), *side("debitor"), *side("creditor"))


def with_term(df: DataFrame, terms: DataFrame, date: str = "date") -> DataFrame:
    """Adds the term whose closed interval holds the date; of several the first by (start, end); none leaves nulls.

    The terms become a calendar, one row a day, so that the lookup is an equi-join that Spark may broadcast by its size.
    """
    cols = [c for c in terms.columns if c not in ("start_date", "end_date")]
    days = terms.select(F.explode(F.sequence("start_date", "end_date")).alias("_day"), F.struct("start_date", "end_date", *cols).alias("_t"))
    days = days.groupBy("_day").agg(F.min("_t").alias("_t"))
    return df.join(days, F.col(date) == F.col("_day"), "left").select(*df.columns, *(F.col(f"_t.{c}").alias(c) for c in cols))


def date_windows(ranges: DataFrame, span: int) -> DataFrame:
    """Closed contiguous windows of at most span + 1 days over each (start_date, end_date)."""
    starts = F.expr(f"sequence(start_date, end_date, interval {span + 1} days)")
    w = ranges.where("start_date <= end_date").select("*", F.explode(starts).alias("window_start"))
    return w.withColumn("window_end", F.least(F.date_add("window_start", span), F.col("end_date")))


def clip_periods(terms: DataFrame, start: str, end: str) -> DataFrame:
    """Distinct (start, end) terms that touch the range, cut to it."""
    s, e = F.lit(start).cast("date"), F.lit(end).cast("date")
    keep = terms.groupBy("start_date", "end_date").agg(F.min("fiscal_year").alias("fiscal_year")).where((F.col("end_date") >= s) & (F.col("start_date") <= e))
    return keep.select("fiscal_year", F.greatest("start_date", s).alias("start_date"), F.least("end_date", e).alias("end_date"))


def sides(lines: DataFrame) -> DataFrame:
    """The long form: a row a filled side, D before C, with gross = value + tax_value and sign +1 for debits."""
    one = lambda s, sign: F.struct(F.lit(s[0].upper()).alias("side"), F.lit(sign).alias("sign"), F.col(f"{s}_account").alias("account"), F.col(f"{s}_sub").alias("sub"))
    out = lines.withColumn("_s", F.explode(F.array(one("debit", 1), one("credit", -1)))).where("_s.account is not null")
    return out.select(*(c for c in lines.columns if not c.startswith(("debit_", "credit_"))), "_s.*", (F.coalesce("value", F.lit(0)) + F.coalesce("tax_value", F.lit(0))).alias("gross"))


def debit_nets(lines: DataFrame, amount: str = "gross") -> DataFrame:
    """Debit less credit by (journal, account, sub)."""
    return sides(lines).groupBy("journal_id", "account", "sub").agg(F.sum(F.col("sign") * F.col(amount)).alias("net"))


def oriented(net: Column, side: Column) -> Column:
    """As the bank account sees it: spending turns the sign."""
    return F.when(side == "EXPENSE", -net).otherwise(net)


def first_journal(tx: DataFrame, journals: DataFrame) -> DataFrame:
    """Each linked line item with its first journal (by number, null as 0, then id) and the number of its journals."""
    j = journals.where("transaction_id is not null").groupBy("transaction_id").agg(
        F.min(F.struct(F.coalesce("number", F.lit(0)).alias("n"), F.col("journal_id"))).alias("_f"), F.count("*").alias("journals_per_transaction")
    )
    return tx.join(j, "transaction_id").select(*tx.columns, F.col("_f.journal_id").alias("journal_id"), "journals_per_transaction")


def bank_candidates(linked: DataFrame, nets: DataFrame) -> DataFrame:
    """Account keys of a line item's journal whose oriented net is the line's amount."""
    return linked.join(nets, "journal_id").where(oriented(F.col("net"), F.col("side")) == F.col("value"))


def _most_voted(votes: DataFrame, level: str) -> DataFrame:
    """(fiscal_year, level, account, sub, support) of the most voted key; votes: (fiscal_year, level, account, sub, support), to be summed."""
    votes = votes.groupBy("fiscal_year", level, "account", "sub").agg(F.sum("support").alias("support"))
    best = votes.groupBy("fiscal_year", level).agg(F.min(F.struct((-F.col("support")).alias("m"), "account", "sub")).alias("_b"))
    return best.select("fiscal_year", level, F.col("_b.account").alias("account"), F.col("_b.sub").alias("sub"), (-F.col("_b.m")).alias("support"))


def bank_map(linked: DataFrame, candidates: DataFrame, level: str) -> DataFrame:
    """The most voted account key by (fiscal_year, level): support, journals, ratio. Equal votes: the smallest key."""
    totals = linked.groupBy("fiscal_year", level).agg(F.count("*").alias("journals"))
    best = _most_voted(candidates.withColumn("support", F.lit(1)), level)
    out = totals.join(best, ["fiscal_year", level], "left")
    support = F.coalesce("support", F.lit(0))
    return out.select("fiscal_year", level, "account", "sub", support.alias("support"), "journals", rate(support, F.col("journals")).alias("ratio"))


def journal_nets(nets: DataFrame) -> DataFrame:
    """One row a journal, (journal_id, nets): its account keys and their nets in an array (key (account, sub), net), as long as the journal has keys."""
    return nets.groupBy("journal_id").agg(F.collect_list(F.struct(F.struct("account", "sub").alias("key"), "net")).alias("nets"))


def _let(value: Column, f) -> Column:
    """f of a value that is made once a row, also where f holds it in a function of array elements."""
    return F.transform(F.array(value), f)[0]


def resolve_bank(linked: DataFrame, nets: DataFrame, master: DataFrame | None = None, keep_nets: bool = False) -> DataFrame:
    """Adds bank_account, bank_sub and bank_method: voted for the sub-account, voted for the service, the one key of the
    line's amount, the current master's key; a vote needs MIN_SUPPORT and its key in the journal.

    All votes are counted in one pass, and rows meet their journal's nets once; keep_nets leaves them in the column nets for
    counter_labels.
    """
    levels = ("connected_sub_account_id", "connected_account_id")
    types = [nets.schema[c].dataType for c in ("account", "sub")]
    key_of = lambda a, s: F.struct(a.cast(types[0]).alias("account"), s.cast(types[1]).alias("sub"))
    votes = bank_candidates(linked, nets).groupBy("fiscal_year", *levels, "account", "sub").agg(F.count("*").alias("support"))
    out = linked.withColumn("_amount", oriented(F.col("value"), F.col("side")))
    for level, tag in zip(levels, ("a", "b")):
        m = _most_voted(votes, level).where(F.col("support") >= MIN_SUPPORT)
        m = m.select(F.col("fiscal_year").alias("_y"), F.col(level).alias("_l"), F.struct("account", "sub").alias(f"_{tag}"))
        # Null-safe, and nulls put out after: an inferred filter on the level would make each map count the votes for itself.
        out = out.join(m, F.col("fiscal_year").eqNullSafe(F.col("_y")) & F.col(level).eqNullSafe(F.col("_l")), "left").drop("_y", "_l")
        out = out.withColumn(f"_{tag}", F.when(F.col("fiscal_year").isNotNull() & F.col(level).isNotNull(), F.col(f"_{tag}")))
    if master is not None:
        out = out.join(master.select("connected_sub_account_id", key_of(F.col("account"), F.col("sub")).alias("_m")), "connected_sub_account_id", "left")
    else:
        none = key_of(F.lit(None), F.lit(None))
        out = out.withColumn("_m", F.when(F.lit(False), none))
    journal = W.partitionBy("journal_id")  # dealt and sorted by the join; a journal's line items, mostly one, share their candidates
    out = out.join(journal_nets(nets), "journal_id", "left").withColumn("_match", F.filter("nets", lambda n: n["net"] == F.col("_amount")))
    out = out.withColumn("_n", F.sum(F.array_size("_match")).over(journal)).withColumn("_c", F.min(F.array_min(F.col("_match")["key"])).over(journal))
    has = lambda c: F.coalesce(F.array_contains(F.col("nets")["key"], F.col(c)), F.lit(False))
    ways = (("fy_sub_account_map", has("_a"), "_a"), ("fy_service_map", has("_b"), "_b"), ("journal_amount", F.col("_n") == 1, "_c"), ("current_master", has("_m"), "_m"))
    way = F.lit("unresolved")
    for name, holds, _ in reversed(ways):
        way = F.when(holds, name).otherwise(way)
    out = out.withColumn("bank_method", way)
    key = F.coalesce(*(F.when(F.col("bank_method") == name, F.col(c)) for name, _, c in ways))
    kept = ["nets"] if keep_nets else []
    return out.select(*linked.columns, "bank_method", key["account"].alias("bank_account"), key["sub"].alias("bank_sub"), *kept)


def counter_labels(resolved: DataFrame, nets: DataFrame | None = None) -> DataFrame:
    """The other side of each resolved line item: label, label with subs, primary account, complexity.

    Keys with a net of zero vanish; negative ones get '-'; the primary is the largest positive, else the most negative one;
    equal amounts go by key. Labels are sorted by code point and joined by '|'; a missing sub-account reads None. Without nets
    the rows carry those of their journals in the column nets (resolve_bank, keep_nets).
    """
    r = resolved.where("bank_account is not null")
    if nets is not None:
        r = r.join(journal_nets(nets), "journal_id", "left")
    bank = F.struct(F.col("bank_account").alias("account"), F.col("bank_sub").alias("sub"))
    other = _let(F.struct(bank.alias("bank"), F.col("nets").alias("nets")), lambda x: F.filter(x["nets"], lambda n: ~n["key"].eqNullSafe(x["bank"]) & (n["net"] != 0)))
    # A net counts against the bank's: it is negative below zero for spending, and above it for the rest.
    spent = F.col("side") == "EXPENSE"
    each = lambda f: F.when(spent, F.transform("_other", lambda n: f(n, n["net"] < 0))).otherwise(F.transform("_other", lambda n: f(n, n["net"] > 0)))
    account = lambda n, less: F.concat(F.when(less, "-").otherwise(""), F.coalesce(n["key"]["account"].cast("string"), F.lit("None")))
    full = lambda n, less: F.concat(account(n, less), F.lit("/"), F.coalesce(n["key"]["sub"].cast("string"), F.lit("None")))
    first = lambda n, less: F.struct(less.alias("less"), (-F.abs(n["net"])).alias("m"), n["key"].alias("key"))
    negative = F.when(spent, F.array_min(F.col("_other")["net"]) < 0).otherwise(F.array_max(F.col("_other")["net"]) > 0)
    # A line item's id is its own; rows that repeat it share their counters, as they share the journal.
    item = W.partitionBy("journal_id", "transaction_id")
    joined = lambda f: F.array_join(F.sort_array(F.array_distinct(F.flatten(F.collect_set(each(f)).over(item)))), "|")
    out = r.withColumn("_other", other).withColumns({
        "_n": F.coalesce(F.sum(F.array_size("_other")).over(item), F.lit(0)), "_negative": F.coalesce(F.max(negative).over(item), F.lit(False)),
        "_account": joined(account), "_full": joined(full), "_p": F.min(F.array_min(each(first))).over(item)["key"],
    })
    any_ = lambda c: F.when(F.col("_n") > 0, F.col(c))
    return out.select(
        *(c for c in resolved.columns if c != "nets"), (F.col("_n") > 1).alias("complex_journal"), F.col("_n").alias("counter_count"), F.col("_negative").alias("has_negative_counter"),
        any_("_account").alias("label_account"), any_("_full").alias("label_account_sub"), F.col("_p.account").alias("primary_account"), F.col("_p.sub").alias("primary_sub"),
    )


def bank_net_by_value(tx: DataFrame, lines: DataFrame, null_safe: bool = False) -> DataFrame:
    """(transaction_id, journal_id, net) of the mapped sub-account's side, by value without tax.

    null_safe compares a missing sub-account with a missing one; otherwise a line item without one gets null.
    """
    j = tx.select("transaction_id", "side", "bank_sub").join(lines.drop("date"), "transaction_id")
    same = (lambda c: F.col(c).eqNullSafe(F.col("bank_sub"))) if null_safe else (lambda c: F.col(c) == F.col("bank_sub"))
    part = lambda c: F.sum(F.when(same(c), F.coalesce("value", F.lit(0))).otherwise(0))
    out = j.groupBy("transaction_id", "journal_id", "side", "bank_sub").agg(part("debit_sub").alias("dr"), part("credit_sub").alias("cr"))
    net = F.when(F.col("side") == "EXPENSE", F.col("cr") - F.col("dr")).otherwise(F.col("dr") - F.col("cr"))
    return out.select("transaction_id", "journal_id", (net if null_safe else F.when(F.col("bank_sub").isNotNull(), net)).alias("bank_net_amount"))


def training_pairs(tx: DataFrame, lines: DataFrame) -> DataFrame:
    """A row a (line item, journal branch): which side is the bank's, the bank's net, whether it is the line's amount."""
    nets = bank_net_by_value(tx, lines)
    per = lines.groupBy("transaction_id").agg(F.countDistinct("journal_id").alias("journals_per_transaction"))
    size = lines.groupBy("journal_id").agg(F.count("*").alias("branch_count"))
    out = tx.join(lines.drop("date").withColumnRenamed("value", "line_value"), "transaction_id").join(nets, ["transaction_id", "journal_id"]).join(per, "transaction_id").join(size, "journal_id")
    d, c = F.col("debit_sub") == F.col("bank_sub"), F.col("credit_sub") == F.col("bank_sub")
    out = out.withColumn("bank_side", F.when(d & c, "both").when(d, "debit").when(c, "credit").otherwise("none"))
    return out.withColumn("amount_matches_tx", F.col("bank_net_amount") == F.col("value"))


def pair_stats(tx: DataFrame, pairs: DataFrame) -> DataFrame:
    """One row of link statistics."""
    j = pairs.groupBy("transaction_id", "journal_id").agg(F.max("branch_count").alias("b"), F.bool_or("amount_matches_tx").alias("m"), F.count("*").alias("n"))
    s = j.agg(F.countDistinct("transaction_id").alias("transactions_linked"), F.count("*").alias("journals_linked"), F.count_if(F.col("b") > 1).alias("multi_branch_journals"), F.count_if("m").alias("amount_matches_tx"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows"))
    t = tx.agg(F.count("*").alias("transactions"))  # two single rows
    return t.join(s, F.lit(True)).withColumn("link_rate", rate(F.col("transactions_linked"), F.col("transactions")))


def enrich_line_items(tx: DataFrame, connected: DataFrame, journals: DataFrame, terms: DataFrame) -> DataFrame:
    """tx (transaction_id, date, connected_sub_account_id, ...) with the names of its connected account, its term, and
    linked_journal_count, 0 if none.

    connected: (connected_sub_account_id, ...), of equal ids the last by all its columns; journals: (transaction_id, journal_id).
    """
    names = [c for c in connected.columns if c != "connected_sub_account_id"]
    dim = connected.groupBy("connected_sub_account_id").agg(F.max(F.struct(*names)).alias("_c")).select("connected_sub_account_id", *(F.col(f"_c.{c}").alias(c) for c in names))
    links = journals.where("transaction_id is not null").groupBy("transaction_id").agg(F.count_distinct("journal_id").alias("_n"))
    out = tx.join(dim, "connected_sub_account_id", "left").join(links, "transaction_id", "left").withColumn("linked_journal_count", F.coalesce("_n", F.lit(0))).drop("_n")
    return with_term(out, terms)


def without_openings(journals: DataFrame, most: int | None = None) -> DataFrame:
    """Journals that are no opening entries, by entered_by; at most so many, the first by date and id, if a sample is asked for."""
    out = journals.where(~F.coalesce(F.col("entered_by") == "JOURNAL_TYPE_OPENING", F.lit(False)))
    return out if most is None else out.orderBy("date", "journal_id").limit(most)
