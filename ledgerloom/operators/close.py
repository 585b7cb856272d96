"""Closing a year: review groups, decisions, journals, checks, duplicates, import layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_truncated, merchant_key, value_range
from .ordering import dense_numbers, numbered


def prefix_repair(keys: DataFrame, truncated: Column, least: int = 4) -> DataFrame:
    """(key, merchant): a truncated key takes the one full key that begins with it; others and ambiguous ones stay.

    The prefixes of the full keys, from `least` characters on, make it an equi-join.
    """
    k = keys.select("key", truncated.alias("cut")).groupBy("key").agg(F.bool_and("cut").alias("cut"))
    cut = k.where(F.col("cut") & (F.length("key") >= least)).select("key")
    full = k.where("not cut").select(F.col("key").alias("full"))
    long = full.where(F.length("full") >= least)
    pre = long.select("full", F.explode(F.sequence(F.lit(least), F.length("full"))).alias("len")).select("full", F.expr("substring(full, 1, len)").alias("key"))
    hit = cut.join(pre, "key").groupBy("key").agg(F.min("full").alias("full"), F.count("*").alias("n")).where("n = 1")
    return k.select("key").join(hit.select("key", "full"), "key", "left").select("key", F.coalesce("full", "key").alias("merchant"))


def with_merchants(rows: DataFrame, marker: str, noise: tuple[str, ...] = (), ascii_only: bool = False) -> DataFrame:
    """rows (content, ...) with `merchant`: the key of their text without noise, or the one full key that a cut-off text's key begins.

    marker tells a cut-off text. A null text has the empty key. Keys are repaired once each, not row by row.
    """
    keyed = rows.withColumn("_key", merchant_key(F.coalesce("content", F.lit("")), noise, ascii_only))
    repaired = prefix_repair(keyed.select(F.col("_key").alias("key"), is_truncated(F.col("content"), marker, ascii_only).alias("_cut")), F.col("_cut"))
    return keyed.join(repaired.withColumnRenamed("key", "_key"), "_key", "left").drop("_key")


def review_groups(rows: DataFrame) -> DataFrame:
    """Groups of (routing, merchant, account) with sizes, ranges, totals, a representative, and rank in the review order.

    rows: (transaction_id, routing, merchant, account, amount, date, confidence). The representative is the row of the
    highest confidence, then the earliest (date, id); the order is by routing, account size descending, account, highest confidence, merchant.
    Ranks are counted within an account, and only accounts meet in one task.
    """
    best = F.struct(F.coalesce(-F.col("confidence"), F.lit(1.0)).alias("c"), "date", "transaction_id")
    g = rows.groupBy("routing", "merchant", "account").agg(
        F.count("*").alias("size"), F.sum("amount").alias("total"), value_range(F.min("amount"), F.max("amount")).alias("amount_range"),
        value_range(F.min("date"), F.max("date")).alias("date_range"), F.max("confidence").alias("max_confidence"), F.min(best).alias("_b"),
    )
    sizes = g.groupBy(F.col("account").alias("_account")).agg(F.sum("size").alias("account_size"))
    g = g.join(sizes, F.col("account").eqNullSafe(F.col("_account")))
    g = numbered(g.withColumn("_size", -F.col("account_size")), ["routing", "_size", "account"], [F.desc("max_confidence"), "merchant"], "rank")
    return g.select("rank", "routing", "merchant", "account", "size", "total", "amount_range", "date_range", F.col("_b.transaction_id").alias("representative"), "account_size")


def expand_decisions(members: DataFrame, groups: DataFrame, accounts: DataFrame) -> DataFrame:
    """Each member's decision: its own over its group's. (transaction_id, status, account_id, problem).

    approve takes the proposed account, correct the named one (by id or name), hold and split wait, blank is undecided; a
    word or account that is not known is a problem.
    """
    m = members.join(groups.select("group_id", F.col("decision").alias("g_decision"), F.col("corrected").alias("g_corrected"), "proposed"), "group_id", "left")
    own = F.coalesce(F.trim("decision"), F.lit("")) != ""
    m = m.withColumn("_d", F.lower(F.trim(F.coalesce(F.when(own, F.col("decision")).otherwise(F.col("g_decision")), F.lit("")))))
    m = m.withColumn("_c", F.trim(F.when(own, F.col("corrected")).otherwise(F.col("g_corrected"))))
    named = accounts.select(F.col("account_id").alias("_k"), "account_id").union(accounts.select(F.col("name").alias("_k"), "account_id"))
    named = named.groupBy("_k").agg(F.min("account_id").alias("_found"))
    m = m.join(named, F.col("_c") == F.col("_k"), "left")
    d = F.col("_d")
    status = (
        F.when(d == "", "undecided").when(d == "approve", F.when(F.col("proposed").isNull(), "invalid").otherwise("approved"))
        .when(d == "correct", F.when(F.col("_found").isNull(), "invalid").otherwise("corrected")).when(d == "hold", "held").when(d == "split", "split").otherwise("invalid")
    )
    problem = F.when((d == "approve") & F.col("proposed").isNull(), "no proposed account").when((d == "correct") & F.col("_found").isNull(), "unknown account").when(~d.isin("", "approve", "correct", "hold", "split"), "unknown decision")
    return m.select("transaction_id", status.alias("status"), F.when(status == "approved", F.col("proposed")).when(status == "corrected", F.col("_found")).alias("account_id"), problem.alias("problem"))


def funding_source(df: DataFrame, rules: list[tuple[str, str, str]], default: str = "unconfirmed") -> Column:
    """The first rule (column, text, source) whose column holds the text, ignoring case."""
    out = F.when(F.lit(False), "")
    for column, text, source in rules:
        out = out.when(F.contains(F.lower(F.coalesce(F.col(column), F.lit(""))), F.lit(text.lower())), source)
    return out.otherwise(default)


def journal_branches(tx: DataFrame) -> DataFrame:
    """Double entries of decided line items (transaction_id, date, side, amount, account, funding, payable, loan).

    Spending debits the account and credits what funds it; income turns that around. A personally funded line adds a second
    branch that moves the payable to the loan account, so that the payable nets to zero within the journal.
    """
    spend = F.col("side") == "EXPENSE"
    leg = lambda d, c, n: F.struct(F.lit(n).alias("branch"), F.when(spend, d).otherwise(c).alias("debit"), F.when(spend, c).otherwise(d).alias("credit"))
    personal = F.col("funding") == "personal"
    via = F.when(personal, F.col("payable")).otherwise(F.col("funding"))
    two = F.array(leg(F.col("account"), via, 1), leg(F.col("payable"), F.col("loan"), 2))
    out = tx.withColumn("_b", F.explode(F.when(personal, two).otherwise(F.slice(two, 1, 1))))
    return out.select("transaction_id", "date", F.col("_b.branch").alias("branch"), F.col("_b.debit").alias("debit"), F.col("_b.credit").alias("credit"), "amount", "funding", "side")


def reconcile(branches: DataFrame) -> DataFrame:
    """By funding: journals, amount in and out, and the net of the payable and loan accounts over all branches."""
    one = F.col("branch") == 1
    net = lambda a: F.sum(F.when(F.col("debit") == a, F.col("amount")).otherwise(0) - F.when(F.col("credit") == a, F.col("amount")).otherwise(0))
    return branches.groupBy("funding").agg(
        F.count_if(one).alias("journals"), F.sum(F.when(one & (F.col("side") == "EXPENSE"), F.col("amount")).otherwise(0)).alias("out"),
        F.sum(F.when(one & (F.col("side") == "INCOME"), F.col("amount")).otherwise(0)).alias("in"), net("payable").alias("payable_net"), net("loan").alias("loan_net"),
    )


def legs(lines: DataFrame, by: str = "journal_id") -> DataFrame:
    """(journal, legs): the multiset of (side, account, sub, amount), one sorted text, however the lines split the sides."""
    one = lambda s: F.struct(F.lit(s[0].upper()).alias("side"), F.col(f"{s}_account").alias("account"), F.col(f"{s}_sub").alias("sub"))
    long = lines.withColumn("_l", F.explode(F.array(one("debit"), one("credit")))).where("_l.account is not null and _l.account <> '' and value <> 0")
    counted = long.groupBy(by, "_l.side", "_l.account", "_l.sub", "value").agg(F.count("*").alias("n"))
    text = F.concat_ws(":", "side", "account", F.coalesce(F.col("sub").cast("string"), F.lit("None")), F.col("value").cast("string"), F.col("n").cast("string"))
    return counted.groupBy(by).agg(F.array_join(F.array_sort(F.collect_list(text)), "|").alias("legs"))


def internal_duplicates(lines: DataFrame) -> DataFrame:
    """Groups of journals with equal date, legs and remark: (date, legs, remark, n, first, last)."""
    heads = lines.groupBy("journal_id").agg(F.min(F.struct("branch_index", "date", "remark")).alias("h"))
    j = legs(lines).join(heads, "journal_id")
    return j.groupBy("h.date", "legs", "h.remark").agg(F.count("*").alias("n"), F.min("journal_id").alias("first"), F.max("journal_id").alias("last")).where("n > 1")


def duplicate_candidates(new: DataFrame, old: DataFrame, days: int = 3) -> DataFrame:
    """(new_id, old_id, level): high for the same day and legs, medium for the same day and a shared (account, amount), low
    for up to `days` apart and a shared one.

    Journals of one day with the same (account, amount) pairs are a class, and only classes are compared: a pair and a span of twice days + 1
    days are the join key, an old class is in its own span, a new one looks in all that its days reach, and two classes are told under the
    least pair that they share, for which a row has the pairs before its own. Members join last, so that pairs of journals are not shuffled."""
    def journals(df, tag):
        one = lambda s: F.struct(F.col(f"{s}_account").alias("account"), F.col(f"{s}_sub").alias("sub"), F.col("value").alias("amount"), F.lit(s[0].upper()).alias("side"))
        there = lambda x: x["account"].isNotNull() & (x["account"] != "") & F.coalesce(x["amount"] != 0, F.lit(False))
        j = df.groupBy("journal_id").agg(F.min(F.struct("branch_index", "date"))["date"].alias("date"), F.filter(F.flatten(F.collect_list(F.array(one("debit"), one("credit")))), there).alias("_l")).where(F.size("_l") > 0)
        text = lambda x: F.concat_ws(":", x["side"], x["account"], F.coalesce(x["sub"].cast("string"), F.lit("None")), x["amount"].cast("string"))
        shared = F.array_sort(F.array_distinct(F.transform("_l", lambda x: F.struct(x["account"].alias("account"), x["amount"].alias("amount")))))
        j = j.where("date is not null").select(F.col("journal_id").alias(f"{tag}_id"), "date", shared.alias("shared"), F.unhex(F.md5(F.array_join(F.array_sort(F.transform("_l", text)), "|"))).alias(f"{tag}_legs"))
        return j.withColumn(f"{tag}_class", F.unhex(F.md5(F.to_json(F.struct("date", "shared")))))

    def classes(j, tag):
        c = j.groupBy(f"{tag}_class").agg(F.first("date").alias(f"{tag}_date"), F.first("shared").alias("shared"))
        return c.select("*", F.posexplode("shared").alias("i", "k")).withColumn(f"{tag}_before", F.slice("shared", 1, F.col("i"))).drop("shared", "i")

    span = lambda c, by=0: F.floor((F.unix_date(c) + by) / (2 * (days + 1)))
    a, b = journals(new, "new"), journals(old, "old")
    look = classes(a, "new").withColumn("span", F.explode(F.sequence(span("new_date", -days), span("new_date", days))))
    met = look.join(classes(b, "old").withColumn("span", span("old_date")), ["k", "span"]).where(F.abs(F.datediff("new_date", "old_date")) <= days)
    met = met.where(~F.arrays_overlap("new_before", "old_before")).select("new_class", "old_class", (F.col("new_date") == F.col("old_date")).alias("_same"))
    a, b = a.select("new_id", "new_class", "new_legs"), b.select("old_id", "old_class", "old_legs")
    p, same = met.join(a, "new_class").select("old_class", "new_id", "_same", F.when(F.col("_same"), F.col("new_legs")).alias("_legs")).join(b, "old_class"), F.col("_same")
    return p.select("new_id", "old_id", F.when(same & (F.col("_legs") == F.col("old_legs")), "high").when(same, "medium").otherwise("low").alias("level"))


def near_amounts(left: DataFrame, right: DataFrame, days: int) -> DataFrame:
    """left (id, amount, date) with n, the right rows of equal amount within so many days. Equal amounts are counted by day
    first, so that a common amount meets days, not rows."""
    daily = right.groupBy("amount", F.col("date").alias("_d")).agg(F.count("*").alias("_n"))
    at = left.select("amount", "date").distinct()
    n = at.join(daily, "amount").where(F.abs(F.datediff("date", "_d")) <= days).groupBy("amount", "date").agg(F.sum("_n").alias("n"))
    return left.join(n, ["amount", "date"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def transfer_pairs(tx: DataFrame, days: int = 3) -> DataFrame:
    """Line items (id, amount, date, side, account) that have one of equal amount, other side and other account nearby."""
    # By day and side, the least and largest other account: two of them tell whether one is not the line item's own.
    daily = tx.groupBy("amount", F.col("side").alias("_s"), F.col("date").alias("_d")).agg(F.min("account").alias("_low"), F.max("account").alias("_high"))
    at = tx.select("amount", "side", "account", "date").distinct()
    hit = at.join(daily, "amount").where((F.col("side") != F.col("_s")) & (F.abs(F.datediff("date", "_d")) <= days) & ((F.col("account") != F.col("_low")) | (F.col("account") != F.col("_high"))))
    return tx.join(hit.select("amount", "side", "account", "date").distinct(), ["amount", "side", "account", "date"], "left_semi").select(*tx.columns)


def import_layout(lines: DataFrame) -> DataFrame:
    """Journals renumbered from 1 by their numbers, branches in order, dates with slashes. Numbers are dense over the journals,
    counted in ranges of ids (see ordering)."""
    return lines.join(dense_numbers(lines, "journal_id"), "journal_id").select("no", "branch_index", F.date_format("date", "yyyy/MM/dd").alias("date"), "debit_account", "debit_sub", "credit_account", "credit_sub", "value", "tax_value")


def line_diff(a: DataFrame, b: DataFrame, key: list[str], fields: list[str]) -> DataFrame:
    """Rows of a and b that differ: the key, only_in (a, b or both) and the names of unequal fields."""
    l = a.select(*key, F.struct(*fields).alias("_l"))
    r = b.select(*key, F.struct(*fields).alias("_r"))
    j = l.join(r, key, "full")
    names = F.array_compact(F.array(*(F.when(~F.col(f"_l.{f}").eqNullSafe(F.col(f"_r.{f}")), F.lit(f)) for f in fields)))
    j = j.withColumn("only_in", F.when(F.col("_r").isNull(), "a").when(F.col("_l").isNull(), "b").otherwise("both")).withColumn("fields", F.array_join(names, ","))
    return j.where("only_in <> 'both' or fields <> ''").select(*key, "only_in", "fields")


def catalog_codes(accounts: DataFrame) -> DataFrame:
    """Available accounts coded A001, A002, ... by group, category and name; missing parts sort as empty."""
    a = accounts.where("available").withColumns({f"_{c}": F.coalesce(c, F.lit("")) for c in ("account_group", "category", "name")})
    return numbered(a, ["_account_group", "_category"], ["_name", "account_id"], "_no").withColumn("code", F.format_string("A%03d", "_no")).drop("_no", "_account_group", "_category", "_name")


OVERRIDE_ACTIONS = ("exclude", "set_account", "set_counter_sub_account", "confirm_refund", "merged_into")


def check_overrides(overrides: DataFrame, tx: DataFrame, accounts: DataFrame) -> DataFrame:
    """(transaction_id, action, problem) of overrides that must stop a close: repeated, unknown line item, action, account or
    merge target, or a merge into an excluded one."""
    ids = tx.select("transaction_id").distinct()
    o = overrides.join(ids.withColumn("_known", F.lit(True)), "transaction_id", "left")
    o = o.join(overrides.groupBy("transaction_id").agg(F.count("*").alias("_n")), "transaction_id", "left")
    o = o.join(accounts.select(F.col("name").alias("account"), F.lit(True).alias("_account")).distinct(), "account", "left")
    o = o.join(ids.select(F.col("transaction_id").alias("target_transaction_id"), F.lit(True).alias("_target")), "target_transaction_id", "left")
    gone = overrides.where("action = 'exclude'").select(F.col("transaction_id").alias("target_transaction_id"), F.lit(True).alias("_gone")).distinct()
    o = o.join(gone, "target_transaction_id", "left")
    merge, needs = F.col("action") == "merged_into", F.col("action").isin("set_account", "set_counter_sub_account")
    problem = (
        F.when(F.col("_n") > 1, "repeated").when(F.col("_known").isNull(), "unknown line item").when(~F.coalesce(F.col("action").isin(*OVERRIDE_ACTIONS), F.lit(False)), "unknown action")
        .when(needs & F.col("_account").isNull(), "unknown account").when(merge & F.col("_target").isNull(), "unknown target").when(merge & F.col("_gone").isNotNull(), "target is excluded")
    )
    return o.select("transaction_id", "action", problem.alias("problem")).where("problem is not null")
