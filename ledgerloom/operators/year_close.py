"""From a year's line items to its final journals: routing, review rows, decisions, overrides, status, and the closing checks.

Site rules (account families, keywords, funding, account names) are parameters. Frames are named in each function.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import nfkc, normalize, value_range
from . import checks as K
from . import close as C
from .ordering import numbered
from .routing import MODEL_LAYERS, classify, gate
from .similarity import static_predictions

RULE, MODEL, HUMAN = "rule_candidate", "model_auto_candidate", "human_review"
ROUTINGS = (RULE, MODEL, HUMAN)
CONFIRMED, UNDECIDED, INVALID, EXCLUDED, MERGED = "confirmed", "undecided", "invalid", "excluded", "merged"
#: Fundings without a journal of their own.
UNCONFIRMED, OTHER, BANK, PERSONAL = "unconfirmed", "other", "bank", "personal"


def lineage(sub_account: Column, service: Column, families: dict[str, str]) -> Column:
    """The family of a connected sub-account, "lineage:<family>" if its service belongs to one, else its own id."""
    out = F.when(F.lit(False), "")
    for family, name in families.items():
        out = out.when(service == name, F.lit(f"lineage:{family}"))
    return out.otherwise(sub_account.cast("string"))


def keyword_duplicate(content: Column, is_card: Column, keywords: list[str], exclude: list[str], ascii_only: bool = False) -> Column:
    """Whether a card's text holds one of the keywords and none of the excluded phrases, after NFKC and in capitals."""
    text = F.coalesce(content, F.lit(""))
    text = F.upper(text if ascii_only else nfkc(text))
    holds = lambda words: F.coalesce(F.greatest(F.lit(False), F.lit(False), *(F.contains(text, F.lit(w)) for w in words)), F.lit(False))
    return F.coalesce(is_card, F.lit(False)) & holds(keywords) & ~holds(exclude)


def account_kind(category: Column, group: Column, kinds: tuple[str, str, str] = ("bank", "liability", "other")) -> Column:
    """What kind of account a line item comes from, by the account's category and group; unknown accounts are other."""
    return F.when(category == "CASH_AND_DEPOSITS", kinds[0]).when(group == "LIABILITY", kinds[1]).otherwise(kinds[2])


def target_part(service: Column, excluded: list[str], duplicate: Column) -> Column:
    """excluded_service, duplicate_candidate or target, the first that holds."""
    return F.when(F.coalesce(service.isin(*excluded), F.lit(False)), "excluded_service").when(duplicate, "duplicate_candidate").otherwise("target")


def classify_targets(history: DataFrame, targets: DataFrame, level: str = "n4", ascii_only: bool = False) -> DataFrame:
    """Targets (id, day, content, account, ...) against a fixed history, with layer, account_seen and routing before any model.

    account is the lineage on both sides. High confidence with an account seen before is the rules' case; without, or with
    nothing known, a person's. Other layers that may be automatic go to the model.
    """
    p = classify(static_predictions(history, targets, level, ascii_only))
    seen = F.coalesce(F.col("account_seen"), F.lit(False))
    routing = F.when(F.col("high_confidence"), F.when(seen, RULE).otherwise(HUMAN)).when(F.col("layer").isin(*MODEL_LAYERS), "model").otherwise(HUMAN)
    return p.withColumn("routing", routing)


def review_rows(items: DataFrame, results: DataFrame, accounts: DataFrame, ascii_only: bool = False) -> DataFrame:
    """What a person reviews, one row a line item, in groups of equal routing, proposed account and normalized text.

    items: (transaction_id, date, content, amount, side, routing, pred, layer); results: (transaction_id, account_id, confidence,
    needs_review, insufficient); accounts: (account_id, name). Groups are numbered by routing, account name, text and first
    appearance by (date, id).
    """
    r = results.select("transaction_id", F.col("account_id").alias("_account"), F.col("confidence").alias("_confidence"), F.col("needs_review").alias("_review"), "insufficient")
    asked = F.col("routing") == "model"
    by_gate = gate(F.col("_confidence"), F.col("_review"), F.col("insufficient"), F.col("_account"), F.col("layer"))
    routing = F.when(asked, F.when(by_gate == "model", MODEL).otherwise(HUMAN)).otherwise(F.col("routing"))
    account = F.when(asked, F.col("_account")).otherwise(F.col("pred"))
    source = F.when(asked, "model").when(F.col("routing") == RULE, "rule").when(F.col("pred").isNotNull(), "rule_reference").otherwise("none")
    only = lambda c: F.when(F.col("source") == "model", F.col(c))
    rows = items.join(r, "transaction_id", "left").withColumns({"account_id": account, "source": source, "to": routing, "key": normalize(F.coalesce("content", F.lit("")), "n4", ascii_only)})
    rows = rows.withColumns({"routing": F.col("to"), "confidence": only("_confidence"), "needs_review": only("_review")})
    rows = rows.join(accounts.select("account_id", F.col("name").alias("_name")), "account_id", "left").withColumn("proposed_account", F.coalesce("_name", F.lit("")))
    rank = F.when(F.col("routing") == RULE, 0).when(F.col("routing") == MODEL, 1).otherwise(2)
    rows = rows.withColumn("_order", rank).withColumn("_id", F.coalesce("account_id", F.lit("")))
    groups = rows.groupBy("_order", "proposed_account", "_id", "key").agg(F.min(F.struct("date", "transaction_id")).alias("_first"), F.count("*").alias("group_size"))
    groups = numbered(groups, ["_order", "proposed_account"], ["key", "_first"], "review_group")
    out = rows.join(groups.select("_order", "proposed_account", "_id", "key", "review_group", "group_size"), ["_order", "proposed_account", "_id", "key"])
    return out.select("review_group", "group_size", "routing", "transaction_id", "date", "content", "amount", "side", "proposed_account", "account_id", "source", "confidence", "needs_review", "layer")


def past_summary(candidates: DataFrame) -> DataFrame:
    """(key, day, n, text) from candidates (key, day, rank, match, similarity, occurrences, labels): the uses and labels of the
    first candidate at 100, else no uses and the labels of the nearest one."""
    exact = F.col("similarity") == 100
    best = candidates.groupBy("key", "day").agg(F.min(F.struct(F.when(exact, 0).otherwise(1).alias("far"), "rank", "similarity", "match", "occurrences", "labels")).alias("c"))
    text = F.when(F.col("c.far") == 0, F.concat(F.lit("exact: "), "c.labels")).otherwise(F.concat(F.lit("similar "), F.col("c.similarity").cast("string"), F.lit(" "), "c.match", F.lit(": "), "c.labels"))
    return best.select("key", "day", F.when(F.col("c.far") == 0, F.col("c.occurrences")).otherwise(0).alias("n"), text.alias("text"))


def final_decision(recommendation: Column, routing: Column, proposed: Column, corrected: Column) -> Column:
    """struct(status, account_id, problem) of a reviewed group; corrected is the id behind the corrected name, null if unknown."""
    rec, empty = F.trim(F.coalesce(recommendation, F.lit(""))), F.coalesce(proposed, F.lit("")) == ""
    auto = F.coalesce(routing.isin(RULE, MODEL), F.lit(False))
    takes = (rec == "approve") | ((rec == "existing_auto_candidate") & auto)
    kind = T.StringType()
    is_ = lambda status, account=F.lit(None).cast(kind), problem=F.lit(None).cast(kind): F.struct(F.lit(status).alias("status"), account.cast(kind).alias("account_id"), problem.cast(kind).alias("problem"))
    return (
        F.when(rec == "exclude", is_(EXCLUDED)).when(takes & ~empty, is_(CONFIRMED, proposed)).when(takes, is_(INVALID, problem=F.lit("no proposed account")))
        .when((rec == "correct") & corrected.isNotNull(), is_(CONFIRMED, corrected)).when(rec == "correct", is_(INVALID, problem=F.lit("unknown account")))
        .when(rec == "existing_auto_candidate", is_(INVALID, problem=F.lit("not an automatic routing"))).when(rec == "ask", is_(UNDECIDED, problem=F.lit("open question")))
        .otherwise(is_(INVALID, problem=F.lit("unknown recommendation")))
    )


def resolve_overrides(overrides: DataFrame, tx: DataFrame, accounts: DataFrame, subs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(resolved, problems) of overrides (transaction_id, action, account, counter_sub_account, target_transaction_id, reason).

    resolved: (transaction_id, action, override_account_id, override_sub_id, merged_into, reason). problems: (transaction_id, action, problem);
    a close must not go on while there are any (see require_none). accounts: (account_id, name); subs: (sub_account_id, name).
    """
    named = accounts.groupBy(F.col("name").alias("account")).agg(F.min("account_id").alias("override_account_id"))
    subnamed = subs.groupBy(F.col("name").alias("counter_sub_account")).agg(F.min("sub_account_id").alias("override_sub_id"))
    o = overrides.withColumns({c: F.trim(F.coalesce(c, F.lit(""))) for c in ("action", "account", "counter_sub_account")})
    ids = tx.select("transaction_id").distinct()
    times = o.groupBy("transaction_id").agg(F.count("*").alias("_times"))
    gone = o.where("action = 'exclude'").select(F.col("transaction_id").alias("target_transaction_id"), F.lit(True).alias("_gone")).distinct()
    o = o.join(ids.withColumn("_known", F.lit(True)), "transaction_id", "left").join(times, "transaction_id").join(named, "account", "left").join(subnamed, "counter_sub_account", "left")
    o = o.join(ids.select(F.col("transaction_id").alias("target_transaction_id"), F.lit(True).alias("_target")), "target_transaction_id", "left").join(gone, "target_transaction_id", "left")
    act, merge = F.col("action"), F.col("action") == "merged_into"
    problem = (
        F.when(F.col("_known").isNull(), "unknown line item").when(~act.isin(*C.OVERRIDE_ACTIONS), "unknown action").when(F.col("_times") > 1, "repeated")
        .when((act == "set_counter_sub_account") & F.col("override_sub_id").isNull(), "unknown sub-account").when((act == "set_account") & F.col("override_account_id").isNull(), "unknown account")
        .when(merge & (F.col("_target").isNull() | (F.col("target_transaction_id") == F.col("transaction_id"))), "bad target").when(merge & F.col("_gone").isNotNull(), "target is excluded")
    )
    o = o.withColumn("problem", problem)
    used = lambda action, c: F.when(act == action, F.col(c))
    resolved = o.where("problem is null").select("transaction_id", "action", used("set_account", "override_account_id").alias("override_account_id"), used("set_counter_sub_account", "override_sub_id").alias("override_sub_id"), used("merged_into", "target_transaction_id").alias("merged_into"), "reason")
    return resolved, o.where("problem is not null").select("transaction_id", "action", "problem")


def require_none(problems: DataFrame, what: str) -> None:
    """Raises with the kinds of problems and their counts, never with values."""
    found = sorted((r.problem, r["count"]) for r in problems.groupBy("problem").count().collect())
    if found:
        raise ValueError(f"{what}: " + "; ".join(f"{p}: {n}" for p, n in found))


def proposal_status(funding: Column, side: Column, account: Column, status: Column, transfer_accounts: list[str]) -> Column:
    """How far a line item is from its journal before the final review; account: the decided one, else the proposed one."""
    card = funding != BANK
    return (
        F.when(funding == UNCONFIRMED, "funding_unconfirmed").when(funding == OTHER, "not_applicable").when((side == "INCOME") & card, "refund_review")
        .when(card & F.coalesce(account.isin(*transfer_accounts), F.lit(False)), "structure_review").when(F.coalesce(account, F.lit("")) == "", "no_proposed_account")
        .when(~F.coalesce(status == CONFIRMED, F.lit(False)), "awaiting_decision").otherwise("ready")
    )


def closing_rows(items: DataFrame, groups: DataFrame, overrides: DataFrame, accounts: DataFrame, transfer_accounts: list[str], deposit: str) -> DataFrame:
    """The final state of every line item: status, journal_status, account_id, sub_account_id, merged_into, needs_bankbook_review, problem.

    items: (transaction_id, date, amount, side, funding, review_group, ...); groups: (review_group, recommendation, routing,
    proposed, correction); overrides as resolve_overrides gives them. An override goes before the group's recommendation. An
    automatic refund on a card waits for a person unless one has confirmed it, as do accounts that would undo the transfer.
    """
    names = accounts.groupBy(F.col("name").alias("_correction")).agg(F.min("account_id").alias("_corrected"))
    g = groups.withColumn("_correction", F.trim("correction")).join(names, "_correction", "left")
    g = g.select("review_group", "recommendation", "routing", final_decision(F.col("recommendation"), F.col("routing"), F.col("proposed"), F.col("_corrected")).alias("d"))
    t = items.drop("routing").join(g, "review_group").join(overrides, "transaction_id", "left")
    act = F.coalesce("action", F.lit(""))
    status = F.when(act == "exclude", EXCLUDED).when(act == "merged_into", MERGED).when(act == "set_account", CONFIRMED).otherwise(F.col("d.status"))
    account = F.when(act == "exclude", F.lit(None)).when(act == "set_account", F.col("override_account_id")).otherwise(F.col("d.account_id"))
    t = t.withColumn("status", status).withColumn("account_id", account)
    card = F.col("funding") != BANK
    automatic = card & (F.col("side") == "INCOME") & (F.trim(F.coalesce("recommendation", F.lit(""))) == "existing_auto_candidate") & (act != "confirm_refund")
    journal = (
        F.when(F.col("status") == EXCLUDED, "excluded").when(F.col("status") == MERGED, "merged_transfer").when(F.col("status") != CONFIRMED, "undecided")
        .when(F.col("funding").isin(UNCONFIRMED, OTHER), "funding_unconfirmed").when(automatic, "refund_review")
        .when(card & F.col("account_id").isin(*transfer_accounts), "structure_review").otherwise("generated")
    )
    t = t.withColumn("journal_status", journal)
    problem = F.when(F.col("journal_status") == "refund_review", "automatic refund, not reviewed").when(F.col("journal_status") == "structure_review", "account would undo the transfer").when(act.isin("exclude", "merged_into"), F.concat(F.lit("override: "), F.coalesce("reason", F.lit("")))).when(act != "set_account", F.col("d.problem"))
    bankbook = (F.col("journal_status") == "generated") & (F.col("funding") == BANK) & F.coalesce(F.col("account_id") == deposit, F.lit(False)) & F.col("override_sub_id").isNull()
    keep = [c for c in items.columns if c != "routing"]
    return t.select(*keep, "recommendation", "routing", "action", "status", "journal_status", "account_id", F.col("override_sub_id").alias("sub_account_id"), "merged_into", bankbook.alias("needs_bankbook_review"), problem.alias("problem"))


def number_journals(journals: DataFrame) -> DataFrame:
    """journals (transaction_id, date, ...), one row a journal, with journal_no from 1 by (date, transaction_id)."""
    return numbered(journals, ["date"], ["transaction_id"], "journal_no")


def past_counter_accounts(history: DataFrame, deposit: str) -> DataFrame:
    """(sub_account, merchant, text): which sub-accounts past transfers of a merchant went to, most used first, ties to the
    name; history: (sub_account, merchant, date, account_id, counter_sub). A hint, never applied."""
    h = history.where((F.col("account_id") == deposit) & (F.coalesce("counter_sub", F.lit("")) != ""))
    n = h.groupBy("sub_account", "merchant", "counter_sub").agg(F.count("*").alias("n"), F.max("date").alias("last"))
    one = F.transform(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), "counter_sub", "last"))), lambda x: F.concat(x["counter_sub"], F.lit(" x"), (-x["m"]).cast("string"), F.lit(", last "), x["last"].cast("string")))
    return n.groupBy("sub_account", "merchant").agg(F.array_join(one, "; ").alias("text"))


def close_summary(rows: DataFrame, by: list[str]) -> DataFrame:
    """(field, value, n, amount): how many line items, and how much, each value of the given columns has; null as None."""
    one = F.explode(F.array(*(F.struct(F.lit(c).alias("field"), F.coalesce(F.col(c).cast("string"), F.lit("None")).alias("value")) for c in by)))
    return rows.select("amount", one.alias("_f")).groupBy("_f.field", "_f.value").agg(F.count("*").alias("n"), F.sum("amount").alias("amount"))


def prior_refunds(rows: DataFrame, history: DataFrame, noise: str = "", width: int = 12) -> DataFrame:
    """rows (amount, content, ...) whose amount and first `width` characters of text an earlier year's line item has."""
    head = lambda c: F.substring(F.trim(F.replace(F.coalesce(c, F.lit("")), F.lit(noise), F.lit("")) if noise else F.trim(F.coalesce(c, F.lit("")))), 1, width)
    past = history.select(F.col("amount").alias("_amount"), head(F.col("content")).alias("_head")).distinct()
    return rows.join(past, (F.col("amount") == F.col("_amount")) & (head(F.col("content")) == F.col("_head")), "left_semi")


def final_checks(rows: DataFrame, journals: DataFrame, start: str, end: str, payable: str = "payable") -> DataFrame:
    """The closing checks, one row each (check, level, result, count). rows: closing_rows; journals: one row a branch (journal_id,
    transaction_id, date, branch, debit, credit, debit_sub, credit_sub, amount, credit_amount, funding).

    A personally funded journal must move the payable within one sub-account and leave nothing there.
    """
    side = lambda s, sign, amount: F.struct(F.col(s).alias("account"), F.col(f"{s}_sub").alias("sub"), (F.lit(sign) * F.col(amount)).alias("v"))
    legs = journals.select("journal_id", "transaction_id", "funding", F.explode(F.array(side("debit", 1, "amount"), side("credit", -1, "credit_amount"))).alias("_l")).select("journal_id", "transaction_id", "funding", "_l.*")
    per = legs.groupBy("journal_id").agg(F.sum("v").alias("net"))
    total = legs.agg(F.sum("v").alias("net"))
    made = journals.select("transaction_id").distinct()
    off = rows.where(F.col("status").isin(EXCLUDED, MERGED))
    due = rows.where(~F.col("status").isin(EXCLUDED, MERGED) & (F.col("journal_status") != "generated"))
    personal = legs.where((F.col("funding") == PERSONAL) & (F.col("account") == payable)).groupBy("journal_id", "sub").agg(F.sum("v").alias("net"))
    all_personal = journals.where(F.col("funding") == PERSONAL).select("journal_id").distinct()
    bad = personal.groupBy("journal_id").agg(F.bool_and((F.col("net") == 0) & F.col("sub").isNotNull()).alias("ok"))
    several = journals.groupBy("transaction_id").agg(F.count_distinct("journal_id").alias("n")).where("n > 1")
    return K.report(
        K.check("journals balance", per.where("net <> 0").select("net").union(total.where("net <> 0"))),
        K.row_checks(journals, {"no zero or negative amounts": (F.col("amount") > 0) & (F.col("credit_amount") > 0), "within the year": F.col("date").between(start, end)}),
        K.check("excluded and merged items have no journal", off.join(made, "transaction_id", "left_semi")),
        K.check("every other item has a journal", due),
        K.check("merge targets have a journal", rows.where(F.col("status") == MERGED).select(F.col("merged_into").alias("transaction_id")).join(made, "transaction_id", "left_anti")),
        K.check("no open questions", rows.where(F.trim("recommendation") == "ask")),
        K.check("the payable nets to zero in one sub-account", all_personal.join(bad.where("ok"), "journal_id", "left_anti")),
        K.check("one journal a line item", several),
    )


def closing_warnings(rows: DataFrame, journals: DataFrame, history: DataFrame, overrides: DataFrame, deposit: str, days: int = 3, noise: str = "") -> DataFrame:
    """Warnings of a close, one row each (check, level, result, count): they need a look, and don't stop it.

    rows: closing_rows with content and sub_account; journals as in final_checks; history: (amount, content) of earlier years;
    overrides: (transaction_id, action). A refund of an earlier purchase may be left out if an override says so.
    """
    own = journals.where((F.col("debit") == deposit) & (F.col("credit") == deposit)).select("transaction_id").distinct()
    transfers = rows.join(own, "transaction_id", "left_semi").select("transaction_id", "amount", "date", "side", F.col("connected_account").alias("account"))
    refunds = prior_refunds(rows.where((F.col("side") == "INCOME") & (F.col("funding") != BANK)), history, noise)
    left_out = refunds.where(F.col("status") == EXCLUDED)
    said = overrides.where("action = 'exclude'").select("transaction_id").distinct()
    return K.report(
        K.check("a transfer is journaled from both accounts", C.transfer_pairs(transfers, days), "warning"),
        K.check("refunds of earlier years are left out", left_out.join(said, "transaction_id", "left_anti"), "warning"),
        K.check("refunds of earlier years are left out as told", left_out.join(said, "transaction_id", "left_semi"), "info"),
        K.check("refunds of earlier years are journaled", refunds.where(F.col("journal_status").isin("generated", "refund_review")), "warning"),
        K.check("transfers need the bank book", rows.where("needs_bankbook_review"), "info"),
    )


def group_report(rows: DataFrame, past: DataFrame) -> DataFrame:
    """What a person sees of each review group, one row a (routing, merchant, account): the texts with their counts, most frequent
    first, sides, sources, layers, ranges of date, amount and confidence, the most past uses, and the representative's past.

    rows: review_rows with merchant; past: (transaction_id, past_n, past_text). A group's texts are counted before they are joined;
    the representative has the highest confidence, then the latest date, then the smallest id.
    """
    r = rows.join(past, "transaction_id", "left")
    by = ["routing", "merchant", "account_id"]
    texts = r.groupBy(*by, "content").agg(F.count("*").alias("n"), F.min(F.struct("date", "transaction_id")).alias("first"))
    one = F.transform(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), "first", "content"))), lambda x: F.when(x["m"] < -1, F.concat(x["content"], F.lit(" x"), (-x["m"]).cast("string"))).otherwise(x["content"]))
    texts = texts.groupBy(*by).agg(F.array_join(one, " | ").alias("descriptions"))
    words = lambda c: F.array_join(F.array_sort(F.collect_set(c)), "/").alias(c)
    rep = F.min(F.struct(-F.coalesce("confidence", F.lit(-1.0)), -F.unix_date("date"), "transaction_id", "content", "past_text"))
    span = lambda c: value_range(F.min(c), F.max(c)).alias(f"{c}_range")
    g = r.groupBy(*by).agg(
        F.count("*").alias("size"), F.sum("amount").alias("total"), span("date"), span("amount"), span("confidence"), words("side"), words("source"), words("layer"),
        F.coalesce(F.max("past_n"), F.lit(0)).alias("past_uses"), F.count_if("needs_review").alias("needs_review"), rep.alias("_r"),
    )
    other = g.groupBy("routing", "merchant").agg((F.count("*") - 1).alias("other_groups"))
    same = lambda a, b: F.col(f"g.{a}").eqNullSafe(F.col(f"t.{b}"))
    out = g.alias("g").join(texts.alias("t"), same("routing", "routing") & same("merchant", "merchant") & same("account_id", "account_id")).select("g.*", "t.descriptions")
    out = out.join(other, ["routing", "merchant"])
    return out.select(*by, "size", "total", "date_range", "amount_range", "confidence_range", "side", "source", "layer", "past_uses", "needs_review", "other_groups", "descriptions", F.col("_r.content").alias("representative"), F.col("_r.past_text").alias("past_text"))
