"""Data quality: metrics by year with a total, and field profiles that never show values."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import EMAIL, LONG_DIGITS, PHONE_LOOSE, rate


def with_total(df: DataFrame, by: str, *aggs) -> DataFrame:
    """Aggregates by a column, and once over all with 'total' in its place: one pass, a one-level rollup."""
    out = df.where(F.col(by).isNotNull()).rollup(by).agg(*aggs, F.grouping_id().alias("_g"))
    return out.withColumn(by, F.when(F.col("_g") == 1, "total").otherwise(F.col(by).cast("string"))).drop("_g")


def line_item_quality(tx: DataFrame) -> DataFrame:
    """Metrics by fiscal year and in total. tx: (fiscal_year, status, side, content, journals, amount_match); how often a content
    occurs is counted over all years."""
    c = F.trim(F.coalesce("content", F.lit("")))
    seen = tx.where(c != "").groupBy(c.alias("_c")).agg(F.count("*").alias("_n"))
    t = tx.withColumn("_c", c).join(seen, "_c", "left")
    linked = F.col("journals") > 0
    n = with_total(
        t, "fiscal_year", F.count("*").alias("transactions"), F.count_if(linked).alias("linked"), F.count_if(F.col("journals") > 1).alias("multi_journal"),
        F.count_if(linked & F.col("amount_match")).alias("amount_match"), F.count_if(F.col("_c") != "").alias("content_present"),
        F.count_if(F.col("_n") > 1).alias("content_repeated"), F.count_if(F.col("_n") == 1).alias("content_unique"), F.count_if(F.col("side") == "INCOME").alias("income"),
    )
    return n.withColumns({"linked_rate": rate(F.col("linked"), F.col("transactions")), "amount_match_rate": rate(F.col("amount_match"), F.col("linked")), "content_rate": rate(F.col("content_present"), F.col("transactions"))})


OPENING = "JOURNAL_TYPE_OPENING"
JOURNALIZED = ("registered", "modified", "new_voucher_attached")


def has_partner(branches: Column) -> Column:
    """Whether any side of any branch names a trade partner, by code or name."""
    named = lambda side: (F.coalesce(side["trade_partner_code"], F.lit("")) != "") | (F.coalesce(side["trade_partner_name"], F.lit("")) != "")
    none = F.lit(False)
    return F.coalesce(F.exists(branches, lambda b: F.coalesce(named(b["debitor"]), none) | F.coalesce(named(b["creditor"]), none)), none)


def bank_side_net(journals: DataFrame, tx: DataFrame) -> DataFrame:
    """(transaction_id, net): what all journals of a line item move on its bank side, null-safe in the sub-account.

    Journals without any side move nothing: a line item that has no others gets no row. journals: (transaction_id, branches); tx: (transaction_id, side, bank_sub). Spending counts credit less debit, income the other way.
    """
    b = journals.where("transaction_id is not null").select("transaction_id", F.explode("branches").alias("b"))
    side = lambda s, sign: F.when(F.col(f"b.{s}").isNotNull(), F.struct(F.col(f"b.{s}.sub_account_id").alias("sub"), (F.lit(sign) * F.coalesce(F.col(f"b.{s}.value"), F.lit(0))).alias("v")))
    legs = b.select("transaction_id", F.explode(F.array_compact(F.array(side("debitor", 1), side("creditor", -1)))).alias("l")).groupBy("transaction_id", "l.sub").agg(F.sum("l.v").alias("v"))
    t = tx.select("transaction_id", "side", "bank_sub").join(legs, "transaction_id")
    signed = F.when(F.col("side") == "EXPENSE", -F.col("v")).otherwise(F.col("v"))
    return t.groupBy("transaction_id").agg(F.sum(F.when(F.col("sub").eqNullSafe(F.col("bank_sub")), signed).otherwise(0)).alias("net"))


def journal_quality(journals: DataFrame, tx: DataFrame) -> DataFrame:
    """Metrics of journals by fiscal year and in total. journals: (journal_id, fiscal_year, entered_by, transaction_id, branches);
    opening entries count only in journals_total."""
    known = tx.select("transaction_id").distinct().withColumn("_known", F.lit(True))
    j = journals.join(known, "transaction_id", "left")
    normal = ~F.coalesce(F.col("entered_by") == OPENING, F.lit(False))
    linked = normal & (F.coalesce(F.col("transaction_id").cast("string"), F.lit("")) != "")
    remark = normal & F.coalesce(F.exists("branches", lambda b: F.coalesce(b["remark"], F.lit("")) != ""), F.lit(False))
    partner = normal & has_partner(F.col("branches"))
    n = with_total(
        j, "fiscal_year", F.count("*").alias("journals_total"), F.count_if(normal).alias("journals_normal"), F.count_if(linked).alias("journals_with_transaction_id"),
        F.count_if(linked & F.col("_known")).alias("journals_with_transaction_id_matched"), F.count_if(normal & (F.size(F.coalesce("branches", F.array().cast(journals.schema["branches"].dataType))) > 1)).alias("journals_multi_branch"),
        F.count_if(remark).alias("journals_with_remark"), F.count_if(partner).alias("journals_with_trade_partner"),
    )
    return n.withColumns({"journals_with_remark_rate": rate(F.col("journals_with_remark"), F.col("journals_normal")), "journals_with_trade_partner_rate": rate(F.col("journals_with_trade_partner"), F.col("journals_normal"))})


def transaction_quality(journals: DataFrame, tx: DataFrame) -> DataFrame:
    """Metrics of line items by fiscal year and in total. tx: (transaction_id, fiscal_year, content, side, value, status, bank_sub);
    how often a content occurs is counted over all years, a repeated one once per year in content_repeated_distinct."""
    c = F.trim(F.coalesce("content", F.lit("")))
    seen = tx.where(c != "").groupBy(c.alias("_c")).agg(F.count("*").alias("_n"))
    links = journals.where("transaction_id is not null").groupBy("transaction_id").agg(F.count("*").alias("_journals"))
    t = tx.withColumn("_c", c).join(seen, "_c", "left").join(links, "transaction_id", "left").join(bank_side_net(journals, tx), "transaction_id", "left")
    linked, made = F.col("_journals").isNotNull(), F.coalesce(F.col("status").isin(*JOURNALIZED), F.lit(False))
    filled = F.col("_c") != ""
    n = with_total(
        t, "fiscal_year", F.count("*").alias("transactions"), F.count_if(made).alias("transactions_journalized"), F.count_if(linked).alias("transactions_linked"),
        F.count_if(made & linked).alias("_made_linked"), F.count_if(F.col("_journals") > 1).alias("transactions_multi_journal"),
        F.count_if(linked & F.coalesce(F.col("net") == F.col("value"), F.lit(False))).alias("transactions_amount_match"), F.count_if(filled).alias("content_present"), F.count_if(~filled).alias("content_empty"),
        F.count_if(F.col("_n") > 1).alias("content_repeated_rows"), F.count_distinct(F.when(F.col("_n") > 1, F.col("_c"))).alias("content_repeated_distinct"), F.count_if(F.col("_n") == 1).alias("content_unique_rows"),
    )
    return n.withColumns({
        "transactions_linked_rate": rate(F.col("transactions_linked"), F.col("transactions")), "transactions_linked_rate_of_journalized": rate(F.col("_made_linked"), F.col("transactions_journalized")),
        "transactions_amount_match_rate": rate(F.col("transactions_amount_match"), F.col("transactions_linked")), "content_present_rate": rate(F.col("content_present"), F.col("transactions")),
    }).drop("_made_linked")


def year_counts(df: DataFrame, column: str, metric: str) -> DataFrame:
    """(fiscal_year, metric, value, n): a histogram by year and in total, a missing value as the text None."""
    d = df.where("fiscal_year is not null").withColumn("_v", F.coalesce(F.col(column).cast("string"), F.lit("None")))
    total = d.groupBy("_v").agg(F.count("*").alias("n")).withColumn("fiscal_year", F.lit("total"))
    years = d.groupBy(F.col("fiscal_year").cast("string").alias("fiscal_year"), "_v").agg(F.count("*").alias("n"))
    return years.unionByName(total).select("fiscal_year", F.lit(metric).alias("metric"), F.col("_v").alias("value"), "n")


def quality_metrics(journals: DataFrame, tx: DataFrame) -> DataFrame:
    """All metrics, one row a year and the total: those of journals beside those of line items."""
    return journal_quality(journals, tx).join(transaction_quality(journals, tx), "fiscal_year", "full")


def pivot_report(metrics: DataFrame, rows: list[tuple[str, str | None, str | None]], years: list[str]) -> DataFrame:
    """(row, label, <year>...): metrics (fiscal_year, ...) with the years across, as texts: counts with thousands separators, a rate
    in per cent beside its count, "-" for neither. rows: (label, metric, rate), in order; years as fiscal_year has them."""
    count = lambda m: F.format_number(F.col(m).cast("long"), 0)
    share = lambda m: F.concat(F.format_number(F.col(m) * 100, 1), F.lit("%"))
    cells = []
    for i, (label, metric, ratio) in enumerate(rows):
        if metric and ratio:
            text = F.when(F.col(ratio).isNull(), count(metric)).otherwise(F.concat(count(metric), F.lit(" ("), share(ratio), F.lit(")")))
        else:
            text = count(metric) if metric else share(ratio)
        cells.append(F.struct(F.lit(i).alias("row"), F.lit(label).alias("label"), F.coalesce(text, F.lit("-")).alias("text")))
    long = metrics.select("fiscal_year", F.explode(F.array(*cells)).alias("_c")).select("fiscal_year", "_c.*")
    return long.groupBy("row", "label").pivot("fiscal_year", years).agg(F.first("text")).fillna("-")


def markdown(report: DataFrame, years: list[str]) -> str:
    """A pivoted report, some dozen rows, as a markdown table."""
    head = "| metric | " + " | ".join(years) + " |\n|---|" + "---:|" * len(years)
    return "\n".join([head, *("| " + " | ".join([r.label, *(r[y] for y in years)]) + " |" for r in report.orderBy("row").collect())])


def long_form(df: DataFrame, by: str, metrics: list[str]) -> DataFrame:
    return df.select(by, F.explode(F.array(*(F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics))).alias("_m")).select(by, "_m.*")


def _paths(schema: T.StructType, prefix: str = ""):
    for f in schema.fields:
        if isinstance(f.dataType, T.StructType):
            yield from _paths(f.dataType, f"{prefix}{f.name}.")
        else:
            yield prefix + f.name, f.dataType


def flatten(df: DataFrame) -> DataFrame:
    """Nested objects as dotted columns; arrays stay."""
    return df.select(*(F.col(".".join(f"`{p}`" for p in path.split("."))).alias(path) for path, _ in _paths(df.schema)))


def _leaves(schema: T.StructType, prefix: str = "", lists: tuple = ()):
    """(path, type, arrays to enter on the way): arrays are entered, their elements' fields follow after []."""
    for f in schema.fields:
        yield from _leaf(f.dataType, prefix + f.name, lists)


def _leaf(kind: T.DataType, path: str, lists: tuple):
    if isinstance(kind, T.ArrayType):
        yield path, kind, lists
        yield from _leaf(kind.elementType, path + "[]", (*lists, path))
    elif isinstance(kind, T.StructType):
        yield from _leaves(kind, path + ".", lists)
    else:
        yield path, kind, lists


def profile(df: DataFrame, date_field: str | None = None) -> DataFrame:
    """By field: type, present, non_empty, how many texts hold an e-mail, a phone number or 7 digits, and for date_field the
    first and last date. Objects and arrays are entered; an array counts itself, and its elements under "[]". Each level of
    arrays is one pass."""
    leaves = list(_leaves(df.schema))
    parts: dict[tuple, list] = {}
    for leaf in leaves:
        parts.setdefault(leaf[2], []).append(leaf)
    out = []
    for lists, fields in parts.items():
        rows, names = df, {}
        for i, array in enumerate(lists):
            rows = rows.withColumn(f"_in{i}", F.explode(_field(array, names)))
            names[array + "[]"] = f"_in{i}"
        out.append(_profile_level(rows, [(p, t, _field(p, names)) for p, t, _ in fields], date_field))
    return reduce(DataFrame.unionByName, out)


def _field(path: str, names: dict[str, str]) -> Column:
    """The column of a path whose arrays are exploded into the named columns."""
    base = max((a for a in names if path.startswith(a)), key=len, default="")
    rest = path[len(base) :].lstrip(".")
    quoted = [f"`{p}`" for p in ([names[base]] if base else []) + (rest.split(".") if rest else [])]
    return F.col(".".join(quoted))


def _profile_level(df: DataFrame, leaves: list, date_field: str | None) -> DataFrame:
    aggs = []
    for i, (p, t, c) in enumerate(leaves):
        empty = c.isNull() | ((c == "") if isinstance(t, T.StringType) else (F.size(c) == 0) if isinstance(t, T.ArrayType) else F.lit(False))
        text = c if isinstance(t, T.StringType) else F.lit(None).cast("string")
        hits = [F.count_if(text.rlike("(?U)" + r)).alias(f"{i}_{n}") for n, r in (("email", EMAIL), ("phone", PHONE_LOOSE), ("digits", LONG_DIGITS))]
        day = F.substring(c.cast("string"), 1, 10) if p == date_field else F.lit(None).cast("string")
        aggs += [F.count("*").alias(f"{i}_present"), F.count_if(~empty).alias(f"{i}_non_empty"), *hits, F.min(day).alias(f"{i}_first"), F.max(day).alias(f"{i}_last")]
    one = df.agg(*aggs)
    columns = ("present", "non_empty", "email", "phone", "digits", "first", "last")
    rows = [F.struct(F.lit(p).alias("field"), F.lit(t.simpleString()).alias("type"), *(F.col(f"{i}_{n}").alias(n) for n in columns)) for i, (p, t, _) in enumerate(leaves)]
    return one.select(F.explode(F.array(*rows)).alias("_r")).select("_r.*")


#: What a JSON value is, by the first character of its text; anything else is a number.
KINDS = {"{": "object", "[": "array", '"': "string", "n": "null", "t": "boolean", "f": "boolean"}


def json_depth(brackets: Column) -> Column:
    """How many objects and arrays lie within each other at most, by the brackets outside of texts."""
    step = lambda acc, c: F.struct((acc["now"] + F.when(c.isin("{", "["), 1).otherwise(-1)).alias("now"), F.greatest(acc["most"], acc["now"] + F.when(c.isin("{", "["), 1).otherwise(0)).alias("most"))
    return F.when(F.length(brackets) > 0, F.aggregate(F.split(brackets, ""), F.struct(F.lit(0).alias("now"), F.lit(0).alias("most")), step, lambda a: a["most"])).otherwise(0)


def json_brackets(text: Column) -> Column:
    """The brackets of a JSON text outside of its texts, in which a backslash escapes what follows."""
    return F.regexp_replace(text, r'(?:"[^"\\]*+(?:\\.[^"\\]*+)*+"|[^\[\]{}"]++)++|"', "")


def profile_json(df: DataFrame, text: str, date_field: str | None = None) -> DataFrame:
    """By field of JSON texts without a known schema: types (its kinds, joined by |), present, non_empty, how many texts hold an e-mail, a phone number
    or 7 digits, and for date_field the first and last date.

    Texts are parsed into variants once and entered level by level in the same pass, as deep as the deepest one; objects' fields follow after a dot,
    elements after []. A field may be another kind in any row. null, "", [] and {} are empty. Null texts and texts that are no JSON have no fields.
    """
    known = df.select(F.col(text).cast("string").alias("_json")).where("_json is not null")
    # Equal skeletons are walked once.
    depth = known.select(json_brackets(F.col("_json")).alias("_b")).distinct().agg(F.max(json_depth(F.col("_b")))).first()[0] or 0
    spark, rows = df.sparkSession, known.select(F.lit("").alias("field"), F.try_parse_json("_json").alias("whole"))
    path = F.when(F.col("key").isNull(), F.concat("field", F.lit("[]"))).when(F.col("field") == "", F.col("key")).otherwise(F.concat("field", F.lit("."), "key"))
    rows = spark.sql("SELECT field, e.key AS key, e.value AS value FROM {rows}, LATERAL variant_explode(whole) AS e", rows=rows).select(path.alias("field"), "value")
    rows = rows.withColumn("_text", F.to_json("value")).select("field", *_judged(F.col("value"), F.col("_text")), "value")
    for _ in range(depth - 1):
        # What is found stays as a row without a value; what has fields of its own is there once more, to be entered.
        enter = F.explode(F.when(F.col("value").isNotNull() & F.col("kind").isin("object", "array"), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False))))
        rows = rows.withColumn("enter", enter)
        rows = spark.sql("SELECT t.*, e.pos AS pos, e.key AS key, e.value AS inner FROM {rows} AS t, LATERAL variant_explode_outer(CASE WHEN enter THEN value END) AS e", rows=rows)
        rows = rows.where("NOT enter OR pos IS NOT NULL").withColumn("_text", F.when(F.col("enter"), F.to_json("inner")))
        fresh = zip(("kind", "non_empty", "text"), _judged(F.col("inner"), F.col("_text")), strict=True)
        rows = rows.select(F.when(F.col("enter"), path).otherwise(F.col("field")).alias("field"), *(F.when(F.col("enter"), c).otherwise(F.col(n)).alias(n) for n, c in fresh), F.when(F.col("enter"), F.col("inner")).alias("value"))
    t = F.col("text")
    # The shortest e-mail has an @, the shortest phone number and run of digits 7 characters.
    hits = [(t.contains("@") if n == "email" else F.length(t) >= 7) & t.rlike("(?U)" + r) for n, r in (("email", EMAIL), ("phone", PHONE_LOOSE), ("digits", LONG_DIGITS))]
    day = F.when(F.col("field") == date_field, F.substring(t, 1, 10)) if date_field else F.lit(None).cast("string")
    # Rows are counted by what is asked of them first: plain counts by few different keys.
    flags = ("non_empty", "email", "phone", "digits")
    alike = rows.select("field", "kind", *(F.coalesce(c, F.lit(False)).alias(n) for n, c in zip(flags, (F.col("non_empty"), *hits), strict=True)), day.alias("day"))
    alike = alike.groupBy(*alike.columns).agg(F.count("*").alias("n"))
    types = F.array_join(F.array_sort(F.collect_set("kind")), "|").alias("types")
    counts = [F.sum(F.when(F.col(n), F.col("n")).otherwise(0)).alias(n) for n in flags]
    return alike.groupBy("field").agg(types, F.sum("n").alias("present"), *counts, F.min("day").alias("first"), F.max("day").alias("last"))


def _judged(value: Column, text: Column) -> list[Column]:
    """kind, non_empty and, of strings, the text of a variant that reads `text` as JSON."""
    kinds = F.create_map(*(F.lit(x) for kv in KINDS.items() for x in kv))
    kind = F.coalesce(F.try_element_at(kinds, F.substring(text, 1, 1)), F.lit("number"))
    return [kind.alias("kind"), (~text.isin("null", '""', "[]", "{}")).alias("non_empty"), F.when(text.startswith('"'), F.try_variant_get(value, "$", "string")).alias("text")]


def summary_text(profiled: DataFrame) -> str:
    """A profile, one line a field, as text; it holds counts and dates only."""
    return "\n".join(f"{r.field}: {r.type}, {r.non_empty}/{r.present}" + (f", {r['first']} to {r['last']}" if r["first"] else "") for r in profiled.orderBy("field").collect())


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Histogram of an enumeration, a missing value as the text None."""
    return df.groupBy(F.coalesce(F.col(column).cast("string"), F.lit("None")).alias("value")).agg(F.count("*").alias("n"))
