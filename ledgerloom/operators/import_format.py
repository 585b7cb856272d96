"""The import file of journals: layout, reading back, and the checks that a file says what its journals say.

Journal lines: (journal_no, branch, transaction_id, date, debit_account, debit_sub, debit_tax, debit_amount, debit_tax_value, the same
for credit, remark), one row a branch.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from . import checks as K
from .close import legs
from .ordering import dense_numbers

# The columns of the import layout in their order, and those that must be blank.
COLUMNS = [
    "取引No", "取引日", "借方勘定科目", "借方補助科目", "借方部門", "借方取引先", "借方税区分", "借方インボイス", "借方金額(円)", "借方税額",
    "貸方勘定科目", "貸方補助科目", "貸方部門", "貸方取引先", "貸方税区分", "貸方インボイス", "貸方金額(円)", "貸方税額",
    "摘要", "仕訳メモ", "タグ", "MF仕訳タイプ", "決算整理仕訳", "作成日時", "作成者", "最終更新日時", "最終更新者",
]
BLANK_COLUMNS = [
    "借方部門", "借方取引先", "借方インボイス", "貸方部門", "貸方取引先", "貸方インボイス", "仕訳メモ",
    "タグ", "MF仕訳タイプ", "決算整理仕訳", "作成日時", "作成者", "最終更新日時", "最終更新者",
]
NO_TAX = "対象外"
# End of fixed values.

#: The journal-line field behind each column that is filled.
FILLED = {
    "借方勘定科目": "debit_account", "借方補助科目": "debit_sub", "借方税区分": "debit_tax", "借方金額(円)": "debit_amount", "借方税額": "debit_tax_value",
    "貸方勘定科目": "credit_account", "貸方補助科目": "credit_sub", "貸方税区分": "credit_tax", "貸方金額(円)": "credit_amount", "貸方税額": "credit_tax_value", "摘要": "remark",
}
AMOUNTS = ("debit_amount", "debit_tax_value", "credit_amount", "credit_tax_value")


def import_rows(lines: DataFrame) -> DataFrame:
    """The 27 columns, journals numbered from 1 by their numbers, with branch beside them for the order of rows."""
    numbers = dense_numbers(lines, "journal_no", "_no")
    rows = lines.withColumn("journal_no", F.col("journal_no").cast("long")).join(numbers, "journal_no")
    filled = lambda c: F.coalesce(F.col(FILLED[c]).cast("long") if FILLED[c] in AMOUNTS else F.col(FILLED[c]).cast("string"), F.lit(0 if FILLED[c] in AMOUNTS else ""))
    special = {COLUMNS[0]: F.col("_no"), COLUMNS[1]: F.date_format("date", "yyyy/MM/dd")}
    return rows.select(*(special.get(c, filled(c) if c in FILLED else F.lit("")).alias(c) for c in COLUMNS), F.col("branch").cast("long").alias("branch"))


def journal_index(lines: DataFrame) -> DataFrame:
    """(no, journal_no, transaction_id, date): which import number each journal has, from its first branch."""
    first = lines.where(F.col("branch").cast("long") == 1).withColumn("journal_no", F.col("journal_no").cast("long"))
    return first.join(dense_numbers(lines, "journal_no", "no"), "journal_no").select("no", "journal_no", "transaction_id", "date")


def write_import_file(rows: DataFrame, path: str) -> None:
    """One UTF-8 file without byte order mark, LF, quotes where needed, journals and branches in order."""
    spark = rows.sparkSession
    folder = path + ".parts"
    rows.orderBy(COLUMNS[0], "branch").select(*COLUMNS).coalesce(1).write.mode("overwrite").csv(folder, header=True, lineSep="\n", emptyValue="", escape='"')
    jvm = spark.sparkContext._jvm
    fs_path = jvm.org.apache.hadoop.fs.Path
    fs = fs_path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    part = next(s.getPath() for s in fs.globStatus(fs_path(folder + "/part-*")))
    fs.delete(fs_path(path), False)
    if not fs.rename(part, fs_path(path)):
        raise OSError(f"cannot write {path}")
    fs.delete(fs_path(folder), True)


def read_import_file(spark: SparkSession, path: str) -> DataFrame:
    """The rows as texts, with `position`, their order in the file: an import file is read by one task."""
    return spark.read.csv(path, header=True, inferSchema=False, multiLine=True, escape='"').withColumn("position", F.monotonically_increasing_id())


def parse_rows(rows: DataFrame, position: str = "position") -> DataFrame:
    """Import or export rows to journal lines: no, branch (running within the journal in file order), fields, filled_blanks.

    Missing amounts are 0, other missing texts empty; filled_blanks lists columns that must be blank and are not.
    """
    number = F.col(f"`{COLUMNS[0]}`").cast("long")
    branch = F.row_number().over(W.partitionBy("no").orderBy(position))
    text = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    amount = lambda c: F.when(text(c) == "", F.lit(0).cast("long")).otherwise(F.col(f"`{c}`").cast("long"))
    blanks = F.filter(F.array(*(F.when(text(c) != "", F.lit(c)) for c in BLANK_COLUMNS if c in rows.columns)), lambda x: x.isNotNull())
    out = rows.select(number.alias("no"), F.col(position), F.replace(text(COLUMNS[1]), F.lit("/"), F.lit("-")).alias("date"), *((amount(c) if f in AMOUNTS else text(c)).alias(f) for c, f in FILLED.items()), blanks.alias("filled_blanks"), text(COLUMNS[1]).alias("written_date"))
    return out.withColumn("branch", branch).drop(position)


def group_journals(lines: DataFrame, by: str = "no") -> DataFrame:
    """(no, lines): each journal's lines in the order of their branches."""
    rest = [c for c in lines.columns if c not in (by, "branch")]
    return lines.groupBy(by).agg(F.array_sort(F.collect_list(F.struct("branch", *rest))).alias("lines"))


def net_by(lines: DataFrame, keys: list[str]) -> DataFrame:
    """Debit less credit by `account`, and by `sub` if asked for; sides without an account are left out."""
    one = lambda s, sign: F.struct(F.col(f"{s}_account").alias("account"), F.col(f"{s}_sub").alias("sub"), (F.lit(sign) * F.col(f"{s}_amount").cast("long")).alias("v"))
    long = lines.select(F.explode(F.array(one("debit", 1), one("credit", -1))).alias("_l")).select("_l.*").where("account is not null and account <> ''")
    return long.groupBy(*keys).agg(F.sum("v").alias("net"))


def net_differences(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Keys whose nets differ between two sets of lines; a key that one lacks counts as 0 there."""
    x = net_by(a, keys).select(*(F.coalesce(k, F.lit("")).alias(k) for k in keys), F.col("net").alias("a"))
    y = net_by(b, keys).select(*(F.coalesce(k, F.lit("")).alias(k) for k in keys), F.col("net").alias("b"))
    return x.join(y, keys, "full").fillna(0, ["a", "b"]).where("a <> b")


def file_checks(spark: SparkSession, path: str) -> DataFrame:
    """Header, encoding and line ends of one import file."""
    raw = spark.read.format("binaryFile").load(path).select("content")
    head = F.split_part(F.decode("content", "UTF-8"), F.lit("\n"), F.lit(1))
    bad = raw.select((head != ",".join(COLUMNS)).alias("header"), (F.hex(F.substring("content", 1, 3)) == "EFBBBF").alias("mark"), F.contains(F.decode("content", "UTF-8"), F.lit("\r")).alias("cr"))
    return K.report(K.check("columns in order", bad.where("header")), K.check("UTF-8 without mark, LF", bad.where("mark or cr")))


def _totals(back: DataFrame, source: DataFrame) -> DataFrame:
    """(check, count) of what sums over all lines tell: one pass over either side."""
    amounts = lambda lines: [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("debit_amount", "credit_amount")]
    flags = {"blank columns are blank": F.size("filled_blanks") > 0, "dates have slashes": ~F.col("written_date").rlike(r"^\d{4}/\d{2}/\d{2}$")}
    one = back.agg(*amounts(back), *(F.count_if(c).alias(k) for k, c in flags.items()), F.lit(1).alias("side"))
    both = one.unionByName(source.agg(*amounts(source), F.lit(-1).alias("side")), allowMissingColumns=True)
    apart = {f"{c.removesuffix('_amount')}s as in the source": F.sum(F.col("side") * F.col(c)) != 0 for c in ("debit_amount", "credit_amount")}
    uneven = {"debits equal credits": F.sum(F.when(F.col("side") == 1, F.col("debit_amount") - F.col("credit_amount"))) != 0}
    n = both.agg(*(c.cast("long").alias(k) for k, c in (apart | uneven).items()), *(F.sum(f"`{k}`").alias(k) for k in flags))
    return _long(n, [*apart, *uneven, *flags])


def _long(counts: DataFrame, names: list[str]) -> DataFrame:
    """One row of counts as rows (check, count)."""
    return counts.select(F.explode(F.array(*(F.struct(F.lit(k).alias("check"), F.coalesce(F.col(f"`{k}`"), F.lit(0)).cast("long").alias("count")) for k in names))).alias("_c")).select("_c.*")


def _by_journal(back: DataFrame, index: DataFrame) -> DataFrame:
    """(check, count) of what each journal's own lines tell, against the journals that are expected: one pass over the lines."""
    gap = (F.col("date") == "") | ((F.col("debit_amount") == 0) & (F.col("credit_amount") == 0)) | ((F.col("branch") == 1) & (F.trim("remark") == ""))
    mine = back.groupBy("no").agg((F.sum("debit_amount") != F.sum("credit_amount")).alias("uneven"), F.max(gap).alias("gap"), F.lit(1).alias("there"))
    expected = index.groupBy(F.col("no").alias("_no")).agg(F.count("*").alias("n"))
    both = mine.join(expected, F.col("no").eqNullSafe(F.col("_no")), "full")
    counts = {
        "every journal is there": F.sum(F.abs(F.coalesce("there", F.lit(0)) - F.coalesce("n", F.lit(0)))), "debits equal credits": F.count_if("uneven"),
        "date, amount and remark are there": F.count_if("gap"),
    }
    return _long(both.agg(*(c.alias(k) for k, c in counts.items())), [*counts])


def _by_account(back: DataFrame, source: DataFrame, accounts: DataFrame, subs: DataFrame, tax: str) -> DataFrame:
    """(check, count) of what the sides tell, by account and sub-account: one pass over the lines, and one over the source's."""
    side = lambda s, sign: F.struct(F.col(f"{s}_account").alias("account"), F.col(f"{s}_sub").alias("sub"), F.col(f"{s}_tax").alias("tax"), F.col(f"{s}_tax_value").alias("tax_value"), F.col(f"{s}_amount").cast("long").alias("amount"), F.lit(sign).alias("sign"))
    sides = back.select(F.explode(F.array(side("debit", 1), side("credit", -1))).alias("_s")).select("_s.*").where("account <> ''")
    mine = sides.groupBy("account", F.coalesce("sub", F.lit("")).alias("sub")).agg(
        F.sum(F.col("sign") * F.col("amount")).alias("a"), F.count_if((F.coalesce("tax", F.lit("")) != tax) | (F.col("tax_value") != 0)).alias("taxed"), F.count_if(F.col("amount") <= 0).alias("empty"), F.lit(True).alias("used"),
    )
    theirs = net_by(source, ["account", "sub"]).groupBy("account", F.coalesce("sub", F.lit("")).alias("sub")).agg(F.sum("net").alias("b"))
    known = accounts.groupBy(F.col("name").alias("account")).agg(F.min("account_id").alias("account_id"))
    named = subs.groupBy("account_id", F.col("name").alias("sub")).agg(F.count("*").alias("n"))
    pairs = mine.join(theirs, ["account", "sub"], "full").fillna(0, ["a", "b"]).join(known, "account", "left").join(named, ["account_id", "sub"], "left")
    wrong = F.col("used") & (F.col("account_id").isNull() | ((F.col("sub") != "") & (F.coalesce("n", F.lit(0)) != 1)))
    by = pairs.groupBy("account").agg((F.sum("a") != F.sum("b")).alias("apart"), F.count_if(F.col("a") != F.col("b")).alias("subs_apart"), F.count_if(wrong).alias("wrong"), F.sum("taxed").alias("taxed"), F.sum("empty").alias("empty"))
    counts = {
        "accounts net as in the source": F.count_if("apart"), "sub-accounts net as in the source": F.sum("subs_apart"), "accounts exist, sub-accounts are unique": F.sum("wrong"),
        "no tax": F.sum("taxed"), "no side without an amount": F.sum("empty"),
    }
    return _long(by.agg(*(c.alias(k) for k, c in counts.items())), [*counts])


def import_checks(back: DataFrame, source: DataFrame, index: DataFrame, accounts: DataFrame, subs: DataFrame, tx: DataFrame, tax: str = NO_TAX) -> DataFrame:
    """Checks of lines read back (parse_rows) against the source's lines, one row each (check, level, result, count).

    accounts: (account_id, name); subs: (sub_account_id, account_id, name); tx: (transaction_id, status, merged_into). The lines are read three times:
    over all of them, by journal and by account; checks that share a grouping are conditional sums of one aggregate.
    """
    ids = index.select("transaction_id").distinct()
    merged = tx.where("status = 'merged'")
    others = {
        "every journal is there": source.select("transaction_id").distinct().join(ids, "transaction_id", "left_anti"),
        "one journal a line item": index.groupBy("transaction_id").agg(F.count("*").alias("n")).where("n > 1"),
        "excluded items are not there": tx.where("status = 'excluded'").join(ids, "transaction_id", "left_semi"),
        "merged items are not there, their targets are": merged.select("transaction_id").join(ids, "transaction_id", "left_semi").union(merged.select(F.col("merged_into").alias("transaction_id")).join(ids, "transaction_id", "left_anti")),
    }
    parts = [_totals(back, source), _by_journal(back, index), _by_account(back, source, accounts, subs, tax), *(bad.agg(F.count("*").alias("count")).select(F.lit(k).alias("check"), "count") for k, bad in others.items())]
    n = reduce(DataFrame.unionByName, parts).groupBy("check").agg(F.sum("count").alias("count"))
    return n.select("check", F.lit("error").alias("level"), F.when(F.col("count") == 0, "pass").otherwise("fail").alias("result"), "count")


def expected_legs(lines: DataFrame, expected: DataFrame) -> DataFrame:
    """(transaction_id, problem) of line items whose journals lack the legs that a table (transaction_id, legs) expects; legs
    are written as `close.legs` writes them, and an empty text expects no journal."""
    l = lines.withColumnsRenamed({"transaction_id": "journal_id"}) if "journal_id" not in lines.columns else lines.drop("journal_id").withColumnRenamed("transaction_id", "journal_id")
    have = legs(l).select(F.col("journal_id").alias("transaction_id"), F.col("legs").alias("_have"))
    e = expected.join(have, "transaction_id", "left").withColumn("_have", F.coalesce("_have", F.lit("")))
    return e.where(F.col("_have") != F.coalesce("legs", F.lit(""))).select("transaction_id", F.when(F.col("_have") == "", "no journal").when(F.coalesce("legs", F.lit("")) == "", "a journal").otherwise("other legs").alias("problem"))


def covered(new: DataFrame, old: DataFrame, by: Column | str = "transaction_id") -> DataFrame:
    """Rows of new whose key the old books lack."""
    key = by if isinstance(by, Column) else F.col(by)
    return new.withColumn("_key", key).join(old.select(key.alias("_key")).distinct(), "_key", "left_anti").drop("_key")
