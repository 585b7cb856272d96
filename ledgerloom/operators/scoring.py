"""What leaves for an external model and what comes back: payloads, answers, budgets. The model itself is injected."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import amount_band, rate, sanitize

# How a payload names the direction of money, and why an answer says it was given.
DIRECTIONS = {"EXPENSE": "出金", "INCOME": "入金"}
REASON_CATEGORIES = ["exact_history", "similar_history", "content_semantics", "amount_or_direction", "insufficient_information"]
# End of fixed values.

#: Written tokens that go to a cache cost so much more than others.
CACHE_WRITE = 1.25
#: Counted tokens may exceed the estimate by this factor before a run is refused.
ESTIMATE_FACTOR = 2.0

#: An answer, as it is asked for and as it is read; only the code may be null in one.
ANSWER = T.StructType([
    T.StructField("primary_account_code", T.StringType()), T.StructField("confidence", T.DoubleType(), False), T.StructField("reason", T.StringType(), False),
    T.StructField("needs_review", T.BooleanType(), False), T.StructField("insufficient_information", T.BooleanType(), False), T.StructField("reason_category", T.StringType(), False),
])

JSON_KINDS = {"string": "string", "double": "number", "boolean": "boolean"}


def payload(content: Column, side: Column, value: Column, date: Column, kind: Column, candidates: Column) -> Column:
    """The least a model needs, as JSON with sorted keys: masked text, direction, amount band, date, account kind, candidates.

    Neither ids nor the answer are in it.
    """
    direction = F.coalesce(F.create_map(*(F.lit(x) for kv in DIRECTIONS.items() for x in kv))[side], side)
    item = F.struct(kind.alias("account_kind"), amount_band(value).alias("amount_band"), sanitize(content).alias("content"), date.cast("string").alias("date"), direction.alias("side"))
    return F.to_json(F.struct(candidates.alias("past_similar_transactions"), item.alias("transaction")), {"ignoreNullFields": "false"})


def system_text(catalog: DataFrame, instructions: str) -> DataFrame:
    """One row (text): the instructions and a line a code of the catalogue (code, name, group, category), in the order of codes.

    A catalogue has some hundred rows; missing values are empty.
    """
    fields = ["code", "name", "group", "category"]
    line = F.struct("code", F.concat_ws("\t", *(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in fields)).alias("line"))
    lines = F.array_join(F.transform(F.array_sort(F.collect_list(line)), lambda x: x["line"]), "\n")
    return catalog.agg(F.concat(F.lit(instructions), lines).alias("text"))


def prompt(body: Column, request: str) -> Column:
    """The request line and the payload."""
    return F.concat(F.lit(request + "\n"), body)


def answer_schema(codes: list[str], with_category: bool = False) -> dict:
    """The JSON schema of ANSWER, so that what is asked for is what parse_answers reads; codes: the catalogue's, some hundred at most."""
    allowed = {"primary_account_code": sorted(codes), "reason_category": REASON_CATEGORIES}

    def shape(field: T.StructField) -> dict:
        value = {"type": JSON_KINDS[field.dataType.simpleString()]} | ({"enum": allowed[field.name]} if field.name in allowed else {})
        return {"anyOf": [value, {"type": "null"}]} if field.nullable else value

    shapes = {field.name: shape(field) for field in ANSWER if with_category or field.name != "reason_category"}
    return {"type": "object", "properties": shapes, "required": [*shapes], "additionalProperties": False}


def parse_answers(answers: DataFrame, catalog: DataFrame) -> DataFrame:
    """answers (transaction_id, stop_reason, text) to (transaction_id, account_id, confidence, needs_review, insufficient, reason_category,
    reason, problem). catalog: (code, account_id). A problem must stop the run; null means none.
    """
    a = answers.withColumn("_a", F.from_json("text", ANSWER, {"mode": "PERMISSIVE"})).withColumn("_json", F.try_parse_json("text"))
    c = catalog.select(F.col("code").alias("_code"), F.col("account_id"))
    a = a.join(c, F.col("_a.primary_account_code") == F.col("_code"), "left")
    sure = F.col("_a.confidence")
    problem = (
        F.when(~F.coalesce(F.col("stop_reason") == "end_turn", F.lit(False)), "unexpected stop").when(F.col("text").isNull(), "no text").when(F.col("_json").isNull(), "not JSON")
        .when(F.col("_a.primary_account_code").isNotNull() & F.col("_code").isNull(), "unknown account code").when(sure.isNull() | ~sure.between(0.0, 1.0), "confidence out of range")
    )
    return a.select("transaction_id", "account_id", sure.alias("confidence"), "_a.needs_review", F.col("_a.insufficient_information").alias("insufficient"), "_a.reason_category", "_a.reason", problem.alias("problem"))


def cost(usage: DataFrame, prices: DataFrame) -> DataFrame:
    """usage (transaction_id, model, input, output, cache_write, cache_read) with cost; prices: (model, input_price, output_price,
    cache_price) a million tokens, a handful of rows."""
    p = prices.select("model", "input_price", "output_price", "cache_price")
    u = usage.join(p, "model", "left")
    total = F.col("input") * F.col("input_price") + F.col("cache_write") * F.col("input_price") * CACHE_WRITE + F.col("cache_read") * F.col("cache_price") + F.col("output") * F.col("output_price")
    return u.withColumn("cost", total / 1e6).drop("input_price", "output_price", "cache_price")


def budget(tokens: DataFrame, shared: int, expected_output: int, prices: tuple[float, float, float], max_cost: float) -> DataFrame:
    """One row: items, counted, estimated, cost_cached, cost_plain, problem; tokens: (transaction_id, counted, estimated).

    prices: input, output and cached input a million tokens. The shared part of every request is written to the cache once.
    """
    price_in, price_out, price_cache = prices
    t = tokens.agg(F.count("*").alias("items"), F.coalesce(F.sum("counted"), F.lit(0)).alias("counted"), F.coalesce(F.sum("estimated"), F.lit(0)).alias("estimated"))
    out = F.col("items") * expected_output * price_out
    cached = (F.col("counted") - F.col("items") * shared) * price_in + shared * price_in * CACHE_WRITE + F.greatest(F.col("items") - 1, F.lit(0)) * shared * price_cache + out
    t = t.withColumns({"cost_cached": F.round(cached / 1e6, 6), "cost_plain": F.round((F.col("counted") * price_in + out) / 1e6, 6)})
    problem = F.when(F.col("counted") > ESTIMATE_FACTOR * F.col("estimated"), "more tokens than estimated").when(F.col("cost_cached") > max_cost, "cost above the limit")
    return t.withColumn("problem", problem)


def _ask(scorer: Callable[[list[dict]], list[dict]], price: Callable[[dict], float] | None, left: float | None, key: str, columns: list[str]):
    """Frames of items to frames of answers, one item after the other; each with its cost, and the last one with an error if it ends early."""

    def run(frames: Iterator) -> Iterator:
        import pandas as pd

        spent, error = 0.0, None
        for frame in frames:
            answers = []
            for item in frame.to_dict("records") if error is None else ():
                if left is not None and spent > left:
                    error = OVER_LIMIT
                else:
                    try:
                        answer = scorer([item])[0]
                    except Exception as e:  # whatever it is, what has been paid for is kept; score_durably raises it
                        error = f"{type(e).__name__}: {e}"
                if error is not None:
                    answers.append({key: item[key], "_error": error})
                    break
                cost = price(answer) if price else 0.0
                spent += cost
                answers.append(answer | {"_cost": cost})
            if answers:
                rows = pd.DataFrame(answers, columns=[*columns, "_cost", "_error"]).astype(object)
                yield rows.where(rows.notna(), None)

    return run


OVER_LIMIT = "scoring costs more than its limit"


def scored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The answers that score_durably has committed under path, with their _cost; none if there is no such folder."""
    return _committed(spark, path, schema).where("_error is null").drop("_error", "_run")


def _committed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    whole = f"{schema}, _cost double, _error string, _run string"
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)
    return spark.read.schema(whole).json(path) if there else spark.createDataFrame([], whole)


def score_durably(
    items: DataFrame, scorer: Callable[[list[dict]], list[dict]], path: str, schema: str, key: str = "transaction_id", approved: bool = False,
    price: Callable[[dict], float] | None = None, max_cost: float | None = None, batch: int = 64, width: int = 1,
) -> DataFrame:
    """items through an injected scorer, in batches that are appended to path as JSON lines as they come; gives the committed answers.

    Items whose key has an answer there aren't asked again, so that a run that broke off is taken up where it ended. A scorer that fails ends its batch: the answers
    before it are committed with the others, then the error is raised. The limit is held against what all runs have committed and is
    looked at before every item, so that with width 1 no item is asked once the total is above it; with more, items asked
    at the same time in one batch don't know of each other's cost. A lost executor loses at most its share of one batch. Keys are unique; a null
    key has no answer that could be found again and is refused. Nothing runs without approval.
    """
    if not approved:
        raise PermissionError("scoring needs approval")
    spark, run_id = items.sparkSession, uuid.uuid4().hex
    columns = spark.createDataFrame([], schema).columns
    queue = f"{path.rstrip('/')}_queue_{run_id}"
    todo = items.join(scored(spark, path, schema).select(key).distinct(), key, "left_anti")
    # The queue is a written table: what is left must not change while answers arrive.
    todo.withColumn("_part", F.coalesce(F.col(key).cast("string"), F.raise_error(F.lit("an item without a key")).cast("string"))).write.parquet(queue)
    todo = spark.read.parquet(queue)
    parts = -(-todo.count() // batch)
    for part in range(parts):
        paid = _committed(spark, path, schema).agg(F.coalesce(F.sum("_cost"), F.lit(0.0)).alias("paid")).first().paid
        now = todo.where(F.pmod(F.xxhash64("_part"), F.lit(parts)) == part).drop("_part")
        answers = now.repartition(width, key).sortWithinPartitions(key).mapInPandas(_ask(scorer, price, None if max_cost is None else max_cost - paid, key, columns), f"{schema}, _cost double, _error string")
        answers.withColumn("_run", F.lit(run_id)).write.mode("append").json(path)
        failed = _committed(spark, path, schema).where((F.col("_run") == run_id) & F.col("_error").isNotNull()).first()
        if failed:
            break
    else:
        failed = None
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(queue)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    if failed:
        raise RuntimeError(failed["_error"])
    return scored(spark, path, schema)


def score(items: DataFrame, scorer: Callable[[list[dict]], list[dict]], schema: str, approved: bool = False, price: Callable[[dict], float] | None = None, max_cost: float | None = None) -> DataFrame:
    """items through an injected scorer within a plan, one after the other within a partition, without retry or fallback.

    Nothing runs without approval. A partition stops with an error once its own answers cost more than max_cost; for paid answers, which must outlive an
    error, and for a limit on the total see score_durably.
    """
    if not approved:
        raise PermissionError("scoring needs approval")
    key, columns = items.columns[0], items.sparkSession.createDataFrame([], schema).columns

    def run(frames: Iterator) -> Iterator:
        for frame in _ask(scorer, price, max_cost, key, columns)(frames):
            if frame["_error"].notna().any():
                raise RuntimeError(frame["_error"].dropna().iloc[0])
            yield frame.drop(columns=["_cost", "_error"])

    return items.mapInPandas(run, schema)


def score_bands(scored: DataFrame, by: str) -> DataFrame:
    """By a column: n, right, accuracy and mean confidence of scored items (ok, confidence)."""
    g = scored.groupBy(by).agg(F.count("*").alias("n"), F.count_if("ok").alias("right"), F.avg("confidence").alias("_c"))
    return g.select(by, "n", "right", rate(F.col("right"), F.col("n")).alias("accuracy"), F.round("_c", 4).alias("mean_confidence"))
