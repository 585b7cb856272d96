"""Language identification by rank-order profiles of letter n-grams and the out-of-place distance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import bound_batches, read_table, slices, text_or_empty

#: Lengths of n-grams; words are padded with one blank on either side.
ORDERS = 5
#: N-grams in a profile, of a language and of a document.
PROFILE = 400
#: A profile is learned from about so many rows of its language: rows are drawn by the hash of their id.
SAMPLE_PER_LANGUAGE = 3000
#: Characters that are counted at a time; longer texts are counted in parts and summed.
PART = 1 << 20
#: Keys that a learning task holds before it sums them up and hands them on.
HELD = 1 << 20
UNKNOWN = "und"

_letters = None


def _letter_table():
    """For each code point, itself plus one if it is a letter, else 0."""
    global _letters
    if _letters is None:
        import sys

        import numpy as np

        _letters = np.fromiter((c + 1 if chr(c).isalpha() else 0 for c in range(sys.maxunicode + 1)), dtype=np.uint32, count=sys.maxunicode + 1)
    return _letters


def ngram_counts(text: str, orders: int = ORDERS):
    """(keys, counts) of the n-grams of all words; a key is a 64-bit polynomial of the code points."""
    import numpy as np

    keys, counts = [], []
    at = 0
    while at < len(text):
        end = min(len(text), at + PART)
        while end < len(text) and text[end].isalpha() and end - at < 2 * PART:
            end += 1
        codes = _letter_table()[np.frombuffer(text[at:end].lower().encode("utf-32-le", "replace"), dtype=np.uint32)]
        at = end
        codes = np.concatenate(([0], codes, [0])).astype(np.uint64)
        letter = codes != 0
        if not letter.any():
            continue
        near = letter.copy()
        near[1:] |= letter[:-1]  # of a run of other characters one blank stays
        near[0] = True
        codes, letter = codes[near], letter[near]
        h = codes + np.uint64(1)  # a blank counts too, or a leading one would vanish
        found, inner = [h[letter]], None
        with np.errstate(over="ignore"):
            for n in range(2, orders + 1):
                h = h[:-1] * np.uint64(0x9E3779B97F4A7C15) + codes[n - 1 :] + np.uint64(1)
                if not len(h):
                    break
                if n == 2:
                    ok = letter[:-1] | letter[1:]
                else:
                    inner = letter[1:-1] if inner is None else inner[:-1] & letter[n - 2 : -1]
                    ok = inner
                found.append(h[ok])
        k, c = np.unique(np.concatenate(found), return_counts=True)
        keys.append(k)
        counts.append(c)
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if len(keys) == 1:
        return keys[0], counts[0]
    k, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    return k, np.bincount(inverse, weights=np.concatenate(counts)).astype(np.int64)


def top_ngrams(text: str, size: int = PROFILE, orders: int = ORDERS):
    """Keys of the text's most frequent n-grams, most frequent first; ties by key."""
    import numpy as np

    keys, counts = ngram_counts(text, orders)
    if len(keys) > size:
        least = np.partition(counts, len(counts) - size)[len(counts) - size]
        some = counts >= least
        keys, counts = keys[some], counts[some]
    return keys[np.argsort(-counts, kind="stable")[:size]]


def _count_batches(orders: int):
    """(lang, text) to (lang, key, n), counted over runs of rows of about HELD keys."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        def summed(sums):
            for lang, found in sums.items():
                k, inverse = np.unique(np.concatenate([x[0] for x in found]), return_inverse=True)
                n = np.bincount(inverse, weights=np.concatenate([x[1] for x in found])).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(k), pa.string()), pa.array(k.view(np.int64)), pa.array(n)], names=["lang", "key", "n"])

        sums: dict[str, list] = {}
        held = 0
        for batch in slices(batches, 1):
            for lang, text in zip(batch.column(0), batch.column(1), strict=True):
                k, c = ngram_counts(text.as_py(), orders)
                sums.setdefault(lang.as_py(), []).append((k, c))
                held += len(k)
                if held >= HELD:
                    yield from summed(sums)
                    sums, held = {}, 0
        yield from summed(sums)

    return run


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from: the CRC-32 of the id as text leaves 2 modulo 4; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def learn_profiles(labelled: DataFrame, sample: int = SAMPLE_PER_LANGUAGE, size: int = PROFILE, orders: int = ORDERS) -> list[tuple]:
    """(lang, key, rank) rows, at most `size` a language, from a frame (doc_id, lang, text) of rows to learn from.

    Languages with more than `sample` rows are learned from about that many, picked by the hash of the id.
    """
    bound_batches(labelled.sparkSession)
    totals = labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()
    if not totals:
        return []
    share = F.create_map(*(x for r in totals for x in (F.lit(r.lang), F.lit(min(1.0, sample / r.n)))))
    drawn = F.pmod(F.xxhash64("doc_id", F.lit("profile")), F.lit(1 << 30)) < share[F.col("lang")] * (1 << 30)
    counts = labelled.where(drawn).select("lang", "text").mapInArrow(_count_batches(orders), "lang string, key long, n long")
    counts = counts.groupBy("lang", "key").agg(F.sum("n").alias("n"))
    # The most frequent of each part, then of all parts: no window holds more than a part of a language.
    order = [F.desc("n"), F.col("key")]
    parts = counts.withColumn("part", F.pmod("key", F.lit(64)))
    parts = parts.withColumn("rank", F.row_number().over(W.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= size)
    ranks = parts.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= size)
    return [(r.lang, r.key, r["rank"] - 1) for r in ranks.select("lang", "key", "rank").collect()]


def _judge(profiles: list[tuple], size: int, orders: int):
    """text -> (language, score)."""
    import numpy as np

    langs = sorted({p[0] for p in profiles})
    keys = np.unique(np.array([p[1] for p in profiles], dtype=np.int64))
    ranks = np.full((len(keys) + 1, len(langs)), -1, dtype=np.int32)
    if profiles:
        at = np.searchsorted(keys, np.array([p[1] for p in profiles], dtype=np.int64))
        ranks[at, np.searchsorted(np.array(langs, dtype=object), np.array([p[0] for p in profiles], dtype=object))] = [p[2] for p in profiles]

    def judge(text):
        top = top_ngrams(text, size, orders).view(np.int64) if text else ()
        if not len(top) or not langs:
            return UNKNOWN, 0.0
        at = np.searchsorted(keys, top)
        at[(at == len(keys)) | (keys[np.minimum(at, len(keys) - 1)] != top)] = len(keys)
        there = ranks[at]
        away = np.where(there >= 0, np.abs(there - np.arange(len(top), dtype=np.int32)[:, None]), size).sum(axis=0)
        best = int(away.argmin())
        return langs[best], 1.0 - float(away[best]) / (size * len(top))

    return judge


def _predict(profiles: list[tuple], size: int, orders: int):
    def run(batches):
        import pyarrow as pa

        judge = _judge(profiles, size, orders)
        for batch in slices(batches, 1):
            found = [judge(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    return run


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE_PER_LANGUAGE, size: int = PROFILE, orders: int = ORDERS) -> DataFrame:
    """Per row of docs: doc_id, held_out, lang_pred, score.

    Profiles are learned from rows that are not held out and have a language and a text; only the text decides a
    prediction. A null text, a text without letters or a corpus without labels gives `und` and score 0. Languages at equal
    distance tie by name. Score is 1 less the distance as a share of the largest possible one. Rows that repeat are
    judged each; an empty table gives an empty one.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(F.col(text_col)).alias("text"), held_out(F.col(id_col)).alias("held_out"), F.col(lang_col).cast("string").alias("lang"))
    profiles = learn_profiles(rows.where("not held_out and lang is not null and text <> ''"), sample, size, orders)
    return rows.select("doc_id", "text", "held_out").mapInArrow(_predict(profiles, size, orders), f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(read_table(spark, sf_dir, "documents"))


#: A text that shares next to no n-grams with any profile is in none of the languages. Of 4,000 texts of sf0.1 the lowest score is
#: 0.27; other languages in Latin letters and random letters reach 0.11 to 0.16.
LEAST_SCORE = 0.2


def _keep(profiles: list[tuple], size: int, orders: int, text_at: int, least: float):
    def run(batches):
        import pyarrow as pa

        judge = _judge(profiles, size, orders)
        for batch in slices(batches, text_at):
            found = [judge(t.as_py()) for t in batch.column(text_at)]
            yield batch.filter(pa.array([lang != UNKNOWN and score >= least for lang, score in found], pa.bool_()))

    return run


def keep_identified(docs: DataFrame, least: float = LEAST_SCORE, sample: int = SAMPLE_PER_LANGUAGE, size: int = PROFILE, orders: int = ORDERS) -> DataFrame:
    """The rows of docs whose text is in a learned language: not `und`, and scored at least `least`. Columns stay, whatever else
    there is.

    Null texts and texts without letters go, as do all where nothing is labelled. Rows that repeat are judged each; a null id counts as
    empty text where rows to learn from are drawn. An empty table gives an empty one.
    """
    rows = docs.select("doc_id", text_or_empty(F.col("text")).alias("text"), held_out(F.col("doc_id")).alias("held_out"), F.col("lang").cast("string").alias("lang"))
    profiles = learn_profiles(rows.where("not held_out and lang is not null and text <> ''"), sample, size, orders)
    return docs.mapInArrow(_keep(profiles, size, orders, docs.columns.index("text"), least), docs.schema)
