"""Quality by a regularised quadratic discriminant over transformed statistics of documents.

A text is counted once into whole numbers (characters, words and lines by kind). A share of counts becomes the square root of the share after
some words of the corpus's own mixture have been added, which steadies short texts; lengths become logarithms. Each class has its mean and a covariance that
is shrunk towards the pooled one and towards a multiple of the unit matrix. The score is the logistic function of the difference of the
classes' log densities and priors, from Mahalanobis distances under Cholesky factors that are made once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, read_table, settled, slices

#: A document counts as label 1 from this score on.
LEAST_SCORE = 0.3
#: Weight of the pooled covariance in a class's, and then of the unit matrix.
POOLED, UNIT = 0.1, 0.03
#: Statistics are kept to 1/STEP, so that their sums of products are whole numbers, the same in any order of rows.
STEP = 1024
#: What is counted. The first three are sizes, in the logarithm of which lengths enter.
COUNTS = ["chars", "words", "lines", "upper", "digits", "symbols", "blanks", "stops", "foreign", "top_word", "repeats", "distinct", "lone_symbols", "odd_ends", "capitals", "short", "repeated_lines"]
#: The size of which each other count is a share, and how much of the corpus's mixture is added to that size.
SHARE_OF = {"upper": 0, "digits": 0, "symbols": 0, "blanks": 0, "stops": 0, "foreign": 0, "top_word": 1, "repeats": 1, "distinct": 1, "lone_symbols": 1, "odd_ends": 1, "capitals": 1, "short": 1, "repeated_lines": 2}
ADDED = (60.0, 10.0, 2.0)
#: The count of characters per word is a statistic too.
FEATURES = 2 + len(SHARE_OF) + 1


def count_text(text: str) -> list[int]:
    """COUNTS of a whole text. Letters are told from others in Latin-1; characters beyond it are `foreign`."""
    import collections
    import operator

    import numpy as np

    codes = np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)
    h = np.zeros(257, np.int64)
    for at in range(0, len(codes), 1 << 20):
        h += np.bincount(np.minimum(codes[at : at + (1 << 20)], 256), minlength=257)
    upper, lower = h[65:91].sum() + h[0xC0:0xDF].sum(), h[97:123].sum() + h[0xDF:0x100].sum()
    digits, blanks, stops = h[48:58].sum(), h[32] + h[9:14].sum(), h[44] + h[46]
    symbols = len(codes) - upper - lower - digits - blanks - stops - h[256]
    words, lines = text.split(), text.split("\n")
    kinds = collections.Counter(words)
    lone = odd = capitals = short = 0
    for w, n in kinds.items():
        if len(w) <= 3:
            short += n
        if not w[-1].isalnum() and w[-1] not in ".,":
            odd += n
            lone += n if len(w) == 1 else 0
        elif len(w) > 1 and w.isupper():
            capitals += n
    repeats = sum(map(operator.eq, words, words[1:]))
    return [int(x) for x in (len(codes), len(words), len(lines), upper, digits, symbols, blanks, stops, h[256], max(kinds.values(), default=0), repeats, len(kinds), lone, odd, capitals, short, len(lines) - len(set(lines)))]


def _count(batches):
    import pyarrow as pa

    for batch in slices(batches, 1):
        counts = [count_text(t.as_py()) for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(counts, pa.list_(pa.int64()))], names=["doc_id", "held_out", "counts"])


def transform(counts, totals):
    """Rows of FEATURES statistics from rows of counts; totals are those of the rows to learn from."""
    import numpy as np

    x, totals = np.asarray(counts, dtype=np.float64).reshape(-1, len(COUNTS)), np.asarray(totals, dtype=np.float64)
    out = [np.log1p(x[:, 0]) / 4, np.log1p(x[:, 1]) / 4]
    for name, size in SHARE_OF.items():
        at = COUNTS.index(name)
        usual = totals[at] / totals[size] if totals[size] else 0.0
        out.append(np.sqrt((x[:, at] + ADDED[size] * usual) / (x[:, size] + ADDED[size])))
    usual = totals[0] / totals[1] if totals[1] else 0.0
    out.append(np.log1p((x[:, 0] + ADDED[1] * usual) / (x[:, 1] + ADDED[1])))
    return np.round(np.stack(out, axis=1) * STEP).astype(np.int64)


def _moments(totals):
    """(quality, counts) to sums of the statistics, of their products and of ones, by class, as (quality, place, value) rows."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        sums = {}
        for batch in batches:
            labels = batch.column(0).to_numpy(zero_copy_only=False)
            x = transform(batch.column(1).flatten().to_numpy(zero_copy_only=False), totals)
            for k in np.unique(labels):
                part = np.concatenate((np.ones((int((labels == k).sum()), 1), np.int64), x[labels == k]), axis=1)
                sums[int(k)] = sums.get(int(k), 0) + part.T @ part
        for k, m in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([k] * m.size, pa.int32()), pa.array(range(m.size), pa.int32()), pa.array(m.ravel())], names=["quality", "place", "value"])

    return run


def fit(moments: dict[int, list[int]]):
    """{label: (mean, inverse Cholesky factor, constant)} from each class's (1 + FEATURES)^2 moments.

    A class's log density with its prior is the constant less half the squared length of factor @ (x - mean).
    """
    import numpy as np

    size = 1 + FEATURES
    m = {k: np.array(v, dtype=np.float64).reshape(size, size) for k, v in moments.items()}
    n = {k: v[0, 0] for k, v in m.items()}
    means = {k: v[0, 1:] / v[0, 0] / STEP for k, v in m.items()}
    spread = {k: v[1:, 1:] / v[0, 0] / STEP**2 - np.outer(means[k], means[k]) for k, v in m.items()}
    every = sum(n.values())
    pooled = sum(spread[k] * n[k] for k in m) / every
    mean = sum(means[k] * n[k] for k in m) / every
    total = pooled + sum(np.outer(means[k] - mean, means[k] - mean) * n[k] for k in m) / every
    scale = np.sqrt(np.diag(total)) + 1e-3  # shrinkage is of statistics on one scale
    model = {}
    for k in m:
        c = ((1 - POOLED) * spread[k] + POOLED * pooled) / np.outer(scale, scale)
        c = (1 - UNIT) * c + UNIT * max(np.trace(c) / FEATURES, 1e-3) * np.eye(FEATURES)
        low = np.linalg.cholesky(c)
        model[k] = (means[k], np.linalg.inv(low) / scale, float(np.log(n[k] / every) - np.log(np.diag(low)).sum()))
    return model


def score_counts(counts, totals, model):
    """Probability of label 1 for rows of counts; a class that nothing is labelled with is impossible, 0.5 without any."""
    import numpy as np

    x = transform(counts, totals) / STEP
    if len(model) < 2:
        return np.full(len(x), float(next(iter(model))) if model else 0.5)
    dense = [constant - 0.5 * (np.einsum("ij,kj->ki", factor, x - mean) ** 2).sum(axis=1) for mean, factor, constant in (model[0], model[1])]
    return 1.0 / (1.0 + np.exp(np.clip(dense[0] - dense[1], -700, 700)))


def _score(totals, model, least):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            s = score_counts(batch.column(2).flatten().to_numpy(zero_copy_only=False), totals, model)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(s), pa.array((s >= least).astype("int32"))], names=["doc_id", "held_out", "score", "predicted"])

    return run


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from: the CRC-32 of the id as text leaves 0 modulo 5; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def classify(docs: DataFrame, labels: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text", least: float = LEAST_SCORE) -> DataFrame:
    """Per row of docs: doc_id, held_out, score, predicted (1 from `least` on).

    Learned are all rows that are not held out and whose id has one quality, 0 or 1, in labels (doc_id, quality); an id with both, a null
    id and other values teach nothing. Only the text decides a score: a null text is an empty one, and empty texts have a score like any other. If
    only one class is labelled all scores are its label; if none is, 0.5. Rows that repeat are learned and scored each; an empty table gives an empty one.

    What goes to the driver are sums of fixed size: one a count, and a class's products of statistics.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), held_out(F.col(id_col)).alias("held_out"))
    counted = scratch.write(rows.mapInArrow(_count, f"doc_id {kind}, held_out boolean, counts array<long>"))
    marked = labels.where("quality in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"), F.max("quality").alias("most")).where("quality = most")
    known = scratch.write(counted.where("not held_out").join(marked, "doc_id").select("quality", "counts"))
    sums = known.agg(*(F.sum(F.col("counts")[i]).alias(c) for i, c in enumerate(COUNTS))).first()
    totals = [x or 0 for x in sums]
    moments = known.mapInArrow(_moments(totals), "quality int, place int, value long").groupBy("quality", "place").agg(F.sum("value").alias("value")).collect()
    table: dict[int, list[int]] = {r.quality: [0] * (1 + FEATURES) ** 2 for r in moments}
    for r in moments:
        table[r.quality][r.place] = r.value
    return counted.mapInArrow(_score(totals, fit(table) if table else {}, least), f"doc_id {kind}, held_out boolean, score double, predicted int")


def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return settled(spark, "op12", lambda scratch: classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"), scratch))
