"""Spelling variants of the corpus's words by a symmetric-delete join.

Every word of the vocabulary emits itself and its distinct single deletions as keys; words that share a key are candidates and
an exact edit distance of one is verified. A word's form is its most frequent near word, if that is much more frequent, and forms
are followed to roots by pointer jumping.

Two words at distance one share exactly one key: of an insertion the shorter word itself, of a replacement what is left without
the replaced place. So no pair counts twice and no pair is lost. Words under one key differ from it by one letter, so that their
number is bounded by the alphabet and the key's length, whatever the size of the corpus.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, read_table, settled, slices

#: A word's least code points, and its least occurrences.
LEAST_LENGTH, LEAST_COUNT = 5, 3
#: Of h, the checksum of a document's id and a run, every DAMAGE-th deletes one code point of the run.
DAMAGE = 97
#: A form occurs at least so many times as often as its variant.
FORM_RATIO = 2
#: Distinct words that a counting task holds before it hands their counts on.
HELD = 300_000
#: Code points of a word beyond which its keys carry a digest in its place: a word has as many keys as letters.
LONG_WORD = 64
#: The factor of the keys' polynomials modulo 2^64; a key is only a candidate's meeting place.
FACTOR = 0x9E3779B97F4A7C15

_table = None


def _fold() -> bytes:
    """Latin-1 bytes to themselves if they are letters of a run, A-Z in lower case, all others to blanks."""
    global _table
    if _table is None:
        _table = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))
    return _table


def words_of(doc_id: str | None, text: str):
    """(word, occurrences) of a text, words of any length as Latin-1 bytes.

    Runs are of code points below 256, so that a text is read as Latin-1, any other code point as a question mark. A
    run's fate hangs on the document and the run alone, so that each distinct run is decided once.
    """
    import collections
    import zlib

    runs = collections.Counter(text.encode("latin-1", "replace").translate(_fold()).split())
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in runs.items():
        h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
        if h % DAMAGE == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        yield run, n


def _count(batches):
    """(id, text) to (word, n), summed over about HELD distinct words at a time."""
    import pyarrow as pa

    def rows(sums):
        return pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in sums], pa.string()), pa.array(list(sums.values()), pa.int64())], names=["word", "n"])

    sums: dict[bytes, int] = {}
    for batch in slices(batches, 1):
        for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
            for word, n in words_of(doc_id.as_py(), text.as_py()):
                if len(word) >= LEAST_LENGTH:
                    sums[word] = sums.get(word, 0) + n
            if len(sums) >= HELD:
                yield rows(sums)
                sums = {}
    if sums:
        yield rows(sums)


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words of all whole texts that occur at least `least` times; a null id counts as empty text."""
    texts = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    counts = texts.mapInArrow(_count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= least)


def deletion_keys(words: list[str]):
    """(index of the word, key) arrays: for each word one key for itself and one for each distinct single deletion."""
    import numpy as np

    by_length: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        by_length.setdefault(len(w), []).append(i)
    owners, keys = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    factor = np.uint64(FACTOR)
    with np.errstate(over="ignore"):
        for size, members in by_length.items():
            c = np.frombuffer("".join(words[i] for i in members).encode("utf-32-le"), dtype=np.uint32).reshape(len(members), size).astype(np.uint64) + np.uint64(1)
            members = np.array(members)
            head = np.zeros((size + 1, len(members)), np.uint64)  # of the letters before a place, and
            tail = np.zeros((size + 1, len(members)), np.uint64)  # of those from it on
            power = np.ones(size + 1, np.uint64)
            for i in range(size):
                head[i + 1] = head[i] * factor + c[:, i]
                power[i + 1] = power[i] * factor
            for i in range(size - 1, -1, -1):
                tail[i] = c[:, i] * power[size - 1 - i] + tail[i + 1]
            owners.append(members)
            keys.append(tail[0])
            left = head[:-1] * power[size - 1 :: -1][:, None] + tail[1:]
            there = np.ones((size, len(members)), bool)
            there[:-1] = (c[:, 1:] != c[:, :-1]).T  # of a run of one letter the last deletion stands for all
            place, who = np.nonzero(there)
            owners.append(members[who])
            keys.append(left[place, who])
    return np.concatenate(owners), np.concatenate(keys)


def _emit(batches):
    """(word, name, n) to (key, name, n)."""
    import pyarrow as pa

    for batch in slices(batches, 0):
        owners, keys = deletion_keys(batch.column(0).to_pylist())
        for at in range(0, len(keys), 1 << 16):
            rows = pa.array(owners[at : at + (1 << 16)])
            yield pa.RecordBatch.from_arrays([pa.array(keys[at : at + (1 << 16)].view("int64")), batch.column(1).take(rows), batch.column(2).take(rows)], names=["key", "name", "n"])


def near_words(words: DataFrame, scratch: Scratch) -> DataFrame:
    """(word, near, n): each word of words (word, n) with every word at an edit distance of exactly one, and that one's n.

    words is a written table of distinct words. A word of more than LONG_WORD code points goes by a digest until its candidates are known, as each
    of its keys would carry it whole; it is verified with its letters like any other.
    """
    named = words.withColumn("name", F.when(F.length("word") > LONG_WORD, F.concat(F.lit("#"), F.sha2("word", 256))).otherwise(F.col("word")))
    keys = scratch.write(named.select("word", "name", "n").mapInArrow(_emit, "key long, name string, n long"))
    left = keys.select("key", F.col("name").alias("a"))
    right = keys.select("key", F.col("name").alias("b"), "n")
    met = left.join(right, "key").where("a <> b")
    digest = F.col("a").startswith("#") | F.col("b").startswith("#")
    short = met.where(~digest).where(F.levenshtein("a", "b", 1) == 1).select(F.col("a").alias("word"), F.col("b").alias("near"), "n")
    letters = named.where("name <> word or length(word) = " + str(LONG_WORD)).select("name", "word")
    far = met.where(digest).select("a", "b", "n").distinct()
    far = far.join(letters.select(F.col("name").alias("a"), F.col("word").alias("word")), "a").join(letters.select(F.col("name").alias("b"), F.col("word").alias("near")), "b")
    return short.union(far.where(F.levenshtein("word", "near", 1) == 1).select("word", "near", "n"))


def follow(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """(word, root) for every row of forms (word, form): the last of the chain of forms. Chains must not close.

    Each round doubles the step, so that a chain of n forms takes about log2(n) equi-joins; a round is written, and words that are through
    leave the joins. A root that many words lead to is only on the large side of a join, which the skew join can split.
    """
    steps = scratch.write(forms.select("word", F.col("form").alias("root")))
    done = None
    while True:
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = scratch.write(steps.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("on")))
        # Words at a root stay in the tables: others jump over them.
        if moved.where("on").limit(1).count() == 0:
            done = moved.select("word", "root")
            break
        scratch.drop(steps)
        steps = moved.select("word", "root")
        steps._scratch_path = moved._scratch_path
    return done


def group_variants(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per word of the corpus: word, form, root, n, n_near, form_n.

    A form is the near word of largest n, of equals the smallest in code-point order, if that n is at least FORM_RATIO times the word's;
    else form and form_n are null, and n_near is 0 for a word without near words. n at least doubles from form to form, so that chains end. Null texts have no words;
    rows that repeat are counted each, as rows of their own; a null id counts as empty text; an empty table gives an empty one.
    """
    words = scratch.write(count_words(docs, id_col, text_col))
    near = near_words(words, scratch)
    best = near.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("n")).alias("less"), F.col("near").alias("near"))).alias("best"))
    joined = words.join(best, "word", "left")
    n = -F.col("best.less")
    ok = n >= FORM_RATIO * F.col("n")
    joined = scratch.write(joined.select("word", F.when(ok, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(ok, n).alias("form_n")))
    roots = follow(joined.where("form is not null").select("word", "form"), scratch)
    return joined.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return settled(spark, "op11", lambda scratch: group_variants(read_table(spark, sf_dir, "documents"), scratch))


#: CRC-32 is folded over the bytes of each distinct (document, run). Near words agree without the same place, or one is the other without a place.
ORACLE = f"""
WITH RECURSIVE crc_table AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END, i) AS c
    FROM (SELECT unnest(range(256)) AS i))),
runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents) GROUP BY ALL),
hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(
           list_transform(regexp_extract_all(hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)), '..'), lambda h: ('0x' || h)::BIGINT),
           lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1]), 4294967295)) AS h
  FROM runs, crc_table),
words AS (
  SELECT word, sum(n)::BIGINT AS n
  FROM (SELECT CASE WHEN h % {DAMAGE} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed)
  WHERE length(word) >= {LEAST_LENGTH} GROUP BY word HAVING sum(n) >= {LEAST_COUNT}),
cut AS (SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
near AS (
  SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM cut a JOIN cut b USING (rest, i) WHERE a.word <> b.word
  UNION SELECT cut.word, cut.n, words.word, words.n FROM cut JOIN words ON cut.rest = words.word
  UNION SELECT words.word, words.n, cut.word, cut.n FROM cut JOIN words ON cut.rest = words.word),
best AS (SELECT word, n, count(*) AS n_near, max(near_n) AS most, arg_min(near, (-near_n, near)) AS near FROM near GROUP BY word, n),
forms AS (SELECT word, near AS form, most AS form_n FROM best WHERE most >= {FORM_RATIO} * n),
chain AS (
  SELECT word, form AS root, 1 AS step FROM forms
  UNION ALL
  SELECT chain.word, forms.form, step + 1 FROM chain JOIN forms ON forms.word = chain.root),
roots AS (SELECT word, arg_max(root, step) AS root FROM chain GROUP BY word)
SELECT word, form, coalesce(root, word) AS root, words.n, coalesce(n_near, 0)::BIGINT AS n_near, form_n
FROM words LEFT JOIN (SELECT word, n_near FROM best) USING (word) LEFT JOIN forms USING (word) LEFT JOIN roots USING (word)
"""
