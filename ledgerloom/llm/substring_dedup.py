"""Removal of word sequences that an earlier document has, found by FM-index search.

Texts that several rows have are settled by their digests, and the first of them goes on. Anchors (see `anchors`, over word
hashes here) gather all occurrences of a window of words under one key. Spans with equal words are settled by the smallest
document that has them. Where a key has different spans, one of each goes into the compressed FM-index of a shard: the Burrows-Wheeler
transform, and the documents in its order, as wavelet matrices of bit planes. The spans are then streamed against it: backward
search gives the matching statistics, how far back from each word a match with an earlier document reaches, and intervals
at the threshold are reported.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import anchors
from .anchors import first_half
from .common import Scratch, read_table, settled, slices, text_or_empty, whole_group

WINDOW = 50
GRAM = 10
#: Words of spans in a shard, on average.
SHARD_WORDS = 1 << 17
#: Different spans under one key beyond which they are compared window by window across the cluster, not in one shard.
HOT_SPANS = 4096
#: Stands for a null id: later than any other.
LAST = (1 << 63) - 1

_BASE = 0xA0761D6478BD642F


def word_hashes(text: bytes):
    """A 64-bit hash of each word, none zero."""
    import numpy as np

    b = np.frombuffer(text, dtype=np.uint8)
    inside = np.concatenate(([False], ~((b == 32) | ((b >= 9) & (b <= 13))), [False]))
    turn = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = turn[::2], turn[1::2]
    out = np.empty(len(start), dtype=np.uint64)
    at = 0
    while at < len(start):  # in parts, as prefix sums take eight bytes a byte
        to = max(at + 1, int(np.searchsorted(end, start[at] + anchors.PART, side="right")))
        base = start[at]
        s = anchors.sums(b[base : end[to - 1]].astype(np.uint64) + np.uint64(1), _BASE)
        h = anchors.range_hash(s, start[at:to] - base, end[at:to] - base, _BASE)
        with np.errstate(over="ignore"):
            out[at:to] = anchors._mix(h + (end[at:to] - start[at:to]).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        at = to
    return np.where(out == 0, np.uint64(1), out)


class WaveletMatrix:
    """Whole numbers as bit planes, one a level, with the count of ones before every 64 bits."""

    def __init__(self, values, top: int):
        """values below top."""
        import numpy as np

        n = len(values)
        self.levels = []
        for bit in range(max(1, (top - 1).bit_length()) - 1, -1, -1):
            one = (values >> bit & 1).astype(bool)
            padded = np.zeros((n // 64 + 1) * 64, dtype=bool)
            padded[:n] = one
            words = np.packbits(padded, bitorder="little").view(np.uint64)
            before = np.concatenate(([0], np.cumsum(np.bitwise_count(words), dtype=np.int32)))[:-1].astype(np.int32)
            self.levels.append((bit, words, before, n - int(one.sum())))
            values = np.concatenate((values[~one], values[one]))

    @staticmethod
    def _ones(words, before, at):
        import numpy as np

        word = at >> 6
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return before[word] + np.bitwise_count(words[word] & below)

    def descend(self, value, at):
        """Where the places before `at` that hold a value end among all of that value, but for where those begin."""
        import numpy as np

        for bit, words, before, zeros in self.levels:
            ones = self._ones(words, before, at)
            at = np.where(value >> bit & 1, zeros + ones, at - ones)
        return at

    def least(self, low, high):
        """The smallest value at places low to high, none of these ranges empty."""
        import numpy as np

        out = np.zeros(len(low), dtype=np.int64)
        for bit, words, before, zeros in self.levels:
            a, b = self._ones(words, before, low), self._ones(words, before, high)
            up = high - b == low - a  # no zero in the range
            out |= up.astype(np.int64) << bit
            low, high = np.where(up, zeros + a, low - a), np.where(up, zeros + b, high - b)
        return out


class FMIndex:
    """Backward search over sequences of small integers, vectorised over many patterns at once."""

    def __init__(self, sequences, values):
        """values: a number for each sequence; least() gives the smallest over a match's occurrences."""
        import numpy as np

        count = len(sequences)
        lengths = np.array([len(s) for s in sequences], dtype=np.int64)
        ends = np.cumsum(lengths + 1) - 1
        n = int(ends[-1]) + 1
        text = np.empty(n, dtype=np.int64)
        own = np.repeat(np.arange(count), lengths + 1)
        text[ends] = np.arange(count)  # each sequence ends in a symbol of its own
        inner = np.ones(n, dtype=bool)
        inner[ends] = False
        text[inner] = np.concatenate(sequences) + count
        # Suffix order by doubling; the closing symbols keep common prefixes short.
        rank, h = np.unique(text, return_inverse=True)[1].astype(np.int64), 1
        while True:
            second = np.concatenate((rank[h:], np.full(min(h, n), -1)))[:n]
            order = np.argsort(rank * (n + 1) + second + 1, kind="stable")
            key = rank[order] * (n + 1) + second[order]
            new = np.concatenate(([0], np.cumsum(np.diff(key) != 0)))
            rank = np.empty(n, dtype=np.int64)
            rank[order] = new
            if new[-1] == n - 1:
                break
            h *= 2
        self.n, self.shift = n, count
        sigma = int(text.max()) + 1
        self.first = np.searchsorted(text[order], np.arange(sigma + 1))  # where each symbol's suffixes begin
        self.bwt = WaveletMatrix(text[order - 1], sigma)
        self.base = self.bwt.descend(np.arange(sigma), np.zeros(sigma, dtype=np.int64))
        self.values, place = np.unique(np.asarray(values), return_inverse=True)
        self.docs = WaveletMatrix(place[own[order]].astype(np.int64), len(self.values))

    def extend(self, symbol, low, high):
        """The suffix ranges of the matches lengthened by a symbol on the left."""
        symbol = symbol + self.shift
        start = self.first[symbol] - self.base[symbol]
        return start + self.bwt.descend(symbol, low), start + self.bwt.descend(symbol, high)

    def least(self, low, high):
        """The smallest value over non-empty suffix ranges."""
        return self.values[self.docs.least(low, high)]


def matching_statistics(index: FMIndex, symbols, at, value, most: int):
    """For each place `at` of symbols, how many of the symbols up to it, `most` at most, a sequence with a value smaller than
    the place's own has in a row."""
    import numpy as np

    out = np.zeros(len(at), dtype=np.int64)
    for a in range(0, len(at), 1 << 18):
        live = np.arange(a, min(a + (1 << 18), len(at)))
        low, high = np.zeros(len(live), dtype=np.int64), np.full(len(live), index.n)
        for step in range(most):
            low, high = index.extend(symbols[at[live] - step], low, high)
            keep = high > low
            keep[keep] = index.least(low[keep], high[keep]) < value[live[keep]]
            live, low, high = live[keep], low[keep], high[keep]
            if not len(live):
                break
            out[live] += 1
    return out


def earlier_windows(sequences, values, window: int = WINDOW):
    """For each sequence, which of its windows a sequence with a smaller value has: a list of boolean arrays."""
    import numpy as np

    symbols = np.unique(np.concatenate(sequences))
    index = FMIndex(coded := [np.searchsorted(symbols, s) for s in sequences], values)
    counts = np.array([len(s) - window + 1 for s in sequences])
    offset = np.cumsum([0, *(len(s) for s in sequences)])[:-1]
    ends = np.concatenate([np.arange(o, o + c) for o, c in zip(offset, counts, strict=True)]) + window - 1
    found = matching_statistics(index, np.concatenate(coded), ends, np.repeat(np.asarray(values), counts), window)
    return np.split(found >= window, np.cumsum(counts)[:-1])


def _rows_of(batch, firsts):
    """Per row that goes on: (text id as bytes, the document, the text's bytes)."""
    import numpy as np

    tids, docs, texts = batch.column(0).to_pylist(), batch.column(1).to_numpy(), batch.column(2)
    first8 = np.array([int.from_bytes(t[:8], "little", signed=True) for t in tids], dtype=np.int64)
    on = np.ones(len(tids), dtype=bool) if firsts is None else anchors.in_filter(firsts.value, first8 ^ docs)
    for i in np.flatnonzero(on).tolist():
        yield tids[i], int(docs[i]), texts[i].as_py()


def _gather(window: int, gram: int, firsts):
    """(tid, doc, bytes) to spans: key, span, len, doc, rid."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in slices(batches, 2):
            out = []
            for tid, doc, text in _rows_of(batch, firsts):
                words = word_hashes(text)
                if len(words) < window:
                    continue
                key, span, first, end, _ = anchors.spans(words, window, gram)
                rid = anchors.row_ids(int.from_bytes(tid[:8], "little"), doc, key, first)
                out.append((key, span, end - first + window - 1, np.full(len(key), doc), rid))
            cols = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in cols], names=["key", "span", "len", "doc", "rid"])

    return run


def _fetch(window: int, gram: int, firsts, wanted, useful):
    """The second reading: the rows of spans that are in question with digests of their words, and word hashes of one of each
    span to index."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in slices(batches, 2):
            tids, cols, digests, raw = [], [], [], []
            for tid, doc, text in _rows_of(batch, firsts):
                words = word_hashes(text)
                if len(words) < window:
                    continue
                key, span, first, end, stop = anchors.spans(words, window, gram)
                bring = anchors.in_filter(wanted.value, anchors.row_ids(int.from_bytes(tid[:8], "little"), doc, key, first))
                asked = np.flatnonzero(bring | anchors.in_filter(useful.value, key ^ span)).tolist()
                plain = _words(text) if asked else []
                for i in asked:
                    tids.append(tid)
                    cols.append((doc, key[i], span[i], stop[i] - first[i], first[i]))
                    digests.append(hashlib.md5(b" ".join(plain[first[i] : stop[i]]), usedforsecurity=False).digest())
                    raw.append(words[first[i] : stop[i]].tobytes() if bring[i] else None)
            c = np.array(cols, dtype=np.int64).reshape(-1, 5).T
            yield pa.RecordBatch.from_arrays([pa.array(tids, pa.binary()), *(pa.array(np.ascontiguousarray(x)) for x in c), pa.array(digests, pa.binary()), pa.array(raw, pa.binary())], names=["tid", "doc", "key", "span", "len", "first", "digest", "words"])

    return run


def _search_shard(window: int):
    def run(table):
        import numpy as np
        import pyarrow as pa

        unique = {}
        for key, span, n, least, words in zip(*(table.column(c).to_pylist() for c in ("key", "span", "len", "least", "words")), strict=True):
            unique[key, span, n] = (least, words)
        names = sorted(unique)
        sequences = [np.frombuffer(unique[k][1], dtype=np.uint64) for k in names]
        values = np.array([unique[k][0] for k in names], dtype=np.int64)
        out = []
        for (key, span, n), hit in zip(names, earlier_windows(sequences, values, window) if names else [], strict=True):
            at = np.flatnonzero(hit)
            for x, y in zip(*anchors.merge(at, at + window), strict=True):
                out.append((key, span, n, int(x), int(y)))
        cols = np.array(out, dtype=np.int64).reshape(-1, 5).T
        return pa.table({c: pa.array(np.ascontiguousarray(x)) for c, x in zip(("key", "span", "len", "a", "b"), cols, strict=True)})

    return run


def _windows(window: int):
    """Spans to their windows, each under 128 bits of hash."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for key, span, n, least, words in zip(*(batch.column(c).to_pylist() for c in range(5)), strict=True):
                m = n - window + 1
                hashes = [hashlib.md5(words[8 * i : 8 * (i + window)], usedforsecurity=False).digest() for i in range(m)]
                yield pa.RecordBatch.from_arrays([*(pa.array([v] * m, pa.int64()) for v in (key, span, n, least)), pa.array(range(m), pa.int64()), pa.array(hashes, pa.binary())], names=["key", "span", "len", "least", "a", "hash"])

    return run


def _words(text: bytes) -> list[bytes]:
    return text.split()  # ASCII white space only, as bytes


def _maybe(covered):
    """Texts that no window covers are done here; the others go on with their bytes. covered None: all go on."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in slices(batches, 3):
            tids, docs, texts = (batch.column(c).to_pylist() for c in (1, 2, 3))
            ids = np.array([int.from_bytes(t[:8], "little", signed=True) ^ d for t, d in zip(tids, docs, strict=True)], dtype=np.int64)
            on = anchors.in_filter(covered.value, ids) if covered is not None else np.ones(len(ids), dtype=bool)
            n, sha = [], []
            for t, o in zip(texts, on.tolist(), strict=True):
                w = _words(t)
                n.append(len(w))
                sha.append(None if o else hashlib.sha256(b" ".join(w)).hexdigest())
            hidden = pa.array([t if o else None for t, o in zip(texts, on.tolist(), strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], hidden, pa.array(n, pa.int64()), pa.array(sha, pa.string())], names=["doc_id", "tid", "doc", "text", "n_words", "sha"])

    return run


def _cut(window: int, with_text: bool):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in slices(batches, 1):
            removed, shas, kept = [], [], []
            for text, n, sha, at in zip(*(batch.column(c).to_pylist() for c in range(1, 5)), strict=True):
                if sha is not None:
                    removed.append(0)
                    shas.append(sha)
                    continue
                pairs = np.array([(p["a"], min(p["b"], n)) for p in at or []], dtype=np.int64).reshape(-1, 2)
                a, b = anchors.merge(*pairs[pairs[:, 1] - pairs[:, 0] >= window].T)
                words, edges = _words(text), [0, *(int(v) for p in zip(a, b, strict=True) for v in p), n]
                left = b" ".join(w for x, y in zip(edges[::2], edges[1::2], strict=True) for w in words[x:y])
                removed.append(int((b - a).sum()))
                shas.append(hashlib.sha256(left).hexdigest())
                kept.append(left)
            cols, names = [batch.column(0), batch.column(2), pa.array(removed, pa.int64()), pa.array(shas, pa.string())], ["doc_id", "n_words", "n_removed", "kept_sha256"]
            if with_text:
                cols, names = [*cols, pa.array(kept, pa.binary())], [*names, "kept"]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return run


def earlier_intervals(rows: DataFrame, scratch: Scratch, window: int = WINDOW, gram: int = GRAM, shard_words: int = SHARD_WORDS, hot_spans: int = HOT_SPANS) -> DataFrame:
    """(tid, doc, a, b): the word intervals of each text that windows of an earlier document cover. rows: (tid, doc, text)."""
    sc = scratch.spark.sparkContext
    cls = ["key", "span", "len"]
    texts = rows.groupBy("tid").agg(F.count("*").alias("n"), F.min("doc").alias("lo"))
    texts = scratch.write(texts, compact=True)
    several = texts.where("n > 1")
    # Of each text the first row goes on: in its copies all windows are earlier ones'. The filter holds every first row, as it must
    # miss none of them; where it lets a further one through, that is a later copy still.
    firsts = sc.broadcast(anchors.Filter(texts, first_half().bitwiseXOR(F.col("lo")), texts.count())) if several.count() else None
    copies = rows.select("tid", "doc").join(several.select("tid", "lo"), "tid").where("doc > lo").select("tid", "doc", F.lit(0).cast("long").alias("a"), F.lit(LAST).alias("b"))
    found = rows.mapInArrow(_gather(window, gram, firsts), "key long, span long, len long, doc long, rid long")
    classes = found.groupBy(*cls).agg(F.min(F.struct("doc", "rid")).alias("least"), F.max("doc").alias("most"))
    classes = scratch.write(classes.select(*cls, F.col("least.doc").alias("least"), F.col("least.rid").alias("rid"), "most"), compact=True)
    # A key whose spans all belong to one document first cannot cover another's.
    keys = classes.groupBy("key").agg(F.count("*").alias("spans"), F.min("least").alias("from"), F.max("least").alias("to")).where("spans > 1 and from < to")
    search = scratch.write(classes.join(keys.select("key", "spans"), "key"), compact=True)
    whole = scratch.write(classes.where("most > least"), compact=True)
    both = whole.select(*cls).union(search.select(*cls))
    wanted = sc.broadcast(anchors.Filter(search, F.col("rid"), search.count()))
    useful = sc.broadcast(anchors.Filter(both, F.col("key").bitwiseXOR(F.col("span")), both.count()))
    second = scratch.write(rows.mapInArrow(_fetch(window, gram, firsts, wanted, useful), "tid binary, doc long, key long, span long, len long, first long, digest binary, words binary"))
    # Whole spans: equal by hashes, told equal by the digests of their words.
    same = second.groupBy("digest", "len").agg(F.min("doc").alias("least"), F.max("doc").alias("most")).where("most > least")
    same = scratch.write(same.select("digest", "len", "least"), compact=True)
    at_once = second.join(same, ["digest", "len"]).where("doc > least").select("tid", "doc", F.col("first").alias("a"), (F.col("first") + F.col("len")).alias("b"))

    pieces = second.where("words is not null").join(search.select(*cls, "least", "spans"), cls).where("doc = least")
    total = search.agg(F.sum("len")).first()[0] or 0
    shards = max(1, math.ceil(total / shard_words))
    cold = pieces.where(F.col("spans") <= hot_spans).withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)))
    hits = cold.select("shard", *cls, "least", "words").groupBy("shard").applyInArrow(whole_group(_search_shard(window)), "key long, span long, len long, a long, b long")
    hot = pieces.where(F.col("spans") > hot_spans).groupBy(*cls, "least").agg(F.min("words").alias("words"))
    by_window = hot.select(*cls, "least", "words").mapInArrow(_windows(window), "key long, span long, len long, least long, a long, hash binary")
    first = by_window.groupBy("hash").agg(F.min("least").alias("from"))
    by_window = by_window.join(first, "hash").where("from < least").select(*cls, "a", (F.col("a") + window).alias("b"))
    hits = scratch.write(hits.union(by_window).join(search.select(*cls, "least"), cls))
    mine = second.select("tid", "doc", *cls, "first").join(hits.withColumnRenamed("least", "doc"), [*cls, "doc"])
    inside = mine.select("tid", "doc", (F.col("first") + F.col("a")).alias("a"), (F.col("first") + F.col("b")).alias("b"))
    return at_once.union(inside).union(copies).distinct()


def remove_earlier(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM, with_text: bool = False, **limits) -> DataFrame:
    """Per row of docs: doc_id, n_words, n_removed, kept_sha256 and, if asked for, kept (the remaining words).

    A word goes if a window of `window` words around it starts in a document with a smaller id, judged on the input. Ids
    must be integers; a null id is larger than any other, and rows of equal id never remove from each other. Null text has
    no words; texts shorter than a window stay whole. Rows that repeat are judged each; other columns are not read. An empty
    table gives an empty one.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    text = text_or_empty(F.col(text_col)).cast("binary")
    doc = F.coalesce(F.col(id_col).cast("long"), F.lit(LAST))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.unhex(F.md5(text)).alias("tid"), doc.alias("doc"), text.alias("text"))
    cover = scratch.write(earlier_intervals(rows.select("tid", "doc", "text"), scratch, window, gram, **limits))
    covered = None if with_text else scratch.spark.sparkContext.broadcast(anchors.Filter(cover, first_half().bitwiseXOR(F.col("doc")), cover.count()))
    by_text = scratch.write(cover.groupBy("tid", "doc").agg(F.collect_list(F.struct("a", "b")).alias("at")), compact=True)  # bounded by its text's length
    rows = rows.select("doc_id", "tid", "doc", "text").mapInArrow(_maybe(covered), f"doc_id {kind}, tid binary, doc long, text binary, n_words long, sha string")
    out = rows.join(by_text, ["tid", "doc"], "left").select("doc_id", "text", "n_words", "sha", "at")
    return out.mapInArrow(_cut(window, with_text), f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string" + ", kept binary" * with_text)


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return settled(spark, "substring", lambda scratch: remove_earlier(read_table(spark, sf_dir, "documents"), scratch))


ORACLE = f"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w, row_number() OVER () AS rid FROM documents),
windows AS (
  SELECT rid, doc_id, s, md5(array_to_string(w[s:s + {WINDOW - 1}], ' ')) AS h
  FROM (SELECT rid, doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) AS s FROM words)),
firsts AS (SELECT h, min(doc_id) AS first FROM windows GROUP BY h),
hits AS (SELECT rid, s FROM windows JOIN firsts USING (h) WHERE doc_id > first OR (doc_id IS NULL AND first IS NOT NULL)),
gone AS (SELECT DISTINCT rid, unnest(range(s, s + {WINDOW})) AS i FROM hits),
removed AS (SELECT rid, count(*) AS n, list(i) AS at FROM gone GROUP BY rid),
tokens AS (SELECT rid, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM words),
kept AS (
  SELECT rid, string_agg(word, ' ' ORDER BY i) AS text FROM tokens ANTI JOIN gone USING (rid, i) GROUP BY rid)
SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM words LEFT JOIN removed USING (rid) LEFT JOIN kept USING (rid)
"""
