"""Removal of repeated byte strings by suffix arrays, sorted in two stages.

Texts that several rows have are settled by their digests, and one of them goes on. Anchors (see `anchors`) gather all
occurrences of a window of bytes under one key. Spans with equal bytes repeat as a whole. Where a key has different spans, one of
each is suffix-sorted with the others in shards of bounded size: only suffixes smaller than their successors are sorted
directly, the rest are induced from them by scans over the buckets, and adjacent common prefixes then show which windows repeat.

Windows of WINDOW bytes are removed. Strings of SHARED bytes that another document has too are told by the same sort; where SHARED is less than
WINDOW, anchors are chosen for the shorter windows, which equal longer ones begin with.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import anchors
from .anchors import first_half
from .common import Scratch, read_table, settled, slices, text_or_empty, whole_group

WINDOW = 400
#: Bytes from which on a string that another document has too is reported. Less than WINDOW finds shorter passages, at nearly twice the cost.
SHARED = WINDOW
GRAM = 64
#: Bytes of spans in a shard, on average.
SHARD_BYTES = 1 << 20
#: Different spans under one key beyond which they are compared window by window across the cluster, not in one shard.
HOT_SPANS = 4096


def _bytes_of(text: bytes):
    import numpy as np

    return np.frombuffer(text, dtype=np.uint8).astype(np.uint64) + np.uint64(1)


def _rows_of(batch, firsts):
    """Per row that goes on: (text id as bytes, its first half as a number, the document's number, the text's bytes)."""
    import numpy as np

    tids, dids, texts = batch.column(0).to_pylist(), batch.column(1).to_numpy(), batch.column(2)
    first8 = np.array([int.from_bytes(t[:8], "little", signed=True) for t in tids], dtype=np.int64)
    on = np.ones(len(tids), dtype=bool) if firsts is None else anchors.in_filter(firsts.value, first8 ^ dids)
    for i in np.flatnonzero(on).tolist():
        yield tids[i], int(first8[i]), int(dids[i]), texts[i].as_py()


SPAN = ["key", "span", "len", "m"]


def _gather(window: int, shared: int, gram: int, firsts):
    """(tid, did, bytes) to spans (key, span, len, m, n, did, rid): one row for all equal spans of a document; m windows in len bytes."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in slices(batches, 2):
            out = []
            for _, t8, did, text in _rows_of(batch, firsts):
                if len(text) < shared:
                    continue
                key, span, first, end, stop = anchors.spans(_bytes_of(text), shared, gram, window)
                rid = anchors.row_ids(t8, did, key, first)
                order = np.lexsort((stop - first, span, key))
                new = np.concatenate(([True], (np.diff(key[order]) != 0) | (np.diff(span[order]) != 0) | (np.diff((stop - first)[order]) != 0)))
                one = order[new]
                n = np.diff(np.concatenate((np.flatnonzero(new), [len(key)])))
                out.append((key[one], span[one], (stop - first)[one], (end - first)[one], n, np.full(len(one), did), rid[one]))
            cols = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in cols], names=[*SPAN, "n", "did", "rid"])

    return run


def _fetch(window: int, shared: int, gram: int, firsts, wanted, repeated):
    """The second reading: a digest of every span that repeats as a whole, and the bytes of one of each span to sort.

    wanted and repeated are broadcast filters that may let more through; rid tells the one asked for.
    """

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in slices(batches, 2):
            tids, cols, digests, raw = [], [], [], []
            for tid, t8, did, text in _rows_of(batch, firsts):
                if len(text) < shared:
                    continue
                key, span, first, end, stop = anchors.spans(_bytes_of(text), shared, gram, window)
                rid = anchors.row_ids(t8, did, key, first)
                bring = anchors.in_filter(wanted.value, rid)
                for i in np.flatnonzero(bring | anchors.in_filter(repeated.value, key ^ span)).tolist():
                    part = text[first[i] : stop[i]]
                    tids.append(tid)
                    cols.append((did, key[i], span[i], stop[i] - first[i], end[i] - first[i], rid[i], first[i]))
                    digests.append(hashlib.md5(part, usedforsecurity=False).digest())
                    raw.append(part if bring[i] else None)
            c = np.array(cols, dtype=np.int64).reshape(-1, 7).T
            yield pa.RecordBatch.from_arrays([pa.array(tids, pa.binary()), *(pa.array(np.ascontiguousarray(x)) for x in c), pa.array(digests, pa.binary()), pa.array(raw, pa.binary())], names=["tid", "did", *SPAN, "rid", "first", "digest", "bytes"])

    return run


def suffix_order(text: bytes, starts, ends, window: int, counts=None):
    """Suffixes in order (to `window` bytes at least) for spans [start, end) of text: the first `counts` of each span, as many as
    begin a window if not given.

    Two stages. A suffix is directly sorted if it is smaller than the one that starts a byte later (or ends its span); the rest
    are larger than their successors, and are appended to the front of their first byte's bucket as a scan over the buckets
    meets their successors. The scan takes a bucket's suffixes together; those whose predecessor shares the bucket form
    the next wave.
    """
    import numpy as np

    t = np.frombuffer(text, dtype=np.uint8).astype(np.int16)
    n = len(t)
    last = np.zeros(n + 1, dtype=bool)
    last[ends - 1] = True
    # Smaller than the successor: the next different byte within the span is larger. An end counts as smallest.
    step = np.zeros(n, dtype=np.int8)
    step[:-1] = np.sign(t[1:] - t[:-1])
    step[last[:n]] = -1
    known = np.where(step != 0, np.arange(n), n)
    following = np.minimum.accumulate(known[::-1])[::-1]
    smaller = step[np.minimum(following, n - 1)] > 0
    # The windows, and after each span's last window the chain of larger suffixes down to a directly sorted one.
    wanted = np.zeros(n + 1, dtype=bool)
    mark = np.zeros(n + 1, dtype=np.int64)
    edge = ends - window + 1 if counts is None else starts + counts
    np.add.at(mark, starts, 1)
    np.add.at(mark, edge, -1)
    wanted[:n] = np.cumsum(mark)[:n] > 0
    edge = edge[edge < ends]
    chained = wanted.copy()
    while len(edge):
        chained[edge] = True
        edge = edge[~smaller[edge] & ~last[edge]] + 1
    items = np.flatnonzero(chained[:n])
    direct = items[smaller[items] | last[items]]
    stop = np.repeat(ends, ends - starts)  # spans follow each other without gaps
    keys = [text[i : min(i + window, e)] for i, e in zip(direct.tolist(), stop[direct].tolist(), strict=True)]
    direct = direct[np.array(sorted(range(len(keys)), key=keys.__getitem__), dtype=np.int64)] if keys else direct
    # A larger suffix that ends its span is one byte long: the least of its bucket, ahead of what is induced there.
    lone = direct[~smaller[direct]]
    small = direct[smaller[direct]]
    front: list[list] = [[] for _ in range(257)]
    for c in np.unique(t[lone]):
        front[c].append(lone[t[lone] == c])
    starts_at = np.zeros(n + 1, dtype=bool)
    starts_at[starts] = True
    bounds = np.searchsorted(t[small], np.arange(257))
    out = []

    def induce(wave):
        """Appends the larger predecessors of a wave to their buckets, in the wave's order."""
        prev = wave[~starts_at[wave]] - 1
        prev = prev[chained[prev] & ~smaller[prev]]
        if not len(prev):
            return
        byte = t[prev]
        order = np.argsort(byte, kind="stable")
        prev, byte = prev[order], byte[order]
        cut = np.flatnonzero(np.diff(byte)) + 1
        for part in np.split(prev, cut):
            front[t[part[0]]].append(part)

    for c in range(256):
        done = 0
        while done < len(front[c]):
            wave = np.concatenate(front[c][done:])
            done = len(front[c])
            induce(wave)
        tail = small[bounds[c] : bounds[c + 1]]
        induce(tail)
        out += [*front[c], tail]
        front[c] = []
    order = np.concatenate(out) if out else items[:0]
    return order[wanted[order]]


def compare_windows(spans: list[bytes], counts, dids, several, window: int = WINDOW, shared: int = SHARED):
    """For the first `counts` suffixes of each span: (repeats, shares), two boolean arrays over all spans' bytes, and the spans' starts.

    repeats: the suffix's first `window` bytes start anywhere else among the spans; shares: its first `shared` bytes start in
    another document. dids: a document of each span; several: whether further documents have the span too.
    """
    import numpy as np

    lengths = np.array([len(s) for s in spans], dtype=np.int64)
    ends = np.cumsum(lengths)
    starts = ends - lengths
    text = b"".join(spans)
    order = suffix_order(text, starts, ends, window, counts)
    own = np.searchsorted(ends, order, side="right")
    room = ends[own] - order
    repeats, shares = np.zeros(len(text), dtype=bool), np.zeros(len(text), dtype=bool)
    view = np.lib.stride_tricks.sliding_window_view(np.frombuffer(text + bytes(window), dtype=np.uint8), window)
    prefix = np.zeros(max(0, len(order) - 1), dtype=np.int64)
    for a in range(0, len(order) - 1, 1 << 14):
        part = view[order[a : a + (1 << 14) + 1]]
        differ = part[1:] != part[:-1]
        prefix[a : a + len(differ)] = np.where(differ.any(axis=1), differ.argmax(axis=1), window)  # adjacent common prefixes
    prefix = np.minimum(prefix, np.minimum(room[1:], room[:-1]))  # that don't go past a span's end
    same = np.flatnonzero(prefix >= window)
    repeats[order[same]] = True
    repeats[order[same + 1]] = True
    if len(order):
        begin = np.flatnonzero(np.concatenate(([True], prefix < shared)))
        size = np.diff(np.concatenate((begin, [len(order)])))
        d = dids[own]
        several_in = np.logical_or.reduceat(several[own], begin) | (np.minimum.reduceat(d, begin) < np.maximum.reduceat(d, begin))
        shares[order[np.repeat(several_in & ((size > 1) | np.logical_or.reduceat(several[own], begin)), size)]] = True
    return repeats, shares, starts


def repeated_windows(spans: list[bytes], window: int = WINDOW):
    """For each span, which of its windows start anywhere else among the spans: a list of boolean arrays."""
    import numpy as np

    counts = np.array([len(s) - window + 1 for s in spans], dtype=np.int64)
    hit, _, starts = compare_windows(spans, counts, np.zeros(len(spans), np.int64), np.zeros(len(spans), bool), window, window)
    return [hit[a : a + n] for a, n in zip(starts.tolist(), counts.tolist(), strict=True)]


#: What an interval says: its bytes are removed, or another document has them.
REMOVED, ELSEWHERE = 0, 1
INTERVAL = "tid binary, kind long, a long, b long"
#: An interval of a span that its text has in several places is told by the span, with a null tid.
HIT = INTERVAL + ", key long, span long, len long, m long"


def _sort_shard(window: int, shared: int):
    def run(table):
        import numpy as np
        import pyarrow as pa

        unique: dict = {}
        rows = zip(*(table.column(c).to_pylist() for c in (*SPAN, "bytes", "tid", "first", "did", "n", "several")), strict=True)
        for key, span, size, m, raw, *rest in rows:
            unique.setdefault((key, raw, m), (span, size, *rest))
        names = sorted(unique)
        about = [unique[x] for x in names]
        counts, dids, several = np.array([x[2] for x in names], np.int64), np.array([x[4] for x in about], np.int64), np.array([x[6] for x in about], bool)
        out = []
        if names:
            repeats, shares, starts = compare_windows([x[1] for x in names], counts, dids, several, window, shared)
            for (key, _, m), (span, size, tid, first, _, n, many), at in zip(names, about, starts.tolist(), strict=True):
                # What the whole span is, and so the intervals of its occurrences, is told elsewhere.
                for kind, hit, width, told in ((REMOVED, repeats, window, n > 1), (ELSEWHERE, shares, shared, many)):
                    found = np.flatnonzero(hit[at : at + m]) if not told else ()
                    if len(found):
                        for x, y in zip(*anchors.merge(found, found + width), strict=True):
                            shift = first if n == 1 else 0
                            out.append((tid if n == 1 else None, kind, shift + int(x), shift + int(y), key, span, size, m))
        cols = list(zip(*out, strict=True)) or [()] * 8
        return pa.table({c: pa.array(list(x), pa.binary() if c == "tid" else pa.int64()) for c, x in zip(("tid", "kind", "a", "b", *SPAN), cols, strict=True)})

    return run


def _windows(window: int, shared: int):
    """Spans to their windows of either width, each under 128 bits of hash."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for tid, first, did, several, raw, m in zip(*(batch.column(c).to_pylist() for c in range(6)), strict=True):
                for kind, width in ((REMOVED, window), (ELSEWHERE, shared)):
                    n = min(m, len(raw) - width + 1)
                    if n > 0:
                        hashes = [hashlib.md5(raw[i : i + width], usedforsecurity=False).digest() for i in range(n)]
                        longs = ((kind, n), (did, n), (width, n))
                        yield pa.RecordBatch.from_arrays([pa.array([tid] * n, pa.binary()), pa.array(range(first, first + n), pa.int64()), *(pa.array([v] * k, pa.int64()) for v, k in longs), pa.array([several] * n, pa.bool_()), pa.array(hashes, pa.binary())], names=["tid", "a", "kind", "did", "width", "several", "hash"])

    return run


def _maybe(covered):
    """Texts that no interval covers are done here; the others go on with their bytes. covered None: all go on."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in slices(batches, 2):
            ids = np.array([int.from_bytes(t[:8], "little", signed=True) for t in batch.column(1).to_pylist()], dtype=np.int64)
            on = anchors.in_filter(covered.value, ids) if covered is not None else np.ones(len(ids), dtype=bool)
            texts = batch.column(2)
            hidden = pa.array([t.as_py() if o else None for o, t in zip(on.tolist(), texts, strict=True)], pa.binary())
            n = [len(t.as_buffer()) for t in texts]
            sha = [None if o else hashlib.sha256(t.as_buffer()).hexdigest() for o, t in zip(on.tolist(), texts, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), hidden, pa.array(n, pa.int64()), pa.array(sha, pa.string())], names=["doc_id", "tid", "text", "n_bytes", "sha"])

    return run


def _cut(with_text: bool):
    """Texts without their covered bytes, and the digest of what stays."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in slices(batches, 1):
            removed, runs, shas, elsewhere, kept = [], [], [], [], []
            for text, n, sha, at in zip(*(batch.column(c) for c in range(1, 5)), strict=True):
                pairs = np.array([(p["kind"], p["a"], p["b"]) for p in at.as_py() or []], dtype=np.int64).reshape(-1, 3)
                a, b = anchors.merge(*pairs[pairs[:, 0] == REMOVED, 1:].T)
                c, d = anchors.merge(*pairs[pairs[:, 0] == ELSEWHERE, 1:].T)
                removed.append(int((b - a).sum()))
                runs.append(len(a))
                elsewhere.append(int((d - c).sum()))
                if sha.as_py() is not None:
                    shas.append(sha.as_py())
                    continue
                raw, edges = text.as_py(), [0, *(int(v) for p in zip(a, b, strict=True) for v in p), n.as_py()]
                left = b"".join(raw[x:y] for x, y in zip(edges[::2], edges[1::2], strict=True))
                shas.append(hashlib.sha256(left).hexdigest())
                kept.append(left)
            cols = [batch.column(0), batch.column(2), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(shas, pa.string()), pa.array(elsewhere, pa.int64())]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_shared"]
            if with_text:
                cols, names = [*cols, pa.array(kept, pa.binary())], [*names, "kept"]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return run


def repeated_intervals(rows: DataFrame, scratch: Scratch, window: int = WINDOW, gram: int = GRAM, shared: int = SHARED, shard_bytes: int = SHARD_BYTES, hot_spans: int = HOT_SPANS) -> DataFrame:
    """(tid, kind, a, b): byte intervals of each text. Kind REMOVED: what windows which start elsewhere cover; kind ELSEWHERE: what
    strings of `shared` bytes cover that start in another document. rows: (tid, did, text) in bytes.
    """
    sc = scratch.spark.sparkContext
    texts = rows.groupBy("tid").agg(F.count("*").alias("n"), F.min("did").alias("lo"), F.max("did").alias("hi"), F.max(F.octet_length("text")).cast("long").alias("len"))
    texts = scratch.write(texts)
    several = texts.where("n > 1")
    # Of each text one row goes on. The filter holds every such row, as it must miss none; a further one that it lets through is a copy still.
    firsts = sc.broadcast(anchors.Filter(texts, first_half().bitwiseXOR(F.col("lo")), texts.count())) if several.count() else None
    found = rows.mapInArrow(_gather(window, shared, gram, firsts), "key long, span long, len long, m long, n long, did long, rid long")
    classes = found.groupBy(*SPAN).agg(F.sum("n").alias("n"), F.min("rid").alias("rid"), F.min("did").alias("lo"), F.max("did").alias("hi"))
    classes = scratch.write(classes)
    keys = classes.groupBy("key").agg(F.count("*").alias("spans")).where("spans > 1")
    sort = scratch.write(classes.join(keys, "key").select(*SPAN, "n", "rid", (F.col("lo") < F.col("hi")).alias("several"), "spans"))
    whole = scratch.write(classes.where("n > 1").select(*SPAN))
    scratch.drop(classes)
    wanted = sc.broadcast(anchors.Filter(sort, F.col("rid"), sort.count()))
    repeated = sc.broadcast(anchors.Filter(whole, F.col("key").bitwiseXOR(F.col("span")), whole.count()))
    second = scratch.write(rows.mapInArrow(_fetch(window, shared, gram, firsts, wanted, repeated), "tid binary, did long, key long, span long, len long, m long, rid long, first long, digest binary, bytes binary"))

    # Whole spans: equal by hashes, told equal by their digests.
    at = ["digest", "len", "m"]
    same = scratch.write(second.groupBy(*at).agg(F.count("*").alias("n"), F.min("did").alias("lo"), F.max("did").alias("hi")).where("n > 1").select(*at, (F.col("lo") < F.col("hi")).alias("several")))
    spread = second.select("tid", "first", *at).join(same, at)
    until = F.col("first") + F.col("len"), F.col("first") + F.col("m") + (shared - 1)
    one = lambda kind, b, there: F.when(there, F.struct(F.lit(kind).cast("long").alias("kind"), F.col("first").alias("a"), b.alias("b")))
    at_once = spread.select("tid", F.explode(F.array_compact(F.array(one(REMOVED, until[0], F.col("len") >= window), one(ELSEWHERE, until[1], F.col("several"))))).alias("i")).select("tid", "i.*")

    # By rid too: of a span with very many occurrences, those that the filter let through by chance would all meet in one shard.
    pieces = second.where("bytes is not null").join(sort, [*SPAN, "rid"])
    total = sort.agg(F.sum("len")).first()[0] or 0
    shards = max(1, math.ceil(total / shard_bytes))
    cold = pieces.where(F.col("spans") <= hot_spans).withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)))
    hits = scratch.write(cold.drop("spans", "rid", "digest").groupBy("shard").applyInArrow(whole_group(_sort_shard(window, shared)), HIT))
    placed = hits.where("tid is null").drop("tid").join(second.select("tid", "first", *SPAN), SPAN).select("tid", "kind", (F.col("first") + F.col("a")).alias("a"), (F.col("first") + F.col("b")).alias("b"))
    hot = pieces.where(F.col("spans") > hot_spans).groupBy(*SPAN, "several").agg(F.min(F.struct("tid", "first", "did", "bytes")).alias("s"))
    by_window = hot.select("s.tid", "s.first", "s.did", "several", "s.bytes", "m").mapInArrow(_windows(window, shared), "tid binary, a long, kind long, did long, width long, several boolean, hash binary")
    met = by_window.groupBy("kind", "hash").agg(F.count("*").alias("n"), (F.bool_or("several") | (F.min("did") < F.max("did"))).alias("many"))
    met = scratch.write(met.where(f"n > 1 and (kind = {REMOVED} or many)").select("kind", "hash"))
    by_window = by_window.join(met, ["kind", "hash"], "left_semi").select("tid", "kind", "a", (F.col("a") + F.col("width")).alias("b"))
    copies = several.select("tid", F.explode(F.array_compact(F.array(*(F.when(c, F.struct(F.lit(k).cast("long").alias("kind"), F.lit(0).cast("long").alias("a"), F.col("len").alias("b"))) for k, c in ((REMOVED, F.col("len") >= window), (ELSEWHERE, (F.col("len") >= shared) & (F.col("lo") < F.col("hi")))))))).alias("i")).select("tid", "i.*")
    return at_once.union(hits.where("tid is not null").select("tid", "kind", "a", "b")).union(placed).union(by_window).union(copies).distinct()


def remove_repeats(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM, shared: int = SHARED, with_text: bool = False, **limits) -> DataFrame:
    """Per row of docs: doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_shared and, if asked for, kept (the remaining bytes).

    A byte goes if a string of `window` bytes around it also starts anywhere else, overlapping or in the same document
    included; matches never cross documents and are judged on the input. n_shared counts the bytes, removed or not, that a string
    of `shared` bytes covers which another document has too (rows equal in id and text are one document). Null text counts as empty; texts
    shorter than a window stay whole. Rows that repeat are each other's copies. Other columns are not read. An empty table
    gives an empty one.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    text = text_or_empty(F.col(text_col)).cast("binary")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.unhex(F.md5(text)).alias("tid"), F.xxhash64(F.col(id_col), text).alias("did"), text.alias("text"))
    cover = scratch.write(repeated_intervals(rows.select("tid", "did", "text"), scratch, window, gram, min(shared, window), **limits))
    covered = None if with_text else scratch.spark.sparkContext.broadcast(anchors.Filter(cover, first_half(), cover.count()))
    by_text = scratch.write(cover.groupBy("tid").agg(F.collect_list(F.struct("kind", "a", "b")).alias("at")))  # bounded by its text's length
    rows = rows.select("doc_id", "tid", "text").mapInArrow(_maybe(covered), f"doc_id {kind}, tid binary, text binary, n_bytes long, sha string")
    out = rows.join(by_text, "tid", "left").select("doc_id", "text", "n_bytes", "sha", "at")
    schema = f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, n_shared long" + ", kept binary" * with_text
    return out.mapInArrow(_cut(with_text), schema)


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return settled(spark, "suffix", lambda scratch: remove_repeats(read_table(spark, sf_dir, "documents"), scratch))
