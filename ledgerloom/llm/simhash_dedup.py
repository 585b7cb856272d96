"""SimHash near-deduplication with bit-sliced comparison of fingerprints.

Fingerprints are collapsed to distinct values and dealt by the parts that a close pair must share (pigeonhole). Within a
block the fingerprints lie as bit planes, a word of 64 fingerprints at a time; carry-save counters add up the differing
planes of many pairs at once, and a block's rows are abandoned once all their pairs are past the radius.
"""

from __future__ import annotations

import math
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, connected_components, read_table, settled, slices, text_or_empty, whole_group

BITS = 64
SHINGLE = 3
RADIUS = 3
SEED = 42
#: Fingerprints that are compared with each other at a time.
BLOCK = 1024
#: Fingerprints of a bucket beyond which it is dealt again by more bits, and about the size of a group.
BUCKET = 4096


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The SimHash of a text as a signed 64-bit number; 0 without words."""
    import numpy as np
    import xxhash

    words = (text or "").encode("utf-8", "replace").lower().split()  # bytes: only A-Z change, only ASCII space splits
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        h = np.array([xxhash.xxh64_intdigest(joined, SEED)], dtype=np.uint64)
    else:
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        ends = np.cumsum(lengths + 1) - 1
        digest = xxhash.xxh64_intdigest
        pairs = zip((ends - lengths)[: 1 - shingle].tolist() if shingle > 1 else (ends - lengths).tolist(), ends[shingle - 1 :].tolist(), strict=True)
        h = np.fromiter((digest(joined[a:b], SEED) for a, b in pairs), dtype=np.uint64, count=len(words) - shingle + 1)
    ones = np.zeros(BITS, dtype=np.int64)
    for a in range(0, len(h), 1 << 16):
        ones += np.unpackbits(h[a : a + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view(np.int64)[0])


def _fingerprints(shingle: int):
    def run(batches):
        import pyarrow as pa

        for batch in slices(batches, 1):
            prints = [fingerprint(t.as_py(), shingle) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.int64())], names=["doc_id", "fp"])

    return run


def planes(prints):
    """The bits of fingerprints, (n,) or (n, words) of uint64, as rows of 64-bit words: a row a bit, in it one bit a fingerprint."""
    import numpy as np

    n = len(prints)
    raw = np.ascontiguousarray(prints).view(np.uint8).reshape(n, -1)
    bits = np.zeros((raw.shape[1] * 8, -(-n // 64) * 64), dtype=np.uint8)
    bits[:, :n] = np.unpackbits(raw, axis=1, bitorder="little").T
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64)


class _Counters:
    """Carry-save counters in bit planes; one overflows, for good, once more than `radius` bits have been added to it."""

    def __init__(self, shape: tuple, radius: int):
        import numpy as np

        full, width = np.uint64(0xFFFFFFFFFFFFFFFF), max(1, radius.bit_length())
        first = (1 << width) - 1 - radius  # they start so that they overflow just past the radius
        self.planes = [np.full(shape, full if first >> k & 1 else 0, dtype=np.uint64) for k in range(width)]
        self.over = np.zeros(shape, dtype=np.uint64)

    def add(self, x, y) -> None:
        """A carry-save adder takes two planes and the lowest counter plane; the carry ripples through the rest."""
        c = self.planes
        u = c[0] ^ x
        carry = (c[0] & x) | (u & y)
        c[0] = u ^ y
        for k in range(1, len(c)):
            c[k], carry = c[k] ^ carry, c[k] & carry
        self.over |= carry

    def keep(self, some) -> None:
        self.planes, self.over = [c[some] for c in self.planes], self.over[some]


def _spare(n: int, words: int):
    """Past the n-th bit of a row of words, all ones."""
    import numpy as np

    out = np.zeros(words, dtype=np.uint64)
    if n % 64:
        out[-1] = np.uint64(0xFFFFFFFFFFFFFFFF) << np.uint64(n % 64)
    return out


def close_pairs(a, b, radius: int):
    """(i, j) of all pairs of a and b, (n,) or (n, words) of uint64 fingerprints, that differ in at most radius bits."""
    import numpy as np

    full, sliced = np.uint64(0xFFFFFFFFFFFFFFFF), planes(b)
    row = np.arange(len(a))
    raw = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), -1)
    masks = np.where(np.unpackbits(raw, axis=1, bitorder="little").astype(bool), full, np.uint64(0)).T
    count = _Counters((len(a), sliced.shape[1]), radius)
    count.over |= _spare(len(b), sliced.shape[1])
    for k in range(0, len(sliced), 2):
        count.add(sliced[k] ^ masks[k][row][:, None], sliced[k + 1] ^ masks[k + 1][row][:, None])
        if k % 8 == 6:
            alive = (count.over != full).any(axis=1)
            if not alive.all() and alive.sum() * 4 <= 3 * len(row):
                row = row[alive]
                count.keep(alive)
                if not len(row):
                    break
    if not len(row):
        return row, row
    i, j = np.nonzero(np.unpackbits((~count.over).view(np.uint8).reshape(len(row), -1), axis=1, bitorder="little"))
    return row[i], j


def close_rows(a, b, radius: int):
    """The rows k of which a[k] and b[k], (n, words) of uint64, differ in at most radius bits: 64 pairs a word, a plane at a time."""
    import numpy as np

    if not len(a):
        return np.zeros(0, dtype=np.int64)
    full, sliced = np.uint64(0xFFFFFFFFFFFFFFFF), planes(a ^ b)
    word = np.arange(sliced.shape[1])
    count = _Counters(word.shape, radius)
    count.over |= _spare(len(a), len(word))
    for k in range(0, len(sliced), 2):
        count.add(sliced[k], sliced[k + 1])
        if k % 16 == 14:  # blocks of 64 pairs that are all past the radius are abandoned
            alive = count.over != full
            if alive.sum() * 2 <= len(word):
                word, sliced = word[alive], sliced[:, alive]
                count.keep(alive)
                if not len(word):
                    return word
    near = np.flatnonzero(np.unpackbits((~count.over).view(np.uint8), bitorder="little"))
    return word[near >> 6] * 64 + (near & 63)


def forest(i, j, n: int):
    """(member, root) links that join the components of the pairs (i, j) among n things."""
    import numpy as np

    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        after = label.copy()
        np.minimum.at(after, i, low)
        np.minimum.at(after, j, low)
        after = after[after]
        if (after == label).all():
            break
        label = after
    member = np.flatnonzero(label != np.arange(n))
    return member, label[member]


def _links(radius: int):
    """Some buckets of distinct fingerprints to links that join their close pairs' components."""

    def run(table):
        import numpy as np
        import pyarrow as pa

        prints, bucket, mask = (table.column(c).to_numpy() for c in ("fp", "bucket", "mask"))
        order = np.lexsort((prints, bucket, mask))
        prints, bucket, mask = np.ascontiguousarray(prints[order]).view(np.uint64), bucket[order], mask[order]
        found = []

        def add(x, y):
            i, j = close_pairs(x, y, radius)
            m, r = forest(i, j + len(x), len(x) + len(y))
            both = np.concatenate((x, y))
            found.append(np.stack((both[m], both[r])))

        starts = [*np.flatnonzero(np.r_[True, (np.diff(bucket) != 0) | (np.diff(mask) != 0)]).tolist(), len(prints)] if len(prints) else [0]
        at = 0
        while at + 1 < len(starts):  # whole buckets together up to a block; a larger bucket block by block
            to = at + 1
            while to + 1 < len(starts) and starts[to + 1] - starts[at] <= BLOCK:
                to += 1
            a, end, at = starts[at], starts[to], to
            for p in range(a, end, BLOCK):
                for q in range(p, end, BLOCK):
                    add(prints[p : min(p + BLOCK, end)], prints[q : min(q + BLOCK, end)])
        e = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.uint64)
        e = np.unique(np.sort(e[:, e[0] != e[1]].view(np.int64), axis=0), axis=1)
        return pa.table({"a": pa.array(e[0]), "b": pa.array(e[1])})

    return run


def _split(mask: int, parts: int) -> list[int]:
    """Masks that hold one of `parts` parts of the bits that `mask` leaves free, besides its own."""
    free = [k for k in range(BITS) if not mask >> k & 1]
    cuts = [round(k * len(free) / parts) for k in range(parts + 1)]
    return [mask | sum(1 << k for k in free[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def _signed(mask: int) -> int:
    return mask - ((mask >> 63) << 64)


def close_links(prints: DataFrame, scratch: Scratch, radius: int = RADIUS, total: int | None = None) -> DataFrame:
    """Links (a, b) that join the components of the distinct fingerprints in prints (fp long) at `radius` bits or fewer.

    The 64 bits fall into m parts; a close pair agrees in at least m - radius of them, so that pairs meet under one of the
    combinations of parts. m grows with the number of fingerprints, which keeps buckets small; no pair is lost at any m.
    A bucket of more than BUCKET fingerprints is dealt again by radius + 1 parts of the bits that it leaves free, one of
    which a close pair shares, until every bucket is small: a row is copied radius + 1 times a level, whatever its bucket's size.
    """
    total = prints.count() if total is None else total
    parts = radius + 1
    while parts < BITS // 2 and 2.0 ** (BITS // parts * (parts - radius)) * BUCKET < total:
        parts += 1
    cuts = [round(k * BITS / parts) for k in range(parts + 1)]
    masks = [sum(((1 << cuts[k + 1]) - 1) ^ ((1 << cuts[k]) - 1) for k in kept) for kept in combinations(range(parts), parts - radius)]

    def dealt(rows: DataFrame, keys: Column) -> DataFrame:
        rows = rows.select("fp", F.explode(keys).alias("mask"))
        return rows.withColumn("bucket", F.col("fp").bitwiseAND(F.col("mask")))

    rows = dealt(prints, F.array(*(F.lit(_signed(m)) for m in masks)))
    small = []
    while True:
        sizes = scratch.write(rows.groupBy("mask", "bucket").agg(F.count("*").alias("n")).where("n > 1"))  # alone there: no partner
        rows = rows.join(sizes, ["mask", "bucket"])
        small.append(rows.where(F.col("n") <= BUCKET).select("fp", "mask", "bucket"))
        large = [r["mask"] for r in sizes.where(F.col("n") > BUCKET).select("mask").distinct().collect()]  # at most the masks
        if not large:
            break
        finer = F.create_map(*(x for m in large for x in (F.lit(m), F.array(*(F.lit(_signed(f)) for f in _split(m & (1 << BITS) - 1, radius + 1))))))
        rows = scratch.write(dealt(scratch.write(rows.where(F.col("n") > BUCKET).select("fp", "mask")), finer[F.col("mask")]).select("fp", "mask", "bucket").distinct())
    groups = max(1, math.ceil(total / BUCKET))
    links = [rows.withColumn("group", F.pmod(F.xxhash64("mask", "bucket"), F.lit(groups * len(masks)))).groupBy("group").applyInArrow(whole_group(_links(radius)), "a long, b long") for rows in small]
    return reduce(DataFrame.union, links).distinct()


def near_components(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """Per row of docs: doc_id, fingerprint (16 hex digits), component_id.

    Words are what ASCII white space separates, with A-Z lower-cased; shorter texts hash their whole word sequence, and
    null, empty and blank texts get fingerprint zero, linked like any other. component_id is the smallest id reachable over
    links, null only if all of them are null. Rows that repeat are rows each; an empty table gives an empty one.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(F.col(text_col)).alias("text"))
    rows = scratch.write(rows.mapInArrow(_fingerprints(shingle), f"doc_id {kind}, fp long"))
    distinct = scratch.write(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    links = close_links(distinct.select("fp"), scratch, radius, distinct.count())
    roots = connected_components(links, scratch).withColumnRenamed("node", "fp")
    named = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = scratch.write(named.select("fp", "root").join(least, "root").select("fp", "component_id"))
    out = rows.join(named, "fp")
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op10_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return settled(spark, "simhash", lambda scratch: near_components(read_table(spark, sf_dir, "documents"), scratch))
