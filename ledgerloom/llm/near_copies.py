"""Near copies by shingle similarity: SimHash comparison in bit planes, then the shingle sets themselves.

Every text gets a SimHash of BITS bits over its shingle set and a prefix of the set under one order for the whole corpus,
frequent shingles last. Two sets at the similarity share an element of their prefixes, so that no pair is missed there, and
passages that many texts share rarely make texts meet. Texts that meet are compared by fingerprint (see `simhash_dedup`: planes
and carry-save counters), and what lies within the radius by its sets. Links come in two passes: each text of a
meeting with the meeting's first one, then, in meetings that still hold several components, all pairs of different components.
"""

from __future__ import annotations

import math
import zlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import anchors
from .common import Scratch, connected_components, fresh, slices, text_or_empty, whole_group
from .simhash_dedup import close_pairs, close_rows
from .substring_dedup import word_hashes

SHINGLE = 5
SIMILARITY = 0.8
#: Bits of a fingerprint, and the distance up to which two are compared by their sets. Two sets at a similarity of 0.8 differ in a
#: bit with a chance of at most 0.1875, reached by 4 shingles of 5; more than RADIUS bits of BITS then differ with a chance
#: under 2e-9. A radius of BITS switches the comparison off.
BITS, RADIUS = 256, 90
#: Counters of the frequency sketch, and how many of them are a row of it. Frequency only orders prefixes: any order loses no pair.
COUNTERS, ROW = 1 << 22, 1 << 12
#: Rows of the sketch that are added up at a time.
FOLD = 256
#: Documents of a meeting up to which its pairs are listed.
FEW = 32
#: Documents, and shingles, of a chunk of a larger meeting.
CHUNK, CHUNK_SHINGLES = 1000, 1 << 20
#: Shingles of the texts that are verified together, on average.
SHARD_SHINGLES = 1 << 19
#: Rows of a tile that are compared with a block at a time.
STRIP, BLOCK = 64, 1024
#: Least meetings of a text that tell whether two texts have met before.
LEAST = 8
#: Bits of a parity bitmap, which tiles with sets compare first.
PARITY = 1 << 10

_STEP = 0x9E3779B97F4A7C15


def shingle_set(text: bytes | str | None, shingle: int = SHINGLE):
    """Sorted distinct hashes (uint64) of a text's shingles: A-Z lower-cased, words between ASCII white space, repeats once.

    Fewer words than a shingle make one of all of them; a text without words has none.
    """
    import numpy as np

    raw = (text or b"") if not isinstance(text, str) else text.encode("utf-8", "replace")
    w = word_hashes(raw.lower())
    if not len(w):
        return w
    n = max(1, len(w) - shingle + 1)
    h = np.zeros(n, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(min(shingle, len(w))):
            h = h * np.uint64(_STEP) + w[i : i + n]
        return np.unique(anchors._mix(h + np.uint64(min(shingle, len(w)))))


def simhash(shingles):
    """BITS bits as uint64 words: a bit is 1 if it is set in over half of the shingles' hashes."""
    import numpy as np

    words = BITS // 64
    salt = (np.arange(1, words + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))[None, :]
    ones = np.zeros(BITS, dtype=np.int64)
    for a in range(0, len(shingles), 1 << 14):
        part = anchors._mix(shingles[a : a + (1 << 14), None] ^ salt)
        ones += np.unpackbits(part.view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint16)
    return np.packbits(ones * 2 > len(shingles), bitorder="little").view(np.uint64)


def prefix_length(size: int, similarity: float) -> int:
    """So many first elements of a set, in any common order, hold one that it shares with any set at the similarity."""
    return size - math.ceil(similarity * size - 1e-9) + 1


def alike(a, b, similarity: float) -> bool:
    """Whether two sorted sets have a Jaccard similarity of at least `similarity`."""
    import numpy as np

    if min(len(a), len(b)) < similarity * max(len(a), len(b)) - 1e-9:
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common >= similarity * (len(a) + len(b) - common) - 1e-9


def _count_shingles(shingle: int):
    """Texts to rows (row, part, counts) of the sketch: how many shingles fall under each counter."""

    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        sums = np.zeros(COUNTERS, dtype=np.uint32)
        for batch in slices(batches, 0):
            for text in batch.column(0):
                np.add.at(sums, (shingle_set(text.as_py(), shingle) & np.uint64(COUNTERS - 1)).astype(np.int64), 1)
        rows = sums.reshape(-1, ROW)
        some = np.flatnonzero(rows.any(axis=1))
        part = TaskContext.get().partitionId()
        packed = [zlib.compress(rows[i].astype(np.int64).tobytes(), 1) for i in some]
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array([part] * len(some), pa.int64()), pa.array(packed, pa.binary())], names=["row", "part", "counts"])

    return run


def _add_counts(table):
    import numpy as np
    import pyarrow as pa

    total = sum(np.frombuffer(zlib.decompress(x.as_py()), dtype=np.int64) for x in table.column("counts"))
    return pa.table({"row": table.column("row")[:1], "part": table.column("group")[:1], "counts": pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())})


def frequency_classes(texts: DataFrame, scratch: Scratch, shingle: int):
    """A byte for each counter: 0 up to four times the mean count, then one more for each doubling.

    Tasks' counts are added up FOLD at a time, so that no task gets more; COUNTERS bytes reach the driver, whatever the input.
    """
    import numpy as np

    counts = scratch.write(texts.mapInArrow(_count_shingles(shingle), "row long, part long, counts binary"))
    parts = (counts.agg(F.max("part")).first()[0] or 0) + 1
    while True:
        folded = counts.withColumn("group", F.expr(f"part div {FOLD}")).groupBy("row", "group")
        folded = scratch.write(folded.applyInArrow(_add_counts, "row long, part long, counts binary"))
        scratch.drop(counts)
        counts, parts = folded, math.ceil(parts / FOLD)
        if parts <= 1:
            break
    sums = np.zeros(COUNTERS, dtype=np.int64)
    for r in counts.toLocalIterator():
        sums[r.row * ROW : (r.row + 1) * ROW] = np.frombuffer(zlib.decompress(r.counts), dtype=np.int64)
    scratch.drop(counts)
    over = sums / (4 * max(1.0, sums.mean()))
    return np.where(over < 1, 0, 1 + np.floor(np.log2(np.maximum(over, 1)))).astype(np.uint8)


def _sketches(shingle: int, similarity: float, classes, kind: str):
    """(doc, h, text) to (doc, h, n, fp, prefix): the number of shingles, the fingerprint and the prefix."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in slices(batches, 2):
            sizes, prints, prefixes = [], [], []
            for text in batch.column(2):
                s = shingle_set(text.as_py(), shingle)
                order = np.argsort(classes.value[(s & np.uint64(COUNTERS - 1)).astype(np.int64)], kind="stable")
                sizes.append(len(s))
                prints.append(simhash(s).tobytes())
                prefixes.append(s[order[: prefix_length(len(s), similarity) if len(s) else 0]])
            ends = np.concatenate(([0], np.cumsum([len(p) for p in prefixes]))).astype(np.int32)
            flat = np.concatenate(prefixes).view(np.int64) if prefixes else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(prints, pa.binary()), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], names=["doc", "h", "n", "fp", "prefix"])

    return run


def _shared(wanted):
    """(rid, n, prefix) to (rid, n, meeting): the elements of the prefixes that the broadcast filter may hold."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            lists = batch.column(2)
            flat, row = lists.flatten(), np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy())
            kept = np.flatnonzero(anchors.in_filter(wanted.value, flat.to_numpy()))
            at = pa.array(row[kept])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), flat.take(pa.array(kept))], names=["rid", "n", "meeting"])

    return run


def _words(column):
    """Fingerprints of a binary column as an (n, BITS / 64) array."""
    import numpy as np

    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, dtype=np.uint64).reshape(-1, BITS // 64)


def _gate(radius: int):
    """(a, b, fa, fb) to the pairs (a, b) whose fingerprints are within the radius."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            near = close_rows(_words(batch.column(2)), _words(batch.column(3)), radius) if batch.num_rows else []
            yield batch.select(["a", "b"]).take(pa.array(near, pa.int64()))

    return run


def _fetch(wanted):
    """(doc, h, key, text) of the texts whose key the broadcast filter may hold."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            yield batch.filter(pa.array(anchors.in_filter(wanted.value, batch.column(2).to_numpy())))

    return run


def _verify(shingle: int, similarity: float):
    """Groups of a first text and others to links (a, b) of the others at the similarity with it."""

    def run(table):
        import pyarrow as pa

        table = table.sort_by([("a", "ascending"), ("chunk", "ascending"), ("head", "descending")])
        a, b, at, first = [], [], None, None
        for x, c, rid, head, text in zip(*(table.column(k) for k in ("a", "chunk", "rid", "head", "text")), strict=True):
            if (x, c) != at:
                at, first = (x, c), shingle_set(text.as_py(), shingle)
                assert head.as_py(), "a chunk lacks its first text"
            elif alike(first, shingle_set(text.as_py(), shingle), similarity):
                a.append(x.as_py())
                b.append(rid.as_py())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _met_before(least, i, j, here):
    """Which of the pairs (i, j) share one of their least meetings that comes before `here` (a scalar or one a pair)."""
    import numpy as np

    out = np.zeros(len(i), dtype=bool)
    here = np.broadcast_to(here, len(i))
    for a in range(0, len(i), 1 << 14):
        x, y = least[i[a : a + (1 << 14)]], least[j[a : a + (1 << 14)]]
        same = (x[:, :, None] == y[:, None, :]).any(axis=2)
        out[a : a + (1 << 14)] = (same & (x < here[a : a + (1 << 14), None])).any(axis=1)
    return out


def _least_of(column):
    """The lists of a column as rows of LEAST numbers, filled up with the largest, which is before nothing."""
    import numpy as np

    out = np.full((len(column), LEAST), (1 << 63) - 1)
    for k, x in enumerate(column.to_pylist()):
        out[k, : len(x)] = x
    return out


def _list_pairs(radius: int, similarity: float):
    """The rows of some small meetings to the pairs (a, b) that may be alike: of different labels and near fingerprints."""

    def run(table):
        import numpy as np
        import pyarrow as pa

        table = table.sort_by([("meeting", "ascending"), ("rid", "ascending")])
        meeting, n, label, rid = (table.column(c).to_numpy() for c in ("meeting", "n", "label", "rid"))
        prints, least = _words(table.column("fp")), _least_of(table.column("least"))
        found = []
        for d in range(1, FEW):
            i = np.flatnonzero(meeting[d:] == meeting[:-d])
            if not len(i):
                break
            j = i + d
            some = (label[i] != label[j]) & (np.minimum(n[i], n[j]) >= similarity * np.maximum(n[i], n[j]) - 1e-9)
            i, j = i[some], j[some]
            some = ~_met_before(least, i, j, meeting[i])
            i, j = i[some], j[some]
            near = close_rows(prints[i], prints[j], radius)
            found.append(np.stack((rid[i[near]], rid[j[near]])))
        e = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
        return pa.table({"a": pa.array(e[0]), "b": pa.array(e[1])})

    return run


def _tile_pairs(table, prints, radius: int, similarity: float, bounds=None):
    """Pairs (i, j) of a tile of one large meeting that may be alike and have not met before."""
    import numpy as np

    size, side, label = (table.column(c).to_numpy() for c in ("n", "side", "label"))
    least = _least_of(table.column("least"))
    here = table.column("meeting")[0].as_py()
    order = np.argsort(size, kind="stable")
    left = order[side[order] <= 0]
    right = order[side[order] > 0] if (side > 0).any() else left
    for a in range(0, len(left), STRIP):
        x = left[a : a + STRIP]
        low = np.searchsorted(size[right], size[x[0]] * similarity - 1e-6)
        high = np.searchsorted(size[right], size[x[-1]] / similarity + 1e-6, side="right")
        for b in range(max(low, a) if right is left else low, high, BLOCK):
            y = right[b : min(b + BLOCK, high)]
            i, j = close_pairs(prints[x], prints[y], radius)
            if right is left:
                some = a + i < b + j
                i, j = i[some], j[some]
            i, j = x[i], y[j]
            some = label[i] != label[j]
            if bounds is not None:
                some &= np.bitwise_count(bounds[i] ^ bounds[j]).sum(axis=1, dtype=np.int64) <= (size[i] + size[j]) * (1 - similarity) / (1 + similarity) + 1e-6
            i, j = i[some], j[some]
            some = ~_met_before(least, i, j, here)
            yield from zip(i[some].tolist(), j[some].tolist(), strict=True)


def _partners(radius: int, similarity: float):
    """The documents of a tile that may have a similar one in it."""

    def run(table):
        import pyarrow as pa

        rid = table.column("rid").to_pylist()
        found = {x for pair in _tile_pairs(table, _words(table.column("fp")), radius, similarity) for x in pair}
        return pa.table({"rid": pa.array([rid[i] for i in sorted(found)], pa.int64()), "meeting": pa.array([table.column("meeting")[0].as_py()] * len(found), pa.int64())})

    return run


def _parity(s):
    """PARITY bits: whether an odd number of the set falls under each. Two differ in no more bits than their sets do in elements."""
    import numpy as np

    return np.packbits((np.bincount((s & np.uint64(PARITY - 1)).astype(np.int64), minlength=PARITY) & 1).astype(bool), bitorder="little").view(np.uint64)


def _similar(shingle: int, radius: int, similarity: float):
    """Links that join the components of a tile's pairs at the similarity; pairs already joined are not compared."""

    def run(table):
        import numpy as np
        import pyarrow as pa

        rid = table.column("rid").to_pylist()
        sets = [shingle_set(t.as_py(), shingle) for t in table.column("text")]
        up = list(range(len(rid)))

        def top(i):
            while up[i] != i:
                up[i] = up[up[i]]
                i = up[i]
            return i

        a, b = [], []
        for i, j in _tile_pairs(table, _words(table.column("fp")), radius, similarity, np.stack([_parity(s) for s in sets])):
            x, y = top(i), top(j)
            if x != y and alike(sets[i], sets[j], similarity):
                up[y] = x
                a.append(rid[i])
                b.append(rid[j])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _across(rows: DataFrame, scratch: Scratch):
    """Deals (rid, n, meeting, label) of large meetings into tiles that hold every pair of different labels of a meeting.

    A meeting's most frequent label is its core. Whatever has another label is chunked and meets all chunks; two of the
    core never meet, so that a tight group of near copies costs rows in proportion to its size.
    """
    labels = scratch.write(rows.groupBy("meeting", "label").agg(F.count("*").alias("c"), F.sum("n").alias("n")))
    cores = labels.groupBy("meeting").agg(F.max(F.struct("c", "label", "n")).alias("core"), F.sum("c").alias("c"), F.sum("n").alias("n"))
    chunks = lambda c, n: F.ceil(F.greatest(c / CHUNK, n / CHUNK_SHINGLES)).cast("int")
    cores = cores.select("meeting", F.col("core.label").alias("core"), chunks(F.col("c") - F.col("core.c"), F.col("n") - F.col("core.n")).alias("first"), chunks(F.col("core.c"), F.col("core.n")).alias("rest"))
    rows = rows.join(scratch.write(cores.where("first > 0")), "meeting")
    stray, deal = F.col("label") != F.col("core"), F.xxhash64("rid")
    c = F.when(stray, F.pmod(deal, "first")).otherwise(F.col("first") + F.pmod(deal, "rest")).cast("int")
    last = F.when(stray, F.col("first") + F.col("rest")).otherwise(F.col("first")) - 1
    rows = rows.withColumn("c", c).withColumn("other", F.explode(F.sequence(F.lit(0), last))).drop("core", "first", "rest")
    side = F.when(F.col("c") == F.col("other"), -1).when(F.col("c") < F.col("other"), 0).otherwise(1)
    return rows.select("*", F.least("c", "other").alias("x"), F.greatest("c", "other").alias("y"), side.alias("side"))


class _Corpus:
    """The texts behind row numbers, fetched for those that are asked for."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str):
        text = text_or_empty(F.col(text_col))
        rows = docs.select(F.col(id_col).alias("doc"), F.xxhash64(text).alias("h"), text.cast("binary").alias("text"))
        self.rows, self.kind = rows, rows.schema["doc"].dataType.simpleString()

    def texts(self, named: DataFrame, scratch: Scratch) -> DataFrame:
        """(rid, text) for the rows (rid, doc, h) of `named`. Rows equal in doc and h are one text."""
        key = F.xxhash64("doc", "h")
        filtered = anchors.Filter(named, key, named.count())
        wanted = scratch.spark.sparkContext.broadcast(filtered)
        found = self.rows.select("doc", "h", key.alias("key"), "text").mapInArrow(_fetch(wanted), f"doc {self.kind}, h long, key long, text binary")
        found = found.select(F.col("doc").alias("d"), F.col("h").alias("g"), "text").join(named, F.col("doc").eqNullSafe(F.col("d")) & (F.col("h") == F.col("g")))
        out = scratch.write(found.select("rid", "text").dropDuplicates(["rid"]))
        wanted.destroy()
        return out


def similar_groups(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """(doc, h, kept, component) of the rows of docs that have near copies, h the xxhash64 of the text.

    A pair is similar if its sets of `shingle`-word shingles have a Jaccard similarity of at least `similarity`; a group is what
    similar pairs join. Of a group the row of the smallest id is kept (a null id comes last, ties by h), and component is its
    id. Texts without words are in no group, nor is a row alike to none; rows equal in id and text are one row here. An empty table
    gives an empty one. No similar pair is lost, but for equal 64-bit hashes and the chance that RADIUS states.
    """
    corpus = _Corpus(docs, id_col, text_col)
    sc, own = scratch.spark.sparkContext, scratch.part(compact=True)
    classes = sc.broadcast(frequency_classes(corpus.rows.select("text"), own, shingle))
    sketches = corpus.rows.mapInArrow(_sketches(shingle, similarity, classes, corpus.kind), f"doc {corpus.kind}, h long, n long, fp binary, prefix array<long>")
    sketches = own.write(sketches.where("n > 0").withColumn("rid", F.monotonically_increasing_id()))
    classes.destroy()
    sized = lambda a, b: F.least(a, b) >= F.lit(similarity) * F.greatest(a, b) - 1e-9

    # Only elements that another prefix has go on: they are counted first, alone, and then looked for in a filter of them.
    met = sketches.select(F.explode("prefix").alias("meeting")).groupBy("meeting").agg(F.count("*").alias("met")).where("met > 1")
    met = own.write(met)
    wanted = sc.broadcast(anchors.Filter(met, F.col("meeting"), met.count()))
    shared = sketches.select("rid", "n", "prefix").mapInArrow(_shared(wanted), "rid long, n long, meeting long").join(met, "meeting")
    shared = own.write(shared)
    wanted.destroy()
    meetings = shared.groupBy("meeting").agg(F.min(F.struct("rid", "n")).alias("hub"), F.max("met").alias("met"), F.min("n").alias("low"), F.max("n").alias("high"))
    meetings = own.write(meetings.where((F.col("met") > 2) | sized(F.col("low"), F.col("high"))).select("meeting", "hub"))
    shared = own.write(shared.join(meetings, "meeting"))
    known = own.write(sketches.drop("prefix").join(shared.select("rid").distinct(), "rid"))
    own.drop(sketches)
    own.drop(meetings)

    def both(pairs: DataFrame, columns: list[str]) -> DataFrame:
        a = known.select(F.col("rid").alias("a"), *(F.col(c).alias(c + "a") for c in columns))
        b = known.select(F.col("rid").alias("b"), *(F.col(c).alias(c + "b") for c in columns))
        return pairs.join(a, "a").join(b, "b")

    def verified(pairs: DataFrame) -> DataFrame:
        """Links (a, b) of the pairs (a, b) at the similarity; a's partners are dealt out by their shingles."""
        ends = pairs.select(F.col("a").alias("rid")).union(pairs.select(F.col("b").alias("rid"))).distinct()
        texts = corpus.texts(known.join(ends, "rid").select("rid", "doc", "h"), own)
        weighed = pairs.join(known.select(F.col("rid").alias("b"), "n"), "b")
        heads = own.write(weighed.groupBy("a").agg(F.sum("n").alias("n")))
        total = heads.agg(F.sum("n")).first()[0] or 0
        heads = heads.select("a", F.ceil(F.col("n") / CHUNK_SHINGLES).cast("int").alias("chunks"))
        others = pairs.join(heads, "a").select("a", F.pmod(F.xxhash64("b"), "chunks").cast("int").alias("chunk"), F.col("b").alias("rid"), F.lit(False).alias("head"))
        firsts = heads.select("a", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), F.col("a").alias("rid"), F.lit(True).alias("head"))
        # A chunk needs its first text only where it has others.
        firsts = firsts.join(others.select("a", "chunk").distinct(), ["a", "chunk"])
        shard = F.pmod(F.xxhash64("a", "chunk"), F.lit(max(1, math.ceil(total / SHARD_SHINGLES))))
        dealt = others.union(firsts.select("a", "chunk", "rid", "head")).withColumn("shard", shard).join(texts, "rid")
        links = own.write(dealt.groupBy("shard").applyInArrow(whole_group(_verify(shingle, similarity)), "a long, b long"), compact=False)
        own.drop(texts)
        return links

    hubs = shared.where(F.col("rid") != F.col("hub.rid")).where(sized(F.col("n"), F.col("hub.n")))
    pairs = both(hubs.select(F.col("hub.rid").alias("a"), F.col("rid").alias("b")).distinct(), ["fp"])
    links = verified(own.write(pairs.select("a", "b", "fpa", "fpb").mapInArrow(_gate(radius), "a long, b long")))
    roots = own.write(connected_components(links, own))

    # Meetings that still hold several components.
    labels = own.write(known.join(roots.withColumnRenamed("node", "rid"), "rid", "left").select("rid", "n", "fp", F.coalesce("root", "rid").alias("label")))
    named = shared.select("rid", "meeting", "met").join(labels.select("rid", "label"), "rid")
    mixed = own.write(named.groupBy("meeting").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("meeting"))
    named = own.write(named.join(mixed, "meeting", "left_semi").select("rid", "meeting", "met"))
    own.drop(shared)
    least = named.groupBy("rid").agg(F.slice(F.sort_array(F.collect_list("meeting")), 1, LEAST).alias("least"))  # at most its prefix
    least = own.write(least.join(labels, "rid"))
    few = F.col("met") <= min(FEW, CHUNK)
    small = named.where(few).select("rid", "meeting").join(least, "rid")
    groups = max(1, math.ceil(named.count() / 8192))
    small = small.withColumn("group", F.pmod(F.xxhash64("meeting"), F.lit(groups))).groupBy("group")
    pairs = own.write(small.applyInArrow(whole_group(_list_pairs(radius, similarity)), "a long, b long").distinct(), compact=False)
    more = verified(pairs)
    large = named.where(~few).select("rid", "meeting").join(least.drop("fp"), "rid")
    if not large.isEmpty():
        prints = labels.select("rid", "fp")
        tiles = _across(large, own).join(prints, "rid").groupBy("meeting", "x", "y")
        partners = own.write(tiles.applyInArrow(whole_group(_partners(radius, similarity)), "rid long, meeting long").distinct(), compact=False)
        texts = corpus.texts(known.join(partners.select("rid").distinct(), "rid").select("rid", "doc", "h"), own)
        tiles = _across(partners.join(least.drop("fp"), "rid"), own).join(prints, "rid").join(texts, "rid").groupBy("meeting", "x", "y")
        more = own.write(more.union(tiles.applyInArrow(whole_group(_similar(shingle, radius, similarity)), "a long, b long")), compact=False)
    if not more.isEmpty():
        roots = connected_components(links.union(more), own)
    members = own.write(roots.withColumnRenamed("node", "rid").join(known.select("rid", "doc", "h"), "rid").select("root", "doc", "h"))
    first = own.write(members.groupBy("root").agg(F.min(F.struct(F.col("doc").isNull().alias("none"), "doc", "h")).alias("first")))
    kept = F.col("doc").eqNullSafe(F.col("first.doc")) & (F.col("h") == F.col("first.h"))
    out = scratch.write(members.join(first, "root").select("doc", "h", kept.alias("kept"), F.col("first.doc").alias("component")))
    own.close()
    return out


def drop_near_copies(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """docs without all but one row of each group of near copies; see similar_groups for the groups and which row stays.

    Rows keep their columns, whatever those are called. Null and empty texts stay, as do rows with a null id that are alike to
    none; rows equal in id and text share their fate. An empty table gives an empty one.
    """
    lost = similar_groups(docs, scratch, id_col, text_col, **how).where("not kept").select("doc", "h").distinct()
    doc, h = fresh(docs, "doc", "h")
    lost = lost.select(F.col("doc").alias(doc), F.col("h").alias(h))
    return docs.join(lost, F.col(id_col).eqNullSafe(F.col(doc)) & (F.xxhash64(text_or_empty(F.col(text_col))) == F.col(h)), "left_anti")
