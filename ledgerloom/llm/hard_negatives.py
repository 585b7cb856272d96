"""Hard negatives by vantage-point trees over norm-augmented vectors.

Rows are dealt into shards of bounded size, anchors into blocks, and each shard meets each block in one task, which builds the shard's tree.
With one more coordinate all of a shard's vectors get one length M: then the squared distance to an anchor q is
|q|^2 + M^2 - 2 q.x, so that a window of inner products is an annulus around q. Nodes are visited nearest first from the annulus's inner
edge on, as far as they can still hold a row that comes before the k-th found, and never outside it. Each shard's first k are merged into the whole's.

Components are whole numbers, so that inner products are exact; distances only rule nodes out, with room for rounding.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Scratch, read_table, settled, whole_group

#: Rows of a shard and anchors of a block, about.
SHARD_ROWS, BLOCK_ANCHORS = 16_384, 2_048
#: Rows of a leaf.
LEAF = 128
POSITIVES, NEGATIVES = 5, 10
#: A negative's score in percent of the positive's.
LOW, HIGH = 30, 90
#: Scores beyond are taken for it, so that they fit a long; and components beyond, so that their squares are finite.
MOST, LARGEST = 1 << 62, 1e140


class VantageTree:
    """The vantage-point tree of vectors of whole numbers, with an id and a label each."""

    def __init__(self, vectors, ids, labels):
        import numpy as np

        square = np.einsum("ij,ij->i", vectors, vectors)
        self.reach = float(square.max(initial=0.0))  # M^2
        extra = np.sqrt(np.maximum(self.reach - square, 0.0))
        order = np.lexsort((ids, square))
        self.nodes = []  # (start, end, label of all or None, vantage, [(nearest, farthest, child)])
        self.vantages = []

        def build(members):
            at, labels_here = len(self.nodes), labels[members]
            only = int(labels_here[0]) if (labels_here == labels_here[0]).all() else None
            self.nodes.append(None)
            if len(members) <= LEAF:
                self.nodes[at] = (self.filled, self.filled + len(members), only, None, ())
                self.order.append(members)
                self.filled += len(members)
                return at
            v = members[0]
            d = np.sqrt(np.maximum(2 * (self.reach - vectors[members] @ vectors[v] - extra[members] * extra[v]), 0.0))
            by = np.argsort(d, kind="stable")
            half, mine = len(members) // 2, len(self.vantages)
            self.vantages.append(v)
            inner, outer = by[:half][::-1], by[half:]  # the inner half's farthest is its vantage
            parts = [(float(d[p].min()), float(d[p].max()), build(members[p])) for p in (inner, outer)]
            self.nodes[at] = (0, 0, only, mine, parts)
            return at

        self.order, self.filled = [], 0
        if len(ids):
            build(order)
        order = np.concatenate(self.order) if self.order else order
        self.vantage, self.vantage_extra = vectors[self.vantages], extra[self.vantages]
        self.vectors, self.ids, self.labels = vectors[order], ids[order], labels[order]
        self.longest = math.sqrt(self.reach)

    def probe(self, anchor):
        """What searches for one anchor share: its distances to the vantages, and leaves' scores as they are needed."""
        import numpy as np

        size = float(anchor @ anchor)
        # An anchor's extra coordinate is 0.
        away = np.sqrt(np.maximum(size + self.reach - 2 * (self.vantage @ anchor), 0.0)) if len(self.vantages) else ()
        exact = math.sqrt(size) * self.longest < 2**53
        return anchor, size, away, exact, {}

    def _scores(self, probe, node, start, end):
        import numpy as np

        anchor, _, _, exact, known = probe
        if node not in known:
            if exact:
                known[node] = (self.vectors[start:end] @ anchor).astype(np.int64)
            else:  # beyond what doubles hold, by whole numbers of any size
                whole = [[int(x) for x in row] for row in self.vectors[start:end]]
                q = [int(x) for x in anchor]
                known[node] = np.array([max(-MOST, min(MOST, sum(map(lambda a, b: a * b, row, q)))) for row in whole], dtype=np.int64)
        return known[node]

    def first(self, probe, k, low, high, keep):
        """The first k (score, id) by score downwards, then id, of rows with low <= score <= high that keep(labels, ids) lets through.

        keep also takes a node's only label, with None for its ids, to tell whether the node can hold such rows.
        """
        import heapq

        import numpy as np

        if not self.nodes or low > high:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        _, size, away, _, _ = probe
        both = size + self.reach
        room = 1e-7 * (math.sqrt(size) + self.longest) + 1e-6
        least, most = (math.sqrt(max(both - 2.0 * high, 0.0)) if high < MOST else 0.0) - room, math.sqrt(max(both - 2.0 * low, 0.0)) + room
        scores, ids = np.zeros(0, np.int64), np.zeros(0, np.int64)
        heap = [(0.0, 0, 0.0, math.inf)]
        while heap:
            near, node, inner, outer = heapq.heappop(heap)
            if near > most:
                break
            start, end, only, vantage, parts = self.nodes[node]
            if vantage is None:
                s = self._scores(probe, node, start, end)
                ok = (s >= low) & (s <= high)
                if ok.any():
                    ok &= keep(self.labels[start:end], self.ids[start:end])
                    found = np.flatnonzero(ok)
                    if len(found):
                        scores, ids = np.concatenate((scores, s[found])), np.concatenate((ids, self.ids[start:end][found]))
                        first = np.lexsort((ids, -scores))[:k]
                        scores, ids = scores[first], ids[first]
                        if len(scores) == k:
                            low = int(scores[-1])
                            most = min(most, math.sqrt(max(both - 2.0 * low, 0.0)) + room)
                continue
            d = away[vantage]
            for shortest, farthest, child in parts:
                a, b = max(inner, d - farthest, shortest - d), min(outer, d + farthest)
                if a > most or b < least:
                    continue
                label = self.nodes[child][2]
                if label is not None and not keep(label, None):
                    continue
                heapq.heappush(heap, (max(a, least), child, a, b))
        return scores, ids


def _tree_of(rows):
    import numpy as np

    vectors = rows.column("codes").combine_chunks()
    vectors = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(rows.num_rows, -1)
    return VantageTree(vectors, rows.column("row").to_numpy(), rows.column("label").to_numpy())


def _vectors(table):
    import numpy as np

    return table.column("codes").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(table.num_rows, -1)


def _find_positives(k):
    """A block's anchors and a shard to (anchor, row, score), the shard's first k of each anchor's label."""

    def run(anchors, rows):
        import numpy as np
        import pyarrow as pa

        out = [(np.zeros(0, np.int64),) * 3]
        if anchors.num_rows and rows.num_rows:
            tree = _tree_of(rows)
            for me, label, q in zip(anchors.column("row").to_pylist(), anchors.column("label").to_pylist(), _vectors(anchors), strict=True):
                scores, ids = tree.first(tree.probe(q), k, -MOST, MOST, lambda labels, there, label=label, me=me: (labels == label) if there is None else (labels == label) & (there != me))
                out.append((np.full(len(ids), me), ids, scores))
        return pa.table(dict(zip(("anchor", "row", "score"), map(pa.array, map(np.concatenate, zip(*out, strict=True))), strict=True)))

    return run


def _find_negatives(k, low, high):
    """A block's anchors, with the scores of their positives, and a shard to (anchor, score of the positive, row, score)."""

    def run(anchors, rows):
        import numpy as np
        import pyarrow as pa

        out = [(np.zeros(0, np.int64),) * 4]
        if anchors.num_rows and rows.num_rows:
            tree = _tree_of(rows)
            for me, label, wanted, q in zip(anchors.column("row").to_pylist(), anchors.column("label").to_pylist(), anchors.column("wanted").to_pylist(), _vectors(anchors), strict=True):
                probe = tree.probe(q)
                for p in wanted:
                    scores, ids = tree.first(probe, k, max(-MOST, -(-low * p // 100)), min(MOST, high * p // 100), lambda labels, there, label=label: labels != label)
                    out.append((np.full(len(ids), me), np.full(len(ids), p), ids, scores))
        return pa.table(dict(zip(("anchor", "positive_score", "row", "score"), map(pa.array, map(np.concatenate, zip(*out, strict=True))), strict=True)))

    return run


def mine(vectors: DataFrame, scratch: Scratch, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", anchors_of: int = 100, relabel: int = 7,
         shard_rows: int = SHARD_ROWS, block_anchors: int = BLOCK_ANCHORS) -> DataFrame:
    """Rows anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Each anchor (id divisible by `anchors_of`) has as positives its first POSITIVES other rows of its label; each positive has as negatives the first
    NEGATIVES rows of other labels whose score is LOW to HIGH percent of its own. First is by score downwards, then by id. Where the id is
    divisible by `relabel` the label is first moved on by one modulo 10. Components are floor(256 x).

    Rows with a null label or vector, or a component that is null or not finite, take no part; a row with a null id is no anchor and comes last
    among equals. Vectors of another length than the anchor's aren't compared; empty vectors all score 0. Rows that
    repeat are rows each, as anchors too: an anchor leaves out itself only. A label may hold any share of the rows and vectors may be equal in any number: shards
    are dealt by the row, not by what it holds. Without positives or negatives there are no rows; an empty table gives an empty one. A
    score beyond 2^62 counts as 2^62, a component beyond 1e140 as that.
    """
    kind = vectors.schema[id_col].dataType.simpleString()
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf))
    rows = rows.where("label is not null and v is not null").where(finite)
    moved = F.when(F.col("id") % relabel == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    capped = lambda x: F.greatest(F.least(x, F.lit(LARGEST)), F.lit(-LARGEST)) * 256
    codes = F.transform("v", lambda x: F.when(F.abs(x) < 1 << 44, F.floor(x * 256).cast("double")).otherwise(capped(x)))  # beyond, doubles are whole
    rows = scratch.write(rows.select("id", moved.alias("label"), codes.alias("codes"), F.size("v").alias("dim")))
    # A row's number orders equal scores by id; its place in the written table tells rows of one id apart.
    numbered = number(rows, scratch)
    anchors = scratch.write(numbered.where(F.col("id") % anchors_of == 0).select("row", "id", "label", "codes", "dim"))
    shards, blocks = max(1, math.ceil(numbered.count() / shard_rows)), max(1, math.ceil(anchors.count() / block_anchors))

    def meet(asking: DataFrame, find, schema: str) -> DataFrame:
        dealt = numbered.select("row", "label", "codes", "dim", F.pmod(F.xxhash64("row"), F.lit(shards)).alias("shard")).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        asking = asking.withColumn("block", F.pmod(F.xxhash64("row", F.lit("block")), F.lit(blocks)).cast("int")).withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))))
        return asking.groupBy("dim", "shard", "block").cogroup(dealt.groupBy("dim", "shard", "block")).applyInArrow(find, schema)

    def first(found: DataFrame, keys: list[str], k: int) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(W.partitionBy(*keys).orderBy(F.desc("score"), "row"))).where(F.col("rank") <= k)

    positives = meet(anchors.select("row", "label", "codes", "dim"), _find_positives(POSITIVES), "anchor long, row long, score long")
    positives = scratch.write(first(positives, ["anchor"], POSITIVES))
    wanted = positives.groupBy(F.col("anchor").alias("row")).agg(F.collect_set("score").alias("wanted"))  # at most POSITIVES
    negatives = meet(anchors.join(wanted, "row").select("row", "label", "codes", "dim", "wanted"), _find_negatives(NEGATIVES, LOW, HIGH), "anchor long, positive_score long, row long, score long")
    negatives = first(negatives, ["anchor", "positive_score"], NEGATIVES)
    name = lambda key, to: numbered.select(F.col("row").alias(key), F.col("id").alias(to))
    out = positives.select("anchor", F.col("row").alias("positive"), F.col("score").alias("positive_score"))
    out = out.join(negatives.select("anchor", "positive_score", "rank", F.col("row").alias("negative"), F.col("score").alias("negative_score")), ["anchor", "positive_score"])
    out = out.join(name("anchor", "anchor_id"), "anchor").join(name("positive", "positive_id"), "positive").join(name("negative", "negative_id"), "negative")
    return out.select(F.col("anchor_id").cast(kind).alias("anchor_id"), "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


def number(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """rows, a written table, with `row`: numbers from 0 in the order of the id, null last, and of all else for rows of one id.

    Rows are sorted by ranges and counted within each; only the ranges' counts meet in one task.
    """
    order = [F.col("id").asc_nulls_last(), "label", "dim", "codes", F.monotonically_increasing_id()]  # equal rows may be many
    sorted_rows = scratch.write(rows.orderBy(*order).withColumn("part", F.spark_partition_id()).withColumn("place", F.monotonically_increasing_id()))
    counts = sorted_rows.groupBy("part").agg(F.count("*").alias("n"))
    starts = counts.withColumn("start", F.coalesce(F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    placed = F.col("place") - F.shiftleft(F.col("part").cast("long"), 33) + F.col("start")
    return scratch.write(sorted_rows.join(F.broadcast(starts.select("part", "start")), "part").select("id", "label", "codes", "dim", placed.alias("row")))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return settled(spark, "op13", lambda scratch: mine(read_table(spark, sf_dir, "embeddings"), scratch))


ORACLE = f"""
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM rows a JOIN rows b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {POSITIVES})
SELECT anchor_id, positive_id, (row_number() OVER w)::INTEGER AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND {LOW} * positive_score <= 100 * score AND 100 * score <= {HIGH} * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= {NEGATIVES}
"""
