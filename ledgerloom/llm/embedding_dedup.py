"""Near-deduplication of embeddings by a subspace pigeonhole join.

Unit vectors are rotated and cut into blocks of few dimensions. Two vectors within squared distance D are, in some block,
within the block's share of D by its dimensions. So each block is range-joined under its share over a grid of its first
coordinates, and what it finds is verified exactly. A pair counts in the first block that qualifies it, no other, so that
the union of the blocks' candidates needs no deduplication.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, connected_components, read_table, settled, whole_group
from .simhash_dedup import forest

COSINE = 0.93
#: Dimensions of a block.
BLOCK = 8
#: Vectors of a grid cell beyond which it is cut into chunks, whose pairs are dealt out.
CELL = 2000
ROTATION_SEED = 20240
#: Candidate pairs that are verified at a time.
PAIRS = 40_000


def _rotation(dim: int):
    """A fixed random rotation: it spreads any vector's length over all blocks and keeps distances."""
    import numpy as np

    q, r = np.linalg.qr(np.random.default_rng(ROTATION_SEED).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def _prepare(table_column):
    """Unit vectors in double precision from a list column of one length.

    einsum without BLAS adds up in an order that depends on the dimension alone, so that every task gets the same numbers.
    """
    import numpy as np

    flat = table_column.combine_chunks() if hasattr(table_column, "combine_chunks") else table_column
    x = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _blocks(dim: int, cosine: float):
    """(cuts, budgets): where blocks start and end, and the squared distance that each may use, with room for rounding."""
    count = max(1, dim // BLOCK)
    cuts = [round(k * dim / count) for k in range(count + 1)]
    whole = (2.0 - 2.0 * cosine) * (1 + 1e-9) + 1e-12
    return cuts, [whole * (b - a) / dim for a, b in zip(cuts, cuts[1:], strict=False)]


def _deal(cosine: float, grid: int):
    """Each vector's coordinates in every block, once for its home cell there and once for each smaller neighbour in its reach."""

    def run(batches):
        import itertools

        import numpy as np
        import pyarrow as pa

        for batch in batches:
            dims = np.diff(batch.column(2).offsets.to_numpy())
            for dim in np.unique(dims):
                part = batch.take(pa.array(np.flatnonzero(dims == dim)))
                y = np.einsum("ij,jk->ik", _prepare(part.column(2)), _rotation(int(dim)))
                cuts, budgets = _blocks(int(dim), cosine)
                for k, budget in enumerate(budgets):
                    reach = math.sqrt(budget)
                    z = y[:, cuts[k] : cuts[k + 1]].astype(np.float32)
                    at = y[:, cuts[k] : min(cuts[k] + grid, cuts[k + 1])] / (2 * reach)
                    home = np.floor(at).astype(np.int64)
                    frac = at - home
                    coordinates = pa.FixedSizeBinaryArray.from_buffers(pa.binary(4 * z.shape[1]), len(z), [None, pa.py_buffer(np.ascontiguousarray(z))]).cast(pa.binary())
                    for move in itertools.product((-1, 0, 1), repeat=at.shape[1]):
                        if move > (0,) * at.shape[1]:
                            continue
                        near = np.ones(len(at), dtype=bool)
                        for c, m in enumerate(move):
                            near &= (frac[:, c] <= 0.5 + 1e-9) if m < 0 else (frac[:, c] >= 0.5 - 1e-9) if m > 0 else True
                        if not near.any():
                            continue
                        cell = np.ascontiguousarray((home[near] + np.array(move)).astype(np.int32))
                        code = pa.FixedSizeBinaryArray.from_buffers(pa.binary(4 * cell.shape[1]), len(cell), [None, pa.py_buffer(cell)]).cast(pa.binary())
                        rows = pa.array(np.flatnonzero(near))
                        n = len(rows)
                        yield pa.RecordBatch.from_arrays(
                            [part.column(0).take(rows), part.column(1).take(rows), pa.array([k] * n, pa.int32()), pa.array([dim] * n, pa.int32()), code, pa.array([any(move)] * n), coordinates.take(rows)],
                            names=["cls", "label", "block", "dim", "cell", "guest", "z"],
                        )

    return run


def _partners(cosine: float):
    """The rows of a tile that have another one within the block's budget. Coordinates are rounded, the budget has room for it."""

    def run(table):
        import numpy as np

        _, budgets = _blocks(table.column("dim")[0].as_py(), cosine)
        budget = budgets[table.column("block")[0].as_py()] + 1e-5
        z = np.frombuffer(b"".join(table.column("z").to_pylist()), dtype=np.float32).reshape(table.num_rows, -1).astype(np.float64)
        square, side = (z * z).sum(axis=1), table.column("side").to_numpy()
        left = np.flatnonzero(side <= 0)
        right = left if not (side > 0).any() else np.flatnonzero(side > 0)
        found = np.zeros(len(z), dtype=bool)
        step = max(1, 4_000_000 // max(1, len(right)))
        for s in range(0, len(left), step):
            rows = left[s : s + step]
            close = square[rows][:, None] + square[right][None, :] - 2 * (z[rows] @ z[right].T) <= budget
            if right is left:
                close[np.arange(len(rows)), np.arange(s, s + len(rows))] = False
            found[rows] |= close.any(axis=1)
            found[right] |= close.any(axis=0)
        return table.drop_columns(["z"]).take(np.flatnonzero(found))

    return run


def _verify(cosine: float):
    """One tile to link counts (cls, null, n) and links (cls, cls, null) that join its components."""

    def run(table):
        import numpy as np
        import pyarrow as pa

        k, dim = table.column("block")[0].as_py(), table.column("dim")[0].as_py()
        table = table.sort_by("cls")
        ids, copies, side = (table.column(c).to_numpy() for c in ("cls", "copies", "side"))
        u = _prepare(table.column("embedding"))
        y = np.einsum("ij,jk->ik", u, _rotation(dim))
        cuts, budgets = _blocks(dim, cosine)
        z = y[:, cuts[k] : cuts[k + 1]]
        square = (z * z).sum(axis=1)
        left = np.flatnonzero(side <= 0)
        right = left if not (side > 0).any() else np.flatnonzero(side > 0)
        links, edges = np.zeros(len(ids), dtype=np.int64), []
        step = max(1, 4_000_000 // max(1, len(right)))
        for s in range(0, len(left), step):
            rows = left[s : s + step]
            close = square[rows][:, None] + square[right][None, :] - 2 * (z[rows] @ z[right].T) <= budgets[k] + 1e-9
            ii, jj = np.nonzero(close)
            ii, jj = rows[ii], right[jj]
            if right is left:
                some = ii < jj
                ii, jj = ii[some], jj[some]
            for a in range(0, len(ii), PAIRS):
                i, j = ii[a : a + PAIRS], jj[a : a + PAIRS]
                gap = (y[i] - y[j]) ** 2
                apart = np.add.reduceat(gap, cuts[:-1], axis=1)
                fits = apart <= np.array(budgets)
                ok = fits[:, k] & ~fits[:, :k].any(axis=1)
                ok &= np.einsum("ij,ij->i", u[i], u[j]) >= cosine
                i, j = i[ok], j[ok]
                np.add.at(links, i, copies[j])
                np.add.at(links, j, copies[i])
                m, r = forest(i, j, len(ids)) if len(i) else (i, j)
                edges.append(np.stack((ids[m], ids[r])))
        e = np.concatenate(edges, axis=1) if edges else np.zeros((2, 0), np.int64)
        e = np.unique(e, axis=1)
        some = np.flatnonzero(links)
        none = lambda n: np.ones(n, dtype=bool)
        return pa.table({
            "a": pa.array(np.concatenate((ids[some], e[0]))),
            "b": pa.concat_arrays([pa.array(np.zeros(len(some), np.int64), mask=none(len(some))), pa.array(e[1])]),
            "n": pa.concat_arrays([pa.array(links[some]), pa.array(np.zeros(e.shape[1], np.int64), mask=none(e.shape[1]))]),
        })

    return run


def near_vectors(vectors: DataFrame, scratch: Scratch, cosine: float = COSINE, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """Per row of vectors: vec_id, n_links, component_id, kept.

    Rows of equal, non-null label and equal dimension link at a cosine of at least `cosine`, in double precision. Vectors
    that are null, empty, zero or hold a null or non-finite component link with nothing. Equal vectors of a label are one
    class with its number of copies: copies link with each other and share the class's links. component_id is the smallest
    id reachable. Rows of equal id are rows each. An empty table gives an empty one.

    Blocks deal their own coordinates only; whole vectors follow for those that have a partner in a block. A cell with more than
    CELL vectors is cut into chunks, and each pair of chunks is one tile. Tiles hand on counts of links and spanning links,
    never their pairs. With g coordinates in the grid, a vector has up to (2^g + 1) / 2 rows a block.
    """
    v = F.col(vector_col)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    useful = F.col(label_col).isNotNull() & v.isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), v.alias("embedding"), F.coalesce(useful, F.lit(False)).alias("useful"))
    good = rows.where("useful")
    classes = good.groupBy("label", "embedding").agg(F.count("*").alias("copies"), F.min("vec_id").alias("least"))
    classes = scratch.write(classes.withColumn("cls", F.monotonically_increasing_id()))
    most = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    grid = min(BLOCK, max(1, math.ceil(math.log(max(most, 2) / CELL, 3)) + 1))
    kind = dict(classes.dtypes)["label"]
    dealt = scratch.write(classes.select("cls", "label", "embedding").mapInArrow(_deal(cosine, grid), f"cls long, label {kind}, block int, dim int, cell binary, guest boolean, z binary"))
    cell = ["label", "dim", "block", "cell"]
    sizes = dealt.groupBy(*cell).agg(F.count_if(~F.col("guest")).alias("homes"), F.count_if("guest").alias("guests"))
    # Without a home vector, or with one vector alone, a cell has no pair of its own.
    sizes = sizes.where("homes > 0 and homes + guests > 1").select(*cell, F.ceil(F.col("homes") / CELL).cast("int").alias("p"), F.ceil(F.col("guests") / CELL).cast("int").alias("q"))
    tiles = dealt.join(scratch.write(sizes), cell)
    chunk = F.pmod(F.xxhash64("cls"), F.when(F.col("guest"), F.col("q")).otherwise(F.col("p"))).cast("int")
    tiles = tiles.withColumn("chunk", chunk)
    # Tile (x, y, false): home chunks x <= y; (x, y, true): home chunk x and guest chunk y.
    one = lambda x, y, guest, side: F.struct(x.cast("int").alias("x"), y.cast("int").alias("y"), F.lit(guest).alias("mixed"), side.cast("int").alias("side"))
    c = F.col("chunk")
    home_home = F.transform(F.sequence(F.lit(0), F.col("p") - 1), lambda o: one(F.least(c, o), F.greatest(c, o), False, F.when(c <= o, 0).otherwise(1)))
    home_guest = F.transform(F.sequence(F.lit(0), F.greatest(F.col("q"), F.lit(1)) - 1), lambda o: one(c, o, True, F.lit(0)))
    guest_home = F.transform(F.sequence(F.lit(0), F.col("p") - 1), lambda o: one(o, c, True, F.lit(1)))
    to = F.when(F.col("guest"), guest_home).when(F.col("q") > 0, F.concat(home_home, home_guest)).otherwise(home_home)
    tile = [*cell, "x", "y", "mixed"]
    tiles = tiles.withColumn("to", F.explode(to)).select("cls", "z", *cell, "to.x", "to.y", "to.mixed", "to.side")
    near = tiles.groupBy(*tile).applyInArrow(whole_group(_partners(cosine)), f"cls long, label {kind}, dim int, block int, cell binary, x int, y int, mixed boolean, side int")
    near = scratch.write(near)
    scratch.drop(dealt)
    # Whole vectors go only where a block has let a pair through.
    found = scratch.write(near.join(classes.drop("label"), "cls").groupBy(*tile).applyInArrow(whole_group(_verify(cosine)), "a long, b long, n long"))
    scratch.drop(near)
    counts = found.where("b is null").groupBy(F.col("a").alias("cls")).agg(F.sum("n").alias("links"))
    roots = connected_components(found.where("b is not null").select("a", "b"), scratch).withColumnRenamed("node", "cls")
    named = classes.join(counts, "cls", "left").join(roots, "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    named = scratch.write(named)
    least = scratch.write(named.groupBy("root").agg(F.min("least").alias("component_id")))
    named = named.join(least, "root").select("label", "embedding", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    linked = good.join(named, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    alone = rows.where("not useful").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return settled(spark, "vectors", lambda scratch: near_vectors(read_table(spark, sf_dir, "embeddings"), scratch))


ORACLE = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= {COSINE}),
reach AS (
  SELECT vec_id AS node, vec_id AS seen FROM embeddings
  UNION
  SELECT r.node, l.b FROM reach r JOIN links l ON r.seen = l.a)
SELECT node AS vec_id, (SELECT count(*) FROM links WHERE a = node) AS n_links, min(seen) AS component_id, node = min(seen) AS kept
FROM reach GROUP BY node
"""
