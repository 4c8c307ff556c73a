"""Exact top-k inner-product search with ball trees (operator 1).

Rows are dealt into shards of bounded size; each shard is one ball tree (numpy arrays in a
single row). Queries come in blocks. A block meets the shards in two rounds: in the first
it searches one shard; the kth scores found there are shared with every other shard, which
then opens only nodes whose bound can still beat them.

The bound of a ball for query q is q.c + |q| r (a little more, for rounding). Within a
shard the nodes' bounds are worked out level by level for the whole block; leaves are
opened in descending order of their bounds, the best leaf of each query first, and each
opened leaf raises the query's kth score before the next round of leaves.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.storage import written

LEAF = 64
SHARD_ROWS = 4096
QUERY_BLOCK = 512
EXACT = float(1 << 53)


def quantised(table: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(vec_id, v array<long>, dim, key): floor(scale * x) and a row number; vectors that are null, or hold null or
    non-finite components, take no part. Components must fit a long when scaled."""
    x = F.col("v")
    usable = x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c)
                                      & (F.abs(c) != F.lit(float("inf"))))
    return (table.select(F.col(id_col).cast("long").alias("vec_id"),
                         F.col(vector_col).cast("array<double>").alias("v"))
            .filter(F.col("vec_id").isNotNull() & F.coalesce(usable, F.lit(False)))
            .select("vec_id", F.transform("v", lambda c: F.floor(F.lit(float(scale)) * c)).alias("v"),
                    F.size("v").alias("dim"), F.monotonically_increasing_id().alias("key")))


# ---- the tree ------------------------------------------------------------------------
def build_tree(ids: np.ndarray, vectors: np.ndarray) -> dict:
    """A balanced ball tree: rows are halved along the widest direction between two far
    points until leaves hold LEAF rows. Nodes are stored level by level: children of node
    i are 2i + 1 and 2i + 2; a leaf's rows are sorted by id."""
    depth = max(0, math.ceil(math.log2(max(1, len(ids)) / LEAF))) if len(ids) > LEAF else 0
    order = np.arange(len(ids))
    parts = [order]
    nodes = [parts]
    for _ in range(depth):
        halves = []
        for part in parts:
            v = vectors[part].astype(np.float64)
            if len(part) > 1:
                a = v[np.argmax(((v - v[0]) ** 2).sum(axis=1))]
                b = v[np.argmax(((v - a) ** 2).sum(axis=1))]
                by = np.lexsort((ids[part], v @ (b - a)))
            else:
                by = np.arange(len(part))
            half = (len(part) + 1) // 2
            halves += [part[by[:half]], part[by[half:]]]
        parts = halves
        nodes.append(parts)
    parts = [p[np.argsort(ids[p], kind="stable")] for p in parts]
    nodes[-1] = parts
    flat = [p for level in nodes for p in level]
    dim = vectors.shape[1]
    centres = np.zeros((len(flat), dim))
    radii = np.full(len(flat), -1.0)  # an empty node
    first = np.full(len(flat), np.iinfo(np.int64).max)
    for i, p in enumerate(flat):
        if len(p):
            v = vectors[p].astype(np.float64)
            centres[i] = v.mean(axis=0)
            radii[i] = math.sqrt(((v - centres[i]) ** 2).sum(axis=1).max(initial=0.0))
            first[i] = ids[p].min()
    rows = np.concatenate(parts) if parts else order
    return {"ids": ids[rows], "vectors": vectors[rows], "depth": depth, "centres": centres, "radii": radii,
            "first": first, "starts": np.cumsum([0] + [len(p) for p in parts])}


def scores(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Exact integer inner products. Doubles hold them up to 2^53; beyond, longs."""
    peak = float(np.abs(q).max(initial=0)) * float(np.abs(v).max(initial=0)) * max(1, v.shape[1])
    if peak < EXACT:
        return np.rint(q.astype(np.float64) @ v.astype(np.float64).T).astype(np.int64)
    return q @ v.T


class Best:
    """The k best (score, id) of each query so far: score descending, id ascending."""

    def __init__(self, n: int, k: int) -> None:
        self.k = k
        self.score = np.full((n, k), np.iinfo(np.int64).min)
        self.id = np.full((n, k), np.iinfo(np.int64).max)

    def add(self, rows: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        """``score``: rows x candidates (their ids the same for all rows)."""
        s = np.concatenate((self.score[rows], score), axis=1)
        i = np.concatenate((self.id[rows], np.broadcast_to(ids, score.shape)), axis=1)
        by = np.lexsort((i, -s.astype(np.float64) if np.abs(s[s > np.iinfo(np.int64).min]).max(initial=0) < EXACT
                         else ~s), axis=1)[:, : self.k]
        self.score[rows] = np.take_along_axis(s, by, axis=1)
        self.id[rows] = np.take_along_axis(i, by, axis=1)


def search_tree(tree: dict, q_ids: np.ndarray, q: np.ndarray, k: int, floor: np.ndarray,
                floor_id: np.ndarray) -> Best:
    """The k best candidates of the tree for each query, leaving out what cannot beat the
    kth score known so far (``floor``; ``floor_id`` breaks ties)."""
    best = Best(len(q), k)
    norm = np.sqrt((q.astype(np.float64) ** 2).sum(axis=1))
    qf = q.astype(np.float64)

    def bound(rows: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        # rows x nodes; rounding of the products is far below one part in 2^40
        dots = qf[rows] @ tree["centres"][nodes].T
        reach = norm[rows, None] * tree["radii"][nodes]
        return dots + reach + (np.abs(dots) + reach) * 2.0 ** -40 + 0.5

    def can(rows: np.ndarray, nodes: np.ndarray, ub: np.ndarray) -> np.ndarray:
        kth, kth_id = np.maximum(floor, best.score[:, -1]), floor_id.copy()
        own = best.score[:, -1] >= floor
        kth_id[own] = np.where(best.score[own, -1] > floor[own], best.id[own, -1],
                               np.minimum(best.id[own, -1], floor_id[own]))
        whole = np.floor(ub)
        return (tree["radii"][nodes] >= 0) & (
            (whole > kth[rows, None]) | ((whole == kth[rows, None]) & (tree["first"][nodes] < kth_id[rows, None])))

    depth = tree["depth"]
    alive = np.ones((len(q), 1), bool)
    rows = np.arange(len(q))
    for level in range(depth + 1):
        nodes = np.arange(2 ** level - 1, 2 ** (level + 1) - 1)
        if level:
            alive = np.repeat(alive, 2, axis=1)
        ub = bound(rows, nodes)
        alive &= can(rows, nodes, ub)
    leaves = nodes
    ub = np.where(alive, ub, -np.inf)
    by = np.argsort(-ub, axis=1, kind="stable")
    live = rows[alive.any(axis=1)]
    for turn in range(len(leaves)):
        if not len(live):
            break
        leaf = by[live, turn]
        now = ub[live, leaf]
        ok = now > -np.inf
        live, leaf, now = live[ok], leaf[ok], now[ok]
        if not len(live):
            break
        # a query whose next bound is below its kth score is done: later bounds are lower still
        kth = np.maximum(floor[live], best.score[live, -1])
        go = np.floor(now) >= kth
        live, leaf = live[go], leaf[go]
        for x in np.unique(leaf):
            mine = live[leaf == x]
            a, b = tree["starts"][x], tree["starts"][x + 1]
            s = scores(q[mine], tree["vectors"][a:b])
            ids = tree["ids"][a:b]
            s = np.where(ids[None, :] == q_ids[mine, None], np.iinfo(np.int64).min, s)
            best.add(mine, s, ids)
    best.id[best.score == np.iinfo(np.int64).min] = np.iinfo(np.int64).max
    return best


# ---- on Spark ------------------------------------------------------------------------
TREES = "shard long, dim int, blob binary"
FOUND = "key long, query_id long, vec_id long, score long"


def _pack(tree: dict) -> bytes:
    import io
    out = io.BytesIO()
    np.savez(out, **tree)
    return out.getvalue()


def _unpack(blob: bytes) -> dict:
    import io
    with np.load(io.BytesIO(blob)) as z:
        return {k: z[k] for k in z.files}


def _vectors(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.int64).reshape(len(column), dim)


def shards(rows: DataFrame, shard_rows: int) -> DataFrame:
    """One row per shard: its ball tree. Shards are dealt by a hash of the row number, so
    that they stay of the same size whatever vectors or ids repeat."""
    n = rows.count()
    count = max(1, -(-n // shard_rows))
    dealt = rows.select("vec_id", "v", "dim", F.pmod(F.xxhash64("key"), F.lit(count)).alias("shard"))

    def build(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        dim = key[1].as_py()
        ids = np.asarray(table.column("vec_id"), np.int64)
        v = _vectors(table.column("v").combine_chunks(), dim)
        return pa.table({"shard": [key[0].as_py()], "dim": pa.array([dim], pa.int32()),
                         "blob": pa.array([_pack(build_tree(ids, v))], pa.binary())})

    return dealt.groupBy("shard", "dim").applyInArrow(build, TREES)


def query_blocks(queries: DataFrame, block_rows: int) -> DataFrame:
    """One row per block of queries, each with its row number: a repeated query is searched
    and answered as often."""
    n = queries.count()
    count = max(1, -(-n // block_rows))
    dealt = queries.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(count)))

    def build(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        dim = key[1].as_py()
        v = _vectors(table.column("v").combine_chunks(), dim)
        return pa.table({"block": [key[0].as_py()], "dim": pa.array([dim], pa.int32()),
                         "keys": pa.array([np.asarray(table.column("key"), np.int64).tobytes()], pa.binary()),
                         "ids": pa.array([np.asarray(table.column("vec_id"), np.int64).tobytes()], pa.binary()),
                         "vectors": pa.array([v.tobytes()], pa.binary())})

    return dealt.groupBy("block", "dim").applyInArrow(build, "block long, dim int, keys binary, ids binary, vectors binary")


def _searcher(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                tree = _unpack(r["blob"])
                keys, q_ids = np.frombuffer(r["keys"], np.int64), np.frombuffer(r["ids"], np.int64)
                q = np.frombuffer(r["vectors"], np.int64).reshape(len(q_ids), r["dim"])
                low = np.iinfo(np.int64).min
                floor = np.frombuffer(r["floor"], np.int64) if r["floor"] else np.full(len(q), low)
                floor_id = np.frombuffer(r["floor_id"], np.int64) if r["floor_id"] else \
                    np.full(len(q), np.iinfo(np.int64).max)
                best = search_tree(tree, q_ids, q, k, floor, floor_id)
                row, col = np.nonzero(best.score > low)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[row]), pa.array(q_ids[row]), pa.array(best.id[row, col]), pa.array(best.score[row, col])],
                    names=["key", "query_id", "vec_id", "score"])
    return run


def _merge(found: DataFrame, k: int) -> DataFrame:
    """The k best of each query row: score descending, then id ascending."""
    from pyspark.sql import Window
    order = Window.partitionBy("key").orderBy(F.desc("score"), F.asc("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def top_k(candidates: DataFrame, queries: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding",
          k: int = 5, scale: int = 256, shard_rows: int = SHARD_ROWS,
          block_rows: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k highest integer inner products
    over all candidates but the row with its own id; all of them if there are fewer.

    Ties go to the smaller vec_id. Rows with a null id, and vectors that are null or hold
    null or non-finite components, take no part. Vectors are compared with those of their
    own length. Repeated rows count as rows: each query row has
    its k, and each copy of a candidate its rank. Other columns are not read. An empty table
    gives no rows.
    """
    spark = candidates.sparkSession
    rows = written(quantised(candidates, id_col, vector_col, scale), "topk-rows")
    asked = written(quantised(queries, id_col, vector_col, scale), "topk-queries")
    trees = written(shards(rows, shard_rows), "topk-trees")
    blocks = written(query_blocks(asked, block_rows), "topk-blocks")

    # Round 1: each block in one home shard of its length; round 2: in all the others.
    homes = trees.groupBy("dim").agg(F.sort_array(F.collect_set("shard")).alias("shards"))
    # one row per vector length and shard number: the shards' names only, not their rows
    pairs = (blocks.select("block", "dim").join(homes, "dim")
             .withColumn("home", F.expr("shards[cast(block % size(shards) as int)]"))
             .select("block", "dim", "home", F.explode("shards").alias("shard")))
    pairs = written(pairs, "topk-pairs")
    none = F.lit(None).cast("binary")
    first = (pairs.filter("shard = home").join(blocks, ["block", "dim"]).join(trees, ["shard", "dim"])
             .withColumns({"floor": none, "floor_id": none}))
    cols = ["blob", "keys", "ids", "vectors", "dim", "floor", "floor_id"]
    seen = written(first.select(cols).mapInArrow(_searcher(k), FOUND), "topk-first")

    # the kth score of each query so far, put into its block's order
    kth = _merge(seen, k).groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct(F.col("score"), (-F.col("vec_id")).alias("neg"))).alias("last"))
    kth = kth.filter(F.col("n") == k).select(
        "key", F.col("last.score").alias("floor"), (-F.col("last.neg")).alias("floor_id"))
    n_blocks = max(1, -(-asked.count() // block_rows))
    dealt = asked.select("key", "dim") \
        .withColumn("block", F.pmod(F.xxhash64("key"), F.lit(n_blocks))).join(kth, "key")
    floors = dealt.groupBy("block", "dim").agg(
        F.collect_list(F.struct("key", "floor", "floor_id")).alias("known"))  # at most a block's rows

    def ordered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                known = {x["key"]: (x["floor"], x["floor_id"]) for x in r["known"] or ()}
                none = (np.iinfo(np.int64).min, np.iinfo(np.int64).max)
                both = np.array([known.get(int(i), none) for i in np.frombuffer(r["keys"], np.int64)], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["block"]], pa.int64()), pa.array([r["dim"]], pa.int32()),
                     pa.array([r["keys"]], pa.binary()), pa.array([r["ids"]], pa.binary()), pa.array([r["vectors"]], pa.binary()),
                     pa.array([both[:, 0].tobytes()], pa.binary()), pa.array([both[:, 1].tobytes()], pa.binary())],
                    names=["block", "dim", "keys", "ids", "vectors", "floor", "floor_id"])

    primed = blocks.join(floors, ["block", "dim"], "left").mapInArrow(
        ordered, "block long, dim int, keys binary, ids binary, vectors binary, floor binary, floor_id binary")
    primed = written(primed, "topk-primed")
    rest = (pairs.filter("shard != home").join(primed, ["block", "dim"]).join(trees, ["shard", "dim"]))
    found = seen.unionByName(rest.select(cols).mapInArrow(_searcher(k), FOUND))
    return _merge(found, k).select("query_id", "rank", "vec_id", "score")
