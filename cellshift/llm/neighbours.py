"""Approximate nearest neighbours by largest inner product: NN-descent and greedy graph search.

Building.  Equal vectors are one node.  Every node keeps its ``NEAR`` best
neighbours so far.  In a round each node sends its code to its neighbours; what
meets at a node are neighbours of neighbours, which are compared with each other
unless both came by edges already used, and the better ones are sent back.  The
first lists come from the same comparison of nodes that lie side by side in a few
random hyperplane orders.  Lists of nodes that many others point to are compared
in chunks of ``CHUNK``, in another order each round, and lie over several tasks, so
no list is ever gathered whole and none is cut.  Equal scores are ordered by a hash
of both nodes, so that they do not make one node the neighbour of all.  Rounds stop when few lists change.

Two graphs are built.  One compares directions only and so keeps its shape where
norms differ; the other takes plain inner products, so that a node's list leads at
once to the longest vectors of its region, which all members of a group of near
copies look for.

Searching.  A query starts with its own neighbours and expands the best
``POOL`` nodes it knows along edges of the first graph in both directions and
of the second in one, round by round, until all of them are expanded.

For the graphs nodes travel as directions in single precision and a length, so that
a long vector costs the others no digits; they are compared in double precision, as
near copies differ in the last digits only.  The search uses the original vectors in
double precision, scaled by powers of two against overflow, the final order their
inner products.
"""

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql import types as T

from cellshift.session import stored

NEAR = 32
CHUNK = 256
FIRST_CHUNK = 512
SENT_BACK = 6
BUCKET_EDGES = 200_000  # edges a task reads, one chunk at a time
HELD = 2_000_000  # pairs a task holds before it sends back the best of each node
ORDERS = 8
ORDER_BITS = 16
ROUNDS = 14
SETTLED = 0.05  # share of list entries that are new in the last round
POOL = 100
SEED = 3


def usable(table: DataFrame, key: str, vector: str) -> DataFrame:
    """vec_id, vec (doubles): rows with an id and a finite vector that is not null or all zero.

    An id with several vectors keeps the smallest; repeated rows count once.
    Shorter vectors are filled up with zeros where they are compared.
    """
    vec = F.col(vector).cast("array<double>")
    finite = ~F.exists(
        F.col("vec"), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    )
    return (
        table.select(F.col(key).cast("long").alias("vec_id"), vec.alias("vec"))
        .where(F.col("vec_id").isNotNull() & F.col("vec").isNotNull())
        .where(finite & F.exists("vec", lambda x: x != 0))
        .groupBy("vec_id")
        .agg(F.min("vec").alias("vec"))
    )


def nodes_of(rows: DataFrame, members: int) -> DataFrame:
    """vec_id, node, vec, nth: equal vectors share the smallest id as node.

    nth numbers the ids of a node up to ``members``; further copies have none.
    Only so many rows of each vector leave a task.
    """
    inside = W.partitionBy("vec").orderBy("vec_id")
    first = (
        rows.withColumn("nth", F.row_number().over(inside))
        .where(F.col("nth") <= members)
        .withColumn("node", F.min("vec_id").over(W.partitionBy("vec")))
    )
    return first


def inner(a: Column, b: Column) -> Column:
    """The inner product in double precision."""
    zero = F.lit(0.0)
    products = F.zip_with(a, b, lambda x, y: F.coalesce(x, zero) * F.coalesce(y, zero))
    return F.aggregate(products, zero, lambda s, x: s + x)


def _rows(x: np.ndarray) -> list[bytes]:
    return [r.tobytes() for r in x]


def _directions(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Unit vectors; the vectors scaled to components of at most 1, their lengths, and the powers of two taken out."""
    powers = np.frexp(np.abs(x).max(axis=1))[1]
    scaled = np.ldexp(x, -powers[:, None])
    length = np.sqrt((scaled * scaled).sum(axis=1))
    return scaled / length[:, None], scaled, length, powers


def coded(nodes: DataFrame, width: int, largest: float) -> DataFrame:
    """node, code, size, full, asked, orders: direction and length for the graphs, vectors for the search and of a query, order for the first lists.

    ``largest`` is the table's largest component.
    """
    planes = np.random.default_rng(SEED).normal(size=(ORDERS, width, ORDER_BITS))
    top = int(np.frexp(largest)[1])

    @F.pandas_udf("code binary, size double, full binary, asked binary, orders array<long>")
    def code(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        places = 1 << np.arange(ORDER_BITS - 1, -1, -1)
        for batch in batches:
            x = np.zeros((len(batch), width))
            for n, vec in enumerate(batch):
                x[n, : len(vec)] = vec
            direction, scaled, length, powers = _directions(x)
            orders = [((direction @ p > 0) @ places) for p in planes]
            yield pd.DataFrame(
                {
                    "code": _rows(direction.astype(np.float32)),
                    "size": np.ldexp(length, powers - top),
                    "full": _rows(np.ldexp(x, -top)),
                    "asked": _rows(scaled),
                    "orders": list(np.stack(orders, axis=1).astype(np.int64)),
                }
            )

    return nodes.select("node", code("vec").alias("c")).select("node", "c.*")


def _best_pairs(node, x, size, product, fresh, worst, sent):
    """node, other, near of the better pairs in which at least one side is fresh.

    ``x`` are directions and ``size`` lengths.  Near is the inner product of the
    node's direction with the other vector, or how little the directions differ.
    A node gets its best ``sent`` partners that are nearer than its worst neighbour.
    """
    new = np.flatnonzero(fresh)
    x = x.astype(np.float64)
    near = x[new] @ x.T
    if not product:
        squares = (x * x).sum(axis=1)
        near = 2 * near - squares[new][:, None] - squares[None, :]
    same = node[new][:, None] == node[None, :]
    out = []
    for side, apart, mine, others in (
        (near, same, new, np.arange(len(node))),
        (near[:, ~fresh].T, same[:, ~fresh].T, np.flatnonzero(~fresh), new),
    ):
        if not side.size:
            continue
        if product:
            side = side * size[others]
        side = np.where(apart, -np.inf, side)
        k = min(sent, side.shape[1])
        best = np.argpartition(-side, k - 1, axis=1)[:, :k]
        values = np.take_along_axis(side, best, axis=1)
        rows, columns = np.nonzero(values > worst[mine][:, None])
        out.append((node[mine[rows]], node[others[best[rows, columns]]], values[rows, columns]))
    return out


def _mixed(x: np.ndarray) -> np.ndarray:
    """Bits of ids stirred, to deal them evenly."""
    x = x.astype(np.uint64)
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _reduced(found: list[tuple], keep: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The best ``keep`` distinct partners of each node."""
    node, other, near = (np.concatenate(c) for c in zip(*found, strict=True))
    order = np.lexsort((other, node))
    node, other, near = node[order], other[order], near[order]
    once = np.ones(len(node), bool)
    once[1:] = (node[1:] != node[:-1]) | (other[1:] != other[:-1])
    node, other, near = node[once], other[once], near[once]
    order = np.lexsort((_mixed(node ^ _mixed(other).astype(np.int64)), -near, node))  # ties differ from node to node
    node, other, near = node[order], other[order], near[order]
    begins = np.flatnonzero(np.concatenate(([True], node[1:] != node[:-1]))) if len(node) else np.zeros(0, int)
    place = np.arange(len(node)) - np.repeat(begins, np.diff(np.append(begins, len(node))))
    top = place < keep
    return node[top], other[top], near[top]


def _as_lists(node, other, near) -> pa.RecordBatch:
    """Rows node, others, nears from pairs sorted by node."""
    begins = np.flatnonzero(np.concatenate(([True], node[1:] != node[:-1])))
    ends = pa.array(np.append(begins, len(node)).astype(np.int32))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(node[begins]),
            pa.ListArray.from_arrays(ends, pa.array(other)),
            pa.ListArray.from_arrays(ends, pa.array(near)),
        ],
        names=["node", "others", "nears"],
    )


def _decoded(batch: pa.RecordBatch, width: int) -> np.ndarray:
    raw = np.frombuffer(b"".join(batch.column("code").to_pylist()), dtype=np.float32)
    return raw.reshape(batch.num_rows, width)


def _side_by_side(ordered: DataFrame, width: int, product: bool) -> DataFrame:
    """node, others, nears: the best of each chunk of neighbouring rows (node, code, size)."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, x = batch.column("node").to_numpy(zero_copy_only=False), _decoded(batch, width)
            size = batch.column("size").to_numpy(zero_copy_only=False)
            found = []
            for at in range(0, len(node), FIRST_CHUNK):
                # the last chunk reaches back, so that no row is left with few partners
                begin = max(0, min(at, len(node) - FIRST_CHUNK))
                part = slice(begin, begin + FIRST_CHUNK)
                n = node[part]
                least = np.full(len(n), -np.inf)
                found += _best_pairs(n, x[part], size[part], product, np.ones(len(n), bool), least, NEAR)
            if found and sum(len(f[0]) for f in found):
                yield _as_lists(*_reduced(found, NEAR))

    return ordered.mapInArrow(compare, _PAIRS)


def _dealt(state: DataFrame, turn: int) -> DataFrame:
    """pivot, salt, node, code, size, worst, fresh: every node at itself and at its neighbours."""
    own = F.array(F.struct(F.col("node").alias("pivot"), F.lit(False).alias("fresh")))
    others = F.zip_with("others", "fresh", lambda p, f: F.struct(p.alias("pivot"), f.alias("fresh")))
    return state.select("node", "code", "size", "worst", F.inline(F.concat(own, others))).select(
        "pivot", F.xxhash64("node", F.lit(turn)).alias("salt"), "node", "code", "size", "worst", "fresh"
    )


def _gathered(dealt: DataFrame, buckets: int) -> DataFrame:
    """What meets at a pivot side by side, in an order of the round's own; a hub goes over as many tasks as it fills."""
    return dealt.repartitionByRange(buckets, "pivot", "salt").sortWithinPartitions("pivot", "salt")


_PAIRS = "node long, others array<long>, nears array<double>"


def _compare(gathered: DataFrame, width: int, product: bool) -> DataFrame:
    """node, others, nears: the better pairs among the nodes that meet at a pivot.

    A task holds the vectors of one Arrow batch and of less than two chunks; what a
    node has at several pivots of a task is merged before it is sent back.
    """

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, count, rest = [], 0, None
        for batch in chain(batches, [None]):
            if batch is not None:
                if not batch.num_rows:
                    continue
                plain = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("pivot", "node", "size", "worst", "fresh")]
                rows = (*plain, _decoded(batch, width))
                rest = rows if rest is None else tuple(np.concatenate(c) for c in zip(rest, rows, strict=True))
            if rest is None:
                break
            pivot, node, size, worst, fresh, x = rest
            edges = (np.flatnonzero(pivot[1:] != pivot[:-1]) + 1).tolist()
            for begin, stop in zip([0, *edges], [*edges, len(pivot)], strict=True):
                parts = [slice(p[0], p[-1] + 1) for p in np.array_split(np.arange(begin, stop), -(-(stop - begin) // CHUNK))]
                if stop == len(pivot) and batch is not None:  # the next batch may go on with it
                    full = max(0, (stop - begin) // CHUNK - 1)
                    parts = [slice(begin + n * CHUNK, begin + (n + 1) * CHUNK) for n in range(full)]
                    rest = tuple(c[begin + full * CHUNK :].copy() for c in rest)
                for part in parts:
                    new = fresh[part]
                    if len(new) < 2 or not new.any():
                        continue
                    for pair in _best_pairs(node[part], x[part], size[part], product, new, worst[part], SENT_BACK):
                        if len(pair[0]):
                            found.append(pair)
                            count += len(pair[0])
                if count > HELD:
                    yield _as_lists(*_reduced(found, NEAR))
                    found, count = [], 0
        if found:
            yield _as_lists(*_reduced(found, NEAR))

    return gathered.mapInArrow(meet, _PAIRS)


_LISTS = T.StructType(
    [
        T.StructField("others", T.ArrayType(T.LongType())),
        T.StructField("nears", T.ArrayType(T.DoubleType())),
        T.StructField("fresh", T.ArrayType(T.BooleanType())),
    ]
)


@F.pandas_udf(_LISTS)
def _merge(
    node: pd.Series, others: pd.Series, nears: pd.Series, found: pd.Series, found_nears: pd.Series
) -> pd.DataFrame:
    """The ``NEAR`` nearest of a list and what was found, and which of them are new."""
    out = []
    for at, have, have_near, new, new_near in zip(node, others, nears, found, found_nears, strict=True):
        have = np.asarray(have if have is not None else [], dtype=np.int64)
        have_near = np.asarray(have_near if have_near is not None else [], dtype=np.float64)
        if new is None or not len(new):
            out.append((have, have_near, np.zeros(len(have), bool)))
            continue
        ids = np.concatenate((have, np.asarray(new, dtype=np.int64)))
        near = np.concatenate((have_near, np.asarray(new_near, dtype=np.float64)))
        ids, first = np.unique(ids, return_index=True)  # what it has comes first
        near, fresh = near[first], first >= len(have)
        best = np.lexsort((_mixed(at ^ _mixed(ids).astype(np.int64)), -near))[:NEAR]
        out.append((ids[best], near[best], fresh[best]))
    return pd.DataFrame(out, columns=["others", "nears", "fresh"])


def _joined(state: DataFrame, better: DataFrame) -> DataFrame:
    """The state with what was found merged into its lists."""
    gathered = better.groupBy(F.col("node").alias("at")).agg(
        F.flatten(F.collect_list("others")).alias("found"), F.flatten(F.collect_list("nears")).alias("found_nears")
    )
    both = state.join(gathered, F.col("node") == F.col("at"), "left")
    merged = _merge("node", "others", "nears", "found", "found_nears")
    return both.select("node", "code", "size", merged.alias("m")).select(
        "node", "code", "size", "m.*"
    )


def graph(codes: DataFrame, width: int, product: bool) -> DataFrame:
    """node, others, nears: the neighbour lists NN-descent ends with, by plain products or by direction."""
    none = F.array()
    state = codes.select(
        "node",
        "code",
        "size",
        none.cast("array<long>").alias("others"),
        none.cast("array<double>").alias("nears"),
    )
    ordered = (
        codes.select("node", "code", "size", F.posexplode("orders").alias("which", "order"))
        .repartitionByRange("which", "order", "node")
        .sortWithinPartitions("which", "order", "node")
        .select("node", "code", "size")
    )
    state = stored(_joined(state, _side_by_side(ordered, width, product)), "nn-lists")
    edges = state.agg(F.sum(F.size("others") + 1).alias("n")).first()["n"] or 0
    buckets = max(12, -(-edges // BUCKET_EDGES))
    for turn in range(ROUNDS):
        worst = F.when(F.size("nears") >= NEAR, F.element_at("nears", -1)).otherwise(
            F.lit(float("-inf"))
        )
        dealt = _dealt(state.withColumn("worst", worst), turn)
        state = stored(
            _joined(state.drop("fresh"), _compare(_gathered(dealt, buckets), width, product)), "nn-lists"
        )
        seen = state.select(
            F.sum(F.size(F.filter("fresh", lambda x: x))).alias("new"), F.sum(F.size("others")).alias("all")
        ).first()
        if (seen["new"] or 0) <= SETTLED * (seen["all"] or 0):
            break
    return state.select("node", "others", "nears")


@F.pandas_udf(T.DoubleType())
def _near(full: pd.Series, asked: pd.Series) -> pd.Series:
    """Inner products of vectors with asked vectors."""
    if not len(full):
        return pd.Series([], dtype="float64")
    a, b = (np.frombuffer(b"".join(x), dtype=np.float64).reshape(len(full), -1) for x in (full, asked))
    return pd.Series(np.einsum("nd,nd->n", a, b))


def search(
    queries: DataFrame, lists: DataFrame, products: DataFrame, codes: DataFrame, most: int = POOL
) -> DataFrame:
    """query, node: the best ``most`` nodes that each query node (column node) finds.

    A search ends when every node of its pool has been expanded, so none is cut off.  A node
    that left a pool is farther than all that stay and never comes back: it ends.
    ``lists`` are expanded in both directions, ``products`` (by plain products) only
    from a node to its list: a long vector is in the lists of many.
    """
    one_way = lists.select("node", F.explode("others").alias("other"))
    edges = stored(
        one_way.unionByName(one_way.select(F.col("other").alias("node"), F.col("node").alias("other")))
        .unionByName(products.select("node", F.explode("others").alias("other")))
        .distinct(),
        "nn-edges",
    )
    asked = stored(
        queries.select(F.col("node").alias("query")).join(
            codes.select(F.col("node").alias("query"), "asked"), "query"
        ),
        "nn-asked",
    )
    there = codes.select(F.col("node").alias("other"), "full")
    # the first step leads to the query's own neighbours
    pool = asked.select(
        "query", F.col("query").alias("node"), F.lit(float("inf")).alias("near"), F.lit(False).alias("used")
    )
    best = W.partitionBy("query").orderBy(F.desc("near"), "node")
    while not pool.where(~F.col("used")).isEmpty():
        reached = (
            pool.where(~F.col("used"))
            .join(edges, "node")
            .select("query", "other")
            .distinct()
            .join(there, "other")
            .join(asked, "query")
        )
        scored = reached.select(
            "query",
            F.col("other").alias("node"),
            _near("full", "asked").alias("near"),
            F.lit(False).alias("used"),
        ).where(F.col("query") != F.col("node"))
        known = pool.withColumn("used", F.lit(True))
        pool = stored(
            known.unionByName(scored)
            .groupBy("query", "node")
            .agg(F.max("near").alias("near"), F.max("used").alias("used"))
            .withColumn("nth", F.row_number().over(best))
            .where(F.col("nth") <= most + 1)  # the query itself is one of them
            .drop("nth"),
            "nn-pool",
        )
    return pool.where(F.col("query") != F.col("node")).select("query", "node")


def nearest(table: DataFrame, is_query: Column, k: int = 20, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found of every row for which ``is_query`` holds.

    ``is_query`` is a condition on ``vec_id``.  Nearest first, ties to the smaller
    vec_id; a row is not its own neighbour, but a copy of it is.  Vectors that are
    null, all zero or hold null or non-finite components take no part, nor do rows
    without id.  Fewer candidates than ``k`` give fewer rows; an empty table none.
    A search keeps ``POOL`` nodes, or ``k`` if that is more.
    """
    rows = stored(usable(table, key, vector), "nn-rows")
    parts = F.transform("vec", lambda x: F.abs(x))
    size = rows.agg(F.max(F.size("vec")).alias("width"), F.max(F.array_max(parts)).alias("largest")).first()
    named = stored(nodes_of(rows, k + 1), "nn-nodes")
    nodes = named.where("nth = 1").select("node", "vec")
    width, largest = size["width"] or 1, size["largest"] or 1.0
    codes = stored(coded(nodes, width, largest), "nn-codes")
    lists, products = graph(codes, width, product=False), graph(codes, width, product=True)

    asking = stored(
        rows.where(is_query)
        .join(nodes.select(F.col("vec").alias("v"), "node"), F.col("vec") == F.col("v"))
        .select("vec_id", "node", "vec"),
        "nn-queries",
    )
    found = search(asking.select("node").distinct(), lists, products, codes, max(POOL, k))
    own = asking.select(F.col("node").alias("query"), "node").distinct()
    pairs = found.unionByName(own)
    measured = stored(
        pairs.join(nodes.select(F.col("node").alias("query"), F.col("vec").alias("q")), "query")
        .join(nodes.select("node", F.col("vec").alias("v")), "node")
        .select("query", "node", inner(F.col("q"), F.col("v")).alias("score")),
        "nn-scores",
    )
    members = named.select(F.col("node"), F.col("vec_id").alias("found_id"))
    ranked = W.partitionBy("query_id").orderBy(F.desc("score"), "found_id")
    return (
        asking.select(F.col("vec_id").alias("query_id"), F.col("node").alias("query"))
        .join(measured, "query")
        .join(members, "node")
        .where(F.col("found_id") != F.col("query_id"))
        .withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", F.col("found_id").alias("vec_id"), "score")
    )
