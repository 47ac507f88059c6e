"""Approximate nearest neighbours by learned partitions.

The neighbour graph of a bounded sample is cut into balanced parts; a small network
learns which part a vector's neighbours are in, places every vector in its likeliest
part and sends a query to several.  How many follows from the true neighbours that a
bounded number of the queries have among all rows.  What is found there is ranked by
exact cosines.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .blocks import search_blocks, smallest_ids
from .common import keep, table

SAMPLE, PARTS, GRAPH_NEIGHBOURS, HIDDEN = 8192, 32, 10, 64
TARGET_RECALL = 0.97
# queries whose true neighbours are looked up to tell how many parts to try
CALIBRATION = 512


def usable(vector: str = "embedding") -> Column:
    """True for vectors of finite components that are not all zero."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: F.coalesce((x == x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.coalesce((F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def _unit(x: np.ndarray) -> np.ndarray:
    x = np.asarray(x, dtype=np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """The k nearest of each unit vector, in slices of rows."""
    out = np.empty((len(x), k), dtype=np.int64)
    for start in range(0, len(x), 512):
        near = x[start : start + 512] @ x.T
        near[np.arange(len(near)), np.arange(start, start + len(near))] = -np.inf
        top = np.argpartition(-near, k - 1, axis=1)[:, :k]
        order = np.argsort(-np.take_along_axis(near, top, 1), axis=1, kind="stable")
        out[start : start + 512] = np.take_along_axis(top, order, 1)
    return out


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, passes: int = 12, slack: float = 0.1) -> np.ndarray:
    """Parts of nearly equal size that cut few edges of the graph.

    Starts from halvings along the widest direction; then vectors move to the part
    that most of their neighbours are in, as long as it has room.
    """
    part = np.zeros(len(x), dtype=np.int64)
    for _ in range(int(np.log2(parts))):
        new = part * 2
        for p in np.unique(part):
            rows = np.flatnonzero(part == p)
            centred = x[rows] - x[rows].mean(axis=0)
            axis = np.linalg.eigh(centred.T @ centred)[1][:, -1]
            new[rows[np.argsort(centred @ axis, kind="stable")[len(rows) // 2 :]]] += 1
        part = new
    room = int(np.ceil(len(x) / parts * (1 + slack)))
    for _ in range(passes):
        votes = np.zeros((len(x), parts))
        np.add.at(votes, (np.repeat(np.arange(len(x)), graph.shape[1]), part[graph].ravel()), 1)
        np.add.at(votes, (graph.ravel(), np.repeat(part, graph.shape[1])), 1)
        best = votes.argmax(axis=1)
        gain = votes[np.arange(len(x)), best] - votes[np.arange(len(x)), part]
        sizes = np.bincount(part, minlength=parts)
        moved = 0
        for i in np.argsort(-gain, kind="stable"):
            if gain[i] <= 0:
                break
            if sizes[best[i]] < room:
                sizes[part[i]] -= 1
                sizes[best[i]] += 1
                part[i] = best[i]
                moved += 1
        if not moved:
            break
    return part


@dataclass
class Router:
    """A one-layer network from unit vectors to parts, and how many parts a query tries."""

    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    probes: int

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(x @ self.w1 + self.b1, 0) @ self.w2 + self.b2


def _train_network(x: np.ndarray, goal: np.ndarray, epochs: int = 40, batch: int = 256, rate: float = 3e-3) -> Router:
    """Cross entropy with Adam; a fixed seed makes reruns agree."""
    rng = np.random.default_rng(0)
    d, p = x.shape[1], goal.shape[1]
    params = [rng.normal(0, d**-0.5 * 2, (d, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, (HIDDEN, p)), np.zeros(p)]
    first, second = [np.zeros_like(w) for w in params], [np.zeros_like(w) for w in params]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for start in range(0, len(x), batch):
            rows = order[start : start + batch]
            inner = x[rows] @ params[0] + params[1]
            hidden = np.maximum(inner, 0)
            z = hidden @ params[2] + params[3]
            z = np.exp(z - z.max(axis=1, keepdims=True))
            dz = (z / z.sum(axis=1, keepdims=True) - goal[rows]) / len(rows)
            dh = (dz @ params[2].T) * (inner > 0)
            step += 1
            for i, g in enumerate((x[rows].T @ dh, dh.sum(axis=0), hidden.T @ dz, dz.sum(axis=0))):
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g * g
                params[i] = params[i] - rate * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    return Router(*params, probes=1)


def fit(sample: np.ndarray, parts: int = PARTS, k: int = 5, target: float = TARGET_RECALL) -> Router | None:
    """Learn partitions on a sample; ``None`` if it is too small to be worth cutting.

    ``probes`` is the smallest number of parts whose neighbours reach ``target`` of the
    sample's true ``k`` nearest: a first guess, for queries that lie like the rows.
    """
    while parts > 1 and len(sample) < parts * 32:
        parts //= 2
    if parts < 2:
        return None
    x = _unit(sample)
    graph = neighbour_graph(x, GRAPH_NEIGHBOURS)
    part = balanced_parts(x, graph, parts)
    goal = np.zeros((len(x), parts))
    np.add.at(goal, (np.repeat(np.arange(len(x)), graph.shape[1]), part[graph].ravel()), 1 / (graph.shape[1] + 1))
    goal[np.arange(len(x)), part] += 1 / (graph.shape[1] + 1)
    # two thirds train the network, the rest tells how many parts to try
    held = np.arange(len(x)) % 3 == 0
    router = _train_network(x[~held], goal[~held])
    ranks = np.argsort(np.argsort(-router.logits(x), axis=1, kind="stable"), axis=1)
    home = ranks.argmin(axis=1)
    need = ranks[np.flatnonzero(held)[:, None], home[graph[held][:, :k]]]
    router.probes = next(m for m in range(1, parts + 1) if (need < m).mean() >= target)
    return router


def sampled(vectors: DataFrame, bound: int) -> np.ndarray:
    """About ``bound`` distinct vectors, chosen by hash: all that reaches the driver."""
    share = bound / max(bound, vectors.count())
    place = F.pmod(F.xxhash64("embedding"), F.lit(1_000_000)) / 1_000_000
    rows = vectors.where(place < share).select("embedding").toArrow().column("embedding").combine_chunks()
    return rows.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), -1) if len(rows) else np.empty((0, 0))


def probes_for(
    router: Router, base: DataFrame, queries: DataFrame, k: int = 5, target: float = TARGET_RECALL, bound: int = CALIBRATION
) -> int:
    """The fewest parts that hold ``target`` of the true ``k`` nearest rows of about ``bound`` of the queries.

    Queries may lie elsewhere than the rows, so neither a sample of the rows nor the
    neighbours inside it tell.  ``base`` has ids, embedding and cell.  Every task compares
    its rows with the queries asked and hands on the nearest ones.
    """
    share = bound / max(bound, queries.count())
    place = F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(1_000_000)) / 1_000_000
    asked = queries.where(place < share).select("vec_id", "embedding").toArrow()
    if not asked.num_rows:
        return router.probes
    wanted = _unit(_matrix(asked["embedding"]))
    own = asked["vec_id"].to_numpy()
    schema = pa.schema([("query", pa.int32()), ("score", pa.float64()), ("ids", pa.list_(pa.int64())), ("cell", pa.int32())])

    def near(batches):
        held = schema.empty_table()
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            cosine = wanted @ _unit(_matrix(rows["embedding"])).T
            take = min(k + 1, batch.num_rows)
            top = np.argpartition(-cosine, take - 1, axis=1)[:, :take]
            at = pa.array(top.ravel())
            new = [np.repeat(np.arange(len(wanted), dtype=np.int32), take), np.take_along_axis(cosine, top, 1).ravel()]
            found = [rows[name].combine_chunks().take(at) for name in ("ids", "cell")]
            both = pa.concat_tables([held, pa.Table.from_arrays([*map(pa.array, new), *found], schema=schema)])
            # of what came so far the k + 1 best of each query stay: one of them may be the query's own row
            query, score = both["query"].to_numpy(), both["score"].to_numpy()
            order = np.lexsort((-score, query))
            first = np.searchsorted(query[order], np.arange(len(wanted)))
            held = both.take(pa.array(order[np.arange(len(order)) - first[query[order]] <= k])).combine_chunks()
        yield from held.to_batches()

    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    rows = base.select("ids", "embedding", "cell").mapInArrow(near, "query int, score double, ids array<bigint>, cell int")
    own_ids = F.element_at(F.array(*[F.lit(int(i)) for i in own]), F.col("query") + 1)
    rows = rows.select("query", "score", "cell", F.explode("ids").alias("vec_id")).where(F.col("vec_id") != own_ids)
    true = rows.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query", "cell").toArrow()
    if not true.num_rows:
        return router.probes
    ranks = np.argsort(np.argsort(-router.logits(wanted), axis=1, kind="stable"), axis=1)
    need = ranks[true["query"].to_numpy(), true["cell"].to_numpy()]
    return next(m for m in range(1, ranks.shape[1] + 1) if (need < m).mean() >= target)


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1).astype(np.float64)


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 5, parts: int = PARTS, sample: int = SAMPLE, target: float = TARGET_RECALL
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows found of each query by cosine.

    Both sides have vec_id and embedding.  Null ids and vectors that are null, zero or
    hold null or non-finite components take no part, nor do vectors whose length is not
    the most frequent one.  A row of the query's id is no neighbour of it; ties go to the
    smaller id; repeated rows count once.  Equal vectors are one candidate with its
    ``k + 1`` smallest ids, so a vector that a third of all rows share costs no more than
    another.  Fewer candidates than ``k`` give fewer rows.

    The network is fitted on about ``sample`` vectors; every vector is placed.  A query
    tries as many parts as :func:`probes_for` finds.  Parts are searched in blocks of
    bounded size.
    """
    clean = lambda df: df.where(usable() & F.col("vec_id").isNotNull()).select("vec_id", "embedding")
    base = clean(vectors)
    common = base.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").first()
    n = common.n if common else 0
    base = keep(smallest_ids(base.where(F.size("embedding") == n), "embedding", "vec_id", k + 1), "ann-vectors")
    asked = keep(clean(queries).where(F.size("embedding") == n).dropDuplicates(["vec_id", "embedding"]), "ann-asked")
    router = fit(sampled(base, sample), parts, k, target)
    kind, asked_kind = (df.schema["embedding"].dataType.simpleString() for df in (base, asked))
    base = keep(_routed(base, router, 1, f"ids array<bigint>, embedding {kind}"), "ann-base")
    if router is not None:
        router = replace(router, probes=probes_for(router, base, asked, k, target))
    asked = keep(_routed(asked, router, router.probes if router else 1, f"vec_id bigint, embedding {asked_kind}"), "ann-queries")
    schema = pa.schema([("query_id", pa.int64()), ("score", pa.float64()), ("ids", pa.list_(pa.int64()))])

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        q, b = _matrix(left["embedding"]), _matrix(right["embedding"])
        q_norm, b_norm = np.linalg.norm(q, axis=1), np.linalg.norm(b, axis=1)
        ids = right["ids"].combine_chunks()
        first = ids.flatten().to_numpy()[ids.offsets.to_numpy()[:-1] - ids.offsets[0].as_py()]
        order = np.argsort(first, kind="stable")
        b, b_norm = b[order], b_norm[order]
        rows, scores, found = [], [], []
        take = min(k + 1, len(b))
        for start in range(0, len(q), 256):
            cosine = (q[start : start + 256] @ b.T) / np.outer(q_norm[start : start + 256], b_norm)
            # candidates are ordered by id: a stable sort leaves ties in that order
            least = -np.partition(-cosine, take - 1, axis=1)[:, take - 1]
            for i, row in enumerate(cosine):
                near = np.flatnonzero(row >= least[i])
                near = near[np.argsort(-row[near], kind="stable")][:take]
                rows.append(np.full(len(near), start + i))
                scores.append(row[near])
                found.append(order[near])
        at = pa.array(np.concatenate(rows))
        return pa.Table.from_arrays(
            [left["vec_id"].combine_chunks().take(at), pa.array(np.concatenate(scores)), ids.take(pa.array(np.concatenate(found)))],
            schema=schema,
        )

    found = search_blocks(base, asked, search, "query_id bigint, score double, ids array<bigint>")
    rows = found.select("query_id", "score", F.explode("ids").alias("vec_id")).where("vec_id <> query_id")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    # a row that two parts or two rows of its id offer counts once
    rows = rows.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    ranked = rows.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _routed(rows: DataFrame, router: Router | None, probes: int, kinds: str) -> DataFrame:
    """``rows`` once for each of their ``probes`` likeliest parts (``cell``), with ``place``."""
    names = [c.split()[0] for c in kinds.split(", ")]

    def route(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            table_ = pa.Table.from_batches([batch])
            if router is None:
                cells = np.zeros((batch.num_rows, 1), dtype=np.int64)
            else:
                logits = router.logits(_unit(_matrix(table_["embedding"])))
                cells = np.argsort(-logits, axis=1, kind="stable")[:, :probes]
            again = batch.take(pa.array(np.repeat(np.arange(batch.num_rows), cells.shape[1])))
            yield pa.record_batch([*again.columns, pa.array(cells.ravel().astype(np.int32))], names=[*names, "cell"])

    placed = rows.select(*names).mapInArrow(route, f"{kinds}, cell int")
    return placed.withColumn("place", F.xxhash64(names[0], "embedding"))


def op4_nearest_neighbours(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where("vec_id % 50 = 0"))
