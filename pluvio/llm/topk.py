"""Exact top-k search by inner product: ball-tree branch and bound per shard.

Candidates and queries are dealt by space: a bounded sample of each gives
pivots, every row goes to its nearest one, and a pivot's rows are divided into
shards (or query groups) of bounded size. A pivot and its farthest row make a ball. A
cell is one shard and one query group: it builds a ball tree of the shard, and
takes its nodes in the order of their upper bound, q.c + |q| r, as long as
one of the queries can still gain.

Cells run in waves. The first joins every query group with the shards whose
balls promise most. From then on the k-th score of every query so far is known, and
a shard is shipped to a query group only if the bound of their two balls passes
the least k-th score of the group; inside a cell it cuts nodes in the same way.
The bound of two balls is that of their pivots, whose number is bounded, so
the pairs are compared on the driver.

Of candidates with equal vectors only the 2 k smallest by id, of one id at most
k, can be among the k best of any query, so no more of them go on; Spark
drops the rest before the shuffle.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pluvio.llm.common import staged

SHARD_ROWS, QUERY_ROWS, LEAF_ROWS, BLOCK = 4096, 4096, 64, 256
#: Ranks of ids share a number with the score: score * PLACES + (PLACES - 1 - rank).
PLACES = 1 << 16
LOWEST = LOWEST_SCORE = -(1 << 63)
#: Pivots, and the sample (in the order of a hash) that they are chosen from, at most.
MOST_PIVOTS, SAMPLE = 256, 4096
#: Scores below this share their number with a rank; a cell with larger ones is searched without the tree.
NARROW = 1 << 46


class BallTree:
    """A binary tree of balls over the rows of ``points``, split at the
    median along the line between two far points. ``rank`` orders rows of
    equal score; a node keeps the least rank below it."""

    def __init__(self, points: np.ndarray) -> None:
        self.order = np.arange(len(points))
        self.nodes: list[tuple] = []  # start, end, left, right
        self._points = points
        centres, radii, ranks = [], [], []
        todo = [(0, len(points), -1, 0)]
        while todo:
            start, end, parent, side = todo.pop()
            rows = self.order[start:end]
            inside = points[rows]
            centre = inside.mean(axis=0)
            far = np.sqrt(np.square(inside - centre).sum(axis=1))
            me = len(self.nodes)
            self.nodes.append([start, end, -1, -1])
            centres.append(centre)
            radii.append(far.max())
            ranks.append(rows.min())
            if parent >= 0:
                self.nodes[parent][2 + side] = me
            if end - start <= LEAF_ROWS or radii[-1] == 0:
                continue
            a = inside[far.argmax()]
            b = inside[np.square(inside - a).sum(axis=1).argmax()]
            middle = (end - start) // 2
            self.order[start:end] = rows[np.argpartition(inside @ (b - a), middle)]
            todo += [(start, start + middle, me, 0), (start + middle, end, me, 1)]
        self.centres, self.radii, self.ranks = np.array(centres), np.array(radii), np.array(ranks)

    def search(self, queries: np.ndarray, own: np.ndarray, floor: np.ndarray, k: int) -> np.ndarray:
        """The k largest keys of each query above its ``floor``, unordered and
        filled up with ``LOWEST``. ``own``: from and to which row a query skips."""
        best = np.full((len(queries), k), LOWEST)
        least = floor.copy()
        length = np.sqrt(np.square(queries).sum(axis=1))

        def bound(node: int, which: np.ndarray) -> np.ndarray:
            reach = queries[which] @ self.centres[node] + length[which] * self.radii[node]
            reach = np.floor(reach + 1e-6 + 1e-9 * np.abs(reach)).astype(np.int64)
            return reach * PLACES + (PLACES - 1 - self.ranks[node])

        everyone = np.arange(len(queries))
        first = bound(0, everyone)
        heap = [(-first.max(initial=LOWEST + 1), 0, everyone, first)]
        while heap:
            _, node, which, reach = heapq.heappop(heap)
            still = reach > least[which]
            which = which[still]
            if not len(which):
                continue
            start, end, *children = self.nodes[node]
            if children[0] >= 0:
                for child in children:
                    reach = bound(child, which)
                    go = reach > least[which]
                    if go.any():
                        heapq.heappush(heap, (-reach[go].max(), child, which[go], reach[go]))
                continue
            rows = self.order[start:end]
            scores = np.rint(queries[which] @ self._points[rows].T).astype(np.int64)
            keys = scores * PLACES + (PLACES - 1 - rows)
            keys[(rows[None, :] >= own[which, :1]) & (rows[None, :] < own[which, 1:])] = LOWEST
            merged = np.concatenate([best[which], keys], axis=1)
            best[which] = np.partition(merged, merged.shape[1] - k, axis=1)[:, -k:]
            least[which] = np.maximum(floor[which], best[which].min(axis=1))
        best[best <= floor[:, None]] = LOWEST
        return best


def integer_vectors(rows: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, v, n): floor(scale * x) of each component, and how many rows have
    this id and vector; rows without an id, and vectors that are null or hold
    a null or non-finite component, are left out."""
    sound = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    floored = F.transform(vector_col, lambda x: F.floor(x.cast("double") * scale))
    return (rows.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & sound)
            .select(F.col(id_col).cast("long").alias("id"), floored.alias("v"))
            .groupBy("id", "v").agg(F.count(F.lit(1)).alias("n")))


def _stack(vectors: pd.Series, width: int, kind: type = np.float64) -> np.ndarray:
    made = np.zeros((len(vectors), width), kind)
    for i, v in enumerate(vectors):
        made[i, :len(v)] = v
    return made


def _wide(points: np.ndarray, queries: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """(query row, point row, score) of the k best points of each query, by whole numbers."""
    scores = queries @ points.T
    found = []
    for q, (start, end) in enumerate(own.tolist()):
        place = np.argsort(-scores[q], kind="stable")
        place = place[(place < start) | (place >= end)][:k]
        found.append((np.full(len(place), q), place, scores[q, place]))
    return tuple(np.concatenate(x) for x in zip(*found))


def _cell(k: int):
    """Search of one group of queries in one shard."""

    def work(shard: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        found: list[pd.DataFrame] = [pd.DataFrame({"q": [], "vec_id": [], "score": []}).astype("int64")]
        if len(shard) and len(queries):
            shard = shard.sort_values("id", ignore_index=True)
            ids = shard["id"].to_numpy()
            width = max(shard["v"].map(len).max(), queries["v"].map(len).max())
            points = _stack(shard["v"], width)
            tree = BallTree(points)
            for at in range(0, len(queries), BLOCK):
                block = queries.iloc[at:at + BLOCK]
                q, q_ids, numbers = _stack(block["v"], width), block["id"].to_numpy(), block["q"].to_numpy()
                top = float(np.abs(points).max(initial=0)) * float(np.abs(q).max(initial=0)) * width
                if top >= 1 << 63:
                    raise ValueError("scores that may not fit a long are not supported")
                own = np.stack([np.searchsorted(ids, q_ids, side) for side in ("left", "right")], axis=1)
                if max(np.abs(points).max(initial=0), np.abs(q).max(initial=0)) ** 2 * width >= NARROW:
                    row, place, score = _wide(_stack(shard["v"], width, np.int64),
                                              _stack(block["v"], width, np.int64), own, k)
                    found.append(pd.DataFrame({"q": numbers[row], "vec_id": ids[place], "score": score}))
                    continue
                known = block["kth_score"].notna().to_numpy()
                rank = np.searchsorted(ids, block["kth_id"].fillna(0).astype("int64").to_numpy())
                floor = np.where(known, block["kth_score"].fillna(0).astype("int64").clip(-NARROW, NARROW).to_numpy() * PLACES
                                 + (PLACES - 1 - rank), LOWEST)
                best = tree.search(q, own, floor, k)
                row, column = np.nonzero(best > LOWEST)
                score, rest = np.divmod(best[row, column], PLACES)
                found.append(pd.DataFrame({"q": numbers[row], "vec_id": ids[PLACES - 1 - rest], "score": score}))
        return pd.concat(found, ignore_index=True)

    return work


class Pivots:
    """Points of a bounded sample; every row belongs to the nearest one."""

    def __init__(self, sample: list[list[int]], most: int) -> None:
        width = max(map(len, sample), default=0)
        points = np.unique(_stack(pd.Series(sample), width), axis=0) if sample else np.zeros((1, 0))
        # spread over the sample: each next pivot is the point farthest from those before
        chosen, far = [0], np.square(points - points[0]).sum(axis=1)
        while len(chosen) < min(most, len(points)) and far.max() > 0:
            chosen.append(int(far.argmax()))
            far = np.minimum(far, np.square(points - points[chosen[-1]]).sum(axis=1))
        self.points = points[chosen]

    def nearest(self, vectors: pd.Series) -> tuple[np.ndarray, np.ndarray]:
        """Number and distance of the nearest pivot."""
        width = max(self.points.shape[1], vectors.map(len).max() if len(vectors) else 0)
        pivots, place, far = _stack(pd.Series(list(self.points)), width), [], []
        for at in range(0, len(vectors), BLOCK):
            x = _stack(vectors.iloc[at:at + BLOCK], width)
            square = np.square(pivots).sum(axis=1)[None, :] - 2 * x @ pivots.T
            own = square.argmin(axis=1)
            place.append(own)
            far.append(np.sqrt(np.square(x - pivots[own]).sum(axis=1)))
        empty = [np.zeros(0)]
        return np.concatenate(place or empty).astype(np.int32), np.concatenate(far or empty)


def _bounds(queries: Pivots, query_radius: np.ndarray, shards: Pivots, radius: np.ndarray) -> np.ndarray:
    """Upper bounds of the inner products of the rows of each query pivot and each shard pivot."""
    width = max(queries.points.shape[1], shards.points.shape[1])
    a, b = (_stack(pd.Series(list(p.points)), width) for p in (queries, shards))
    lengths = [np.sqrt(np.square(x).sum(axis=1)) for x in (a, b)]
    bound = a @ b.T + np.outer(query_radius, lengths[1]) + np.outer(lengths[0], radius) + np.outer(query_radius, radius)
    return bound + 1e-6 + 1e-9 * np.abs(bound)


def _sampled(rows: DataFrame, size: int) -> Pivots:
    """Pivots for sets of about ``size`` rows, from a sample in the order of a hash."""
    most = max(1, min(MOST_PIVOTS, -(-rows.count() // size)))
    return Pivots([r["v"] for r in rows.select("v").orderBy(F.xxhash64("v")).limit(SAMPLE).collect()], most)


def _placed(rows: DataFrame, pivots: Pivots, size: int, part: str) -> tuple[DataFrame, dict[int, tuple[float, int]]]:
    """``rows`` with their pivot and ``part``, a division of the pivot's rows into
    sets of about ``size``; and radius and parts of each pivot."""
    fields = [*rows.schema.fields, T.StructField("pivot", T.IntegerType()), T.StructField("far", T.DoubleType())]

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            f["pivot"], f["far"] = pivots.nearest(f["v"])
            yield f

    placed = staged(rows.mapInPandas(work, T.StructType(fields)), "placed")
    balls = {r["pivot"]: (r["far"], -(-r["n"] // size)) for r in placed.groupBy("pivot").agg(
        F.max("far").alias("far"), F.count(F.lit(1)).alias("n")).collect()}  # a row a pivot
    parts = F.element_at(F.create_map(*[F.lit(x) for p, (_, n) in balls.items() for x in (p, n)]), F.col("pivot")) \
        if balls else F.lit(1)
    deal = F.pmod(F.xxhash64("id", "v"), parts).cast("int")
    return placed.withColumn(part, deal).drop("far"), balls


def _pairs(rows: DataFrame, key: str, shipped: dict[int, list[int]], balls: dict[int, tuple[float, int]], other: str,
           into: str) -> DataFrame:
    """``rows`` once for each part of the pivots that theirs (``key``) is paired
    with. There are at most ``MOST_PIVOTS`` squared pairs to broadcast."""
    pairs = [(p, o, balls[o][1]) for p, others in shipped.items() for o in others]
    listed = rows.sparkSession.createDataFrame(pairs, f"{key} int, {other} int, parts int")
    return rows.join(F.broadcast(listed), key).withColumn(
        into, F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")


def top_k(rows: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id",
          vector_col: str = "embedding", scale: int = 64, shard_rows: int = SHARD_ROWS,
          query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, rank from 1, vec_id, score): for each id of a row with
    ``is_query`` the k rows with the highest integer inner products, those of
    that id excluded, all if there are fewer; ties go to the smaller id.

    Every row with an id takes part, also one that shares it with others; query
    rows that share an id give one list, in which each of them counts. Rows
    without an id cannot be told and are left out; see :func:`integer_vectors`
    for the vectors that are. Any score that fits a long is exact; a shard whose
    largest query component times its largest component times the width reaches
    2^63 is refused. Shorter vectors count as filled up with zeros. With no query or
    no candidate, or on an empty table, the result is empty.
    """
    # a cell's rows come by a random hash; PLACES leaves room for twice the expected size and more
    if shard_rows * 4 > PLACES:
        raise ValueError(f"shard_rows is at most {PLACES // 4}")
    own = [F.col(id_col), F.col(vector_col)]
    vectors = staged(integer_vectors(rows.select(*own), id_col, vector_col, scale), "vectors")
    asked = staged(integer_vectors(rows.where(is_query).select(*own), id_col, vector_col, scale)
                   .withColumn("q", F.monotonically_increasing_id()), "queries")
    copies = F.explode(F.sequence(F.lit(1), F.least("n", F.lit(k)).cast("int")))
    alike = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    candidates = staged(vectors.select("id", "v", copies.alias("copy")).withColumn("nth", alike)
                        .where(F.col("nth") <= 2 * k).select("id", "v"), "candidates")
    shard_pivots, query_pivots = _sampled(candidates, shard_rows), _sampled(asked, query_rows)
    candidates, balls = _placed(candidates, shard_pivots, shard_rows, "shard")
    queries, groups = _placed(asked.select("q", "id", "v"), query_pivots, query_rows, "cell_group")
    radius = lambda of, p: np.array([of.get(i, (0.0, 0))[0] for i in range(len(p.points))])
    bound = _bounds(query_pivots, radius(groups, query_pivots), shard_pivots, radius(balls, shard_pivots))
    left = {g: sorted(balls, key=lambda p: -bound[g, p]) for g in groups}  # pivots not yet searched, by promise
    best, wave = None, 1
    place = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    while any(left.values()):
        now = {g: found[:wave] for g, found in left.items()}
        left = {g: found[wave:] for g, found in left.items()}
        by_shard: dict[int, list[int]] = {}
        for g, found in now.items():
            for p in found:
                by_shard.setdefault(p, []).append(g)
        shards = _pairs(candidates.withColumnRenamed("pivot", "p"), "p", by_shard, groups, "g", "cell_group")
        right = queries.withColumnRenamed("pivot", "g")
        if best is None:
            right = right.withColumn("kth_score", F.lit(None).cast("long")).withColumn(
                "kth_id", F.lit(None).cast("long"))
        else:
            kth = best.where(F.col("rank") == k).select(
                "q", F.col("score").alias("kth_score"), F.col("vec_id").alias("kth_id"))
            right = right.join(kth, "q", "left")
        right = _pairs(right, "g", now, balls, "p", "shard")
        cell = ["p", "shard", "g", "cell_group"]
        cells = shards.groupBy(*cell).cogroup(right.groupBy(*cell))
        found = cells.applyInPandas(_cell(k), "q long, vec_id long, score long")
        if best is not None:
            found = found.unionByName(best.drop("rank"))
        best = staged(found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k), "best")
        if any(left.values()):  # a group goes on while one of its queries can gain
            kth = best.where(F.col("rank") == k).select("q", "score")
            least = {r["pivot"]: r["least"] for r in queries.join(kth, "q", "left").groupBy("pivot").agg(F.min(
                F.coalesce("score", F.lit(LOWEST_SCORE))).alias("least")).collect()}  # a row a pivot
            left = {g: [p for p in found if bound[g, p] >= least[g]] for g, found in left.items()}
        wave *= 4
    if best is None:
        return _none(rows)
    repeated = best.join(asked.select("q", F.col("id").alias("query_id"), "n"), "q").withColumn(
        "copy", F.explode(F.sequence(F.lit(1), F.least("n", F.lit(k)).cast("int"))))
    last = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (repeated.withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _none(rows: DataFrame) -> DataFrame:
    """The result without any query or candidate."""
    return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
