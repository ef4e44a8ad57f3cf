"""Exact top-n by inner product without scoring every query against every point.

Queries are dealt out by cells of a k-d tree over their vectors (its planes come from a bounded sample, which has no
influence on the result), so a task holds queries that lie near each other. Points are read in rounds of bounded size. Within a
round, near queries are searched as one group: a point stays a candidate of the group as long as an upper bound of its scores
reaches the smallest n-th score that a query of the group is known to have. The bound is the smallest of

- the point's inner product with the box around the group (its extreme coordinates),
- the one with the group's centre, plus radius times the point's norm, and
- the largest norm of the group times the point's norm (Cauchy-Schwarz).

Groups are split until they hold ``block`` queries at most; each part starts from the candidates of the whole and raises its
n-th scores by its most promising ones. What is left is scored, points of large norm first, until a query's n-th
score exceeds its own norm times that of the next points.

With more rounds than one, the points that score best with the cells' centres are searched first. The n-th scores
among these stay with the queries, which are written once: a round writes only what reaches them.
Only the points of one round (``round_bytes``, a constant) are broadcast at once; there is no join of queries and points.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revue.conf import materialize
from revue.operators import topk
from revue.operators.positions import dense_index

ROUND_BYTES, BLOCK, QUERIES_AT_ONCE, POINTS_AT_ONCE = 32 << 20, 1024, 8192, 1024
#: Sample for the planes of the query cells, depth of their tree, promising points (times n) of a group or cell.
SAMPLE, DEPTH, PROMISING = 16_384, 8, 4
#: Bounds and the scores that decide about candidates are 32-bit sums: they are raised, n-th scores lowered, by this share.
SLACK = 2e-5


class Points:
    """The points of one round, largest norms first: ids and vectors. ``n`` scores of a query are asked for."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, norms: np.ndarray | None, n: int, block: int = BLOCK):
        self.ids, self.vectors, self.n, self.block = ids, np.ascontiguousarray(vectors, np.float32), n, block
        if norms is None:
            norms = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
        self.norms = norms.astype(np.float32)
        self.signed = bool((self.vectors < 0).any())

    def bound(self, queries: np.ndarray, at: np.ndarray | slice) -> np.ndarray:
        """Upper bounds of the scores that the points at some places have with any of the queries."""
        vectors, norms = self.vectors[at], self.norms[at]
        high, low, centre = queries.max(axis=0), queries.min(axis=0), queries.mean(axis=0)
        box = np.maximum(vectors, 0) @ high + np.minimum(vectors, 0) @ low if self.signed else vectors @ high
        ball = vectors @ centre + np.sqrt(((queries - centre) ** 2).sum(axis=1).max()) * norms
        reach = np.sqrt((queries * queries).sum(axis=1).max())
        return np.minimum(np.minimum(box, ball), reach * norms) + SLACK * reach * norms


def _merged(row: np.ndarray, score: np.ndarray, point: np.ndarray, rows: np.ndarray,
            tops: np.ndarray, points: np.ndarray) -> None:
    """Put new (row, score, point) into the sorted lists of the queries ``rows``; equal scores go by point."""
    n = tops.shape[1]
    row = np.concatenate([row, np.repeat(rows, n)])
    score = np.concatenate([score, tops[rows].ravel()])
    point = np.concatenate([point, points[rows].ravel()])
    order = np.lexsort((point, -score, row))
    row, score, point = row[order], score[order], point[order]
    nth = np.arange(len(row)) - np.searchsorted(row, row)
    kept = nth < n
    tops[row[kept], nth[kept]], points[row[kept], nth[kept]] = score[kept], point[kept]


def _split(queries: np.ndarray, rows: np.ndarray, times: int = 3) -> list[np.ndarray]:
    """The rows in 2 ** ``times`` parts, by the medians of the widest coordinates."""
    if not times or len(rows) < 2:
        return [rows]
    part, half = queries[rows], len(rows) // 2
    order = np.argpartition(part[:, np.argmax(part.max(axis=0) - part.min(axis=0))], half)
    return _split(queries, rows[order[:half]], times - 1) + _split(queries, rows[order[half:]], times - 1)


class _Left:
    """Pairs (query row, place of a point) that are left out."""

    def __init__(self, row: np.ndarray, at: np.ndarray, queries: int, points: int):
        order = np.argsort(row, kind="stable")
        self.at, self.begin = at[order], np.searchsorted(row[order], np.arange(queries + 1))
        self.column = np.full(points if len(at) else 0, -1)

    def drop(self, scores: np.ndarray, rows: np.ndarray, at: np.ndarray) -> None:
        """Set the scores of left out pairs (``rows`` x places ``at``) to minus infinity."""
        sizes = self.begin[rows + 1] - self.begin[rows]
        total = int(sizes.sum())
        if not total:
            return
        nth = np.arange(total) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        self.column[at] = np.arange(len(at))
        column = self.column[self.at[np.repeat(self.begin[rows], sizes) + nth]]
        self.column[at] = -1
        line = np.repeat(np.arange(len(rows)), sizes)
        scores[line[column >= 0], column[column >= 0]] = -np.inf


def search(points: Points, queries: np.ndarray, tops: np.ndarray, found: np.ndarray,
           seen_row: np.ndarray, seen_at: np.ndarray, least: np.ndarray | None = None) -> None:
    """Bring the lists (``tops`` scores, ``found`` points) of some queries up to date, in place.

    ``seen_row`` / ``seen_at`` are the pairs left out: row of the query and place of the point in the round. Points that score
    below ``least`` of a query need not be listed.
    """
    exact, n = queries, points.n
    queries = queries.astype(np.float32)
    least = np.maximum(np.full(len(queries), -np.inf, np.float32) if least is None else least, tops[:, -1])
    left = _Left(seen_row, seen_at, len(queries), len(points.ids))
    norms = np.sqrt((queries * queries).sum(axis=1))
    stack = [(np.arange(len(queries)), np.arange(len(points.ids)))] if len(queries) else []
    while stack:
        rows, at = stack.pop()
        bound = points.bound(queries[rows], at)
        reached = bound >= least[rows].min()
        at, bound = at[reached], bound[reached]
        if not len(at):
            continue
        many = PROMISING * n
        if len(at) > 2 * many:
            best = at[np.argpartition(-bound, many)[:many]]
            scores = queries[rows] @ points.vectors[best].T
            left.drop(scores, rows, best)
            nth = np.partition(scores, many - n, axis=1)[:, many - n]
            least[rows] = np.maximum(least[rows], nth - SLACK * norms[rows] * points.norms[best].max())
            at = at[bound >= least[rows].min()]
        if len(rows) > points.block:
            stack += [(part, at) for part in _split(queries, rows) if len(part)]
            continue
        for begin in range(0, len(at), POINTS_AT_ONCE):
            some = at[begin:begin + POINTS_AT_ONCE]
            rows = rows[(1 + SLACK) * norms[rows] * points.norms[some[0]] >= least[rows]]
            if not len(rows):
                break
            scores = queries[rows] @ points.vectors[some].T
            left.drop(scores, rows, some)
            hit = scores >= (least[rows] - SLACK * norms[rows] * points.norms[some[0]])[:, None]
            hit = np.flatnonzero(hit & (scores > -np.inf) if len(seen_at) else hit)
            if len(hit):
                row, place = rows[hit // len(some)], some[hit % len(some)]
                score = np.einsum("ij,ij->i", exact[row], points.vectors[place].astype(np.float64)).astype(np.float32)
                _merged(row, score, points.ids[place], np.unique(row), tops, found)
                least[rows] = np.maximum(least[rows], tops[rows, -1])


def _flat(column: pa.Array, dtype) -> tuple[np.ndarray, np.ndarray]:
    """Row number and value of all elements of a list column."""
    sizes = np.asarray(column.value_lengths().fill_null(0))
    return np.repeat(np.arange(len(column)), sizes), np.asarray(column.flatten()).astype(dtype)


def _searched(shared, batches: Iterator[pa.RecordBatch], n: int):
    """Of each part of a batch (query, cell, features, least, seen): the part, its lists' scores and points."""
    pos, points = shared.value
    for batch in batches:
        for begin in range(0, batch.num_rows, QUERIES_AT_ONCE):
            part = batch.slice(begin, QUERIES_AT_ONCE)
            queries = _flat(part.column(2), np.float64)[1].reshape(part.num_rows, -1)
            tops = np.full((part.num_rows, n), -np.inf, np.float32)
            found = np.full((part.num_rows, n), np.iinfo(np.int64).max)
            least = part.column(3).to_numpy(zero_copy_only=False).astype(np.float32)
            row, seen = _flat(part.column(4), np.int64)
            search(points, queries, tops, found, row, np.searchsorted(pos, seen), least)
            yield part, tops, found


def _list_batches(shared, n: int):
    """The lists of the queries that have any."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, tops, found in _searched(shared, batches, n):
            has = tops > -np.inf
            any_ = has[:, 0]
            begin = pa.array(np.concatenate([[0], np.cumsum(has[any_].sum(axis=1))]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([part.column(0).filter(pa.array(any_)), pa.ListArray.from_arrays(begin, pa.array(found[has])),
                                              pa.ListArray.from_arrays(begin, pa.array(tops[has]))], ["query", "points", "scores"])
    return run


def _least_batches(shared, n: int):
    """The queries with their n-th scores, lowered: a score computed anew may differ in its last digit."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, tops, _ in _searched(shared, batches, n):
            nth = tops[:, -1]
            least = np.where(np.isfinite(nth), nth - SLACK * np.abs(nth), nth).astype(np.float32)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(2), pa.array(least)],
                                             ["query", "cell", "features", "least"])
    return run


def _ordered(points: DataFrame) -> DataFrame:
    norm = F.aggregate("features", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    return materialize(dense_index(points.select(F.col("id").cast("long").alias("id"), "features", norm.alias("norm")),
                                   [F.desc("norm"), F.asc("id")], "pos"), "points-by-norm")


def _tree(x: np.ndarray, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A k-d tree over the rows: axis and cut of each inner node (children of k: 2k + 1, 2k + 2), centres of its cells."""
    axis, cut, parts = [], [], [x]
    for _ in range(depth):
        nodes, parts = parts, []
        for part in nodes:
            j = int(np.argmax(part.max(axis=0) - part.min(axis=0))) if len(part) else 0
            axis.append(j)
            cut.append(float(np.median(part[:, j])) if len(part) else 0.0)
            parts += [part[part[:, j] < cut[-1]], part[part[:, j] >= cut[-1]]]
    return np.array(axis), np.array(cut), np.array([part.mean(axis=0) for part in parts if len(part)])


def _cell_batches(axis: np.ndarray, cut: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _flat(batch.column(1), np.float32)[1].reshape(batch.num_rows, -1)
            node = np.zeros(len(x), np.int64)
            while len(x) and node[0] < len(axis):
                node = 2 * node + 1 + (x[np.arange(len(x)), axis[node]] >= cut[node])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(node.astype(np.int32)), batch.column(1)], ["query", "cell", "features"])
    return run


def _near(queries: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """(query, cell, features), cell by cell, written; and the centres of the cells."""
    queries = materialize(queries.select("id", "features"), "queries")  # read twice, and they may come from a whole table of ratings
    sample = queries.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).toArrow()
    x = np.asarray(sample["features"].combine_chunks().flatten()).astype(np.float32).reshape(len(sample), -1) if len(sample) else np.zeros((0, 1), np.float32)
    axis, cut, centres = _tree(x)
    kind = queries.schema["id"].dataType.simpleString()
    cells = queries.mapInArrow(_cell_batches(axis, cut), f"query {kind}, cell int, features array<float>")
    return materialize(_dealt(cells), "queries-by-cell"), centres


def _best_batches(centres: np.ndarray, many: int):
    """(cell, pos, score): of the points of a task the ``many`` that score best with each centre."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores, ids = np.zeros((len(centres), 0)), np.zeros((len(centres), 0), np.int64)
        for batch in batches:
            x = _flat(batch.column(1), np.float64)[1].reshape(batch.num_rows, -1)
            scores = np.hstack([scores, centres @ x.T])
            ids = np.hstack([ids, np.broadcast_to(batch.column(0).to_numpy(), (len(centres), len(x)))])
            if scores.shape[1] > many:
                at = np.argpartition(-scores, many - 1, axis=1)[:, :many]
                scores, ids = np.take_along_axis(scores, at, 1), np.take_along_axis(ids, at, 1)
        cell = np.repeat(np.arange(len(centres), dtype=np.int32), scores.shape[1])
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(ids.ravel()), pa.array(scores.ravel())], ["cell", "pos", "score"])
    return run


def _promising(ordered: DataFrame, centres: np.ndarray, many: int) -> DataFrame:
    """``pos`` of the points that are among the ``many`` best ones of a cell's centre: a few for each cell."""
    best = ordered.select("pos", "features").mapInArrow(_best_batches(centres, many), "cell int, pos long, score double")
    return topk.per_key(best, ["cell"], [F.desc("score"), F.asc("pos")], many).select("pos").distinct()


def _dealt(queries: DataFrame) -> DataFrame:
    """Dealt out by cell. The number of parts is named: each is minutes of search, however few bytes it holds."""
    parts = max(1, int(queries.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return queries.repartitionByRange(parts, "cell", "query").sortWithinPartitions("cell")


def _with_seen(queries: DataFrame, places: DataFrame | None) -> DataFrame:
    """The queries with the places to leave out (query, pos) as an array ``seen``, cell by cell as before."""
    columns = ["query", "cell", "features", "least"]
    if places is None:
        return queries.select(*columns, F.array().cast("array<bigint>").alias("seen"))
    seen = places.groupBy("query").agg(F.collect_list("pos").alias("seen"))
    return _dealt(queries.join(seen, "query", "left").select(*columns, "seen"))


def top_n(queries: DataFrame, points: DataFrame, n: int, exclude: DataFrame | None = None,
          round_bytes: int = ROUND_BYTES, block: int = BLOCK) -> DataFrame:
    """(query, point, score, rank): the ``n`` points of largest inner product for every query, exactly.

    ``queries`` and ``points`` are (id, features array<float>) with unique ids, numbers for points; ``exclude`` (query, point) holds
    pairs to leave out. Scores are 32-bit floats as doubles, equal ones are ranked by the point's id. A query
    gets fewer rows only if fewer points are left.

    One pass over the queries per round; the excluded pairs of a round reach a query as an
    array, which holds at most the points of the round.
    """
    spark = queries.sparkSession
    ordered = _ordered(points)
    shape = ordered.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("features")).alias("dim")).first()
    total, dim = shape["n"], shape["dim"]
    kind = queries.schema["id"].dataType.simpleString()
    near, centres = _near(queries)
    if not total or not len(centres):
        return spark.createDataFrame([], f"query {kind}, point long, score double, rank int")
    per_round = max(1, round_bytes // (4 * dim + 12))
    rounds = -(-total // per_round)
    places = None
    if exclude is not None:
        places = materialize(exclude.select(F.col("query").cast(kind).alias("query"), F.col("point").cast("long").alias("id"))
                             .distinct().join(ordered.select("id", "pos"), "id").select("query", "pos"), "excluded-places")

    def look(within: Callable[[DataFrame], DataFrame], asked: DataFrame, batches: Callable, columns: str):
        """What the queries find among the points ``within`` selects by ``pos``, and the broadcast that holds these."""
        rows = within(ordered).select("pos", "id", "features", "norm").orderBy("pos").toArrow()
        vectors = np.asarray(rows["features"].combine_chunks().flatten()).astype(np.float32).reshape(len(rows), dim)
        some = Points(rows["id"].to_numpy(), vectors, np.sqrt(rows["norm"].to_numpy()), n, block)
        held = spark.sparkContext.broadcast((rows["pos"].to_numpy(), some))
        found = _with_seen(asked, None if places is None else within(places)).mapInArrow(batches(held, n), f"query {kind}, {columns}")
        return found, held

    listed = _list_batches, "points array<long>, scores array<float>"
    asked = near.withColumn("least", F.lit(-np.inf).cast("float"))
    if rounds == 1:
        found, _ = look(lambda df: df, asked, *listed)
        best = found.select("query", F.posexplode(F.arrays_zip("points", "scores")).alias("nth", "p"))
        return best.select("query", F.col("p.points").alias("point"), F.col("p.scores").cast("double").alias("score"),
                           (F.col("nth") + 1).alias("rank"))
    first = materialize(_promising(ordered, centres, PROMISING * n), "promising-places")
    found, held = look(lambda df: df.join(F.broadcast(first), "pos", "left_semi"), asked, _least_batches,
                       "cell int, features array<float>, least float")
    asked = materialize(found, "queries-with-least")
    held.destroy()
    hits = None
    for r in range(rounds):
        found, held = look(lambda df: df.where(F.col("pos").between(r * per_round, (r + 1) * per_round - 1)), asked, *listed)  # noqa: B023
        found = materialize(found, "top-n-round")
        held.destroy()
        hits = found if hits is None else hits.union(found)
    hit = F.transform(F.arrays_zip("points", "scores"), lambda p: F.struct((0.0 - p["scores"].cast("double")).alias("less"), p["points"].alias("point")))
    best = (hits.select("query", hit.alias("hits")).groupBy("query")
            .agg(F.slice(F.array_sort(F.flatten(F.collect_list("hits"))), 1, n).alias("hits")))
    return (best.select("query", F.posexplode("hits").alias("nth", "p"))
            .select("query", F.col("p.point").alias("point"), (0.0 - F.col("p.less")).alias("score"), (F.col("nth") + 1).alias("rank")))
