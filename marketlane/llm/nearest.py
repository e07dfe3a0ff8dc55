"""Approximate nearest neighbours by largest inner product: multiprobe p-stable hashing.

Vectors get one more component, so that all have the norm of the longest and
the largest inner product is the smallest distance. A table takes ``functions``
Gaussian projections, each cut into cells of a width; a vector's bucket is its
row of cells. A query visits buckets in the order of the estimated chance that
a neighbour at the usual distance lies there, until the chances visited add up
to a share. The distance and the share are fitted on FIT_QUERIES vectors (a
bounded sample, whose neighbours are found exactly by a pass over all rows) so
that RECALL of their neighbours are met in some table. Every row is indexed.

What that fit leaves open is settled query by query. A query that met fewer
than ``k`` others, or for which a row at the distance of the worst it would
return had a chance below SURE of being met, is compared with all rows in a
second pass, in blocks; so lone vectors and small tables lose nothing.

A bucket's vectors are cut into blocks and dealt out over groups; a query's
vector goes once to each group that holds buckets it visits. There inner
products are taken in double precision, and the best of each group and table
are merged. Equal vectors are searched as one and stand for their ``k`` + 1
smallest ids, which is all that a result can use; so a vector that many rows
share makes no bucket larger. Queries are dealt out in blocks too.

Vectors that are null, empty, zero, of another length than most (the smallest
of equally frequent lengths), or that hold null or non-finite components take
no part, nor do rows with a null id. Rows that repeat an id are one row. Ties
go to the smaller id. With fewer candidates than ``k`` all are returned. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlane import scratch

TABLES, FUNCTIONS = 2, 6
WIDTH = 2.0  # of a cell, in norms
REACH = 2  # cells to either side that a query may visit; a vector of a table's other cells is left to the other tables
RECALL = 0.97
SURE = 0.9
FIT_QUERIES = 100
GROUP_ROWS, QUERY_ROWS = 8192, 4096


def usable(vectors: DataFrame, vector: str) -> Column:
    v = F.col(vector).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col(vector).isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0)


def classes(vectors: DataFrame, k: int, key: str, vector: str) -> DataFrame:
    """One row for each distinct vector: class (smallest id), vector, ids (k + 1 smallest)."""
    rows = vectors.where(F.col(key).isNotNull() & usable(vectors, vector)).select(
        F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v")
    )
    sizes = rows.groupBy(F.size("v").alias("size")).agg(F.count(F.lit(1)).alias("n"))
    usual = sizes.agg(F.min_by("size", F.struct(-F.col("n"), "size"))).first()[0]
    rows = rows.where(F.size("v") == (usual or 0)).dropDuplicates(["id"])
    place = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    least = rows.withColumn("place", place).where(F.col("place") <= k + 1)
    return least.groupBy("v").agg(F.min("id").alias("class"), F.sort_array(F.collect_list("id")).alias("ids"))


class Tables:
    """Projections of all tables, and the chances of buckets."""

    def __init__(self, dim: int, longest: float) -> None:
        rng = np.random.default_rng(1996)
        self.longest = longest
        self.directions = rng.normal(size=(TABLES, dim + 1, FUNCTIONS))
        self.width = WIDTH * longest
        self.shift = rng.uniform(0, self.width, (TABLES, 1, FUNCTIONS))
        self.steps = np.random.default_rng(7).integers(1, 1 << 62, FUNCTIONS) * 2 + 1
        self.spread, self.share = longest, 1.0

    def candidates(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.longest**2 - (x**2).sum(axis=1), 0))
        return np.hstack([x, rest[:, None]])

    def queries(self, q: np.ndarray) -> np.ndarray:
        norm = np.linalg.norm(q, axis=1, keepdims=True)
        return np.hstack([q * (self.longest / np.where(norm > 0, norm, 1)), np.zeros((len(q), 1))])

    def places(self, full: np.ndarray) -> np.ndarray:
        """Projections in cells: tables, rows, functions."""
        return (np.einsum("nd,tdf->tnf", full, self.directions) + self.shift) / self.width

    def bucket(self, cells: np.ndarray, table: int) -> np.ndarray:
        """One number for each row of cells of a table."""
        with np.errstate(over="ignore"):
            h = (cells.astype(np.int64) * self.steps).sum(axis=-1) + np.int64(table) * np.int64(0x1234567)
        return h ^ (h >> 29)

    def visits(self, place: np.ndarray, share: float) -> tuple[np.ndarray, np.ndarray]:
        """Offsets from the query's cells in falling order of chance until ``share`` is reached, and sums of the chances."""
        frac = place - np.floor(place)
        offsets = np.arange(-REACH, REACH + 1)
        edge = (np.append(offsets, REACH + 1)[None, :] - frac[:, None]) * self.width / self.spread
        chance = np.diff(_normal(edge), axis=1)
        limit = 256
        while True:
            total, at = np.ones(1), np.zeros((1, 0), np.int8)
            for f in range(FUNCTIONS):
                grown = (total[:, None] * chance[f][None, :]).ravel()
                best = np.argsort(-grown, kind="stable")[:limit]
                at = np.hstack([at[best // len(offsets)], offsets[best % len(offsets), None].astype(np.int8)])
                total = grown[best]
            sums = np.cumsum(total)
            if sums[-1] >= share or limit >= len(offsets) ** FUNCTIONS:
                n = int(np.searchsorted(sums, share)) + 1
                return at[:n], sums[:n]
            limit *= 4

    def met(self, places: np.ndarray, distance: float) -> float:
        """Chance that a row at a distance from a query lies in a bucket that the query visits in some table."""
        missed = 1.0
        offsets = np.arange(-REACH, REACH + 2)
        for place in places:
            at, _ = self.visits(place, self.share)
            edge = (offsets[None, :] - (place - np.floor(place))[:, None]) * self.width / max(distance, 1e-6 * self.longest)
            chance = np.diff(_normal(edge), axis=1)
            missed *= 1 - min(1.0, float(np.prod(chance[np.arange(FUNCTIONS), at + REACH], axis=1).sum()))
        return 1 - missed


def _normal(x: np.ndarray) -> np.ndarray:
    """Distribution function of the normal distribution, by a table."""
    return np.interp(x, _GRID, _CDF, 0.0, 1.0)


_GRID = np.linspace(-8, 8, 16001)
_CDF = np.concatenate([[0], np.cumsum((np.exp(-_GRID[1:] ** 2 / 2) + np.exp(-_GRID[:-1] ** 2 / 2)) / 2 * np.diff(_GRID)) / np.sqrt(2 * np.pi)])


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1)


def _best(scores: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k largest finite scores of a row; ties to the smaller column."""
    n = min(k, int(np.isfinite(scores).sum()))
    if not n:
        return np.zeros(0, np.int64)
    limit = np.partition(scores, -n)[-n]
    at = np.flatnonzero(scores >= limit)
    return at[np.lexsort((at, -scores[at]))]


def fitted(found: DataFrame, k: int) -> Tables | None:
    """Tables with distance and share fitted on the sample."""
    dim, longest = found.agg(F.max(F.size("v")), F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)))).first()
    if dim is None:
        return None
    tables = Tables(dim, longest)
    sample = found.orderBy(F.xxhash64("class"), "class").limit(FIT_QUERIES).select("v").toArrow()
    q = _matrix(sample.column("v").combine_chunks())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("v"))
            s = q @ x.T
            rows = [(i, float(s[i, j]), j) for i in range(len(q)) for j in _best(s[i], k + 1)]
            i, s, j = zip(*rows) if rows else ((), (), ())
            yield pa.record_batch({
                "q": pa.array(i, pa.int32()), "s": pa.array(s, pa.float64()), "class": batch.column("class").take(pa.array(j, pa.int32())),
                "v": batch.column("v").take(pa.array(j, pa.int32())),
            })

    near = found.select("class", "v").mapInArrow(run, "q int, s double, class long, v array<double>")
    place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("s"), "class"))
    near = near.withColumn("place", place).where(F.col("place").between(2, k + 1)).toArrow()
    if not near.num_rows:
        return tables
    owner, x = near.column("q").to_numpy(), _matrix(near.column("v").combine_chunks())
    qf, xf = tables.queries(q), tables.candidates(x)
    tables.spread = max(float(np.linalg.norm(xf - qf[owner], axis=1).mean()), 1e-6 * longest)
    need = np.full(len(x), 2.0)
    qp, xp = tables.places(qf), tables.places(xf)
    for t in range(TABLES):
        for i in range(len(q)):
            at, sums = tables.visits(qp[t, i], 2.0)
            order = {tuple(o): s for o, s in zip(at.tolist(), sums.tolist())}
            for j in np.flatnonzero(owner == i):
                away = tuple((np.floor(xp[t, j]) - np.floor(qp[t, i])).astype(int).tolist())
                need[j] = min(need[j], order.get(away, 2.0))
    tables.share = float(np.quantile(need, RECALL))
    return tables


def search(vectors: DataFrame, queries: Column, k: int, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id and score: the ``k`` nearest found for each row that ``queries`` picks."""
    found = scratch.durable(classes(vectors, k, key, vector), "vectors")
    tables = fitted(found, k)
    asked = vectors.where(queries & usable(vectors, vector)).select(
        F.col(key).cast("long").alias("query_id"), F.col(vector).cast("array<double>").alias("v")
    ).dropDuplicates(["query_id"])
    asked = asked.join(found.select("v", "class"), "v").select("query_id", F.col("class").alias("q"))
    if tables is None:
        return asked.select("query_id", F.lit(1).alias("rank"), F.col("q").alias("vec_id"), F.lit(0.0).alias("score")).limit(0)
    asked = scratch.durable(asked, "queries")

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = np.floor(tables.places(tables.candidates(_matrix(batch.column("v")))))
            for t in range(TABLES):
                yield pa.record_batch({"bucket": tables.bucket(cells[t], t), "class": batch.column("class")})

    index = scratch.durable(found.select("class", "v").mapInArrow(indexed, "bucket long, class long"), "index")
    blocks = index.groupBy("bucket").agg(F.ceil(F.count("class") / GROUP_ROWS).cast("int").alias("blocks"))
    wanted = found.join(asked.select(F.col("q").alias("class")).distinct(), "class", "left_semi").select("class", "v")
    total, n_queries = index.count(), wanted.count()
    groups = 1 + total // GROUP_ROWS
    parts = 1 + n_queries // QUERY_ROWS
    group = F.pmod(F.xxhash64("bucket", "block"), F.lit(groups)).cast("int")

    def visited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = tables.places(tables.queries(_matrix(batch.column("v"))))
            for t in range(TABLES):
                for i, q in enumerate(batch.column("class").to_pylist()):
                    at, _ = tables.visits(place[t, i], tables.share)
                    bucket = tables.bucket(np.floor(place[t, i]) + at, t)
                    yield pa.record_batch({"q": np.full(len(at), q), "bucket": bucket})

    probes = wanted.mapInArrow(visited, "q long, bucket long").join(blocks, "bucket")
    probes = probes.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("group", group)
    probes = probes.groupBy("group", "q").agg(F.collect_set("bucket").alias("buckets"))
    part = F.pmod(F.xxhash64("q"), F.lit(parts)).cast("int")
    asking = probes.join(wanted.withColumnRenamed("class", "q"), "q").select(
        "group", part.alias("part"), F.lit(0).alias("kind"), F.col("q").alias("id"), "v", "buckets"
    )
    cut = F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int")
    held = index.join(blocks, "bucket").select("class", "bucket", cut.alias("block")).withColumn("group", group)
    held = held.groupBy("group", "class").agg(F.collect_set("bucket").alias("buckets")).join(found.select("class", "v"), "class")
    offered = held.select(
        "group", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), F.lit(1).alias("kind"),
        F.col("class").alias("id"), "v", "buckets",
    )

    every = F.array(F.lit(0).cast("long"))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def best(queries, rows):
            """The k + 1 best of one group's rows for each of its queries."""
            if not queries or not rows:
                return
            qid, qv, qb = ([x for part in queries for x in part[c]] for c in range(3))
            xid, xv, xb = ([x for part in rows for x in part[c]] for c in range(3))
            names = {b: n for n, b in enumerate({b for bs in xb for b in bs})}
            asks, has = np.zeros((len(qid), len(names)), np.float32), np.zeros((len(xid), len(names)), np.float32)
            for lists, into in ((qb, asks), (xb, has)):
                for n, bs in enumerate(lists):
                    into[n, [names[b] for b in bs if b in names]] = 1
            q, x = np.array(qv), np.array(xv)
            order = np.argsort(xid)
            xid, x, has = np.array(xid)[order], x[order], has[order]
            for a in range(0, len(q), 256):
                s = np.where(asks[a : a + 256] @ has.T > 0, q[a : a + 256] @ x.T, -np.inf)
                for n in range(len(s)):
                    j = _best(s[n], k + 1)
                    if len(j):
                        exact = (x[j] * q[a + n]).sum(axis=1)
                        yield pa.record_batch({"q": np.full(len(j), qid[a + n]), "class": xid[j], "score": exact})

        now, queries, rows = None, [], []
        for batch in batches:
            g, p, kind = (batch.column(c).to_numpy() for c in ("group", "part", "kind"))
            cuts = np.flatnonzero((g[1:] != g[:-1]) | (p[1:] != p[:-1]) | (kind[1:] != kind[:-1])) + 1
            for a, b in zip([0, *cuts], [*cuts, len(g)]):
                if b == a:
                    continue
                if (g[a], p[a]) != now:
                    yield from best(queries, rows)
                    now, queries, rows = (g[a], p[a]), [], []
                piece = batch.slice(a, b - a)
                (rows if kind[a] else queries).append(
                    (piece.column("id").to_pylist(), list(_matrix(piece.column("v"))), piece.column("buckets").to_pylist())
                )
        yield from best(queries, rows)

    def best_of(asking: DataFrame, offered: DataFrame) -> DataFrame:
        """q, class, score: the k + 1 best classes of each query among those it shares a bucket with."""
        dealt = asking.unionByName(offered).repartition("group", "part").sortWithinPartitions("group", "part", "kind")
        # A group may give a class again that another table's group gave.
        near = dealt.mapInArrow(scored, "q long, class long, score double").distinct()
        top = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "class"))
        return near.withColumn("place", top).where(F.col("place") <= k + 1).drop("place")

    near = scratch.durable(best_of(asking, offered), "near")
    rows = near.join(found.select("class", F.size("ids").alias("n")), "class")
    upto = F.sum("n").over(Window.partitionBy("q").orderBy(F.desc("score"), "class"))
    # The score of the last row that a query would return; null where it met too few.
    last = rows.withColumn("upto", upto).groupBy("q").agg(F.max(F.when(F.col("upto") >= k + 1, F.col("score"))).alias("last"))

    def open_still(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _matrix(batch.column("v"))
            place = tables.places(tables.queries(v))
            out = []
            for i, (q, worst) in enumerate(zip(batch.column("class").to_pylist(), batch.column("last").to_pylist())):
                if worst is not None:
                    square = 2 * tables.longest**2 - 2 * worst * tables.longest / np.linalg.norm(v[i])
                    if tables.met(place[:, i], max(square, 0.0) ** 0.5) >= SURE:
                        continue
                out.append(q)
            yield pa.record_batch({"q": pa.array(out, pa.int64())})

    short = wanted.join(last.withColumnRenamed("q", "class"), "class", "left").select("class", "v", "last")
    short = scratch.durable(short.mapInArrow(open_still, "q long"), "open")
    n_short = short.count()
    if n_short:
        groups, parts = 1 + found.count() // GROUP_ROWS, 1 + n_short // QUERY_ROWS
        part = F.pmod(F.xxhash64("q"), F.lit(parts)).cast("int")
        asking = short.join(wanted.withColumnRenamed("class", "q"), "q").select(
            F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"), part.alias("part"), F.lit(0).alias("kind"),
            F.col("q").alias("id"), "v", every.alias("buckets"),
        )
        offered = found.select(
            F.pmod(F.xxhash64("class"), F.lit(groups)).cast("int").alias("group"),
            F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), F.lit(1).alias("kind"),
            F.col("class").alias("id"), "v", every.alias("buckets"),
        )
        near = near.join(short, "q", "left_anti").unionByName(best_of(asking, offered))
    ids = near.join(found.select("class", "ids"), "class").select("q", "score", F.explode("ids").alias("vec_id"))
    top = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "vec_id"))
    ids = ids.withColumn("place", top).where(F.col("place") <= k + 1).drop("place")
    own = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    out = asked.join(ids, "q").where("query_id <> vec_id").withColumn("rank", F.row_number().over(own))
    return out.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
