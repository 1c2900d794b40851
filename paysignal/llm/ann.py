"""Approximate nearest neighbours: adaptive dimension scan of inverted lists.

Largest inner product is turned into least distance by one more component,
sqrt(M^2 - |v|^2) with M the largest norm of all vectors (0 for queries). The
vectors are dealt to lists by the nearest of some centroids, which are fitted on
a bounded sample; every vector is indexed. A random rotation makes any prefix
of the dimensions a fair sample of the distance, so a scan of a probed list
reads rotated dimensions in column blocks and after each block abandons the
candidates whose partial distance, scaled up, exceeds the k-th best so far by
more than the hypothesis test allows (``EPSILON``). Survivors are scored on the
original vectors in double precision.

How many lists a query probes is measured, not guessed: for some sampled
queries the true neighbours are found by a scan of all vectors, and the probes
are the fewest that reach ``RECALL`` of them.

A list is split into chunks of some ``CHUNK`` vectors and its queries into
chunks of some ``QUERIES``; each pair of chunks is a group, so no task holds a
whole list.

Defined cases: vectors that are null, zero, or hold null or non-finite
components, or have a null id, take no part; shorter vectors end in zeros; of
queries that repeat an id one is asked, and no row with the query's id is its
candidate; a query probes further lists until they hold k candidates; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paysignal.llm.scratch import Scratch
from paysignal.llm.vectors import best, dimensions, pack, unpack, usable

#: Most vectors (and bytes) that centroids are fitted on.
SAMPLE, SAMPLE_BYTES = 16_384, 64 << 20
MAX_LISTS = 1024
ROUNDS = 10
CHUNK, QUERIES = 2048, 1024
#: Pairs of a query and a candidate that are worked on at once.
PAIRS = 1 << 18
#: Below this share of pairs alive, a column block is read for those pairs only.
GATHER = 0.1
EPSILON = 2.1
CALIBRATE = 96
RECALL = 0.94


def rotation(dims: int, seed: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def centroids(sample: np.ndarray, lists: int, seed: int) -> np.ndarray:
    """Lloyd's algorithm; an empty cell is moved to the vector farthest from its centroid."""
    rng = np.random.default_rng(seed)
    centres = sample[rng.choice(len(sample), min(lists, len(sample)), replace=False)].copy()
    for _ in range(ROUNDS):
        near = nearest(sample, centres)
        sizes = np.bincount(near, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, near, sample)
        empty = np.flatnonzero(sizes == 0)
        centres = sums / np.maximum(sizes, 1)[:, None]
        if len(empty):
            far = np.argsort(-((sample - centres[near]) ** 2).sum(axis=1), kind="stable")[: len(empty)]
            centres[empty[: len(far)]] = sample[far]
    return centres


def distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances, less each row's own square (which changes no order)."""
    return (centres**2).sum(axis=1) - 2 * (x @ centres.T)


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.concatenate([distances(x[i : i + 4096], centres).argmin(axis=1) for i in range(0, len(x), 4096)] or [np.zeros(0, int)])


def widths(dims: int) -> list[int]:
    """Column blocks: narrow first, then twice as wide."""
    out, width = [], 8
    while dims > 0:
        out.append(min(width, dims))
        dims -= out[-1]
        width = min(64, width * 2)
    return out


def scan(queries: np.ndarray, vectors: np.ndarray, k: int, skip: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(query, candidate) pairs that hold each query's k nearest by the test; both
    sides are rotated. ``skip`` marks pairs that are no candidates. While most
    pairs are alive a column block is one matrix product, then only the pairs
    left are gathered."""
    dims = vectors.shape[1]
    head = min(len(vectors), 4 * k)

    def exact(q: np.ndarray, v: np.ndarray) -> np.ndarray:
        out = q @ v.T
        out *= -2
        out += (q**2).sum(axis=1)[:, None]
        out += (v**2).sum(axis=1)
        return out

    first = np.where(skip[:, :head], np.inf, exact(queries, vectors[:head]))
    bar = np.partition(first, k - 1, axis=1)[:, k - 1] if head >= k else np.full(len(queries), np.inf)
    slack = 1e-9 * max(1e-30, float((vectors**2).sum(axis=1).max()))
    partial = np.where(skip, np.inf, 0.0)
    done, who, what = 0, None, None
    for width in widths(dims):
        cols = slice(done, done + width)
        done += width
        if who is None:
            partial += exact(queries[:, cols], vectors[:, cols])
        else:
            partial = partial + ((queries[who, cols] - vectors[what, cols]) ** 2).sum(axis=1)
        if done == dims:
            break
        most = bar * (1 + EPSILON / np.sqrt(done)) ** 2 * (done / dims) + slack
        if who is None:
            stays = partial <= most[:, None]
            if stays.mean() < GATHER:
                who, what = np.nonzero(stays)
                partial = partial[who, what]
        else:
            stays = partial <= most[who]
            who, what, partial = who[stays], what[stays], partial[stays]
    # Of the survivors, those not beyond the k-th best.
    if who is None:
        kth = np.partition(partial, min(k, len(vectors)) - 1, axis=1)[:, min(k, len(vectors)) - 1]
        return np.nonzero(np.isfinite(partial) & (partial <= kth[:, None] + slack))
    order = np.lexsort((partial, who))
    who, what, partial = who[order], what[order], partial[order]
    begins = np.searchsorted(who, np.arange(len(queries)))
    ends = np.append(begins[1:], len(who))
    kth = np.full(len(queries), np.inf)
    full = begins + k <= ends
    kth[full] = partial[begins[full] + k - 1]
    stays = partial <= kth[who] + slack
    return who[stays], what[stays]


def search(
    df: DataFrame, is_query: Column, k: int = 20, key: str = "vec_id", vector: str = "embedding", seed: int = 11, recall: float = RECALL
) -> DataFrame:
    """``query_id, rank, vec_id, score``: of the rows found, each query's k
    largest inner products (double precision, on the original vectors)."""
    spark = df.sparkSession
    scratch = Scratch(spark, "ann")
    rows = df.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("vector"), is_query.alias("asks"))
    rows = rows.filter(F.col("id").isNotNull())
    dims = dimensions(rows, "vector")

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok, matrix = usable(batch, "vector", dims)
            some = matrix.any(axis=1)
            ok, matrix = ok[some], matrix[some]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(ok)),
                    batch.column(2).take(pa.array(ok)),
                    pack(matrix.astype("<f8")),
                    pa.array((matrix**2).sum(axis=1)),
                ],
                names=["id", "asks", "vector", "square"],
            )

    vectors = scratch.table(rows.mapInArrow(clean, "id long, asks boolean, vector binary, square double"), "vectors")
    size = vectors.agg(F.count("*").alias("n"), F.max("square").alias("most")).first()
    if not size["n"]:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    most, wide = size["most"], dims + 1

    def draw(column: Column, seed_: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(seed_), column), F.lit(1 << 30)) / F.lit(float(1 << 30))

    wanted = min(SAMPLE, SAMPLE_BYTES // (8 * wide))
    drawn = vectors.filter(draw(F.col("id"), seed) < 1.2 * wanted / size["n"]).select("id", "vector", "square").collect()
    drawn = sorted(drawn, key=lambda r: (r["id"], r["vector"]))[: 2 * wanted] or vectors.select("id", "vector", "square").limit(1).collect()
    turn = rotation(wide, seed)

    def turned(matrix: np.ndarray, asks: bool = False) -> np.ndarray:
        extra = np.zeros(len(matrix)) if asks else np.sqrt(np.maximum(0.0, most - (matrix**2).sum(axis=1)))
        return np.column_stack((matrix, extra)) @ turn

    lists = max(1, min(MAX_LISTS, int(np.sqrt(size["n"]) / 2)))
    sample = np.frombuffer(b"".join(r["vector"] for r in drawn), dtype="<f8").reshape(-1, dims)
    model = spark.sparkContext.broadcast((turn, centroids(turned(sample), lists, seed)))  # at most MAX_LISTS + dims rows

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, centres = model.value
        for batch in batches:
            matrix = unpack(batch.column(1), dims, "<f8")
            yield pa.RecordBatch.from_arrays(
                [pa.array(nearest(turned(matrix), centres).astype(np.int32)), batch.column(0), batch.column(1)], names=["list", "id", "vector"]
            )

    index = scratch.table(vectors.select("id", "vector").mapInArrow(assign, "list int, id long, vector binary"), "index")
    centres = model.value[1]
    held = np.zeros(len(centres), dtype=np.int64)
    for r in index.groupBy("list").count().collect():
        held[r["list"]] = r["count"]

    asked = vectors.filter("asks").dropDuplicates(["id"]).select("id", "vector")
    probes = _probes(index, asked, dims, k, centres, turned, held, recall, scratch, draw)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres_ = model.value[1]
        for batch in batches:
            order = np.argsort(distances(turned(unpack(batch.column(1), dims, "<f8"), True), centres_), axis=1, kind="stable")
            enough = (np.cumsum(held[order], axis=1) <= k).sum(axis=1) + 1
            take = np.minimum(np.maximum(probes, enough), order.shape[1])
            row = np.repeat(np.arange(len(order)), take)
            chosen = order[np.arange(order.shape[1]) < take[:, None]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(chosen.astype(np.int32)), batch.column(0).take(pa.array(row)), batch.column(1).take(pa.array(row))],
                names=["list", "id", "vector"],
            )

    visits = asked.mapInArrow(choose, "list int, id long, vector binary")
    crowd = {r["list"]: r["count"] for r in visits.groupBy("list").count().collect()}
    chunks = F.array(*[F.lit(int(max(1, -(-n // CHUNK)))) for n in held])
    parts = F.array(*[F.lit(int(-(-crowd.get(i, 0) // QUERIES))) for i in range(len(held))])

    def own(seed_: int, of: Column) -> Column:
        return F.pmod(F.xxhash64(F.lit(seed_), "id", "vector"), of).cast("int")

    def each(of: Column) -> Column:
        return F.explode(F.sequence(F.lit(0), of - 1))

    n_chunks, n_parts = chunks[F.col("list")], parts[F.col("list")]
    left = visits.select("list", own(3, n_parts).alias("part"), each(n_chunks).alias("chunk"), "id", "vector")
    right = index.filter(n_parts > 0).select("list", own(4, n_chunks).alias("chunk"), each(n_parts).alias("part"), "id", "vector")

    def meet(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        ids, found = candidates["id"].to_numpy(), []
        if len(queries) and len(candidates):
            vectors_ = unpack(candidates["vector"], dims, "<f8")
            rotated = turned(vectors_)
            asks, query_ids = unpack(queries["vector"], dims, "<f8"), queries["id"].to_numpy()
            step = max(1, PAIRS // len(ids))
            for at in range(0, len(asks), step):
                part, part_ids = asks[at : at + step], query_ids[at : at + step]
                who, what = scan(turned(part, True), rotated, k, part_ids[:, None] == ids)
                score = (part[who] * vectors_[what]).sum(axis=1)
                order = np.lexsort((ids[what], -score, who))
                who, what, score = who[order], what[order], score[order]
                place = np.arange(len(who)) - np.searchsorted(who, who)
                top = place < k
                found.append((part_ids[who[top]], ids[what[top]], score[top]))
        return pa.table(
            {
                "query_id": pa.array(np.concatenate([f[0] for f in found] or [[]]), type=pa.int64()),
                "vec_id": pa.array(np.concatenate([f[1] for f in found] or [[]]), type=pa.int64()),
                "score": pa.array(np.concatenate([f[2] for f in found] or [[]]), type=pa.float64()),
            }
        )

    keys = ["list", "chunk", "part"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(meet, "query_id long, vec_id long, score double")
    return best(found, k)


def _probes(index, asked, dims, k, centres, turned, held, recall, scratch, draw) -> int:
    """The fewest lists that hold ``recall`` of the true neighbours of some sampled queries."""
    n = asked.count()
    picked = asked.filter(draw(F.col("id"), 5) < 1.5 * CALIBRATE / max(1, n)).collect() or asked.limit(CALIBRATE).collect()
    picked = sorted(picked, key=lambda r: r["id"])[: 2 * CALIBRATE]
    if not picked:
        return 1
    asks = np.frombuffer(b"".join(r["vector"] for r in picked), dtype="<f8").reshape(-1, dims)
    names = np.array([r["id"] for r in picked])

    def nearest_of_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = np.zeros((len(names), 0))
        ids = lists = np.zeros((len(names), 0), dtype=np.int64)
        for batch in batches:
            new = np.broadcast_to(batch.column(1).to_numpy(), (len(names), len(batch)))
            where = np.broadcast_to(batch.column(0).to_numpy().astype(np.int64), new.shape)
            value = np.where(new == names[:, None], -np.inf, asks @ unpack(batch.column(2), dims, "<f8").T)
            score, ids, lists = (np.concatenate(x, axis=1) for x in ((score, value), (ids, new), (lists, where)))
            top = np.argsort(-score, axis=1, kind="stable")[:, :k]
            score, ids, lists = (np.take_along_axis(x, top, axis=1) for x in (score, ids, lists))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(names, score.shape[1])),
                pa.array(ids.ravel()),
                pa.array(lists.ravel().astype(np.int32)),
                pa.array(score.ravel()),
            ],
            names=["query_id", "vec_id", "list", "score"],
        )

    found = index.mapInArrow(nearest_of_all, "query_id long, vec_id long, list int, score double").filter("score > -1e300")
    true = best(found.withColumn("vec_id", F.struct("vec_id", "list")), k).select("query_id", "vec_id.list").collect()
    order = np.argsort(distances(turned(asks, True), centres), axis=1, kind="stable")
    place = {int(q): np.argsort(o) for q, o in zip(names, order, strict=True)}
    ranks = np.sort([place[r["query_id"]][r["list"]] for r in true]) if true else np.zeros(1, dtype=int)
    return int(ranks[min(len(ranks) - 1, int(np.ceil(recall * len(ranks))))]) + 1
