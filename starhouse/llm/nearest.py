"""Approximate nearest neighbours by multi-index hashing of learned binary codes.

Codes: a bounded sample of the vectors is turned by several rotations that are learned by iterative
quantisation (each brings its axes nearer to the corners of a cube), and every sign of a turned vector is
a bit. Search: a code is cut into substrings of eight or sixteen bits. Two codes within a Hamming radius r differ by
at most r / substrings bits in one substring at least, so looking up all values so near in every substring's
index finds all codes within r. What is found and within r is ranked by the cosine of its vector.

The radius is learned too: it holds nearly all true neighbours of some sample vectors. Neighbours among a
sample are farther than among all vectors, so it is on the safe side. A query that finds fewer
neighbours than asked for searches again with the largest radius, where every code is found.

Queries go to all tasks in blocks of bounded size; every task indexes its own rows and sends the best
few of each query. Rows are read where they lie, whole vectors are not shuffled. Of rows with equal
vectors a task compares one and sends the smallest ids: a vector that very many rows have costs no more.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starhouse.llm.common import quoted, stored

#: Vectors from which rotations and the radius are learned, and those of them that act as queries.
SAMPLE, SAMPLE_QUERIES = 4096, 256
#: Lengths of vectors that have an index of their own, the most common ones. Vectors of others are compared exactly.
MAX_LENGTHS = 64
#: Bits of a code, at least: as many rotations as are needed.
BITS = 256
TURNS = 25
#: Part of the sample's true neighbours that the radius holds.
HELD = 0.99
#: Queries of a block, and rows that are indexed at once.
QUERY_BLOCK, INDEX_BLOCK = 2048, 8192
_ONES = np.array([bin(x).count("1") for x in range(256)])


def usable(vec_id: str, vector: str) -> Column:
    """Rows that take part: with an id, and a vector without null or non-finite components that is not zero."""
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col(vec_id).isNotNull() & F.col(vector).isNotNull() & F.coalesce(whole, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def _unit(vectors: np.ndarray) -> np.ndarray:
    # Scaling first keeps squares of very large or small components finite and above 0.
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt(np.einsum("ij,ij->i", scaled, scaled))[:, None]


def learn_rotations(unit: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Rotations side by side, as a matrix of dimension x bits, by iterative quantisation of unit vectors."""
    dimension = unit.shape[1]
    out = []
    for k in range(math.ceil(bits / dimension)):
        rng = np.random.Generator(np.random.PCG64([3, k]))
        turn = np.linalg.qr(rng.standard_normal((dimension, dimension)))[0]
        for _ in range(TURNS):
            corners = np.sign(unit @ turn)
            left, _, right = np.linalg.svd(unit.T @ corners)
            turn = left @ right
        out.append(turn)
    turned = np.hstack(out)
    return turned[:, : -(-bits // 8) * 8] if turned.shape[1] >= bits else turned


def codes(unit: np.ndarray, rotations: np.ndarray) -> np.ndarray:
    """A row of bytes for each vector; bits beyond a last byte's are 0."""
    return np.packbits(unit @ rotations > 0, axis=1)


def _distances(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return _ONES[left ^ right].sum(axis=-1)


def learn_radius(unit: np.ndarray, rotations: np.ndarray, k: int) -> int:
    """A Hamming radius that holds HELD of the k nearest neighbours among the sample."""
    queries = unit[:SAMPLE_QUERIES]
    cosines = queries @ unit.T
    cosines[np.arange(len(queries)), np.arange(len(queries))] = -2
    nearest = np.argsort(-cosines, axis=1, kind="stable")[:, : min(k, len(unit) - 1)]
    if not nearest.size:
        return rotations.shape[1]
    code = codes(unit, rotations)
    return int(np.quantile(_distances(code[: len(queries), None, :], code[nearest]), HELD, method="higher"))


def probed_share(bits: int, width: int, radius: int) -> float:
    """Part of unrelated codes that lookups in substrings of so many bits reach."""
    substrings = bits // width
    each = sum(math.comb(width, k) for k in range(min(width, radius // substrings) + 1)) / 2**width
    return 1 - (1 - each) ** substrings


def substring_width(bits: int, radius: int) -> int:
    """8 bits, or 16 if that halves what lookups reach: they look up more values each."""
    return 16 if bits % 16 == 0 and 2 * probed_share(bits, 16, radius) < probed_share(bits, 8, radius) else 8


class SubstringIndex:
    """The rows of a block by the value of each substring of their codes."""

    def __init__(self, code: np.ndarray, width: int = 8) -> None:
        self.code, self.width = code, width
        self.parts = self._cut(code).T
        self.order = [np.argsort(part, kind="stable") for part in self.parts]
        self.values = [part[order] for part, order in zip(self.parts, self.order, strict=True)]

    def _cut(self, code: np.ndarray) -> np.ndarray:
        return np.ascontiguousarray(code).view(f"u{self.width // 8}")

    def probed(self, queries: np.ndarray, radius: int) -> np.ndarray:
        """Whether a lookup of each query (rows) reaches each code: all codes within the radius, and some others.

        Codes within the radius differ in ``radius // substrings`` bits at most in one substring, so all values so near
        are looked up in each.
        """
        flips = radius // len(self.parts)
        found = np.zeros((len(queries), len(self.code)), dtype=bool)
        if flips >= self.width:
            found[:] = True
            return found
        masks = np.flatnonzero(np.bitwise_count(np.arange(1 << self.width)) <= flips).astype(self.parts.dtype)
        for column, order, values in zip(self._cut(queries).T, self.order, self.values, strict=True):
            for value in np.unique(column):
                near = masks ^ value
                first, last = np.searchsorted(values, near), np.searchsorted(values, near, side="right")
                sizes = last - first
                rows = order[np.repeat(first - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())]
                found[np.flatnonzero(column == value)[:, None], rows[None, :]] = True
        return found

    def within(self, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Query and row of all pairs of codes that differ in ``radius`` bits at most."""
        query, row = np.nonzero(self.probed(queries, radius))
        near = np.zeros(len(query), dtype=bool)
        for start in range(0, len(query), 1 << 16):
            part = slice(start, start + (1 << 16))
            near[part] = _distances(queries[query[part]], self.code[row[part]]) <= radius
        return query[near], row[near]


def cosines(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Of rows in pairs, in double precision. Every pair is summed alike, wherever it stands."""
    return np.einsum("ij,ij->i", _unit(left), _unit(right))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _search(rows: DataFrame, block, rotations: np.ndarray, radius: int, k: int) -> DataFrame:
    """query_id, vec_id and score: of each query the best k of each block of rows that a task has read."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, queries = block.value
        width = substring_width(rotations.shape[1], radius)
        asked = codes(_unit(queries), rotations)
        for whole in batches:
            for start in range(0, whole.num_rows, INDEX_BLOCK):
                batch = whole.slice(start, INDEX_BLOCK)
                ids, vectors = batch.column(0).to_numpy(zero_copy_only=False), _matrix(batch.column(1))
                # Equal vectors are compared once. k + 1 of their ids are enough, as one may be the query's own.
                order = np.argsort(ids, kind="stable")
                ids, vectors = ids[order], vectors[order]
                _, first, group, count = np.unique(vectors, axis=0, return_index=True, return_inverse=True, return_counts=True)
                group = group.ravel()
                by_group = np.argsort(group, kind="stable")
                begin = np.concatenate([[0], np.cumsum(count)])
                index = SubstringIndex(codes(_unit(vectors[first]), rotations), width)
                for at in range(0, len(asked), 256):
                    query, row = index.within(asked[at : at + 256], radius)
                    yield _best(query_ids, queries, query + at, row, vectors[first], ids, by_group, begin, k)

    return rows.mapInArrow(find, "query_id long, vec_id long, score double")


def _best(query_ids, queries, query, row, vectors, ids, by_group, begin, k) -> pa.RecordBatch:
    out: list[tuple[np.ndarray, ...]] = []
    for start in range(0, len(query), 1 << 15):
        part = slice(start, start + (1 << 15))
        q, r = query[part], row[part]
        score = cosines(queries[q], vectors[r])
        members = np.minimum(begin[r + 1] - begin[r], k + 1)
        pair = np.repeat(np.arange(len(q)), members)
        place = np.arange(len(pair)) - np.repeat(np.cumsum(members) - members, members)
        vec = ids[by_group[begin[r[pair]] + place]]
        other = vec != query_ids[q[pair]]
        out.append((q[pair][other], vec[other], score[pair][other]))
    if out:
        q, vec, score = (np.concatenate(x) for x in zip(*out, strict=True))
        order = np.lexsort((vec, -score, q))
        q, vec, score = q[order], vec[order], score[order]
        # A row that is repeated counts once.
        new = np.ones(len(q), dtype=bool)
        new[1:] = (q[1:] != q[:-1]) | (vec[1:] != vec[:-1])
        q, vec, score = q[new], vec[new], score[new]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        q, vec, score = q[rank < k], vec[rank < k], score[rank < k]
    else:
        q, vec, score = np.zeros(0, dtype=int), np.zeros(0, dtype=np.int64), np.zeros(0)
    return pa.RecordBatch.from_arrays(
        [pa.array(query_ids[q], pa.int64()), pa.array(vec, pa.int64()), pa.array(score, pa.float64())], names=["query_id", "vec_id", "score"])


def _blocks(spark, queries: DataFrame) -> Iterator:
    """Broadcasts of QUERY_BLOCK queries or fewer: ids and vectors."""
    n = max(1, math.ceil(queries.count() / QUERY_BLOCK * 1.25))
    for k in range(n):
        part = queries.filter(F.pmod(F.xxhash64("vec_id"), F.lit(n)) == k).toPandas()
        if len(part):
            yield spark.sparkContext.broadcast((part["vec_id"].to_numpy(), np.array(part["vector"].tolist(), dtype=np.float64)))


def _top(found: DataFrame, k: int) -> DataFrame:
    """The k best rows of each query. An id that comes with several vectors counts once, with the best."""
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return once.withColumn("rank", place).filter(F.col("rank") <= k)


def _exact(rows: DataFrame, k: int) -> DataFrame:
    """The k nearest rows of queries by comparing all of a length, in tiles of INDEX_BLOCK candidates and QUERY_BLOCK queries."""
    rows = stored(rows.withColumn("length", F.size("vector")), "uncommon")
    queries = rows.filter("__query").groupBy("vec_id", "length").agg(F.min("vector").alias("vector"))
    one = queries.groupBy("vec_id").agg(F.min(F.struct("vector", "length")).alias("q")).select("vec_id", "q.*")
    sizes = stored(rows.groupBy("length").agg(
        F.ceil(F.count("*") / INDEX_BLOCK).cast("int").alias("blocks"), F.ceil(F.count_if("__query") / QUERY_BLOCK).cast("int").alias("turns")
    ).filter("turns > 0"), "sizes")

    def dealt(df: DataFrame, own: str, other: str) -> DataFrame:
        mine = F.pmod(F.xxhash64("vec_id"), F.col(own)).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.col(other) - 1))
        return df.join(sizes, "length").select("length", mine.alias(own), every.alias(other), "vec_id", "vector")

    def compare(candidates: pa.Table, asked: pa.Table) -> pa.Table:
        out = []
        if candidates.num_rows and asked.num_rows:
            candidates, asked = (x.combine_chunks() for x in (candidates, asked))
            ids, vectors = candidates["vec_id"].to_numpy(), _matrix(candidates["vector"].chunk(0))
            for query, vector in zip(asked["vec_id"].to_pylist(), _matrix(asked["vector"].chunk(0)), strict=True):
                score = cosines(np.broadcast_to(vector, vectors.shape), vectors)
                order = np.lexsort((ids, -score))
                order = order[ids[order] != query]
                order = order[np.sort(np.unique(ids[order], return_index=True)[1])][:k]
                out.append((np.full(len(order), query), ids[order], score[order]))
        columns = [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.zeros(0, dtype=np.int64)] * 2 + [np.zeros(0)]
        return pa.table({n: pa.array(x, t) for n, x, t in zip(("query_id", "vec_id", "score"), columns, (pa.int64(), pa.int64(), pa.float64()), strict=True)})

    keys = ["length", "blocks", "turns"]
    left = dealt(rows.select("length", "vec_id", "vector"), "blocks", "turns")
    right = dealt(one, "turns", "blocks")
    left = left.select(*[F.col(x).alias(x) for x in left.columns])
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(compare, "query_id long, vec_id long, score double")
    return _top(found, k).select("query_id", "vec_id", "score", "rank")


def nearest(table: DataFrame, is_query: Column, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id and score: the k nearest rows that each query's search finds, by cosine.

    ``is_query`` marks queries; candidates are all rows but those of the query's id. Ties go to the smaller vec_id.
    Ids are whole numbers. A row without id, or whose vector is null, empty or zero or has null or non-finite
    components, takes no part. Vectors of different lengths are never compared; those of lengths beyond the MAX_LENGTHS
    most common are compared without an index. Repeated rows count once; of
    several vectors of one id, the smallest is the query and the nearest the candidate. An empty table gives no rows.
    """
    spark = table.sparkSession
    rows = table.withColumn("__query", F.coalesce(is_query, F.lit(False))).select(
        quoted(vec_id).cast("long").alias("vec_id"), quoted(vector).cast("array<double>").alias("vector"), "__query"
    ).filter(usable("vec_id", "vector"))
    counts = rows.groupBy(F.size("vector").alias("length")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "length").limit(MAX_LENGTHS + 1).collect()
    common = {row["length"]: row["n"] for row in counts[:MAX_LENGTHS]}
    parts = []
    if len(counts) > MAX_LENGTHS:
        parts.append(_exact(rows.filter(~F.size("vector").isin(list(common))), k))
    for length, n in common.items():
        alike = rows.filter(F.size("vector") == length)
        # About as many as are wanted pass the hash, before any are sorted.
        few = alike.filter(F.pmod(F.xxhash64("vec_id"), F.lit(n)) < 2 * SAMPLE)
        sample = few.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("vector").toPandas()["vector"]
        unit = _unit(np.array(sample.tolist(), dtype=np.float64))
        rotations = learn_rotations(unit)
        radius = learn_radius(unit, rotations, k)
        queries = stored(alike.filter("__query").groupBy("vec_id").agg(F.min("vector").alias("vector")), "queries")
        candidates = alike.select("vec_id", "vector")
        found = [_search(candidates, block, rotations, radius, k) for block in _blocks(spark, queries)]
        if found:
            best = stored(_top(_union(found), k), "found")
            full = best.groupBy("query_id").count().filter(F.col("count") >= k)
            short = stored(queries.join(full, queries.vec_id == full.query_id, "left_anti"), "short")
            again = [_search(candidates, block, rotations, rotations.shape[1], k) for block in _blocks(spark, short)]
            parts.append(best.join(short, best.query_id == short.vec_id, "left_anti"))
            if again:
                parts.append(_top(_union(again), k))
    if not parts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return _union(parts).select("query_id", "rank", "vec_id", "score")


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out
