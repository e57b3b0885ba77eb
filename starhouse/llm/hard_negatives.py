"""Hard-negative mining over Hilbert-ordered blocks with zone maps.

1. Vectors are sorted along a Hilbert curve through the main directions of a bounded sample and written as Parquet
   rows of BLOCK vectors each, with the least and largest value of every dimension: the block's zone map.
2. Interval arithmetic on a zone map bounds the scores that an anchor can have in a block. A search asks, for each of
   an anchor's windows of scores, for the best k rows; a block is read by an anchor whose bounds meet a window above
   the k-th best score found so far.
3. A search begins in the anchor's own block and goes on in waves of blocks, the most promising first, each wave some
   times larger than the one before. After a wave the limits rise, and fewer rows and blocks are left to look at.
   What is never read cannot hold a result, so results are exact whatever the sample.
4. Positives are one search with an open window. Each positive's score gives a window for its negatives: a second
   search, in the same blocks.

The anchors of a block travel together. Blocks meet them in tiles of at most TILE groups of anchors, so that a block
which all anchors want is shared out among tasks. A tile sends k rows for each window at most, better than the limit.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starhouse.llm.common import quoted, stored

#: Vectors of a block.
BLOCK = 1024
#: Vectors from which the directions of the curve are learned.
SAMPLE = 4096
#: Directions and bits of each: a place on the curve has at most 56 bits.
DIRECTIONS, BITS = 8, 7
#: Groups of anchors that one task lets meet a block, and zone maps that it looks at at once.
TILE, PACK = 1024, 1024
#: Each wave reads up to so many times as many blocks as all before.
GROWTH = 8
SCALE = 256
_LARGEST = float(1 << 53)
_ENDS = (-(1 << 63) + 1, (1 << 63) - 1)


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of cells: rows of whole numbers below 2 ** bits. Neighbours in place touch in space."""
    n = cells.shape[1]
    axes = [cells[:, k].astype(np.uint64) for k in range(n)]
    zero = np.uint64(0)
    for level in range(bits - 1, 0, -1):
        q, low = np.uint64(1 << level), np.uint64((1 << level) - 1)
        for k in range(n):
            turned = (axes[k] & q) != 0
            swapped = np.where(turned, zero, (axes[0] ^ axes[k]) & low)
            axes[0] = np.where(turned, axes[0] ^ low, axes[0] ^ swapped)
            axes[k] = axes[k] ^ swapped if k else axes[0]
    for k in range(1, n):
        axes[k] = axes[k] ^ axes[k - 1]
    flip = np.zeros(len(cells), dtype=np.uint64)
    for level in range(bits - 1, 0, -1):
        flip = np.where((axes[n - 1] & np.uint64(1 << level)) != 0, flip ^ np.uint64((1 << level) - 1), flip)
    out = np.zeros(len(cells), dtype=np.uint64)
    for level in range(bits - 1, -1, -1):
        for axis in axes:
            out = out << np.uint64(1) | ((axis ^ flip) >> np.uint64(level) & np.uint64(1))
    return out


class Curve:
    """Places of vectors on a curve through the main directions of sample vectors of their length."""

    def __init__(self, sample: list[list[float]]) -> None:
        self.of: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for length in {len(x) for x in sample} - {0}:
            alike = np.array([x for x in sample if len(x) == length])
            alike = alike / max(np.abs(alike).max(), 1.0)  # keeps squares finite
            turn = np.linalg.svd(alike - alike.mean(axis=0), full_matrices=False)[2][:DIRECTIONS].T
            spots = alike @ turn
            self.of[length] = turn / max(np.abs([x for x in sample if len(x) == length]).max(), 1.0), spots.min(axis=0), spots.max(axis=0)

    def places(self, vectors: np.ndarray) -> np.ndarray:
        """Of a length that the sample lacks, the first dimensions are the directions."""
        length = vectors.shape[1]
        if not length:
            return np.zeros(len(vectors), dtype=np.int64)
        if length in self.of:
            turn, low, high = self.of[length]
            part = (vectors @ turn - low) / np.where(high > low, high - low, 1.0)
        else:
            part = np.arctan(vectors[:, :DIRECTIONS]) / math.pi + 0.5
        cells = np.clip(np.nan_to_num(part) * (1 << BITS), 0, (1 << BITS) - 1).astype(np.int64)
        return hilbert(cells, BITS).astype(np.int64)


def usable(vec_id: str = "vec_id", label: str = "label", vector: str = "vector") -> Column:
    """Rows that take part: with id, label and vector, and all components finite, also SCALE times as large."""
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) * SCALE < float("inf")))
    return F.col(vec_id).isNotNull() & F.col(label).isNotNull() & F.col(vector).isNotNull() & F.coalesce(whole, F.lit(False))


def _lists(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of a column of lists by their length: numbers of the rows, and their values as a matrix."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    begin = np.cumsum(sizes) - sizes
    for size in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == size)
        yield rows, flat[begin[rows][:, None] + np.arange(size)]


def _packed(matrix: np.ndarray) -> bytes:
    """A letter for the type, and the values."""
    narrow = not matrix.size or np.abs(matrix).max() < 1 << 31
    return (b"i" + matrix.astype("<i4").tobytes()) if narrow else (b"d" + matrix.astype("<f8").tobytes())


def _unpacked(raw: bytes, rows: int) -> np.ndarray:
    flat = np.frombuffer(raw, dtype="<i4" if raw[:1] == b"i" else "<f8", offset=1)
    return flat.reshape(rows, -1).astype(np.float64)


BLOCKS = """block long, length int, ids array<long>, labels array<string>, vectors binary, low array<double>, high array<double>,
    anchors array<int>"""


def blocks(table: DataFrame, is_anchor: Column, vec_id: str, label: str, vector: str, size: int = BLOCK) -> DataFrame:
    """Written blocks of the vectors that take part: ids, labels, vectors (times SCALE, rounded down), zone map, anchors' numbers."""
    marked = table.select(
        quoted(vec_id).cast("long").alias("vec_id"), quoted(label).cast("string").alias("label"),
        quoted(vector).cast("array<double>").alias("vector"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"))
    rows = marked.filter(usable()).withColumn("length", F.size("vector"))
    n = max(rows.count(), 1)
    spread = F.xxhash64("vec_id")
    few = rows.filter(F.pmod(spread, F.lit(n)) < 2 * SAMPLE)  # about as many as are wanted, before any are sorted
    sample = few.orderBy(spread, "vec_id").limit(SAMPLE).select("vector").toPandas()["vector"]
    curve = Curve([list(x) for x in sample])

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = np.zeros(batch.num_rows, dtype=np.int64)
            for at, matrix in _lists(batch.column(2)):
                place[at] = curve.places(matrix)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place)], names=[*batch.schema.names, "place"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        held: list[tuple] = []

        def block() -> pa.RecordBatch:
            nonlocal held, made
            ids, labels, vectors, anchors = zip(*held, strict=True)
            matrix = np.floor(np.array(vectors, dtype=np.float64).reshape(len(held), -1) * SCALE)
            row = {
                "block": (part << 32) + made, "length": matrix.shape[1], "ids": ids, "labels": labels, "vectors": _packed(matrix),
                "low": matrix.min(axis=0).tolist(), "high": matrix.max(axis=0).tolist(), "anchors": np.flatnonzero(anchors).tolist()}
            held, made = [], made + 1
            return pa.RecordBatch.from_pylist([row], schema=_KIND)

        for batch in batches:
            for row in zip(*[x.to_pylist() for x in batch.columns[:4]], strict=True):
                if held and (len(held) == size or len(held[0][2]) != len(row[2])):
                    yield block()
                held.append(row)
        if held:
            yield block()

    schema = "vec_id long, label string, vector array<double>, anchor boolean, length int, place long"
    ordered = rows.mapInArrow(placed, schema).repartitionByRange("length", "place", "vec_id").sortWithinPartitions("length", "place", "vec_id")
    return stored(ordered.mapInArrow(cut, BLOCKS), "blocks")


_KIND = pa.schema([
    ("block", pa.int64()), ("length", pa.int32()), ("ids", pa.list_(pa.int64())), ("labels", pa.list_(pa.string())), ("vectors", pa.binary()),
    ("low", pa.list_(pa.float64())), ("high", pa.list_(pa.float64())), ("anchors", pa.list_(pa.int32()))])


def bounds(vectors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest inner product of each vector (rows) with any vector between low and high (rows), by interval arithmetic."""
    up, down = np.maximum(vectors, 0), np.minimum(vectors, 0)
    least, most = up @ low.T + down @ high.T, up @ high.T + down @ low.T
    # Whole numbers that doubles hold need no margin; larger ones get what rounding may cost.
    size = np.abs(vectors) @ np.maximum(np.abs(low), np.abs(high)).T
    margin = np.where(size < _LARGEST, 0.0, size * 1e-12)
    return least - margin, most + margin


def scores(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of whole numbers; beyond 64 bits the largest or smallest number."""
    largest = [np.abs(x).max() if x.size else 0.0 for x in (left, right)]
    if largest[0] * largest[1] * max(left.shape[1], 1) < _LARGEST:
        return (left @ right.T).astype(np.int64)
    exact = np.array([[int(x) for x in row] for row in left], dtype=object) @ np.array([[int(x) for x in row] for row in right], dtype=object).T
    return np.clip(exact, *_ENDS).astype(np.int64)


class _Group:
    """The anchors of a block with their windows: from (the limit so far, above the window's lower end) and to."""

    def __init__(self, row: dict) -> None:
        self.group, self.numbers, self.labels, n = row["group"], np.array(row["numbers"], dtype=np.int64), np.array(row["labels"], dtype=object), len(row["numbers"])
        self.vectors = _unpacked(row["vectors"], n)
        self.start, self.end = (np.array(row[x], dtype=np.int64).reshape(n, -1) for x in ("start", "end"))

    def wanted(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """How far the bounds of each zone map (columns) reach above the start of a window that they meet; below 0: not at all."""
        least, most = bounds(self.vectors, low, high)
        meets = (most[:, None, :] >= self.start[:, :, None]) & (least[:, None, :] <= self.end[:, :, None]) & (self.start <= self.end)[:, :, None]
        return np.where(meets, most[:, None, :] - self.start[:, :, None].astype(np.float64), -1.0).max(axis=1)


def _choose(groups: DataFrame, zones: DataFrame) -> DataFrame:
    """group, block and place (from 1, the most promising first) of blocks, other than a group's own, that some of its anchors must read."""
    n_packs, n_parts = (max(1, math.ceil(x.count() / size)) for x, size in ((zones, PACK), (groups, TILE)))
    part = F.pmod(F.xxhash64("group"), F.lit(n_parts))
    asked = groups.withColumn("pack", F.explode(F.sequence(F.lit(0), F.lit(n_packs - 1)))).withColumn("part", part.cast("int"))
    held = zones.withColumn("pack", F.pmod(F.xxhash64("block"), F.lit(n_packs)).cast("int")).withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.lit(n_parts - 1))))

    def choose(maps: pa.Table, anchors: pa.Table) -> pa.Table:
        out = []
        maps = maps.combine_chunks()
        if maps.num_rows:
            names = maps["block"].to_numpy()
            lows = {m.shape[1]: (rows, m) for rows, m in _lists(maps["low"].chunk(0))}
            highs = {m.shape[1]: m for _, m in _lists(maps["high"].chunk(0))}
            for row in anchors.to_pylist():
                group = _Group(row)
                if group.vectors.shape[1] in lows:
                    rows, low = lows[group.vectors.shape[1]]
                    need = group.wanted(low, highs[group.vectors.shape[1]]).max(axis=0)
                    kept = (need >= 0) & (names[rows] != group.group)
                    out.append((np.full(kept.sum(), group.group), names[rows][kept], need[kept]))
        columns = [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.zeros(0, dtype=np.int64)] * 2 + [np.zeros(0)]
        return pa.table({"group": columns[0], "block": columns[1], "need": columns[2]})

    found = held.select("pack", "part", "block", "low", "high").groupBy("pack", "part").cogroup(asked.groupBy("pack", "part")).applyInArrow(
        choose, "group long, block long, need double")
    place = F.row_number().over(Window.partitionBy("group").orderBy(F.desc("need"), "block"))
    return found.select("group", "block", place.alias("place"))


FOUND = "group long, number int, window int, score long, vec_id long"


def _read(pairs: DataFrame, groups: DataFrame, held: DataFrame, k: int, same: bool, n_parts: int) -> DataFrame:
    """The best k rows of each block for each window of the groups that read it, of the anchor's label or of others."""
    parts = pairs.select("block", "group", F.pmod(F.xxhash64("group"), F.lit(n_parts)).cast("int").alias("part"))
    left = held.select("block", "ids", F.col("labels").alias("names"), F.col("vectors").alias("matrix"), "low", "high").join(
        parts.select("block", "part").distinct(), "block")
    left = left.select(*[F.col(x).alias(x) for x in left.columns])  # columns of its own, as both sides come from the pairs
    right = parts.join(groups, "group")

    def read(block: pa.Table, anchors: pa.Table) -> pa.Table:
        out = []
        for row in block.to_pylist():
            ids, names = np.array(row["ids"], dtype=np.int64), np.array(row["names"], dtype=object)
            matrix = _unpacked(row["matrix"], len(ids))
            low, high = np.array([row["low"]]), np.array([row["high"]])
            for one in anchors.to_pylist():
                group = _Group(one)
                if group.vectors.shape[1] != matrix.shape[1]:
                    continue
                reads = np.flatnonzero(group.wanted(low, high)[:, 0] >= 0)
                for at, score in zip(reads.tolist(), scores(group.vectors[reads], matrix), strict=True):
                    fits = (names == group.labels[at]) == same
                    if group.group == row["block"]:
                        fits[group.numbers[at]] = False  # the anchor itself
                    for window, (start, end) in enumerate(zip(group.start[at].tolist(), group.end[at].tolist(), strict=True)):
                        rows = np.flatnonzero(fits & (score >= start) & (score <= end))
                        best = rows[np.lexsort((ids[rows], -score[rows]))[:k]]
                        out.append((
                            np.full(len(best), group.group), np.full(len(best), group.numbers[at]), np.full(len(best), window),
                            score[best], ids[best]))
        columns = [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.zeros(0, dtype=np.int64)] * 5
        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
        return pa.table({n: pa.array(x, kind) for n, x, kind in zip(("group", "number", "window", "score", "vec_id"), columns, kinds, strict=True)})

    return left.groupBy("block", "part").cogroup(right.groupBy("block", "part")).applyInArrow(read, FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("group", "number", "window").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _limited(groups: DataFrame, best: DataFrame, k: int) -> DataFrame:
    """Groups whose windows start at the k-th best score found, where there are so many."""
    full = best.filter(F.col("rank") == k).groupBy("group").agg(F.map_from_entries(F.collect_list(F.struct(
        F.concat_ws(" ", "number", "window"), "score"))).alias("limits"))
    joined = groups.join(full, "group", "left")
    limit = F.expr("""
        transform(start, (x, i) -> coalesce(limits[concat_ws(' ', element_at(numbers, cast(floor(i * size(numbers) / size(start)) as int) + 1),
            pmod(i, cast(size(start) / size(numbers) as int)))], x))""")
    return joined.withColumn("start", F.when(F.col("limits").isNull(), F.col("start")).otherwise(limit)).drop("limits")


def search(groups: DataFrame, held: DataFrame, k: int, same: bool) -> DataFrame:
    """group, number (the anchor), window, score, vec_id and rank: for each window the best k rows of the anchor's label, or
    of other labels, whose scores lie in it. ``groups`` has the anchors of each block with the start and end of their windows."""
    groups = stored(groups, "groups")
    n_parts = max(1, math.ceil(groups.count() / TILE))
    own = groups.select("group", F.col("group").alias("block"))
    best = stored(_best(_read(own, groups, held, k, same, n_parts), k), "best")
    pairs = stored(_choose(_limited(groups, best, k), held.select("block", "low", "high")), "pairs")
    last = pairs.agg(F.max("place")).first()[0] or 0
    done = 0
    while done < last:
        upto = GROWTH * (done + 1)
        wave = pairs.filter((F.col("place") > done) & (F.col("place") <= upto))
        # Written, as each wave needs the limits of the one before more than once.
        now = stored(_limited(groups, best, k), "limits")
        found = _read(wave, now, held, k, same, n_parts)
        best = stored(_best(best.drop("rank").unionByName(found), k), "best")
        done = upto
    return best


def _groups(held: DataFrame) -> DataFrame:
    """The anchors of each block: group (the block), numbers, labels, names (ids) and vectors."""
    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                at = row["anchors"]
                matrix = _unpacked(row["vectors"], len(row["ids"]))[at]
                yield pa.RecordBatch.from_arrays([
                    pa.array([row["block"]]), pa.array([at], pa.list_(pa.int32())), pa.array([[row["labels"][k] for k in at]], pa.list_(pa.string())),
                    pa.array([[row["ids"][k] for k in at]], pa.list_(pa.int64())), pa.array([_packed(matrix)], pa.binary())],
                    names=["group", "numbers", "labels", "names", "vectors"])

    schema = "group long, numbers array<int>, labels array<string>, names array<long>, vectors binary"
    return held.filter(F.size("anchors") > 0).select("block", "ids", "labels", "vectors", "anchors").mapInArrow(pick, schema)


def mine(table: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, least: int = 50, most: int = 95,
         vec_id: str = "vec_id", label: str = "label", vector: str = "embedding", block: int = BLOCK) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score and negative_score.

    A score is the inner product of two rows' components, each times SCALE and rounded down. An anchor's positives are
    the ``positives`` other rows of its label with the highest scores; for each, the negatives are the first ``negatives``
    rows of other labels with ``least`` to ``most`` percent of the positive's score. Ties go to the smaller vec_id.

    Rows without id, label or vector, or with a null or non-finite component (also after scaling), take no part. Rows of
    one id are rows of their own: all may be positives, negatives and anchors, and repeated anchors have repeated results.
    Vectors of different lengths are never compared; empty ones score 0. Scores beyond 64 bits count as the largest
    64-bit number. Labels are compared as text. Further columns play no part, whatever their names. An empty table
    gives no rows.
    """
    held = blocks(table, is_anchor, vec_id, label, vector, block)
    anchors = stored(_groups(held), "anchors")

    def everywhere(x: int) -> Column:
        return F.transform("numbers", lambda _: F.lit(x).cast("long"))

    nearest = search(anchors.withColumns({"start": everywhere(_ENDS[0]), "end": everywhere(_ENDS[1])}), held, positives, same=True)
    # A positive's rank is the number of its window. Windows that an anchor lacks are empty: they start above their end.
    scaled = {x: F.col("score").cast("decimal(20,0)") * y for x, y in (("start", least), ("end", most))}
    start, end = F.ceil(scaled["start"] / 100).cast("long"), F.floor(scaled["end"] / 100).cast("long")
    by_anchor = nearest.groupBy("group").agg(F.map_from_entries(F.collect_list(F.struct(
        F.concat_ws(" ", "number", "rank"), F.struct(start.alias("start"), end.alias("end"))))).alias("windows"))

    def windows(end_of: str, missing: int) -> Column:
        return F.expr(f"""flatten(transform(numbers, n -> transform(sequence(1, {positives}), r ->
            coalesce(windows[concat_ws(' ', n, r)].{end_of}, {missing}L))))""")

    asked = anchors.join(by_anchor, "group").withColumns({"start": windows("start", 1), "end": windows("end", 0)}).drop("windows")
    hard = search(asked, held, negatives, same=False)
    ids = anchors.select("group", F.explode(F.arrays_zip("numbers", "names")).alias("a")).select(
        "group", F.col("a.numbers").alias("number"), F.col("a.names").alias("anchor_id"))
    first = nearest.select("group", "number", (F.col("rank") - 1).alias("window"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    second = hard.select("group", "number", "window", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return second.join(first, ["group", "number", "window"]).join(ids, ["group", "number"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


#: The query of the contract in DuckDB SQL.
ORACLE = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, v.vec_id, a.label = v.label AS same, CAST(list_dot_product(a.e, v.e) AS BIGINT) AS score
  FROM v a JOIN v ON a.vec_id % 50 = 0 AND a.vec_id <> v.vec_id AND len(a.e) = len(v.e)),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 3
"""
