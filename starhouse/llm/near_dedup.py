"""Near-duplicate documents: SuperMinHash signatures, banding, exact verification, union-find.

1. A task hashes the five-word shingles of its documents and makes each set's SuperMinHash signature:
   every shingle walks a random permutation of the signature's places, and brings to its k-th place a value
   between k and k + 1. Once all places of a set hold a value below k + 1, no later step can change one:
   large sets stop after a step or two. Equal places estimate the Jaccard similarity with less variance
   than independent minima.
2. Documents of equal sets form a class by a digest of the set; the smallest id stands for it from here on.
3. Bands of the signature: a class hangs on the smallest class with the same band. The connected
   components of these links are clusters; similar sets are in one cluster with a probability of
   1 - (1 - 0.85^8)^32 > 0.9999 at the threshold, more above it.
4. Within a cluster all sets are compared in whole with that of its smallest id, and those that are not linked with it
   with all others. A cluster that outgrows a task is cut into blocks by a hash, and each pair of blocks is a task's
   work. Tasks give back a spanning set of links.
5. Components of the links, by the smallest id.

Shingles are compared by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starhouse.llm.common import per_group, quoted, slices, stored
from starhouse.llm.components import components
from starhouse.llm.hashing import FACTORS, mixed, word_hashes

SHINGLE = 5
BANDS, ROWS = 32, 8
PLACES = BANDS * ROWS
#: Percent of the union that the intersection of two linked sets has at least.
PERCENT = 85
#: Shingles of a block, at most and at least; what one task compares is two blocks. A cluster of more than the least
#: has up to PARTS blocks before they grow.
BLOCK, LEAST_BLOCK, PARTS = 200_000, 32_000, 16
SMALL = 200
#: Shingles whose permutations are walked at once.
_WALKED = 50_000
#: Characters that are hashed at once; a longer text is hashed alone.
_HASHED = 1 << 20
_COLUMNS = 4096

_GOLDEN = 0x9E3779B97F4A7C15


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """Sorted hashes of the distinct shingles of each text."""
    out: list[np.ndarray] = []
    part: list[bytes] = []
    held = 0
    for text in texts:
        raw = text.encode().lower() if text else b""
        if part and held + len(raw) > _HASHED:
            out += _sets(part)
            part, held = [], 0
        part.append(raw)
        held += len(raw)
    return out + _sets(part) if part else out


def _sets(raw: list[bytes]) -> list[np.ndarray]:
    hashes, starts = word_hashes(b"\n".join(raw))
    ends = np.cumsum([len(x) + 1 for x in raw])
    bounds = np.searchsorted(starts, ends).tolist()
    sums = np.zeros(max(0, len(hashes) - SHINGLE + 1), dtype=np.uint64)
    for k in range(SHINGLE):
        sums += hashes[k : k + len(sums)] * FACTORS[k]
    sums = mixed(sums + FACTORS[SHINGLE] * np.uint64(SHINGLE))
    out, first = [], 0
    for last in bounds:
        n = last - first
        if n >= SHINGLE:
            out.append(np.unique(sums[first : last - SHINGLE + 1]))
        elif n:
            whole = (hashes[first:last] * FACTORS[:n]).sum(dtype=np.uint64, keepdims=True)
            out.append(mixed(whole + FACTORS[SHINGLE] * np.uint64(n)))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
        first = last
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """SuperMinHash signatures, a row per set: step and fraction of a value as the halves of a number."""
    out = np.full((len(sets), PLACES), np.iinfo(np.uint64).max, dtype=np.uint64)
    first, held = 0, 0
    for k, each in enumerate(sets):
        if held and held + len(each) > _WALKED:
            _walk(sets[first:k], out[first:k])
            first, held = k, 0
        held += len(each)
    if held:
        _walk(sets[first:], out[first:])
    return out


def _walk(sets: list[np.ndarray], out: np.ndarray) -> None:
    # A large set goes in parts: a place's least value over parts is that over the whole.
    if len(sets) == 1 and len(sets[0]) > _WALKED:
        for start in range(0, len(sets[0]), _WALKED):
            part = np.full_like(out, np.iinfo(np.uint64).max)
            _walk([sets[0][start : start + _WALKED]], part)
            np.minimum(out, part, out=out)
        return
    elements = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    rows = np.arange(len(elements))
    order: np.ndarray | None = None
    flat = out.reshape(-1)
    for step in range(PLACES):
        draw = mixed(elements + np.uint64((step + 1) * _GOLDEN % (1 << 64)))
        to = step + (((draw >> np.uint64(32)) * np.uint64(PLACES - step)) >> np.uint64(32)).astype(np.int64)
        value = (draw & np.uint64(0xFFFFFFFF)) | np.uint64(step << 32)
        if order is None and step == 0:
            place = to
        else:
            if order is None:
                # Only sets that are not done after the first step need their elements' permutations.
                order = np.tile(np.arange(PLACES, dtype=np.uint8), (len(elements), 1))
                order[rows, first_to] = 0
            place = order[rows, to].astype(np.int64)
            order[rows, to] = order[rows, step]
        np.minimum.at(flat, owner * PLACES + place, value)
        open_sets = (out == np.iinfo(np.uint64).max).any(axis=1)
        still = open_sets[owner]
        if not still.any():
            return
        if step == 0:
            first_to = to[still]
            elements, owner = elements[still], owner[still]
            rows = np.arange(len(elements))
        elif still.sum() < 0.8 * len(still):
            elements, owner, order = elements[still], owner[still], order[still]
            rows = np.arange(len(elements))


def rows_of_band(percent: int) -> int:
    """Places of a band: 8 find sets of 85 percent and more with p > 0.9999; for 80 percent it takes 7 (p > 0.9997), and so on."""
    return next((rows for rows in range(ROWS, 1, -1) if (1 - (percent / 100) ** rows) ** (PLACES // rows) < 4e-4), 1)


def band_hashes(signature: np.ndarray, rows: int = ROWS) -> np.ndarray:
    n = PLACES // rows
    bands = signature[:, : n * rows].reshape(len(signature), n, rows)
    sums = np.zeros(bands.shape[:2], dtype=np.uint64)
    for k in range(rows):
        sums += mixed(bands[:, :, k] + np.uint64(k)) * FACTORS[SHINGLE + 1 + k]
    return mixed(sums + np.arange(n, dtype=np.uint64))


def _sign(rows: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = shingle_sets(batch.column(1).to_pylist())
            bands = band_hashes(signatures(sets), rows).view(np.int64)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([len(x) for x in sets], pa.int64()),
                pa.array([hashlib.blake2b(x.tobytes(), digest_size=16).digest() for x in sets], pa.binary()),
                pa.array([x if len(s) else None for x, s in zip(bands, sets, strict=True)], pa.list_(pa.int64())),
            ], names=["doc_id", "n_shingles", "digest", "bands"])

    return sign


def _labels(linked: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The smallest id that each row of a symmetric link matrix reaches."""
    labels = ids.copy()
    while True:
        least = np.where(linked, labels[None, :], labels.max(initial=0)).min(axis=1, initial=np.iinfo(np.int64).max)
        least = np.minimum(labels, least)
        if (least == labels).all():
            return labels
        labels = least


def _links(ids: np.ndarray, side: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that connect what is similar: within one block (all sides equal), or between two.

    Shingles that only one set has are left out of the products; they count in the sizes.
    """
    sizes = np.array([len(x) for x in sets], dtype=np.int64)
    elements = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, place, count = np.unique(elements, return_inverse=True, return_counts=True)
    shared = count > 1
    column = np.cumsum(shared) - 1
    inside = shared[place]
    owner, place = owner[inside], column[place[inside]]
    common = np.zeros((len(sets), len(sets)), dtype=np.float32)
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    width = int(place[-1]) + 1 if place.size else 0
    for start in range(0, width, _COLUMNS):
        low, high = np.searchsorted(place, [start, start + _COLUMNS])
        matrix = np.zeros((len(sets), min(_COLUMNS, width - start)), dtype=np.float32)
        matrix[owner[low:high], place[low:high] - start] = 1
        common += matrix @ matrix.T
    common = common.astype(np.int64)
    linked = 100 * common >= percent * (sizes[:, None] + sizes[None, :] - common)
    if side.min() != side.max():
        linked &= side[:, None] != side[None, :]
    labels = _labels(linked, ids)
    return [(a, b) for a, b in zip(ids.tolist(), labels.tolist(), strict=True) if a != b]


def _sized(members: DataFrame, name: str) -> DataFrame:
    """cluster and the number of blocks that its documents fill; a document weighs as many shingles as it has and SMALL."""
    total = F.sum(F.col("n_shingles") + SMALL)
    size = F.greatest(F.lit(LEAST_BLOCK), F.least(F.lit(BLOCK), total / PARTS))
    return members.groupBy("cluster").agg(F.ceil(total / size).cast("int").alias(name))


def _in_blocks(members: DataFrame, sizes: DataFrame, blocks: str, seed: int) -> DataFrame:
    return members.join(sizes, "cluster").withColumn("block", F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.col(blocks)).cast("int"))


def _attached(members: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """node and least: documents linked with the first one of their cluster, whose text goes to all blocks. ``texts`` are those of members."""
    dealt = _in_blocks(members, _sized(members, "blocks"), "blocks", 11)
    first = F.col("doc_id") == F.col("cluster")
    spread = dealt.withColumn("block", F.explode(F.when(first, F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array("block"))))
    rows = texts.join(stored(spread.select("cluster", "block", first.alias("first"), "doc_id"), "spread"), "doc_id")

    def compare(group: list[tuple]) -> list[tuple[int, int]]:
        sets = shingle_sets([row[4] for row in group])
        heads = [own for row, own in zip(group, sets, strict=True) if row[2]]
        out = []
        for row, own in zip(group, sets, strict=True):
            # Rows of one id may have several texts: one that is linked is enough.
            if not row[2] and any(100 * (n := len(np.intersect1d(own, x, assume_unique=True))) >= percent * (len(own) + len(x) - n) for x in heads):
                out.append((row[3], row[0]))
        return out

    return per_group(rows.select("cluster", "block", "first", "doc_id", "text"), ["cluster", "block"], compare, "node long, least long")


def verified_links(members: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """node and least: links within clusters. ``members``: cluster, doc_id and n_shingles of a document per class; ``texts``: doc_id, text.

    All are compared with the first of their cluster, its smallest id. Those that it does not reach are then compared with
    all others: in a family of copies hardly any, so that its cost follows its size and not the square of it.
    """
    # Most documents are in no cluster: their texts are left behind once, and not once per step. The join is the same
    # at every size, where a broadcast would do for small tables alone.
    texts = stored(texts.hint("merge").join(members.select("doc_id").distinct(), "doc_id", "left_semi"), "clustered")
    near = stored(_attached(members, texts, percent).distinct(), "attached")
    open_ones = members.join(near.select(F.col("node").alias("doc_id")), "doc_id", "left_anti").filter("doc_id != cluster")
    open_ones = stored(open_ones.select("cluster", "doc_id", "n_shingles"), "open")
    # Blocks of open documents meet blocks of all documents of their cluster, themselves among them.
    turns = stored(_sized(open_ones, "turns"), "turns")
    sizes = stored(_sized(members.join(turns, "cluster", "left_semi"), "blocks").join(turns, "cluster"), "sizes")
    asking = _in_blocks(open_ones, sizes, "turns", 17).select(
        "doc_id", "cluster", F.col("block").alias("low"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("high"), F.lit(True).alias("asks"))
    asked = _in_blocks(members, sizes, "blocks", 17).select(
        "doc_id", "cluster", F.explode(F.sequence(F.lit(0), F.col("turns") - 1)).alias("low"), F.col("block").alias("high"), F.lit(False).alias("asks"))
    dealt = stored(asking.unionByName(asked), "dealt")
    pairs = texts.join(dealt, "doc_id").select("cluster", "low", "high", "asks", "doc_id", "text")

    def compare(rows: list[tuple]) -> list[tuple[int, int]]:
        if len(rows) < 2:
            return []
        _, _, _, side, ids, own = zip(*rows, strict=True)
        return _links(np.array(ids, dtype=np.int64), np.array(side), shingle_sets(list(own)), percent)

    return near.union(per_group(pairs, ["cluster", "low", "high"], compare, "node long, least long"))


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", percent: int = PERCENT) -> DataFrame:
    """A row for each row of ``docs``: doc_id, n_shingles, component_id (the smallest id reachable over links) and kept
    (doc_id = component_id).

    A text's set has its distinct five-word shingles, A-Z in lower case; one of fewer words has them all as one
    shingle. Two texts are linked if ``percent`` hundredths of their sets' union are common. A null or empty text has
    an empty set and no link. Ids are whole numbers. A row without id is linked with nothing: component_id is null
    and kept true. Rows of one id are one document, linked with what any of them is linked with. An empty table gives
    no rows.
    """
    texts = docs.select(quoted(doc_id).cast("long").alias("doc_id"), quoted(text).cast("string").alias("text"))
    signed = stored(texts.mapInArrow(_sign(rows_of_band(percent)), "doc_id long, n_shingles long, digest binary, bands array<long>"), "signed")
    full = signed.filter("n_shingles > 0 and doc_id is not null")
    classes = stored(full.groupBy("digest").agg(F.min("doc_id").alias("class_id")), "classes")
    heads = full.join(classes, (full.digest == classes.digest) & (full.doc_id == classes.class_id), "left_semi")
    bands = stored(heads.select("doc_id", "n_shingles", "digest", F.posexplode("bands").alias("band", "hash")), "bands")
    hubs = bands.groupBy("band", "hash").agg(F.min("doc_id").alias("hub"), F.max("doc_id").alias("last")).filter("hub != last")
    meets = bands.join(hubs, ["band", "hash"]).select("doc_id", "hub")
    clusters = components(meets, "doc_id", "hub")
    members = stored(clusters.union(clusters.select(F.col("least").alias("node"), "least").distinct()), "members")
    sizes = full.select(F.col("doc_id").alias("node"), "n_shingles", "digest")
    compared = members.join(sizes, "node").join(classes.select(F.col("class_id").alias("node"), "digest"), ["node", "digest"], "left_semi")
    compared = stored(compared.select(F.col("least").alias("cluster"), F.col("node").alias("doc_id"), "n_shingles").distinct(), "compared")
    links = stored(verified_links(compared, texts, percent), "links")
    # Rows of one id may be of several classes, whose heads are then linked by that id.
    of_class = full.join(classes, "digest").select("doc_id", "class_id").distinct()
    same_id = of_class.groupBy("doc_id").agg(F.min("class_id").alias("a"), F.max("class_id").alias("b")).filter("a != b")
    many = of_class.join(same_id.select("doc_id", "a"), "doc_id").select(F.col("class_id").alias("node"), F.col("a").alias("least"))
    reached = stored(components(links.union(many), "node", "least"), "reached")
    named = stored(
        of_class.join(reached, of_class.class_id == reached.node, "left")
        .groupBy("doc_id").agg(F.min(F.coalesce("least", "class_id")).alias("component_id")), "named")
    result = signed.select("doc_id", "n_shingles").alias("s").join(named.alias("n"), F.col("s.doc_id") == F.col("n.doc_id"), "left")
    component = F.coalesce("n.component_id", "s.doc_id")
    return result.select(
        "s.doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("s.doc_id"), F.lit(True)).alias("kept"))


def distinct_documents(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document, that of the smallest id, of each group of near-duplicates; columns unchanged.

    Rows of one id are one document: if it stays, each of its texts stays once, with the least of the other columns that
    come with it. Rows without id all stay.
    """
    kept = near_duplicates(docs, percent=percent).filter("kept and doc_id is not null").select("doc_id").distinct()
    named = docs.join(kept, "doc_id", "left_semi")
    rest = [quoted(x) for x in docs.columns if x not in ("doc_id", "text")]
    # Two digests stand for the text as a key; the text itself comes last in what is compared.
    row = F.min(F.struct(*rest, quoted("text"))).alias("row")
    once = named.groupBy("doc_id", F.xxhash64("text").alias("one"), F.crc32(F.col("text").cast("binary")).alias("other")).agg(row)
    columns = [F.col(x) if x == "doc_id" else F.col("row").getField(x).alias(x) for x in docs.columns]
    return once.select(*columns).union(docs.filter("doc_id is null"))
