"""Mixing sources to target weights by entropy balancing.

Each document has a base rate (1, unless given) and is taken at the rate of least relative entropy to it,
counted in words, that gives every source its target: base * exp(lambda of its source), no more than the
cap. The lambdas solve a convex dual problem. Its gradient and curvature are sums over documents, which
are first added up by source and base rate; a Newton step per source follows, until all sources meet
their targets. Lambdas stay in a table with a row per source.

Rates become copies by carrying rounding errors from larger documents to smaller ones: per source, with
the count of its documents of each size and rate. Which documents of equal size get the further copy is
decided by a hash of their ids, in cells of bounded size, so no source or size has to meet in one task.
"""

from __future__ import annotations


import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starhouse.llm.common import columns_but, quoted, stored

CAP = 2.0
ITERATIONS = 60
TOLERANCE = 1e-9
#: Documents of one source, size and rate that are ranked by one task.
CELL = 4096
_ROW = "__row"
_CELL = ["source", "size", "base"]
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Runs of characters other than white space. Null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def capped_targets(sources: DataFrame, share: float = 1.5, cap: float = CAP) -> DataFrame:
    """``sources`` (source, source_size, weight) with target: shares of ``share`` times all sizes by weight.

    A target stops at ``cap`` times its source's size, and the excess is shared by weight among the others,
    until none is above.
    """
    rows = stored(sources.select("source", "source_size", "weight"), "sources")
    total = share * (rows.agg(F.sum("source_size")).first()[0] or 0)
    most = cap * F.col("source_size")
    level = 0.0
    while True:  # the level only rises, and each turn stops another source at least
        stopped = F.col("weight") * level >= most
        x = rows.agg(
            F.sum(F.when(stopped, most)).alias("stopped"), F.sum(F.when(~stopped, F.col("weight"))).alias("weight")
        ).first()
        raised = (total - (x["stopped"] or 0.0)) / x["weight"] if x["weight"] else level
        if raised <= level:
            break
        level = raised
    return rows.withColumn("target", F.least(F.col("weight") * level, most).cast("double"))


def rates(sized: DataFrame, targets: DataFrame, cap: float = CAP) -> DataFrame:
    """Lambda of each source: source, lambda. ``sized``: source, size, base; ``targets``: source, target.

    Newton steps begin where the target would be met without the cap. The dual is flat where all rates of a
    source are at the cap; a step that leaves the bracket found so far is replaced by the bracket's middle.
    """
    cells = stored(
        sized.groupBy("source", "base").agg(F.sum("size").cast("double").alias("size")).filter("size > 0"), "cells")
    whole = cells.groupBy("source").agg(F.sum(F.col("size") * F.col("base")).alias("whole"))
    start = F.ln(F.greatest(F.col("target"), F.lit(1e-9)) / F.col("whole"))
    state = whole.alias("w").join(targets.alias("t"), _same("w", "t", ["source"])).select(
        "w.source", F.col("target").cast("double").alias("target"), start.alias("lambda"),
        F.lit(None).cast("double").alias("low"), F.lit(None).cast("double").alias("high"))
    for _ in range(ITERATIONS):
        free = F.col("base") * F.exp("lambda")
        taken = F.col("size") * F.least(free, F.lit(cap))
        sums = (
            cells.alias("c").join(state.alias("s"), _same("c", "s", ["source"]))
            .groupBy("s.source", "target", "lambda", "low", "high")
            .agg(F.sum(taken).alias("taken"), F.sum(F.when(free < cap, taken).otherwise(0.0)).alias("slope"))
        )
        at, miss = F.col("lambda"), F.col("target") - F.col("taken")
        met = (F.abs(miss) <= TOLERANCE * (F.col("target") + 1)) | ((miss > 0) & (F.col("slope") == 0))
        low, high = F.when(miss > 0, at).otherwise(F.col("low")), F.when(miss < 0, at).otherwise(F.col("high"))
        newton = at + F.greatest(F.lit(-2.0), F.least(F.lit(2.0), F.coalesce(miss / F.nullif("slope", F.lit(0.0)), F.lit(-2.0))))
        inside = (F.coalesce(newton > low, F.lit(True))) & (F.coalesce(newton < high, F.lit(True)))
        to = F.when(met, at).when(inside, newton).otherwise((low + high) / 2)
        state = stored(sums.select(
            "source", "target", to.alias("lambda"), low.alias("low"), high.alias("high"), (to == at).alias("met")), "lambda")
        if not state.filter("not met").limit(1).count():
            break
    return state.select("source", "lambda")


def _extra_copies(cells: pd.DataFrame) -> pd.DataFrame:
    """How many documents of each size and rate of a source get a copy more, errors carried on to smaller ones.

    A source of so many words has at most as many different sizes as the square root of twice that.
    """
    cells = cells.sort_values(["size", "rate"], ascending=[False, True], kind="stable")
    owed, extra = 0.0, []
    for size, part, n in zip(cells["size"], cells["rate"] % 1, cells["n"], strict=True):
        owed += n * part * size
        k = min(n, max(0, round(owed / size))) if size and part else 0
        owed -= k * size
        extra.append(int(k))
    return cells.assign(extra=extra)


def sizes(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id", base: Column | None = None,
          more: list[str] | None = None) -> DataFrame:
    """doc_id, source, size and base of ``docs``, from which a mix is planned, and the columns ``more``."""
    rate = F.coalesce(base.cast("double"), F.lit(1.0)) if base is not None else F.lit(1.0)
    return docs.select(
        *(more or []), quoted(doc_id).alias("doc_id"), quoted(source).alias("source"), word_count(quoted(text)).alias("size"), rate.alias("base"))


def _same(left: str, right: str, names: list[str]) -> list[Column]:
    return [F.col(f"{left}.{x}").eqNullSafe(F.col(f"{right}.{x}")) for x in names]


def plan(sized: DataFrame, targets: DataFrame, cap: float = CAP) -> DataFrame:
    """Copies by cell (source, size, base): copies, and limit, the draw up to which a document gets one more (null: none)."""
    lambdas = rates(sized, targets, cap)
    counts = sized.groupBy(*_CELL).agg(F.count("*").alias("n"))
    # Rates are rounded: what differs from a whole number of copies by rounding alone is one.
    rate = F.round(F.least(F.lit(cap), F.col("base") * F.exp("lambda")), 9)
    cells = counts.alias("n").join(lambdas.alias("l"), _same("n", "l", ["source"])).select(
        "n.source", "size", "base", "n", rate.alias("rate"))
    planned = stored(
        cells.groupBy("source").applyInPandas(_extra_copies, cells.withColumn("extra", F.lit(0).cast("long")).schema), "cells")
    # A cell of more documents than CELL is ranked in parts, each a range of draws.
    part = F.floor(F.col("draw") / F.lit(float(1 << 62)) * F.ceil(F.col("n") / CELL))
    drawn = stored(
        sized.select("doc_id", *_CELL).alias("d")
        .join(planned.filter("extra > 0").alias("p"), _same("d", "p", _CELL))
        .select(*[f"d.{x}" for x in _CELL], "n", "extra", _draw("doc_id").alias("draw")).withColumn("part", part), "drawn")
    before = Window.partitionBy(*_CELL).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = drawn.groupBy(*_CELL, "part", "extra").agg(F.count("*").alias("in_part"))
    parts = parts.withColumn("offset", F.coalesce(F.sum("in_part").over(before), F.lit(0)))
    # Only the part in which the count of further copies is reached has to be ranked.
    reached = parts.filter((F.col("offset") < F.col("extra")) & (F.col("extra") <= F.col("offset") + F.col("in_part")))
    place = F.row_number().over(Window.partitionBy(*_CELL, "part").orderBy("draw"))
    limits = (
        drawn.alias("d").join(reached.alias("r"), [*_same("d", "r", _CELL), F.col("d.part") == F.col("r.part")])
        .select(*[f"d.{x}" for x in _CELL], "d.part", "draw", "offset", "d.extra").withColumn("place", place)
        .filter(F.col("place") + F.col("offset") == F.col("extra")).select(*_CELL, F.col("draw").alias("limit"))
    )
    cells = planned.alias("p").join(limits.alias("m"), _same("p", "m", _CELL), "left").select(
        *[f"p.{x}" for x in _CELL], F.floor("rate").cast("long").alias("copies"), "limit")
    return stored(cells, "cells")


def _draw(doc_id: str) -> Column:
    """A hash of an id below 2^62."""
    return F.shiftrightunsigned(F.xxhash64(doc_id, F.lit(41)), 2)


def take(rows: DataFrame, cells: DataFrame) -> DataFrame:
    """``rows`` (doc_id, source, size, base and any others) with copies."""
    further = F.when(_draw("d.doc_id") <= F.col("limit"), 1).otherwise(0)
    return rows.alias("d").join(cells.alias("c"), _same("d", "c", _CELL), "left").select(
        "d.*", F.when(F.col("d.size") > 0, F.coalesce("c.copies", F.lit(0)) + further).otherwise(0).cast("long").alias("copies"))


def mix(docs: DataFrame, targets: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id",
        base: Column | None = None, cap: float = CAP, sized: DataFrame | None = None) -> DataFrame:
    """``docs`` with size (words), copies and taken (size * copies), which replace columns of those names.

    ``targets`` has source and target, in words. ``base`` gives base rates above 0 (null: 1) and may use any
    column. Null is a source like any other; a source without a target gives nothing. Documents without words
    get no copy. Rows of equal id, source, size and base get equally many copies. Sources come within about
    one of their smaller documents of the target, unless all of it is at the cap. Runs agree. An empty table
    stays empty. ``sized`` may hand over what ``sizes`` gave for the same rows.
    """
    kept = columns_but(docs, ("size", "copies", "taken"))
    wide = sizes(docs.withColumn(_ROW, F.struct(*map(quoted, kept))), text, source, doc_id, base, [_ROW])
    cells = plan(sized if sized is not None else stored(wide.drop(_ROW), "sizes"), targets, cap)
    return take(wide, cells).select(f"{_ROW}.*", "size", "copies", (F.col("size") * F.col("copies")).alias("taken"))


def cyclic_weights(sized: DataFrame, weights: tuple[int, ...] = (5, 2, 1)) -> DataFrame:
    """Sources with source_size and weight: the weights in turn, sources by code point and null last."""
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    # One row per source.
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    return sums.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), turn + 1).cast("double"))


def repeated(mixed: DataFrame, names: list[str]) -> DataFrame:
    """Columns ``names`` of a mix, whatever their names, each row as often as it has copies."""
    turn = "_" + max(names, key=len)  # a name that no column has
    each = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias(turn)
    return mixed.filter("copies > 0").select(*map(quoted, names), each).drop(turn)
