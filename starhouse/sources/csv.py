"""Landing of delimited exports as all-text tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from starhouse import rules
from starhouse.functions.text import blank_tokens
from starhouse.operators import dealing
from starhouse.operators.dedup import keep_first

LANDING_ORDER = "_landing_order"
#: Lines, at most, whose quotes are followed up in one window.
CHUNK_LINES = 8192
_FIELD = '(?:"[^"]*+"|[^",]*+)'
_WHOLE_FIELDS = f"^\ufeff?{_FIELD}(?:,{_FIELD})*+$"


def _landing_order() -> F.Column:
    """Where a row stands in the landed files: file, block in the file, row in the block."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def read_csv_text(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """All columns as text, with the file's name and the landing order.

    Quoted fields may hold line breaks, so every file is one task.  Land many files, or one big
    file through :func:`read_big_csv_text`.  All files must have the same header.
    """
    return (
        spark.read.options(header=True, inferSchema=False, enforceSchema=False, multiLine=True, quote='"', escape='"')
        .csv(path)
        .withColumns({"source_file": F.col("_metadata.file_name"), LANDING_ORDER: _landing_order()})
    )


def read_big_csv_text(spark: SparkSession, path: str, columns: Iterable[str]) -> DataFrame:
    """Like :func:`read_csv_text`, but a file is read by many tasks, quoted line breaks included.

    Spark splits the file at line breaks.  Whether a line continues a quoted field depends on the
    number of quotes before it in the file, so: count quotes per chunk of CHUNK_LINES lines, sum them up chunk by
    chunk (one row each), then number the records inside each chunk.  Only the lines of a record are
    gathered, and a record is parsed from its own text.  Lines are counted ahead, so that the number of tasks follows
    them (:mod:`dealing`).  Every quote character must belong to a
    quoted field, as standard writers ensure: a record where one stands elsewhere, as an inch mark in plain
    text does, stops the job with its file and text, and so does a file that ends inside a quote.  What is
    returned is what :func:`read_csv_text` returns.  The first
    line of every file is its header and must name the columns in their order, else the job stops too.
    """
    names = list(columns)
    source = spark.read.text(path)
    tasks = dealing.tasks_for(spark, source.count())
    lines = source.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_name").alias("source_file"),
        F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("row"), "value",
        (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))).alias("quotes"),
    )
    # A block is named by where its part of the file starts, and by its chunk of lines there.
    lines = lines.withColumn("block", F.struct("start", (F.col("row") - F.pmod("row", F.lit(CHUNK_LINES))).alias("chunk"))).drop("start")
    by_block = Window.partitionBy("file", "block").orderBy("row")
    until_here, before = by_block.rowsBetween(Window.unboundedPreceding, 0), by_block.rowsBetween(Window.unboundedPreceding, -1)
    in_file = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole_file = Window.partitionBy("file")
    open_end = F.raise_error(F.concat(F.lit("a quoted field does not end in "), F.col("file")))
    quotes_before = (
        lines.groupBy("file", "block").agg(F.sum("quotes").alias("quotes"))
        .select(
            "file", "block", F.coalesce(F.sum("quotes").over(in_file), F.lit(0)).alias("block_quotes"),
            (F.sum("quotes").over(whole_file) % 2).alias("odd"), (F.min("block").over(whole_file) == F.col("block")).alias("first"),
        )
        .withColumn("block_quotes", F.when(F.col("odd") == 0, F.col("block_quotes")).otherwise(open_end.cast("bigint")))
        .drop("odd")
    )
    opened = (
        dealing.dealt(lines, tasks, "file", "block").join(quotes_before, ["file", "block"])
        .withColumn("starts", F.pmod(F.col("block_quotes") + F.coalesce(F.sum("quotes").over(before), F.lit(0)), F.lit(2)) == 0)
        .withColumn("record", F.sum(F.col("starts").cast("int")).over(until_here))
    )
    # Lines before a block's first record start (record 0) belong to the last record of an earlier block.
    last_records = (
        opened.groupBy("file", "block").agg(F.max("record").alias("last"))
        .select(
            "file", "block",
            F.last(F.when(F.col("last") > 0, F.struct(F.col("block").alias("b"), F.col("last").alias("r"))), ignorenulls=True)
            .over(in_file).alias("open_record"),
        )
    )
    owned = opened.join(last_records, ["file", "block"]).withColumn(
        "owner", F.when(F.col("record") > 0, F.struct(F.col("block").alias("b"), F.col("record").alias("r"))).otherwise(F.col("open_record"))
    )
    text = F.array_join(F.sort_array(F.collect_list(F.struct("row", "value")))["value"], "\n")
    records = dealing.dealt(owned, tasks, "file", "owner").groupBy("file", "source_file", "owner").agg(
        text.alias("text"), F.min("row").alias("row"), F.bool_or(F.col("first") & (F.col("record") == 1)).alias("is_header")
    )
    schema = ", ".join(f"`{name}` string" for name in names)
    options = {"quote": '"', "escape": '"', "multiLine": "true"}
    header = F.from_csv("text", schema, options)
    as_named = F.array(*[F.regexp_replace(header.getField(name), "^\ufeff", "") for name in names]) == F.array(*map(F.lit, names))
    too_many = F.size(F.split("text", ",")) != F.lit(len(names))
    other = F.raise_error(F.concat(F.lit("other columns than asked for in "), F.col("file"))).cast("boolean")
    is_row = F.when(F.col("is_header"), F.when(F.coalesce(as_named, F.lit(False)) & ~too_many, F.lit(False)).otherwise(other)).otherwise(F.col("text") != "")
    stray = F.raise_error(F.concat(F.lit("a quote inside an unquoted field in "), F.col("file"), F.lit(": "), F.substring("text", 1, 200))).cast("boolean")
    # Doubled quotes taken away, quotes are left around whole fields only.
    whole = ~F.col("text").contains('"') | F.rlike(F.replace("text", F.lit('""'), F.lit("")), F.lit(_WHOLE_FIELDS))
    return (
        records.where(F.when(whole, is_row).otherwise(stray))
        .select(
            F.from_csv("text", schema, options).alias("c"), "source_file",
            F.struct("file", F.col("owner.b.start").alias("block"), "row").alias(LANDING_ORDER),
        )
        .select("c.*", "source_file", LANDING_ORDER)
    )


def land(
    raw: DataFrame, headers: Mapping[str, str], key: str, tokens: Iterable[str] = rules.NULL_TOKENS,
    observation: Observation | None = None,
) -> DataFrame:
    """Renamed text columns with no-value tokens as NULL, one row per key, stamped with the load time.

    Of rows with the same key the first landed stays; rows without a key are left out.  ``observation`` gets the
    number of raw rows and of those without a key.
    """
    present = set(raw.columns)
    columns = [
        blank_tokens(F.col(f"`{header}`") if header in present else F.lit(None).cast("string"), tokens).alias(name)
        for header, name in headers.items()
    ]
    named = raw.select(*columns, "source_file", LANDING_ORDER)
    if observation is not None:
        named = named.observe(observation, F.count("*").alias("raw"), F.count_if(F.col(key).isNull()).alias("no_key"))
    return keep_first(named.where(F.col(key).isNotNull()), [key], [LANDING_ORDER]).drop(LANDING_ORDER).withColumn("loaded_at", F.current_timestamp())


def land_artworks(spark: SparkSession, path: str | list[str], observation: Observation | None = None) -> DataFrame:
    return land(read_csv_text(spark, path), rules.ARTWORK_HEADERS, "object_id", observation=observation)


def land_artists(spark: SparkSession, path: str | list[str], observation: Observation | None = None) -> DataFrame:
    return land(read_csv_text(spark, path), rules.ARTIST_HEADERS, "constituent_id", observation=observation)


