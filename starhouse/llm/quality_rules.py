"""Quality rules with cross-document line frequency.

1. A task measures its documents and sends, without texts, a digest of each text and of each normalised line.
2. Per host, each line's documents are counted, equal texts once: equal (host, line, text) meet first, so a line
   that a third of all documents have is already added up in every task before its own key is shuffled.
3. A line above both limits, a number of documents and a share of its host's documents, is removed.
4. A document is rejected if it fails the base rules, or if removal takes more than DEPLETED of its words.

A line's normal form has A-Z in lower case, digit runs as 0, and its words joined by single spaces.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starhouse.llm.common import columns_but, quoted, slices, stored

#: A removed line is in more distinct texts of its host than this, and in more than this share of them.
LEAST_DOCUMENTS = 20
SHARE = 0.001
#: Percent of its words that a document may lose.
DEPLETED = 70
#: Base rules: fewest words, and the percent of words that may lie in repeated three-word windows.
FEWEST_WORDS = 50
REPEATED = 50

_LOWER = bytes(x + 32 if 65 <= x <= 90 else x for x in range(256))
_DIGITS = re.compile(rb"[0-9]+")
MEASURES = T.StructType([T.StructField(x, T.LongType()) for x in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")])
LINES = T.ArrayType(T.StructType([T.StructField("line", T.LongType()), T.StructField("n_words", T.LongType())]))


def digest(raw: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "big", signed=True)


def normal(line: bytes) -> bytes:
    """A line's normal form; empty if it has no word."""
    return _DIGITS.sub(b"0", b" ".join(line.translate(_LOWER).split()))


def _repeated_words(words: list[bytes]) -> int:
    """Words inside three-word windows that occur twice or more."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    times = Counter(windows)
    n = end = 0
    for k, window in enumerate(windows):
        if times[window] > 1:
            n += k + 3 - max(k, end)
            end = k + 3
    return n


def measure(text: str | None) -> tuple[dict[str, int], int, list[dict[str, int]]]:
    """A text's measures, its digest, and its distinct normalised lines with the words they have in it. Null: as empty."""
    text = text or ""
    raw = text.encode()
    words = raw.split()  # bytes are cut at ASCII white space alone
    lines: dict[bytes, int] = {}
    seen: set[bytes] = set()
    duplicates = 0
    for line in raw.split(b"\n"):
        n = len(line.split())
        if n:
            duplicates += line in seen
            seen.add(line)
            form = normal(line)
            lines[form] = lines.get(form, 0) + n
    measures = {
        "n_words": len(words), "word_chars": len(text) - sum(map(text.count, " \t\n\v\f\r")),
        "n_symbols": sum(map(text.count, "#*$%&|<>")), "n_dup_lines": duplicates, "n_repeat_words": _repeated_words(words),
    }
    return measures, digest(raw), [{"line": digest(form), "n_words": n} for form, n in lines.items()]


def measured(docs: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """Written rows of row (all columns but the text), host, base (measures), digest and lines of each text, and no, a number of the row."""
    kept = columns_but(docs, [text])
    narrow = docs.select(
        F.struct(*map(quoted, kept)).alias("row") if kept else F.struct(F.lit(None).cast("int").alias("none")).alias("row"),
        quoted(host).cast("string").alias("host"), quoted(text).cast("string").alias("text"))
    kinds = [pa.struct([(x.name, pa.int64()) for x in MEASURES]), pa.int64(), pa.list_(pa.struct([("line", pa.int64()), ("n_words", pa.int64())]))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = list(zip(*map(measure, batch.column(2).to_pylist()), strict=True))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *[pa.array(x, kind) for x, kind in zip(found, kinds, strict=True)]],
                names=["row", "host", "base", "digest", "lines"])

    schema = T.StructType([
        narrow.schema["row"], narrow.schema["host"], T.StructField("base", MEASURES), T.StructField("digest", T.LongType()),
        T.StructField("lines", LINES)])
    return stored(narrow.mapInArrow(run, schema).withColumn("no", F.monotonically_increasing_id()), "measured")


def frequent_lines(found: DataFrame, least: int = LEAST_DOCUMENTS, share: float = SHARE) -> DataFrame:
    """host, line and n_documents of lines above both limits; n_documents counts distinct texts of the host. Of ``measured`` rows."""
    spread = found.select("host", "digest", F.explode("lines.line").alias("line"))
    counts = spread.distinct().groupBy("host", "line").agg(F.count("*").alias("n_documents")).filter(F.col("n_documents") > least)
    hosts = found.select("host", "digest").distinct().groupBy("host").agg(F.count("*").alias("n_host"))
    counts, hosts = stored(counts, "counts").alias("c"), stored(hosts, "hosts").alias("h")
    above = counts.join(hosts, F.col("c.host").eqNullSafe(F.col("h.host"))).filter(F.col("n_documents") > share * F.col("n_host"))
    return above.select("c.host", "line", "n_documents")


def _losses(found: DataFrame, frequent: DataFrame) -> DataFrame:
    """no, n_removed (words) and removed (digests of lines) of documents that have frequent lines."""
    spread = found.select("no", "host", F.explode("lines").alias("l")).select("no", "host", "l.*").alias("d")
    # Written first, so that adaptive execution can split the documents of a very common line.
    f = stored(frequent.select("host", "line"), "frequent").alias("f")
    met = spread.join(f, F.col("d.host").eqNullSafe(F.col("f.host")) & (F.col("d.line") == F.col("f.line")))
    return met.select("no", "d.line", "n_words").groupBy("no").agg(F.sum("n_words").alias("n_removed"), F.collect_set("line").alias("removed"))


def base_failed(base: str = "base", fewest: int = FEWEST_WORDS, repeated: int = REPEATED) -> Column:
    n = F.col(f"{base}.n_words")
    return (n < fewest) | (100 * F.col(f"{base}.n_repeat_words") > repeated * n)


def judged(found: DataFrame, least: int = LEAST_DOCUMENTS, share: float = SHARE, depleted: int = DEPLETED) -> DataFrame:
    """``measured`` rows with n_removed (words in frequent lines), removed (their digests), base_failed and kept."""
    losses = stored(_losses(found, frequent_lines(found, least, share)), "losses")
    out = found.join(losses, "no", "left").withColumn("n_removed", F.coalesce("n_removed", F.lit(0)))
    kept = ~base_failed() & (100 * F.col("n_removed") <= depleted * F.col("base.n_words"))
    return out.withColumns({"base_failed": base_failed(), "kept": kept})


def judge(docs: DataFrame, text: str = "text", host: str = "source", **limits) -> DataFrame:
    """A verdict for every row: the columns of ``docs`` but the text, with n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, n_removed, base_failed and kept, which replace columns of those names.

    A null text is as an empty one: no words, so it fails the base rules. Null hosts are one host. Repeated rows, equal
    texts and rows without an id each get their own verdict, but a host counts an equal text once: copies alone make
    no line frequent. A line counts once per document. Texts of any length are measured whole, each within one task.
    An empty table gives none.
    """
    own = [x.name for x in MEASURES] + ["n_removed", "base_failed", "kept"]
    names = columns_but(docs, [text, *own])
    out = judged(measured(docs.select(*map(quoted, dict.fromkeys([*names, host, text]))), text, host), **limits)
    return out.select(*[F.col("row").getField(x).alias(x) for x in names], "base.*", "n_removed", "base_failed", "kept")


def cleaned(docs: DataFrame, text: str = "text", host: str = "source", **limits) -> DataFrame:
    """Kept documents without their frequent lines, columns as in ``docs``. See ``judge`` for nulls and repeats."""
    number = "_" + max(docs.columns, key=len)  # a name that no column has
    numbered = stored(docs.withColumn(number, F.monotonically_increasing_id()), "documents")
    verdicts = judged(measured(numbered, text, host), **limits).filter("kept").select(F.col("row").getField(number).alias(number), "removed")
    rest = [x for x in numbered.columns if x != text]
    narrow = numbered.join(verdicts, number).select(F.struct(*map(quoted, rest)).alias("row"), quoted(text).cast("string").alias("text"), "removed")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = []
            for value, gone in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if value and gone:
                    drop = set(gone)
                    value = b"\n".join(x for x in value.encode().split(b"\n") if not (form := normal(x)) or digest(form) not in drop).decode()
                texts.append(value)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["row", "text"])

    done = narrow.mapInArrow(run, T.StructType([narrow.schema["row"], T.StructField("text", T.StringType())]))
    return done.select(*[F.col("text").alias(x) if x == text else F.col("row").getField(x).alias(x) for x in docs.columns])


#: The same in DuckDB SQL, for the columns of the contract.
ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM d),
windows AS (SELECT r, i, [w[i], w[i + 1], w[i + 2]] AS g FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
twice AS (SELECT r, g FROM windows GROUP BY r, g HAVING count(*) > 1),
repeats AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM windows JOIN twice USING (r, g)) GROUP BY r),
split AS (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d),
lines AS (
  SELECT r, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n,
    trim(regexp_replace(regexp_replace(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x20\x09-\x0D]+', ' ', 'g'), '[0-9]+', '0', 'g'), ' ') AS form
  FROM split WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dup AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM lines GROUP BY r),
seen AS (SELECT source, form, count(DISTINCT t) AS n FROM lines JOIN d USING (r) GROUP BY source, form),
hosts AS (SELECT source, count(DISTINCT t) AS n FROM d GROUP BY source),
often AS (
  SELECT s.source, s.form FROM seen s JOIN hosts h ON s.source IS NOT DISTINCT FROM h.source WHERE s.n > %(least)d AND s.n > %(share)s * h.n),
lost AS (
  SELECT l.r, sum(l.n) AS n FROM lines l JOIN d USING (r) JOIN often o ON o.source IS NOT DISTINCT FROM d.source AND o.form = l.form GROUP BY l.r),
m AS (
  SELECT d.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(length(regexp_replace(d.t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(d.t, '[^#*$%%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols, CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(repeats.n, 0) AS BIGINT) AS n_repeat_words, coalesce(lost.n, 0) AS n_lost
  FROM d JOIN w USING (r) LEFT JOIN dup USING (r) LEFT JOIN repeats USING (r) LEFT JOIN lost USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (n_words < %(fewest)d OR 100 * n_repeat_words > %(repeated)d * n_words) AS base_failed,
  NOT (n_words < %(fewest)d OR 100 * n_repeat_words > %(repeated)d * n_words) AND 100 * n_lost <= %(depleted)d * n_words AS kept,
  CAST(n_lost AS BIGINT) AS n_removed
FROM m
""" % {"least": LEAST_DOCUMENTS, "share": SHARE, "depleted": DEPLETED, "fewest": FEWEST_WORDS, "repeated": REPEATED}
