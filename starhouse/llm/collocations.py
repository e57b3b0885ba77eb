"""Phrase collocations by prefix-free parsing.

1. A task cuts each piece of text at its triggers: windows of LONGEST - 1 words whose hash is 0 modulo MODULUS. A chunk
   reaches from one trigger to the end of the next, so neighbours overlap by a window, and equal passages give equal
   chunks wherever they stand. Equal chunks of a language become one row of the dictionary with their frequency.
2. Phrases are counted inside the distinct chunks, weighted by frequency. A chunk that is not the last of its piece
   leaves phrases that start in its closing window to the next one: every occurrence counts once.
3. Words are counted first, then phrases of two words, and so on. A phrase can only be frequent if both phrases of one
   word less in it are, so each pass skips phrases that a bitmap of frequent shorter ones excludes. The bitmap has a
   fixed size whatever the corpus; its chance hits only cost time, as every count that is kept is exact.
4. Frequent phrases, few against the corpus, meet the counts of their parts by joins.

Nothing is grouped by language alone: also the last ranking goes by ranges of the order.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starhouse.llm.common import quoted, stored
from starhouse.llm.hashing import FACTORS, mixed, word_hashes

LONGEST = 3
LEAST = 10
#: A phrase goes if a longer one around it occurs in this percent of its places, or more.
INSIDE = 50
TOP = 2_000
SCALE = 1_000_000
UNKNOWN = "und"
#: One window in so many is a trigger.
MODULUS = 16
#: The bitmap of frequent phrases has 2 ** BITS bits: 2 MB.
BITS = 24
#: Bytes of text, or words of chunks, that a task works on at once. A longer text is worked on alone.
AT_ONCE = 1 << 20

#: A-Z in lower case, white space between words as space, ends of pieces as line feeds.
_FLAT = bytes(x + 32 if 65 <= x <= 90 else 32 if x == 9 else 10 if chr(x) in ".,;:!?\n\v\f\r" else x for x in range(256))
_SPACES = re.compile(rb"  +")


def _cut(texts: list[bytes], window: int, modulus: int) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The chunks of some texts, the number of each one's text, and whether it is the last of its piece."""
    raw = _SPACES.sub(b" ", b"\n".join(texts).translate(_FLAT))
    hashes, starts = word_hashes(raw)
    if not len(starts):
        return [], np.zeros(0, dtype=np.int64), np.zeros(0, dtype=bool)
    data = np.frombuffer(raw, dtype=np.uint8)
    gap = (data == 32) | (data == 10)
    ends = np.flatnonzero(np.diff(gap.astype(np.int8), append=1) == 1) + 1
    lines = np.cumsum(data == 10)[starts]
    first = np.diff(lines, prepend=-1) != 0
    n = len(starts)
    trigger = np.zeros(n, dtype=bool)
    if n >= window:
        mark = np.zeros(n - window + 1, dtype=np.uint64)
        for k in range(window):
            mark += hashes[k : n - window + 1 + k] * FACTORS[k % len(FACTORS)]
        piece = np.cumsum(first)
        trigger[: len(mark)] = (mixed(mark) % np.uint64(modulus) == 0) & (piece[: len(mark)] == piece[window - 1 :])
    begin = np.flatnonzero(first | trigger)
    following = np.append(begin[1:], n)
    last = np.append(first, True)[following]
    stop = ends[np.where(last, following, following + window) - 1]
    # Texts end at line feeds that the translation cannot tell from others, so their bounds are counted before it.
    chunks = [raw[a:b] for a, b in zip(starts[begin].tolist(), stop.tolist(), strict=True)]
    breaks = np.cumsum([x.translate(_FLAT).count(b"\n") + 1 for x in texts])
    return chunks, np.searchsorted(breaks, lines[begin], side="right"), last


def dictionary(docs: DataFrame, text: str = "text", label: str = "lang", longest: int = LONGEST, modulus: int = MODULUS) -> DataFrame:
    """Distinct chunks: lang, chunk (its words joined by spaces), last (of its piece), weight (frequency in the parse)."""
    window = max(longest - 1, 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def cut(texts: list[bytes], labels: list[str]) -> pa.RecordBatch:
            chunks, owner, last = _cut(texts, window, modulus)
            return pa.RecordBatch.from_arrays(
                [pa.array(labels, pa.string()).take(pa.array(owner)), pa.array(chunks, pa.binary()).cast(pa.string()), pa.array(last)],
                names=["lang", "chunk", "last"])

        for batch in batches:
            texts: list[bytes] = []
            labels: list[str] = []
            size = 0
            for value, name in zip(batch.column(0), batch.column(1), strict=True):
                if value.is_valid:
                    texts.append(value.as_py().encode())
                    labels.append(name.as_py())
                    size += len(texts[-1])
                if size >= AT_ONCE:
                    yield cut(texts, labels)
                    texts, labels, size = [], [], 0
            if texts:
                yield cut(texts, labels)

    narrow = docs.select(quoted(text).cast("string").alias("text"), F.coalesce(quoted(label).cast("string"), F.lit(UNKNOWN)).alias("lang"))
    return narrow.mapInArrow(run, "lang string, chunk string, last boolean").groupBy("lang", "chunk", "last").agg(F.count("*").alias("weight"))


def _numbered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct whole numbers, and the place of each key among them."""
    coded = pa.array(keys).dictionary_encode()
    return coded.dictionary.to_numpy(), coded.indices.to_numpy().astype(np.int64)


class _Words:
    """Lists of words as numbers: tokens (words of a language), their hashes, and where lists begin."""

    def __init__(self, langs: pa.Array, lists: pa.Array) -> None:
        split = pc.split_pattern(lists, " ")
        self.offsets = split.offsets.to_numpy()
        self.offsets = self.offsets - self.offsets[0]
        coded = split.flatten().dictionary_encode()
        names = langs.dictionary_encode()
        self.sizes = np.diff(self.offsets)
        of = np.repeat(names.indices.to_numpy(), self.sizes).astype(np.int64)
        distinct, self.tokens = _numbered(of * max(len(coded.dictionary), 1) + coded.indices.to_numpy())
        lang, word = np.divmod(distinct, max(len(coded.dictionary), 1))
        self.lang, self.word = names.dictionary.take(pa.array(lang)), coded.dictionary.take(pa.array(word))
        raw = b" ".join(x.as_py().encode() for x in coded.dictionary)
        of_lang = [int.from_bytes(hashlib.blake2b(x.as_py().encode(), digest_size=8).digest(), "big") for x in names.dictionary]
        self.hashes = mixed(word_hashes(raw)[0][word] * FACTORS[0] + np.array(of_lang, dtype=np.uint64)[lang] * FACTORS[1])

    def marks(self, size: int) -> np.ndarray:
        """Hashes of the ``size`` words from each place on; of no use where the list ends before."""
        own = self.hashes[self.tokens]
        out = np.zeros(len(own), dtype=np.uint64)
        for k in range(size):
            out = mixed(out * FACTORS[2] + np.append(own[k:], np.zeros(min(k, len(own)), dtype=np.uint64)))
        return out >> np.uint64(64 - BITS)


def _gathered(batches: Iterator[pa.RecordBatch], texts: int) -> Iterator[pa.Table]:
    """Tables of about AT_ONCE bytes of the column ``texts``."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.column(texts).nbytes
        if size >= 8 * AT_ONCE:
            yield pa.Table.from_batches(held).combine_chunks()
            held, size = [], 0
    if size:
        yield pa.Table.from_batches(held).combine_chunks()


def _bitmap(frequent: DataFrame, size: int) -> np.ndarray:
    """A bit for the hash of each phrase of (lang, phrase): 2 ** BITS bits as 64-bit words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << BITS - 6, dtype=np.uint64)
        for part in _gathered(batches, 1):
            words = _Words(part.column(0).combine_chunks(), part.column(1).combine_chunks())
            mark = words.marks(size)[words.offsets[:-1]]
            np.bitwise_or.at(bits, mark >> np.uint64(6), np.uint64(1) << (mark & np.uint64(63)))
        place = np.flatnonzero(bits)
        yield pa.RecordBatch.from_arrays([pa.array(place, pa.int32()), pa.array(bits[place].view(np.int64))], names=["place", "bits"])

    rows = frequent.select("lang", "phrase").mapInArrow(run, "place int, bits long")
    found = rows.groupBy("place").agg(F.bit_or("bits").alias("bits")).toPandas()
    out = np.zeros(1 << BITS - 6, dtype=np.uint64)
    out[found["place"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return out


def _counts(chunks: DataFrame, size: int, window: int, shorter: Callable[[], np.ndarray] | None) -> DataFrame:
    """lang, phrase and f of phrases of ``size`` words whose phrases of one word less are in the bitmap of ``shorter``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shorter() if shorter else None
        for part in _gathered(batches, 1):
            words = _Words(part.column(0).combine_chunks(), part.column(1).combine_chunks())
            weight, last = part.column(3).to_numpy(), part.column(2).to_numpy()
            place = np.arange(len(words.tokens)) - np.repeat(words.offsets[:-1], words.sizes)
            own = words.sizes - np.where(last, 0, window)
            fits = (place < np.repeat(own, words.sizes)) & (place + size <= np.repeat(words.sizes, words.sizes))
            if bits is not None:
                mark = words.marks(size - 1)
                known = (bits[mark >> np.uint64(6)] >> (mark & np.uint64(63)) & np.uint64(1)).astype(bool)
                fits &= known & np.append(known[1:], False)
            at = np.flatnonzero(fits)
            weights = np.repeat(weight, words.sizes)[at]
            if not len(at):
                continue
            # A phrase's number grows by a word at a time; numbers are made dense in between, so that they fit.
            distinct, key = _numbered(words.tokens[at])
            tokens = [distinct]
            for k in range(1, size):
                distinct, key = _numbered(key * len(words.word) + words.tokens[at + k])
                before, token = np.divmod(distinct, len(words.word))
                tokens = [*[x[before] for x in tokens], token]
            sums = np.bincount(key, weights, len(distinct)).astype(np.int64)  # far below 2 ** 53 in one task
            phrase = pc.binary_join_element_wise(*[words.word.take(pa.array(x)) for x in tokens], " ")
            yield pa.RecordBatch.from_arrays([words.lang.take(pa.array(tokens[0])), phrase, pa.array(sums, pa.int64())], names=["lang", "phrase", "f"])

    rows = chunks.select("lang", "chunk", "last", "weight").mapInArrow(run, "lang string, phrase string, f long")
    return rows.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def frequent_phrases(chunks: DataFrame, longest: int = LONGEST, least: int = LEAST) -> DataFrame:
    """lang, phrase, size and f of all phrases of up to ``longest`` words that occur ``least`` times or more."""
    context = chunks.sparkSession.sparkContext
    out = before = None
    for size in range(1, longest + 1):
        known = context.broadcast(_bitmap(before, size - 1)) if size > 1 else None
        found = _counts(chunks, size, max(longest - 1, 1), known and (lambda held=known: held.value))
        before = stored(found.filter(F.col("f") >= least).withColumn("size", F.lit(size)), f"phrases{size}")
        if known:
            known.destroy()
        out = before if out is None else out.unionByName(before)
    return out


def _scored(counts: DataFrame) -> DataFrame:
    """Phrases of two words or more with a, l, r and score of their lowest-scoring cut."""
    words = F.split("phrase", " ")
    cuts = counts.filter("size > 1").select("lang", "phrase", F.col("f").alias("a"), "size", F.explode(F.expr("sequence(1, size - 1)")).alias("k"))
    cuts = cuts.select(
        "lang", "phrase", "a", "k", F.array_join(F.slice(words, F.lit(1), F.col("k")), " ").alias("head"),
        F.array_join(F.slice(words, F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("tail"))
    heads = counts.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    tails = counts.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    parts = cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"])
    # Whole numbers of up to 38 digits: exact as long as a is below 10 ** 16.
    a, l, r = (f"cast({x} as decimal(19,0))" for x in "alr")
    score = F.expr(f"({SCALE} * ({a} * {a})) div ({l} * {r})")
    best = parts.withColumn("score", score).groupBy("lang", "phrase").agg(F.min("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    return best.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def _covered(counts: DataFrame) -> DataFrame:
    """lang, phrase and inside: the most places that one longer phrase around it has, of phrases inside frequent longer ones."""
    parts = F.expr("""
        flatten(transform(sequence(2, size - 1), n -> transform(sequence(1, size - n + 1), i -> array_join(slice(split(phrase, ' '), i, n), ' '))))""")
    longer = counts.filter("size > 2").select("lang", F.explode(parts).alias("phrase"), "f")
    return longer.groupBy("lang", "phrase").agg(F.max("f").alias("inside"))


def collocations(docs: DataFrame, text: str = "text", label: str = "lang", longest: int = LONGEST, least: int = LEAST,
                 inside: int = INSIDE, top: int = TOP) -> DataFrame:
    """The best ``top`` phrases of each language: lang, rank, phrase, a, l, r, n and score.

    Texts are cut at ``.,;:!?`` and line ends into pieces, and those at spaces and tabs into words, A-Z in lower case.
    a is how often a phrase occurs, l and r its two parts at the cut that scores lowest (then shortest first part),
    n all words of the language. Phrases inside a longer frequent one that has ``inside`` percent of their places are
    left out. Higher scores come first, then larger a, then the phrase by its bytes.

    Null texts are as empty ones; a null label is ``und``, one language with documents that say so. Repeated rows count
    as often as they occur. Ids and further columns play no part, whatever their names. Texts of any length are
    counted whole; a piece is never split between tasks. An empty table gives no phrases.
    """
    window = max(longest - 1, 1)
    chunks = stored(dictionary(docs, text, label, longest), "chunks")
    counts = frequent_phrases(chunks, longest, least)
    size = F.length("chunk") - F.length(F.replace("chunk", F.lit(" "))) + 1
    totals = chunks.groupBy("lang").agg(F.sum(F.col("weight") * (size - F.when(F.col("last"), 0).otherwise(window))).alias("n"))
    covered = stored(_covered(counts), "covered")
    open_ones = stored(_scored(counts), "scored").join(covered, ["lang", "phrase"], "left").filter(
        F.coalesce(100 * F.col("inside") < inside * F.col("a"), F.lit(True)))
    return _ranked(open_ones, top).join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _ranked(phrases: DataFrame, top: int) -> DataFrame:
    """The first ``top`` phrases of each language with their rank. No task sorts a whole language.

    Ranges of the order are counted, which gives each the rank it begins with; only those that begin early enough are sorted.
    """
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    ranges = stored(phrases.repartitionByRange("lang", *order).withColumn("part", F.spark_partition_id()), "ranges")
    before = F.sum("rows").over(Window.partitionBy("lang").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    counts = ranges.groupBy("lang", "part").agg(F.count("*").alias("rows")).withColumn("before", F.coalesce(before, F.lit(0)))
    early = stored(counts.filter(F.col("before") < top).select("lang", "part", "before"), "early")
    place = F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))
    return ranges.join(early, ["lang", "part"]).withColumn("rank", (F.col("before") + place).cast("long")).filter(F.col("rank") <= top)


#: The same in DuckDB SQL.
ORACLE = r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
pieces AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, s, array_to_string(w[i : i + s - 1], ' ') AS phrase
  FROM (SELECT lang, w, s, unnest(range(1, len(w) - s + 2)) AS i FROM w, (SELECT unnest([1, 2, 3]) AS s))),
counts AS (SELECT lang, phrase, s, count(*) AS f FROM grams GROUP BY lang, phrase, s),
candidates AS (SELECT * FROM counts WHERE s > 1 AND f >= 10),
cuts AS (
  SELECT lang, phrase, f AS a, k, string_split(phrase, ' ') AS p FROM (SELECT *, unnest(range(1, s)) AS k FROM candidates)),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r,
    CAST((CAST(1000000 AS HUGEINT) * c.a * c.a) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
  FROM cuts c
  JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(c.p[1 : c.k], ' ')
  JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(c.p[c.k + 1 :], ' ')),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_ones AS (
  SELECT lang, unnest([array_to_string(p[1:2], ' '), array_to_string(p[2:3], ' ')]) AS phrase, f
  FROM (SELECT lang, f, string_split(phrase, ' ') AS p FROM candidates WHERE s = 3)),
gone AS (SELECT DISTINCT b.lang, b.phrase FROM best b JOIN inner_ones i USING (lang, phrase) WHERE 100 * i.f >= 50 * b.a),
totals AS (SELECT lang, sum(f) AS n FROM counts WHERE s = 1 GROUP BY lang)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score
FROM best ANTI JOIN gone USING (lang, phrase) JOIN totals USING (lang)
QUALIFY rank <= 2000
"""
