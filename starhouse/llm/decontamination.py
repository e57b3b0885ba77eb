"""Benchmark decontamination with a generalised suffix automaton.

The words of all benchmark items form one automaton whose states stand for the word sequences that occur
in them. A document's words stream through it: each word extends the longest matching sequence, or
follows suffix links until it fits. Where that length reaches the window (13 words), or a whole shorter
item, the words are hit.

Words are read as bytes: lower-casing A-Z and cutting at the other ASCII characters means the same
there, as every other character has bytes of 0x80 and more only.

The automaton never outgrows a task: items are cut into pieces of at most PIECE words, which overlap by
a window less one, and pieces go to as many automata as keep each near BLOCK words. A task holds one
automaton and one batch of documents at a time; documents are not shuffled. Each further automaton takes a pass of its
own over the written documents, of which rows with hits are kept by number.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starhouse.llm.common import columns_but, quoted, slices, stored

WINDOW = 13
PIECE = 2_000
BLOCK = 200_000
_LOWER = bytes(x + 32 if 65 <= x <= 90 else 32 if x < 48 or 58 <= x <= 96 or 123 <= x <= 127 else x for x in range(256))

RESULT = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
    T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("spans", T.ArrayType(T.StructType([T.StructField("first", T.IntegerType()), T.StructField("last", T.IntegerType())]))),
])


def words_of(text: str | None) -> list[bytes]:
    # UTF-8 has no lone surrogates, so neither has text that Spark hands over.
    return text.encode().translate(_LOWER).split(b" ") if text else []


def words(text: str | None) -> list[bytes]:
    """Words of a text: A-Z in lower case, cut at all ASCII characters but letters and digits."""
    return [x for x in words_of(text) if x]


class Automaton:
    """Suffix automaton of many word sequences, with the items that own each window."""

    def __init__(self, window: int = WINDOW) -> None:
        self.window = window
        self.next: list[dict[bytes, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.owners: dict[int, set[str]] = {}
        self.short: dict[int, list[tuple[int, str]]] = {}

    def _state(self, length: int, following: dict[bytes, int], link: int) -> int:
        self.next.append(following)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _clone(self, p: int, word: bytes, q: int) -> int:
        """The part of q that is reached from p by the longest sequences of p."""
        copy = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = copy
            p = self.link[p]
        self.link[q] = copy
        return copy

    def _extend(self, last: int, word: bytes) -> int:
        q = self.next[last].get(word)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self._clone(last, word, q)
        new = self._state(self.length[last] + 1, {}, 0)
        p = last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][word]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._clone(p, word, q)
        return new

    @classmethod
    def of(cls, pieces: Iterable[tuple[str, bytes]], window: int = WINDOW) -> Automaton:
        """Of (item, its words joined by spaces) pairs. A piece of fewer words than the window is an item's only one."""
        self = cls(window)
        split = [(item, joined.split(b" ")) for item, joined in pieces]
        for _, piece in split:
            last = 0
            for word in piece:
                last = self._extend(last, word)
        for item, piece in split:
            state = 0
            for k, word in enumerate(piece, 1):
                state = self.next[state][word]
                if k >= window:
                    self.owners.setdefault(self._suffix(state, window), set()).add(item)
            if len(piece) < window:
                self.short.setdefault(self._suffix(state, len(piece)), []).append((len(piece), item))
        self.short_of = self._short_suffixes()
        return self

    def _suffix(self, state: int, length: int) -> int:
        """The state of the last ``length`` words of a longer sequence of ``state``."""
        while self.length[self.link[state]] >= length:
            state = self.link[state]
        return state

    def _short_suffixes(self) -> dict[int, list[tuple[int, str]]]:
        """Short items that end each state's sequences."""
        if not self.short:
            return {}
        found: dict[int, list[tuple[int, str]]] = {0: []}
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__):
            found[state] = [*self.short.get(state, ()), *found[self.link[state]]]
        return {state: items for state, items in found.items() if items}

    def spans(self, text: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Hit words as (first, last) runs that neither meet nor touch, and the items whose windows occur."""
        following, link, length, window, short_of = self.next, self.link, self.length, self.window, self.short_of
        root = following[0]
        ends: list[tuple[int, int]] = []
        states: set[int] = set()
        items: set[str] = set()
        state = matched = 0
        for k, word in enumerate(text):
            to = following[state].get(word)
            if to is None:
                while state:
                    state = link[state]
                    to = following[state].get(word)
                    if to is not None:
                        matched = length[state] + 1
                        state = to
                        break
                else:
                    matched = 0
                    to = root.get(word)
                    if to is None:
                        continue
                    state, matched = to, 1
            else:
                state = to
                matched += 1
            if matched >= window:
                states.add(state)
                ends.append((k - window + 1, k))
            if short_of and state in short_of:
                for size, item in short_of[state]:
                    if size <= matched:
                        items.add(item)
                        ends.append((k - size + 1, k))
        for state in states:
            items |= self.owners[self._suffix(state, window)]
        return merged(ends), items


def merged(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, last in sorted(spans):
        if out and first <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], last))
        else:
            out.append((first, last))
    return out


def pieces(benchmark: DataFrame, item: str, text: str, window: int) -> DataFrame:
    """Items as pieces of words: item, piece (number), words (joined), n_words. Items without id or words have none."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = words(value)
                for k, start in enumerate(range(0, max(1, len(found) - window + 1), PIECE)):
                    part = found[start : start + PIECE + window - 1]
                    if part:
                        rows.append((name, k, b" ".join(part), len(part)))
            columns = list(zip(*rows, strict=True)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, kind) for x, kind in zip(columns, (pa.string(), pa.int64(), pa.binary(), pa.int64()), strict=True)],
                names=["item", "piece", "words", "n_words"],
            )

    rows = benchmark.select(quoted(item).cast("string").alias("item"), quoted(text).cast("string").alias("text")).dropna()
    return rows.mapInArrow(cut, "item string, piece long, words binary, n_words long").distinct()


class _Benchmark:
    """The pieces of a benchmark as a written table of ``n`` blocks of about BLOCK words: one automaton's worth each."""

    def __init__(self, benchmark: DataFrame, item: str, text: str, window: int) -> None:
        cut = stored(pieces(benchmark, item, text, window), "pieces")
        total = cut.agg(F.sum("n_words")).first()[0] or 0
        self.n, self.window = max(1, math.ceil(total / BLOCK)), window
        self.pieces = cut.withColumn("block", F.pmod(F.xxhash64("item", "piece"), F.lit(self.n)))

    def block(self, k: int):
        """A broadcast of one block: its size is bounded, and a pass over the documents has only one."""
        rows = self.pieces.filter(F.col("block") == k).select("item", "words").collect()
        return self.pieces.sparkSession.sparkContext.broadcast([(x["item"], bytes(x["words"])) for x in rows])


def _searched(batches: Iterator[pa.RecordBatch], place: int, block, window: int) -> Iterator[tuple]:
    """For each batch: itself, its texts, their numbers of words, hit spans (merged), and items found. One automaton per task."""
    automaton = Automaton.of(block.value, window)
    for batch in slices(batches):
        texts = batch.column(place).to_pylist()
        split = [words(value) for value in texts]
        found = [automaton.spans(own) for own in split]
        yield batch, texts, list(map(len, split)), [merged(hit) for hit, _ in found], [owners for _, owners in found]


_HITS = pa.struct([
    ("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())),
    ("spans", pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))),
])


def _hits(counts: Iterable[int], spans: Iterable, items: Iterable) -> pa.Array:
    return pa.array([
        {"n_words": n, "n_hit": sum(last - first + 1 for first, last in hit), "items": sorted(owners),
         "spans": [{"first": first, "last": last} for first, last in hit]}
        for n, hit, owners in zip(counts, spans, items, strict=True)], _HITS)


def find(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
         window: int = WINDOW) -> DataFrame:
    """``docs`` with a struct ``found``, which replaces a column of that name: n_words; n_hit, its words inside
    any occurrence of a window; items, ids of the items with occurring windows, sorted as strings; spans, the
    runs of hit words by first and last number.

    A window is so many consecutive words of an item; an item of fewer, but not none, is one. A null or empty
    text has no words; null items, and items without id, have no windows. Repeated rows and items count once
    each in their own row; an empty benchmark hits nothing. A benchmark of several blocks takes a pass over the
    written documents for each; what the passes find, rows with hits alone, is put together by the row's number.
    """
    known = _Benchmark(benchmark, item, item_text, window)
    kept = columns_but(docs, ["found"])
    narrow = docs.select(F.struct(*map(quoted, kept)).alias("row"), quoted(text).cast("string").alias("text"))

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, counts, spans, items in _searched(batches, 1, only, window):
            yield pa.RecordBatch.from_arrays([batch.column(0), _hits(counts, spans, items)], names=["row", "found"])

    schema = T.StructType([narrow.schema["row"], T.StructField("found", RESULT)])
    if known.n == 1:
        only = known.block(0)
        return narrow.mapInArrow(match, schema).select("row.*", "found")
    numbered, hits = _passes(narrow, known)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            counts = [len(words(x)) for x in batch.column(1).to_pylist()]
            spans = [merged((x["first"], x["last"]) for x in own or ()) for own in batch.column(2).to_pylist()]
            items = [set(own or ()) for own in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), _hits(counts, spans, items)], names=["row", "found"])

    return numbered.join(hits, "no", "left").select("row", "text", "spans", "items").mapInArrow(count, schema).select("row.*", "found")


def _passes(docs: DataFrame, known: _Benchmark) -> tuple[DataFrame, DataFrame]:
    """``docs``, which have a column text, written with a number for each row, and no, spans and items of rows with hits in any block."""
    numbered = stored(docs.withColumn("no", F.monotonically_increasing_id()), "documents")
    parts = []
    for k in range(known.n):
        block = known.block(k)

        def match(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            for batch, _, _, spans, items in _searched(batches, 1, block, known_window):
                hit = [bool(x) for x in spans]
                found = _hits([0] * len(spans), spans, items)
                columns = [batch.column(0), found.field("spans"), found.field("items")]
                yield pa.RecordBatch.from_arrays(columns, names=["no", "spans", "items"]).filter(pa.array(hit))

        known_window = known.window
        rows = numbered.select("no", "text").mapInArrow(match, "no long, spans array<struct<first: int, last: int>>, items array<string>")
        parts.append(stored(rows, f"hits{k}"))
        block.destroy()  # before the next one comes
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    hits = every.groupBy("no").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("items")).alias("items"))
    return numbered, stored(hits, "hits")


def contaminated(found: str = "found", parts: int = 20):
    """The rule of coverage: a part in ``parts`` of a text's words, or more, is hit."""
    return (F.col(f"{found}.n_hit") > 0) & (parts * F.col(f"{found}.n_hit") >= F.col(f"{found}.n_words"))


def items_digest(found: str = "found"):
    return F.sha2(F.array_join(F.col(f"{found}.items"), ","), 256)


def cut_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """A text without the words of the spans and what stands between them."""
    raw = text.encode()
    flat = raw.translate(_LOWER)
    out, at, k, end = [], 0, 0, 0
    wanted = iter(spans)
    span = next(wanted, None)
    for part in flat.split(b" "):
        if part:
            if span and k == span[0]:
                out.append(raw[at:end])
            if span and k == span[1]:
                at = end + len(part)
                span = next(wanted, None)
            k += 1
        end += len(part) + 1
    return b"".join([*out, raw[at:]]).decode()


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", parts: int = 20, lengths: str | None = None,
          item: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """Documents without benchmark passages, with the columns of ``docs``.

    A document goes if its coverage reaches the limit (see ``contaminated``); of any other, the hit spans
    are cut out of the text, and the column ``lengths``, if named, becomes the new text's number of characters.
    Documents without a hit stay as they are, null and empty texts too. Each text goes to Python once: what is
    found is cut at once. ``text`` is a column of strings.
    """
    known = _Benchmark(benchmark, item, item_text, window)
    place, size = docs.columns.index(text), docs.columns.index(lengths) if lengths else None

    def cleaned(batch: pa.RecordBatch, texts: list, counts: list[int], spans: list) -> pa.RecordBatch:
        hits = [sum(last - first + 1 for first, last in own) for own in spans]
        left = [not n or parts * n < of for n, of in zip(hits, counts, strict=True)]
        columns = list(batch.columns)
        if any(n and kept for n, kept in zip(hits, left, strict=True)):
            new = [cut_spans(value, own) if own and kept else value for value, own, kept in zip(texts, spans, left, strict=True)]
            columns[place] = pa.array(new, columns[place].type)
            if size is not None:
                old = columns[size].to_pylist()
                columns[size] = pa.array([len(x) if own and kept else n for x, own, kept, n in zip(new, spans, left, old, strict=True)], columns[size].type)
        return pa.RecordBatch.from_arrays(columns, schema=batch.schema).filter(pa.array(left))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts, counts, spans, _ in _searched(batches, place, only, window):
            yield cleaned(batch, texts, counts, spans)

    if known.n == 1:
        only = known.block(0)
        return docs.mapInArrow(cut, docs.schema)
    row = F.struct(*map(quoted, docs.columns)).alias("row")
    numbered, hits = _passes(docs.select(row, quoted(text).alias("text")), known)

    def cut_found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column(place).to_pylist()
            spans = [merged((x["first"], x["last"]) for x in own or ()) for own in batch.column(batch.num_columns - 1).to_pylist()]
            own = pa.RecordBatch.from_arrays(batch.columns[:-1], names=docs_columns)
            yield cleaned(own, texts, [len(words(x)) for x in texts], spans)

    docs_columns = docs.columns
    joined = numbered.select("row", "no").join(hits.select("no", "spans"), "no", "left").select("row.*", F.col("spans").alias(max(docs_columns, key=len) + "_spans"))
    return joined.mapInArrow(cut_found, docs.schema)
