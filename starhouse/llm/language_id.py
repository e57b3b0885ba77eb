"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1, derived from its code point. A letter trigram is the
element-wise product (binding) of its letters' vectors, each rotated by its place. A text is the sum
(bundle) of its trigram vectors, a language the sum of its texts. A text gets the language whose
profile has the largest cosine with it.

Both sums are linear, so a chunk of texts counts its trigrams first and multiplies once by the vectors
of the trigrams that occur in it. Training sends one vector per language and task; nothing is shuffled
by text, language or source, so no key can be hot.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping
from types import MappingProxyType

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starhouse.llm.common import columns_but, quoted, slices

DIMENSIONS = 1024
SEED = 20_240_501
UNKNOWN = "und"
#: Characters that are counted at once; longer texts are cut into overlapping pieces whose counts add up.
CHUNK = 1 << 20
#: Languages that a model may have: profiles are held by every task.
MAX_LANGUAGES = 2000
#: Texts of fewer letters have too few trigrams to be told from noise surely.
SHORT = 16
_SPACE = 32
_PAIR = re.compile(r"[^\W\d_]{2}")


def _letter_vector(code: int) -> np.ndarray:
    bits = np.random.Generator(np.random.PCG64([SEED, code])).integers(0, 2, DIMENSIONS, dtype=np.int8)
    return bits * np.int8(2) - np.int8(1)


def _pieces(text: str) -> Iterator[str]:
    """Pieces that begin with the last two characters, two letters, of the one before: each trigram is in one piece."""
    start = 0
    while len(text) - start > CHUNK + 2:
        pair = _PAIR.search(text, start + CHUNK)
        end = pair.end() if pair else len(text)
        yield text[start:end]
        start = end - 2
    yield text[start:]


class Encoder:
    """Counts letter trigrams of texts and turns counts into vectors."""

    def __init__(self) -> None:
        self.vectors: dict[int, np.ndarray] = {}
        self.letters: dict[int, bool] = {}
        #: Letters of each owner in the last call of ``sums``.
        self.n_letters = np.zeros(0, dtype=np.int64)

    def _alphabet(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Letters among the code points, space first, and each code point's number in that list (0: no letter)."""
        present = np.flatnonzero(np.bincount(codes, minlength=1))
        for code in present.tolist():
            if code not in self.letters:
                self.letters[code] = chr(code).isalpha()
        found = [code for code in present.tolist() if self.letters[code]]
        number = np.zeros(int(present[-1]) + 1 if present.size else 1, dtype=np.int64)
        number[found] = np.arange(1, len(found) + 1)
        return np.array([_SPACE, *found]), number

    def _trigram_vectors(self, alphabet: np.ndarray, grams: np.ndarray) -> np.ndarray:
        for code in alphabet.tolist():
            if code not in self.vectors:
                self.vectors[code] = _letter_vector(code)
        size = len(alphabet)
        last = np.stack([self.vectors[code] for code in alphabet.tolist()])
        bound = np.roll(last, 2, axis=1)[grams // (size * size)]
        bound *= np.roll(last, 1, axis=1)[grams // size % size]
        bound *= last[grams % size]
        return bound.astype(np.float32)

    def sums(self, texts: list[str], owners: list[int], n_owners: int) -> np.ndarray:
        """The bundle of each owner's texts, as n_owners rows."""
        out = np.zeros((n_owners, DIMENSIONS))
        self.n_letters = np.zeros(n_owners, dtype=np.int64)
        chunk: list[str] = []
        of: list[int] = []
        held = 0
        for text, owner in zip(texts, owners, strict=True):
            for piece in _pieces(f" {text.lower()} "):
                if held and held + len(piece) > CHUNK:
                    self._add(out, chunk, of)
                    chunk, of, held = [], [], 0
                chunk.append(piece)
                of.append(owner)
                held += len(piece)
        if chunk:
            self._add(out, chunk, of)
        return out

    def _add(self, out: np.ndarray, pieces: list[str], owners: list[int]) -> None:
        codes = np.frombuffer("".join(pieces).encode("utf-32-le"), dtype=np.uint32)
        alphabet, number = self._alphabet(codes)
        size = len(alphabet)
        if size == 1:
            return
        row, local = np.unique(np.array(owners), return_inverse=True)
        lengths = np.array([len(piece) for piece in pieces])
        letters = number[codes]
        piece_of = np.repeat(np.arange(len(pieces)), lengths)
        self.n_letters += np.bincount(np.array(owners)[piece_of[letters > 0]], minlength=len(self.n_letters))
        # A run of other characters counts as one space.
        kept = letters > 0
        kept[1:] |= letters[:-1] > 0
        kept[0] = True
        kept[1:] |= piece_of[1:] != piece_of[:-1]
        letters, piece_of = letters[kept], piece_of[kept]
        grams = (letters[:-2] * size + letters[1:-1]) * size + letters[2:]
        within = (piece_of[:-2] == piece_of[2:]) & (grams > 0)
        grams, owner = grams[within], local[piece_of[:-2][within]]
        if not grams.size:
            return
        if size**3 <= 1 << 23:
            seen = np.flatnonzero(np.bincount(grams, minlength=size**3))
            place = np.empty(size**3, dtype=np.int64)
            place[seen] = np.arange(len(seen))
            place = place[grams]
        else:
            seen, place = np.unique(grams, return_inverse=True)
        # Blocks of trigrams keep the counts and vectors small, also for scripts with many letters.
        for start in range(0, len(seen), 8192):
            inside = (place >= start) & (place < start + 8192) if len(seen) > 8192 else slice(None)
            width = min(8192, len(seen) - start)
            counts = np.bincount(owner[inside] * width + place[inside] - start, minlength=len(row) * width)
            vectors = self._trigram_vectors(alphabet, seen[start : start + width])
            out[row] += counts.reshape(len(row), width).astype(np.float32) @ vectors


def _bundles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    encoder, totals = Encoder(), {}
    for batch in slices(batches):
        texts, labels = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        names = sorted(set(labels))
        place = {name: k for k, name in enumerate(names)}
        sums = encoder.sums(texts, [place[x] for x in labels], len(names))
        for name, total in zip(names, sums, strict=True):
            totals[name] = totals.get(name, 0) + total
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(totals), pa.string()), pa.array([x.tolist() for x in totals.values()], pa.list_(pa.float64()))],
        names=["lang", "bundle"],
    )


def train(docs: DataFrame, text: str = "text", label: str = "lang") -> dict[str, np.ndarray]:
    """Profiles by language, from all rows that have a text and a label.

    Rows without text or label are left out; repeated rows count as often as they occur. A model of no
    rows is empty. More than MAX_LANGUAGES labels raise an error.
    """
    labelled = docs.select(quoted(text).cast("string").alias("text"), quoted(label).cast("string").alias("label")).dropna()
    parts = labelled.mapInArrow(_bundles, "lang string, bundle array<double>")
    # Sums per language and component: tasks add up before the shuffle, and no vector meets another whole.
    rows = (
        parts.select("lang", F.posexplode("bundle").alias("place", "value"))
        .groupBy("lang", "place").agg(F.sum("value").alias("value"))
        .filter("value != 0").groupBy("lang").agg(F.collect_list(F.struct("place", "value")).alias("cells"))
        .limit(MAX_LANGUAGES + 1).collect()
    )
    if len(rows) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    profiles = {}
    for row in rows:
        profile = np.zeros(DIMENSIONS)
        for cell in row["cells"]:
            profile[cell["place"]] = cell["value"]
        profiles[row["lang"]] = profile
    return dict(sorted(profiles.items()))


def predict(docs: DataFrame, profiles: dict[str, np.ndarray], text: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score, which replace columns of those names.

    score is the cosine with the chosen profile, 0 at least. A text that is null, or has no letter, gets
    ``und`` and 0; so does every text if there are no profiles. Of equally near languages the first by
    code point is chosen. Rows stay as they are, repeated ones and those without an id too.
    """
    languages = sorted(profiles)
    matrix = np.stack([profiles[x] for x in languages]) if languages else np.zeros((0, DIMENSIONS))
    matrix = matrix / np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-30)
    kept = columns_but(docs, ("lang_pred", "score"))
    narrow = docs.select(F.struct(*map(quoted, kept)).alias("row"), quoted(text).cast("string").alias("text"))

    def classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder()
        for batch in slices(batches):
            texts = batch.column(1).to_pylist()
            bundles = encoder.sums([x or "" for x in texts], list(range(len(texts))), len(texts))
            norms = np.linalg.norm(bundles, axis=1)
            known = (norms > 0) & bool(languages)
            cosines = np.round(np.clip(bundles @ matrix.T / np.maximum(norms, 1e-30)[:, None], 0, 1), 9)
            best = cosines.argmax(axis=1) if languages else np.zeros(len(texts), dtype=int)
            names = [languages[k] if yes else UNKNOWN for k, yes in zip(best.tolist(), known.tolist(), strict=True)]
            scores = np.where(known, cosines[np.arange(len(texts)), best], 0.0) if languages else np.zeros(len(texts))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=["row", "lang_pred", "score"],
            )

    schema = T.StructType([narrow.schema["row"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return narrow.mapInArrow(classify, schema).select("row.*", "lang_pred", "score")


def held_out(doc_id: str = "doc_id"):
    """Whether a document is kept from learning: crc32 of its id's text leaves 2 when divided by 4. No id: false."""
    return F.coalesce(F.crc32(quoted(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _nearest(encoder: Encoder, texts: list[str | None], matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cosines of texts with profiles of length 1, and the length class of each text: the bits of its number of letters."""
    bundles = encoder.sums([x or "" for x in texts], list(range(len(texts))), len(texts))
    cosines = bundles @ matrix.T / np.maximum(np.linalg.norm(bundles, axis=1), 1e-30)[:, None]
    return cosines, np.ceil(np.log2(encoder.n_letters + 1)).astype(np.int64)


def _unit_profiles(profiles: dict[str, np.ndarray]) -> np.ndarray:
    matrix = np.stack([profiles[x] for x in sorted(profiles)]) if profiles else np.zeros((0, DIMENSIONS))
    return matrix / np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-30)


def limits(docs: DataFrame, profiles: dict[str, np.ndarray], text: str = "text", label: str = "lang", lost: float = 0.001) -> dict[int, float]:
    """The least cosine that a text of each length class must have with some profile to count as one of the languages.

    It is what all but a part ``lost`` of labelled texts of the class reach with their own profile, to a rank of one in
    10,000 of them; every labelled text counts. Two vectors without relation have a cosine of 0 with a standard deviation
    of 1 / sqrt(DIMENSIONS), so no limit lies below four of these, or two for texts of fewer than SHORT letters, which may
    not reach more. Classes of fewer than 1 / lost texts get that least limit: they do not show so small a part.
    """
    languages = sorted(profiles)
    matrix = _unit_profiles(profiles)
    labelled = docs.select(quoted(text).alias("text"), quoted(label).cast("string").alias("label")).dropna()
    chosen = labelled.filter(F.col("label").isin(languages))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder()
        for batch in slices(batches):
            cosines, size = _nearest(encoder, batch.column(0).to_pylist(), matrix)
            own = [languages.index(x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(size), pa.array(cosines[np.arange(len(own)), own], pa.float64())], names=["size", "cosine"])

    found = chosen.mapInArrow(measure, "size long, cosine double").groupBy("size").agg(
        F.percentile_approx("cosine", lost, 10_000).alias("least"), F.count("*").alias("n"))
    learned = {row["size"]: row["least"] for row in found.filter(F.col("n") * lost >= 1).collect()}
    return {size: max(learned.get(size, 0.0), least_limit(size)) for size in range(1, 65)}


def least_limit(size: int) -> float:
    return (2 if 1 << size <= SHORT else 4) / DIMENSIONS**0.5


def speaks(docs: DataFrame, profiles: dict[str, np.ndarray], least: Mapping[int, float] = MappingProxyType({}), text: str = "text") -> DataFrame:
    """Rows of ``docs``, columns unchanged, whose text is in a known language: its cosine with one of the profiles reaches
    the limit of its length class (see ``limits``; without them, the least limit).

    Null texts and texts without letters go; so does everything if there are no profiles. Repeated rows are judged alike.
    Each text goes to Python once, and whole rows come back. ``text`` is a column of strings.
    """
    matrix, known = _unit_profiles(profiles), dict(least)
    place = docs.columns.index(text)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder()
        for batch in slices(batches):
            if not len(matrix):
                continue
            cosines, size = _nearest(encoder, batch.column(place).to_pylist(), matrix)
            limit = np.array([known.get(x, least_limit(x)) for x in size.tolist()])
            yield batch.filter(pa.array((encoder.n_letters > 0) & (cosines.max(axis=1) >= limit)))

    return docs.mapInArrow(choose, docs.schema)
