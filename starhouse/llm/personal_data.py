"""Personal data: fixed patterns, and boosted trees over candidates that looser generators propose.

Base spans are what four patterns and their checks accept (e-mail, IP address, card number, phone
number). Generators of high recall propose more, overlapping spans: other separators, missing plus
signs, spelt-out or bracketed parts, IPv6. Which of those are personal data nobody has labelled, so they teach nothing.
What teaches is made of accepted matches, each in its own context: positives are the match written in loose forms,
negatives are loose forms that a check fails (Luhn, octets, numbers of digits and labels), and matches of the patterns that
failed theirs. Features describe what a span says once its writing is undone; the signs that set the base patterns
apart (plus, at sign, dots) are hidden from them. A quarter of the documents is kept from fitting and sets each kind's
threshold: the lowest score from which on candidates have the wanted precision there. A kind without SUPPORT positives
there adds nothing. Added spans do not overlap base spans or each other.

Every document teaches. Lessons of equal binned features are one counted cell; trees grow level by level on sums over all
cells, which tasks add up. Finding is map-only. Patterns need time in proportion to the text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starhouse.llm.common import columns_but, quoted, slices, stored

KINDS = ("email", "ip", "card", "phone")
PRECISION = 0.98
#: Parts of one that sums of slopes are added up in, whole numbers that need no order; and scores that thresholds are told apart by.
UNIT, SCORES = 1 << 24, 1 << 16
#: Positives at or above a threshold that the kept part must have to count as evidence.
SUPPORT = 8
TREES, DEPTH, BINS, RATE, SMOOTH = 40, 3, 32, 0.2, 1.0

Span = tuple[str, int, int]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_AT_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
# At least 14 digits: a chain is found from its first digit on, so shorter ones cannot hide a longer one.
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9]){13,}")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_ANY = re.compile(r"[0-9@]")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def _byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and part <= "255"


def luhn(digits: str) -> bool:
    total = 0
    for k, x in enumerate(reversed(digits)):
        x = int(x) << (k & 1)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Accepted matches of the patterns, by start, then kind as in KINDS."""
    out: list[tuple[int, int, int]] = []
    if not _ANY.search(text):
        return []
    end = 0
    for m in _AT_DOMAIN.finditer(text) if "@" in text else ():
        first = at = m.start()
        while first > end and text[first - 1] in _LOCAL:
            first -= 1
        if first < at:
            end = m.end()
            out.append((first, 0, end))
    for m in _IP.finditer(text):
        if all(map(_byte, m.group().split("."))):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text) if "+" in text else ():
        if 10 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
            out.append((m.start(), 3, m.end()))
    return [(KINDS[kind], first, last) for first, kind, last in sorted(out)]


# Parts have bounded lengths, so that a failing try costs little. A candidate may be any of several kinds.
_LABEL = r"[a-z0-9](?:[a-z0-9-]{0,61}[a-z0-9])?"
_MARKED_AT = r"(?:\s?[\[({<]\s?(?:at|@)\s?[\])}>]\s?|\s?@\s?)"
_MARKED_DOT = r"\s?[\[({<]\s?(?:dot|\.)\s?[\])}>]\s?|\s+dot\s+"
_BYTE_DOT = r"(?:\s?[\[({]\s?(?:\.|dot)\s?[\])}]\s?|\.|\s\.\s|\s+dot\s+)"
_GENERATORS = [(kind, re.compile(pattern, re.IGNORECASE)) for kind, pattern in (
    ("email", rf"(?<![\w.%+-])[\w.%+-]{{1,64}}{_MARKED_AT}{_LABEL}(?:(?:{_MARKED_DOT}|\s?\.\s?){_LABEL}){{1,5}}"),
    # A bare "at" is a word like others: only spelt-out or bracketed dots make it an address.
    ("email", rf"(?<![\w.%+-])[\w.%+-]{{1,64}}\s+at\s+{_LABEL}(?:(?:{_MARKED_DOT}){_LABEL}){{1,5}}"),
    ("ip", rf"(?<![\d.])\d{{1,3}}(?:{_BYTE_DOT}\d{{1,3}}){{3}}(?![\d.]?\d)"),
    ("ip", r"(?<![0-9a-z:])(?:[0-9a-f]{1,4}:){4,7}[0-9a-f]{1,4}(?![0-9a-z:])"),
    ("card", r"(?<!\d)\d(?:[ ._/-]{0,2}\d){12,18}(?!\d)"),
    ("phone", r"(?<![\w+.])(?:\+|00)?\(?\d(?:[ ()./-]{0,3}\d){6,14}(?![ ()./-]{0,3}\d|\w)"),
)]
_NEEDS = {
    "email": re.compile(r"@|[\[({<]\s?at\b|\bdot\b", re.IGNORECASE), "ip": re.compile(r"[0-9a-f]{1,4}(?:[:.\[({]|\s\.|\s+dot)", re.IGNORECASE),
    "card": re.compile(r"\d"), "phone": re.compile(r"\d"),
}
_MAY = re.compile(r"[0-9@]|[\[({<]\s?at\b|\bdot\b", re.IGNORECASE)
_WORDS = {
    "email": re.compile(r"mail|contact|write|courriel|correo"), "ip": re.compile(r"\bip|host|addr|server|client"),
    "card": re.compile(r"card|visa|master|credit|karte|carte|tarjeta"), "phone": re.compile(r"tel|phone|call|fax|mobil|handy"),
}
_AT_SIGN, _DOT_SIGN = re.compile(rf"{_MARKED_AT}|\s+at\s+", re.IGNORECASE), re.compile(rf"{_MARKED_DOT}|\s?\.\s?", re.IGNORECASE)
_LETTERS = re.compile(r"[^a-z]+")
_DATE = re.compile(r"(?:19|20)\d\d[-./ ][01]?\d[-./ ][0-3]?\d|[0-3]?\d[-./][01]?\d[-./](?:19|20)\d\d")
#: Characters of its document that a made candidate is read in, on each side.
CONTEXT = 40


def candidates(text: str) -> list[tuple[str, int, int, list[float]]]:
    """Proposed spans with features; no two of one kind are the same span."""
    if not _MAY.search(text):
        return []
    found = {}
    for kind, pattern in _GENERATORS:
        if _NEEDS[kind].search(text):
            for m in pattern.finditer(text):
                found.setdefault((kind, m.start(), m.end()), None)
    return [(*span, _features(text, *span)) for span in sorted(found)]


def _features(text: str, kind: str, first: int, last: int) -> list[float]:
    """What a span says and where it stands, but not in which signs it is written."""
    span = text[first:last]
    digits = _NOT_DIGIT.sub("", span)
    groups = [x for x in _NOT_DIGIT.split(span) if x]
    own: list[float]
    if kind == "email":
        local, _, domain = _AT_SIGN.sub("@", span, count=1).partition("@")
        labels = _DOT_SIGN.sub(".", domain).lower().split(".")
        final = labels[-1]
        own = [
            float(len(labels)), float(len(final)), float(final.isalpha()), float(len(local)), float(max(map(len, labels))),
            float(local.strip("._%+-") == local), float(any(x.isdigit() for x in local)), 0.0]
    elif kind == "ip" and ":" in span:
        parts = span.split(":")
        own = [float(len(parts)), float(max(map(len, parts))), float(bool(_LETTERS.sub("", span.lower()))), 1.0, float(min(map(len, parts))), 0.0, 0.0, 0.0]
    elif kind == "ip":
        own = [float(len(groups)), float(max(map(len, groups))), 0.0, float(all(map(_byte, groups))),
               float(sum(len(x) > 1 and x[0] == "0" for x in groups)), float(groups[0] == "0"), 0.0, 0.0]
    else:
        separators = [x for x in re.split(r"\d+", span) if x]
        own = [
            float(luhn(digits)), float(len(groups)), float(max(map(len, groups))), float(min(map(len, groups))),
            float(len(set(separators))), float(bool(_DATE.search(span))), float(len(set(digits))), float(span.count("(") == span.count(")"))]
    before, after = text[first - 1 : first] if first else "", text[last : last + 1]
    near = text[max(0, first - 32) : first].lower()
    around = text[max(0, first - 20) : first] + text[last : last + 20]
    return [
        *[float(kind == x) for x in KINDS], *own, float(len(digits)), float(before.isalnum()), float(after.isalnum()),
        float(bool(_WORDS[kind].search(near))), sum(x.isdigit() for x in around) / max(1, len(around)),
    ]


def _grouped(digits: str, sizes: tuple[int, ...], sign: str) -> str:
    out, at = [], 0
    for size in sizes:
        out.append(digits[at : at + size])
        at += size
    return sign.join(x for x in [*out[:-1], digits[at - sizes[-1] :]] if x)


def loose_forms(kind: str, match: str) -> list[tuple[str, bool]]:
    """An accepted match written otherwise (true), and forms of it that fail a check (false)."""
    spice = hashlib.blake2b(match.encode(), digest_size=32).hexdigest()
    draw = int(spice, 16)
    if kind == "email":
        local, domain = match.split("@", 1)
        labels = domain.split(".")
        ways = [(" [at] ", " dot "), (" (at) ", "."), ("(at)", "(dot)"), (" at ", " dot "), (" @ ", " . "), (" [at] ", " [dot] "), ("[@]", "[.]"), (" at ", " [dot] ")]
        good = [(f"{local}{at}{dot.join(labels)}", True) for at, dot in ways]
        bad = [labels[:-1] + [str(draw % 97)], labels[:-1] + [labels[-1][0]], labels[:-1] + [spice[:24].translate(str.maketrans("0123456789", "ghijklmnop"))], labels[:-1] + [labels[-1] + "1"]]
        return good + [(f"{local}{at}{dot.join(x)}", False) for x, (at, dot) in zip(bad * 2, ways, strict=True)]
    if kind == "ip":
        parts = match.split(".")
        signs = ["[.]", "(.)", " . ", " dot ", "[dot]"]
        groups = [spice[4 * k : 4 * k + 4] for k in range(8)]
        wrong = [*parts[:3], str(256 + draw % 700)]
        return [(sign.join(parts), True) for sign in signs] + [(":".join(groups), True), (":".join(x.lstrip("0") or "0" for x in groups), True)] + [
            (sign.join(wrong), False) for sign in signs] + [
            (":".join(x[:2] for x in groups[:6]), False), (":".join(str(int(x, 16) % 60).zfill(2) for x in groups[:5]), False)]
    digits = _NOT_DIGIT.sub("", match)
    if kind == "card":
        wrong = digits[:-1] + str((int(digits[-1]) + 1 + draw % 9) % 10)
        ways = [((4, 4, 4, len(digits) - 12), x) for x in (".", "/", "_", "  ", " . ")] + [((len(digits),), "")]
        return [(_grouped(digits, sizes, x), True) for sizes, x in ways[:-1]] + [(_grouped(wrong, sizes, x), False) for sizes, x in ways]
    area, rest = digits[: 2 + draw % 2], digits[2 + draw % 2 :]
    halves = (3, len(rest) // 2 - 1, len(rest))
    good = [f"00{area} {_grouped(rest, halves, ' ')}", f"0{area} {_grouped(rest, (4, len(rest) - 4), ' ')}", f"(0{area}) {_grouped(rest, (4, len(rest) - 4), '-')}",
            f"0{area}/{rest}", _grouped(digits, (3, 3, len(digits) - 6), "-"), f"({digits[:3]}) {_grouped(digits[3:], (3, len(digits) - 6), '-')}", f"{area} {_grouped(rest, halves, ' ')}"]
    day = f"20{draw % 30:02}-{1 + draw // 7 % 12:02}-{1 + draw // 11 % 28:02}"
    bad = [digits, digits[:7], _grouped(digits[:7], (3, 4), " "), day, f"{day} {draw // 13 % 24:02}", f"{day[8:]}.{day[5:7]}.{day[:4]}",
           f"{digits[:2]} {digits[2:5]} {digits[5:8]}", f"{digits[:4]} {digits[4:6]} {digits[6:8]}"]
    return [(x, True) for x in good] + [(x, False) for x in bad]


def _failed(text: str, accepted: list[Span]) -> list[Span]:
    """Matches of the base patterns that a check turned down."""
    out = [("ip", m.start(), m.end()) for m in _IP.finditer(text)]
    out += [("card", m.start(), m.end()) for m in _CARD.finditer(text)]
    out += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text)] if "+" in text else []
    return [x for x in out if not _touches(x, accepted)]


def lessons(text: str) -> list[tuple[str, int, bool, list[float]]]:
    """Kind, place, whether it is personal data, and features of what a text teaches."""
    if not _ANY.search(text):
        return []
    out = []
    base = base_spans(text)
    for kind, first, last in base:
        before, after = text[max(0, first - CONTEXT) : first], text[last : last + CONTEXT]
        for form, good in loose_forms(kind, text[first:last]):
            made = before + form + after
            for found, a, b, features in candidates(made):
                # A good form counts where the candidate is all of it; one that fails, wherever a candidate meets it.
                if found == kind and (a == len(before) and b == len(before) + len(form) if good else a < len(before) + len(form) and b > len(before)):
                    out.append((kind, first, good, features))
    failed = _failed(text, base)
    if failed:
        out += [(kind, a, False, features) for kind, a, b, features in candidates(text) if any(x[0] == kind and x[1:] == (a, b) for x in failed)]
    return out


@dataclass
class Trees:
    """Boosted trees of fixed depth over binned features, for a logistic loss."""

    cuts: list[np.ndarray] = field(default_factory=list)
    start: float = 0.0
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(cut, x[:, k], side="left") for k, cut in enumerate(self.cuts)], axis=1)

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        self.cuts = [_cuts(*np.unique(col, return_counts=True)) for col in x.T]
        binned, n = self._binned(x), np.ones(len(y), dtype=np.int64)
        return self.grow(float(y.sum()), len(y), lambda *level: self.sums(binned, y * n, n, *level))

    def grow(self, positives: float, n: int, sums: Callable[[np.ndarray, np.ndarray, int], np.ndarray]) -> Trees:
        """Trees for ``n`` rows with so many positives; ``sums(feature, at, depth)`` gives what :meth:`sums` does over all of them."""
        share = (positives + 0.5) / (n + 1)
        self.start = float(np.log(share / (1 - share)))
        for _ in range(TREES):
            feature, at = np.zeros(2**DEPTH - 1, dtype=int), np.full(2**DEPTH - 1, BINS)
            for depth in range(DEPTH):
                g, h = sums(feature, at, depth) / UNIT
                left = self._split(g, h, feature[2**depth - 1 :], at[2**depth - 1 :])
            # A last level's node parts into two leaves; one without a split has all its rows in the left.
            slope, bend = (np.stack([part, whole - part], axis=1).ravel() for part, whole in zip(left, (g[:, 0].sum(axis=1), h[:, 0].sum(axis=1)), strict=True))
            self.trees.append((feature, at, slope / (bend + SMOOTH) * RATE))
        return self

    def sums(self, binned: np.ndarray, positives: np.ndarray, n: np.ndarray, feature: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
        """Slopes and bends of the loss by node of a level, feature and bin, in whole UNITs: (2, nodes, features, BINS).

        Rows stand for ``n`` each, of which ``positives`` are positive.
        """
        p = self._probability(binned)
        parts = [np.rint(x * UNIT).astype(np.int64) for x in (positives - n * p, n * p * (1 - p))]
        node, rows = np.zeros(len(n), dtype=int), np.arange(len(n))
        for _ in range(depth):
            node = 2 * node + 1 + (binned[rows, feature[node]] > at[node])
        out = np.zeros((2, 2**depth, binned.shape[1], BINS), dtype=np.int64)
        for k in range(binned.shape[1]):
            for total, part in zip(out, parts, strict=True):
                np.add.at(total, (node - (2**depth - 1), k, binned[:, k]), part)
        return out

    @staticmethod
    def _split(g: np.ndarray, h: np.ndarray, feature: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The best feature and bin of each node of a level, and the sums of what goes to the left; rows with a larger bin go to the right."""
        g, h = g.cumsum(axis=2), h.cumsum(axis=2)
        total_g, total_h = g[:, :, -1:], h[:, :, -1:]
        gain = g**2 / (h + SMOOTH) + (total_g - g) ** 2 / (total_h - h + SMOOTH) - total_g**2 / (total_h + SMOOTH)
        nodes, where = np.arange(len(g)), gain.reshape(len(g), -1).argmax(axis=1)
        k, cut = np.divmod(where, BINS)
        better = gain[nodes, k, cut] > 1e-9
        feature[: len(g)][better], at[: len(g)][better] = k[better], cut[better]
        cut[~better] = BINS - 1
        return g[nodes, k, cut], h[nodes, k, cut]

    def probability(self, x: np.ndarray) -> np.ndarray:
        return self._probability(self._binned(x))

    def _probability(self, binned: np.ndarray) -> np.ndarray:
        rows = np.arange(len(binned))
        score = np.full(len(binned), self.start)
        for feature, at, value in self.trees:
            node = np.zeros(len(binned), dtype=int)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (binned[rows, feature[node]] > at[node])
            score += value[node - (2**DEPTH - 1)]
        return 1 / (1 + np.exp(-score))


def _cuts(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Bounds of bins that hold about as many rows each; ``values`` are sorted and occur as often as ``counts`` says."""
    places = np.floor(np.linspace(0, 1, BINS)[1:-1] * (counts.sum() - 1))
    return np.unique(values[np.searchsorted(counts.cumsum(), places, side="right")])


@dataclass
class Model:
    trees: Trees | None
    thresholds: dict[str, float]

    def added(self, text: str, base: list[Span]) -> list[Span]:
        """Candidates whose score reaches their kind's threshold: the best first, none over another or a base span."""
        if not self.thresholds:
            return []
        open_ones = [x for x in candidates(text) if x[0] in self.thresholds and not _touches(x, base)]
        if not open_ones:
            return []
        scores = self.trees.probability(np.array([x[3] for x in open_ones])).tolist()
        chosen: list[Span] = []
        for score, (kind, first, last, _) in sorted(zip(scores, open_ones, strict=True), key=lambda x: (-x[0], x[1][:3])):
            if score >= self.thresholds[kind] and not _touches((kind, first, last), chosen):
                chosen.append((kind, first, last))
        return chosen


def _touches(span, others: list[Span]) -> bool:
    return any(span[1] < last and first < span[2] for _, first, last in others)


def in_order(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def learn(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", precision: float = PRECISION) -> Model:
    """A model from what all documents teach. A quarter of them, by a hash of id and text, sets thresholds. Null and empty
    texts teach nothing, and of a table without base matches no kind has a threshold.

    The driver sees counts of each feature's values, sums by node, feature and bin, and counts by score: none grows with the rows.
    """

    def teach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = [
                (kept, kind, good, features)
                for kept, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
                for kind, _, good, features in lessons(value)
            ]
            columns = list(zip(*rows, strict=True)) or [()] * 4
            kinds = (pa.bool_(), pa.string(), pa.bool_(), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(columns, kinds, strict=True)], names=["kept", "kind", "good", "features"])

    kept = F.shiftright(F.xxhash64(quoted(doc_id).cast("string"), quoted(text)), 20).bitwiseAND(F.lit(3)) == 0
    rows = docs.select(kept.alias("kept"), quoted(text).cast("string").alias("text")).filter("text != ''")
    taught = rows.mapInArrow(teach, "kept boolean, kind string, good boolean, features array<double>")
    counted = stored(taught.groupBy("kept", "kind", "features").agg(
        F.count("*").alias("n"), F.count_if("good").alias("positives")), "lessons")
    totals = {x["kept"]: x for x in counted.groupBy("kept").agg(F.sum("n").alias("n"), F.sum("positives").alias("positives")).collect()}
    fitted = totals.get(False)
    if fitted is None or fitted["positives"] in (0, fitted["n"]):
        return Model(None, {})
    values = counted.filter("not kept").select("n", F.posexplode("features").alias("feature", "value")).groupBy("feature", "value").agg(
        F.sum("n").alias("n")).orderBy("feature", "value").toPandas()
    trees = Trees([_cuts(x["value"].to_numpy(), x["n"].to_numpy()) for _, x in values.groupby("feature")])

    def put_in_bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4096):
            codes = trees._binned(_matrix(batch.column(2).flatten(), batch.num_rows)).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in (0, 1)), pa.array([x.tobytes() for x in codes], pa.binary()), *(batch.column(k) for k in (3, 4))],
                                             names=["kept", "kind", "bins", "n", "positives"])

    binned = counted.mapInArrow(put_in_bins, "kept boolean, kind string, bins binary, n long, positives long")
    cells = stored(binned.groupBy("kept", "kind", "bins").agg(F.sum("n").alias("n"), F.sum("positives").alias("positives")), "cells")
    fit_on = cells.filter("not kept").select("bins", "n", "positives")

    def sums(feature: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
        shape = (2, 2**depth, len(trees.cuts), BINS)

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(shape, dtype=np.int64)
            for batch in slices(batches, 1 << 14):
                total += trees.sums(_codes(batch.column(0)), batch.column(2).to_numpy(), batch.column(1).to_numpy(), feature, at, depth)
            place = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(total.ravel()[place])], names=["place", "part"])

        out = np.zeros(shape, dtype=np.int64)
        added = fit_on.mapInArrow(add, "place long, part long").groupBy("place").agg(F.sum("part").alias("part")).toPandas()
        out.ravel()[added["place"].to_numpy()] = added["part"].to_numpy()
        return out

    trees.grow(fitted["positives"], fitted["n"], sums)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1 << 14):
            reached = np.floor(trees._probability(_codes(batch.column(1))) * SCORES).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(reached), *(batch.column(k) for k in (2, 3))], names=["kind", "score", "n", "positives"])

    scored = cells.filter("kept").select("kind", "bins", "n", "positives").mapInArrow(score, "kind string, score long, n long, positives long").groupBy("kind", "score").agg(
        F.sum("n").alias("n"), F.sum("positives").alias("positives")).toPandas()
    thresholds = {}
    for kind in KINDS:
        mine = scored[scored["kind"] == kind]
        if (least := _threshold(mine["score"].to_numpy() / SCORES, mine["positives"].to_numpy(), precision, mine["n"].to_numpy())) is not None:
            thresholds[kind] = least
    return Model(trees, thresholds)


def _matrix(values: pa.Array, rows: int) -> np.ndarray:
    return values.to_numpy(zero_copy_only=False).reshape(rows, -1)


def _codes(bins: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(bins.to_pylist()), dtype=np.uint8).reshape(len(bins), -1) if len(bins) else np.zeros((0, 1), dtype=np.uint8)


def _threshold(score: np.ndarray, known: np.ndarray, precision: float, n: np.ndarray | None = None) -> float | None:
    """The lowest score from which on the share of positives is ``precision``. Entries stand for ``n`` rows, or one, ``known`` of them positive."""
    order = np.argsort(-score, kind="stable")
    score, hits = score[order], known[order].cumsum()
    count = np.arange(1, len(score) + 1) if n is None else n[order].cumsum()
    # Only where the next score is lower does a threshold divide the candidates.
    ends = np.append(score[1:] < score[:-1], True) if len(score) else np.zeros(0, dtype=bool)
    good = np.flatnonzero(ends & (hits >= precision * count) & (hits >= SUPPORT))
    return float(score[good[-1]]) if good.size else None


FOUND = T.StructType([
    T.StructField(name, T.ArrayType(T.StructType([
        T.StructField("kind", T.StringType()), T.StructField("first", T.LongType()), T.StructField("last", T.LongType())])))
    for name in ("base", "spans")
])
_FOUND = pa.struct([(name, pa.list_(pa.struct([("kind", pa.string()), ("first", pa.int64()), ("last", pa.int64())]))) for name in ("base", "spans")])


def detect(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with a struct ``found``, which replaces a column of that name: base, and spans (base and added ones),
    each by start and kind, with the first character's number and the number after the last.

    A null or empty text has no spans. Repeated rows stay and have equal spans.
    """
    kept = columns_but(docs, ["found"])
    narrow = docs.select(F.struct(*map(quoted, kept)).alias("row"), quoted(text).cast("string").alias("text"))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        named = lambda spans: [{"kind": kind, "first": first, "last": last} for kind, first, last in spans]
        for batch in slices(batches):
            rows = []
            for value in batch.column(1).to_pylist():
                base = base_spans(value or "")
                rows.append({"base": named(base), "spans": named(in_order(base + model.added(value or "", base)))})
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, _FOUND)], names=["row", "found"])

    return narrow.mapInArrow(find, T.StructType([narrow.schema["row"], T.StructField("found", FOUND)])).select("row.*", "found")


def listed(spans: Column) -> Column:
    """kind:first:last, joined by commas."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["first"], x["last"])), ",")


def count_of(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("long")


def redact(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs``, columns unchanged, with ``[KIND]`` in the place of each span; of overlapping spans the first to start names the whole.

    Null and empty texts stay. Each text goes to Python once. ``text`` is a column of strings.
    """
    place = docs.columns.index(text)

    def blank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = []
            for value in batch.column(place).to_pylist():
                base = base_spans(value or "")
                parts, at = [], 0
                for kind, first, last in in_order(base + model.added(value or "", base)):
                    if first >= at:
                        parts += [value[at:first], f"[{kind.upper()}]"]
                    at = max(at, last)
                texts.append("".join([*parts, value[at:]]) if parts else value)
            columns = list(batch.columns)
            columns[place] = pa.array(texts, columns[place].type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(blank, docs.schema)
