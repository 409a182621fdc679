"""Toxicity by a support vector machine with a subsequence string kernel and Nyström landmarks.

*Kernel.* A unit is a word's letters; characters that are no letters are dropped (``i.d.i.o.t``) and single letters in a
row are one unit (``s t u p i d``).  Two units are as similar as they share subsequences of four characters, the word's
ends included, spread over at most seven places; every place left out costs a factor ``DECAY``, so inserted letters
lower the similarity a little and leave it high.  The kernel is divided by norms that depend on the lengths alone.

*Training.* Only whole documents have labels; the machine learns which of their units earn label 1, from a bounded sample.
What a unit's document is labelled says little of a unit found in few; how surely it leans to label 1 is its log likelihood ratio ``e`` between the labels, and it counts
``e / (e + EVIDENCE)`` squared of its documents of label 1 as an example of that label, the rest of all its documents as one of
label 0.  So rare insults count too, the more the more often they are seen, and none is cut off.  The landmarks are the units that
tell the labels apart best, and frequent others.  In the landmarks' space (kernel matrix to the power -1/2) a linear machine with squared
hinge loss separates the examples.  Its weights are folded back: the decision for a unit is the sum of one weight per
subsequence, read from a table, which is the same number as with the landmarks one by one.

*Documents.* The highest unit decisions of a document (the first, the mean of the first three and eight), the logarithm
of its number of units and the sum of positive decisions over the root of that number give its score by a logistic regression on the same sample.  Texts are scored whole.

Bounds of the sample: at most ``SAMPLE`` documents of either label, drawn by a hash of their id, each of at most ``LONGEST`` characters,
together of at most ``SAMPLE_CHARS``; of the units that do not lean to label 1, the ``RARE`` most frequent and as many others drawn by a
hash, which then stand for all of them.  Scoring has no bounds.

Defined cases: a null or empty text is scored as one without units; label rows with null and documents without a label are
not learned from; repeated rows get the same score; an empty table gives an empty result; without labels of both kinds
every score is the share of label 1 (0 if there are none); other columns are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from revmart.llm.common import text_of

SAMPLE = 2000
LONGEST = 1 << 18
SAMPLE_CHARS = 1 << 26
RARE = 6000
LANDMARKS = 256
DECAY = 0.6
REACH = 6
#: Offsets of a subsequence's characters after the first, and its weight.
PATTERNS = [(c, DECAY ** (c[2] - 3)) for c in combinations(range(1, REACH + 1), 3)]
#: Places of the table: one for every four letters of the Latin script, as many shared by those with other letters.
LATIN, TABLE = 1 << 20, 1 << 21
#: Units longer than this are scored in overlapping parts.
PART = 24
STEP_CHARS = 1 << 20
#: Subsequences weighed against all landmarks at a time.
STEP_HITS = 1 << 11
#: Units of which variants with an inserted letter are learned too.
VIRTUAL = 128
TOP = 8
#: Documents of label 1 below which a unit is no example of it.
LITTLE = 0.05
#: Log likelihood ratio at which a quarter of a unit's documents of label 1 count as examples of it.
EVIDENCE = 25.0


@lru_cache(maxsize=1)
def _alphabet() -> np.ndarray:
    """Code of each character: 0 for white space, 1 to 26 for a to z, 27 to 31 for other Latin letters, 32 to 254 for those of other
    scripts, 255 for the rest."""
    out = np.full(1 << 16, 255, np.uint8)
    for c in range(1 << 16):
        ch = chr(c)
        if ch.isspace():
            out[c] = 0
        elif "a" <= ch <= "z":
            out[c] = c - 96
        elif ch.isalpha():
            out[c] = 27 + c % 5 if c < 0x250 else 32 + c % 223
    return out


@dataclass
class Units:
    """``codes``: the units' characters, a 0 before, between and after; starts, lengths and texts of the units."""

    codes: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray
    text: np.ndarray


def _runs(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    inside = np.zeros(len(codes) + 2, np.int8)
    inside[1:-1] = codes > 0
    change = np.diff(inside)
    return np.nonzero(change == 1)[0], np.nonzero(change == -1)[0]


def units(texts: list[str]) -> Units:
    lowered = [t.lower() for t in texts]
    points = np.frombuffer("\n".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.where(points < 1 << 16, _alphabet()[np.minimum(points, (1 << 16) - 1)], 32 + points % 223).astype(np.uint8)
    letters = codes != 255
    begins = np.cumsum([0, *[len(t) + 1 for t in lowered]])
    kept_before = np.concatenate(([0], np.cumsum(letters)))
    begins = kept_before[np.minimum(begins, len(points))]
    codes = codes[letters]
    starts, ends = _runs(codes)
    text = np.searchsorted(begins, starts, "right") - 1
    # Single letters in a row are joined: the white space between them goes.
    joined = np.nonzero((ends[:-1] - starts[:-1] == 1) & (ends[1:] - starts[1:] == 1) & (text[:-1] == text[1:]))[0]
    dropped = np.zeros(len(codes) + 1, np.int32)
    dropped[ends[joined]] += 1
    dropped[starts[joined + 1]] -= 1
    codes = np.where(np.cumsum(dropped[:-1]) > 0, np.uint8(255), codes)
    first = np.ones(len(starts), bool)
    first[joined + 1] = False
    text = text[first]
    is_end = (codes == 0) & np.concatenate(([False], codes[:-1] > 0)) if len(codes) else codes.astype(bool)
    packed = codes[((codes > 0) & (codes < 255)) | is_end]
    packed = np.concatenate((np.zeros(1, np.uint8), packed, np.zeros(1, np.uint8)))
    starts, ends = _runs(packed)
    return Units(packed, starts, ends - starts, text)


def _subsequences(codes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """Per pattern: the first places (of the unit's marker or a character) that it fits, the feature, the weight."""
    n = len(codes)
    wide = codes.astype(np.int32)
    nearest_end = np.full(n, n, np.int32)  # the next marker after each place
    zeros = np.nonzero(codes == 0)[0]
    nearest_end[: zeros[-1]] = zeros[np.searchsorted(zeros, np.arange(zeros[-1]), "right")]
    room = nearest_end - np.arange(n)
    other = codes >= 32 if n and codes.max() >= 32 else None
    for (a, b, c), weight in PATTERNS:
        at = np.nonzero(room >= c)[0]
        at = at[at + c < n]
        feature = wide[at] << 15 | wide[at + a] << 10 | wide[at + b] << 5 | wide[at + c]
        if other is not None:
            first, rest = wide[at].astype(np.uint64), (wide[at + a] << 16 | wide[at + b] << 8 | wide[at + c]).astype(np.uint64)
            mixed = ((first << np.uint64(24) | rest) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)
            fits = other[at] | other[at + a] | other[at + b] | other[at + c]
            feature = np.where(fits, LATIN + mixed.astype(np.int32), feature)
        yield at, feature, weight


def _norms(longest: int) -> np.ndarray:
    """Norm of a unit of each length: root of the squared weights of the patterns that fit."""
    lengths = np.arange(longest + 1)
    squared = sum(w * w * np.maximum(0, lengths + 2 - c[2]) for c, w in PATTERNS)
    return np.sqrt(np.maximum(squared, 1.0))


def unit_decisions(u: Units, table: np.ndarray) -> np.ndarray:
    """Sum of the table's weights over every unit's subsequences, divided by its norm; the highest part of long ones."""
    if not len(u.starts):
        return np.zeros(0)
    n = len(u.codes)
    at_place = np.zeros(n)
    for at, feature, weight in _subsequences(u.codes):
        at_place[at] += weight * table[feature]
    total = np.concatenate(([0.0], np.cumsum(at_place)))
    norms = _norms(PART)
    begin, end = u.starts - 1, u.starts + u.lengths  # with the marker before
    out = (total[end] - total[begin]) / norms[np.minimum(u.lengths, PART)]
    for i in np.nonzero(u.lengths > PART)[0]:
        parts = np.arange(begin[i], end[i], PART // 2)
        out[i] = np.max(total[np.minimum(parts + PART, end[i])] - total[parts]) / norms[PART]
    return out


def _of(words: list[bytes]) -> Units:
    codes = np.frombuffer(b"\0" + b"\0".join(words) + b"\0", np.uint8)
    starts, ends = _runs(codes)
    return Units(codes, starts, ends - starts, np.zeros(len(starts), int))


@dataclass
class Machine:
    """``table``: weight per subsequence; ``bias`` of a unit's decision; ``weights`` of a document's features.

    ``landmarks`` and ``coefficients`` are what the table is folded from.
    """

    table: np.ndarray
    bias: float
    weights: np.ndarray
    landmarks: Sequence[bytes] = ()
    coefficients: np.ndarray | None = None

    def features(self, texts: list[str]) -> np.ndarray:
        u = units(texts)
        decisions = np.maximum(unit_decisions(u, self.table) + self.bias, -1.0)
        cuts = np.searchsorted(u.text, np.arange(len(texts) + 1))
        out = np.full((len(texts), 5), -1.0)
        for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
            best = np.full(TOP, -1.0)
            own = decisions[a:b]
            top = np.sort(np.partition(own, len(own) - TOP)[-TOP:] if len(own) > TOP else own)[::-1]
            best[: len(top)] = top
            out[i] = best[0], best[:3].mean(), best.mean(), np.log1p(b - a), np.maximum(own, 0).sum() / np.sqrt(b - a + 1)
        return out

    def scores(self, texts: list[str]) -> np.ndarray:
        f = self.features(texts)
        return 1 / (1 + np.exp(-np.clip(f @ self.weights[:-1] + self.weights[-1], -30, 30)))


def _newton(x: np.ndarray, y: np.ndarray, weight: np.ndarray, hinge: bool, ridge: float) -> np.ndarray:
    """Weights and bias of a linear machine: squared hinge loss, or logistic; ``y`` is 1 or -1, the last column of ``x`` is 1."""
    w = np.zeros(x.shape[1])
    weighted = np.empty_like(x)
    keep = np.full(x.shape[1], ridge)
    keep[-1] = 1e-6
    for _ in range(30):
        margin = y * (x @ w)
        if hinge:
            slope, curve = -2 * y * np.maximum(0, 1 - margin) * weight, 2.0 * (margin < 1) * weight
        else:
            p = 1 / (1 + np.exp(np.clip(margin, -30, 30)))
            slope, curve = -y * p * weight, np.maximum(p * (1 - p), 1e-6) * weight
        np.multiply(x, curve[:, None], out=weighted)
        step = np.linalg.solve(weighted.T @ x + np.diag(keep), x.T @ slope + keep * w)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def train(texts: list[str], labels: list[int]) -> Machine:
    """Fit the machine on labelled texts (see the module's text)."""
    y = np.array(labels) * 2 - 1
    positive, negative = int((y > 0).sum()), int((y < 0).sum())
    if not positive or not negative:
        share = min(max(positive / max(1, len(y)), 1e-9), 1 - 1e-9)
        return Machine(np.zeros(TABLE, np.float32), 0.0, np.array([0, 0, 0, 0, 0, np.log(share / (1 - share))]))
    seen = {1: Counter(), -1: Counter()}
    for text, label in zip(texts, y.tolist()):
        u = units([text])
        raw = u.codes.tobytes()
        seen[label].update({raw[a : a + n] for a, n in zip(u.starts.tolist(), u.lengths.tolist()) if 2 < n <= PART})
    names = sorted(set(seen[1]) | set(seen[-1]))
    p = np.array([seen[1][w] for w in names], float)
    q = np.array([seen[-1][w] for w in names], float)
    rate_p, rate_q = (p + 0.25) / (positive + 0.5), (q + 0.25) / (negative + 0.5)
    lean = np.log(rate_p / rate_q)
    evidence = np.where(lean > 0, 2 * (p * lean - (p + q) * np.log1p((rate_p - rate_q) / (rate_p + rate_q))), 0.0)
    sure = (np.maximum(evidence, 0) / (np.maximum(evidence, 0) + EVIDENCE)) ** 2
    order = np.argsort(-evidence, kind="stable")
    telling = order[: LANDMARKS // 2].tolist()
    common = [i for i in np.argsort(-q, kind="stable") if lean[i] <= 1][: LANDMARKS - len(telling)]
    chosen = [names[i] for i in [*telling, *common]]
    # Every unit is an example of label 1 as surely as it leans to it, and of label 0 for the rest; of units with little
    # to say for label 1 some stand for all.
    toxic = np.nonzero(p * sure > LITTLE)[0]
    rest = np.argsort(-(p * (1 - sure) + q), kind="stable")
    other = rest[RARE:]
    drawn = other[np.argsort([zlib.crc32(names[i]) for i in other], kind="stable")[:RARE]] if len(other) else other
    stands_for = np.concatenate((np.ones(min(RARE, len(rest))), np.full(len(drawn), len(other) / max(1, len(drawn)))))
    rest = np.concatenate((rest[:RARE], drawn))
    examples = np.concatenate((toxic, rest))
    target = np.concatenate((np.ones(len(toxic)), -np.ones(len(rest))))
    share_1 = p[toxic] * sure[toxic]
    share_0 = (p * (1 - sure) + q)[rest] * stands_for

    marks = _of(chosen)
    columns, inverse, mark_of, weights = _landmark_features(marks)
    matrix = np.zeros((len(columns), len(chosen)))
    np.add.at(matrix, (inverse, mark_of), weights)
    matrix /= _norms(PART)[marks.lengths][None, :]
    lookup = np.full(TABLE, -1, np.int32)
    lookup[columns] = np.arange(len(columns))

    def kernel(words: list[bytes]) -> np.ndarray:
        u = _of(words)
        unit_at = np.searchsorted(u.starts - 1, np.arange(len(u.codes)), "right") - 1
        out = np.zeros((len(words), len(chosen)))
        for at, feature, weight in _subsequences(u.codes):
            known = lookup[feature]
            hit = np.nonzero(known >= 0)[0]
            for a in range(0, len(hit), STEP_HITS):
                some = hit[a : a + STEP_HITS]
                np.add.at(out, unit_at[at[some]], weight * matrix[known[some]])
        return out / _norms(PART)[u.lengths][:, None]

    value, vector = np.linalg.eigh(kernel(chosen) + 1e-6 * np.eye(len(chosen)))
    root = vector / np.sqrt(np.maximum(value, 1e-6)) @ vector.T
    words = [names[i] for i in examples]
    total = max(1e-9, share_1.sum())
    per_example = np.concatenate((share_1 / total, share_0 / max(1e-9, share_0.sum())))
    # Virtual examples: the most telling units with one letter inserted count half as much as the units themselves.
    for i in telling[:VIRTUAL]:
        inserted = _inserted(names[i])
        words += inserted
        target = np.concatenate((target, np.ones(len(inserted))))
        share = 0.5 * p[i] * sure[i] / total / max(1, len(inserted))
        per_example = np.concatenate((per_example, np.full(len(inserted), share)))
    # The examples are held once, in the machine's own rows.
    x = np.ones((len(words), len(chosen) + 1))
    for a in range(0, len(words), 1000):
        x[a : a + 1000, :-1] = kernel(words[a : a + 1000]) @ root
    solved = _newton(x, target, per_example * len(words) / 2, True, 0.1)
    del x
    table = np.zeros(TABLE, np.float32)
    table[columns] = matrix @ (root @ solved[:-1])
    machine = Machine(table, float(solved[-1]), np.zeros(6), chosen, root @ solved[:-1])
    found = np.vstack([machine.features(texts[a : a + 100]) for a in range(0, len(texts), 100)])
    machine.weights = _newton(np.hstack([found, np.ones((len(found), 1))]), y, np.ones(len(y)), False, 0.1)
    return machine


def _inserted(unit: bytes) -> list[bytes]:
    """The unit with one more letter at every inner place; the letter changes from place to place."""
    return [unit[:k] + bytes([1 + (unit[k - 1] + 7 * k) % 26]) + unit[k:] for k in range(1, len(unit))] if len(unit) > 3 else []


def _landmark_features(marks: Units) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    unit_at = np.searchsorted(marks.starts - 1, np.arange(len(marks.codes)), "right") - 1
    found = [(feature, unit_at[at], np.full(len(at), weight)) for at, feature, weight in _subsequences(marks.codes)]
    feature, unit, weight = (np.concatenate(x) for x in zip(*found))
    columns, inverse = np.unique(feature, return_inverse=True)
    return columns, inverse, unit, weight


def is_held_out(doc_id: str = "doc_id", folds: int = 5, fold: int = 0):
    """Whether a row is kept from learning: remainder of the CRC-32 of its id as text."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == fold, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Machine:
    """Train on at most ``sample`` labelled documents of either label, outside the held-out fold.

    The documents are drawn by a hash of their id, so the sample does not depend on the order of the rows.
    """
    usable = labels.select("doc_id", "toxic").where("toxic IN (0, 1) AND doc_id IS NOT NULL").where(~is_held_out())
    one_each = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    parts = [one_each.where(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for k in (0, 1)]
    chosen = parts[0].union(parts[1])
    texts = docs.select("doc_id", text_of().alias("text")).where(F.length("text") <= LONGEST)
    # At most 2 * sample rows to join with, and one text of each: of rows with one id the first in order.
    joined = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    in_order = Window.orderBy(F.xxhash64("doc_id"), "doc_id")
    rows = joined.withColumn("chars", F.sum(F.length("text")).over(in_order)).where(F.col("chars") <= SAMPLE_CHARS).orderBy("doc_id").toArrow()
    return train(rows.column("text").to_pylist(), rows.column("toxic").to_pylist())


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """Every column of ``docs`` and ``toxicity``, a score from 0 to 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(batch.schema.get_field_index("text")).to_pylist()]
            sizes = np.cumsum([len(t) for t in texts]) // STEP_CHARS
            cuts = [0, *(np.nonzero(np.diff(sizes))[0] + 1).tolist(), len(texts)]
            found = [machine.scores(texts[a:b]) for a, b in zip(cuts, cuts[1:]) if b > a]
            column = pa.array(np.concatenate(found) if found else np.zeros(0), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, column], [*batch.schema.names, "toxicity"])

    plain = docs.drop("toxicity")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema.fields)
    return plain.mapInArrow(run, f"{fields}, toxicity double")
