"""Toxicity by a subsequence string kernel SVM with Nystroem landmarks.

The kernel compares two words by the four-letter subsequences they share,
each weighted by DECAY to the power of the stretch it spans (SPAN at most), so a gap or an
inserted letter costs a little and not everything.  A text is a bag of words
(letter runs of its sentences; words written with signs or blanks between
their letters are squeezed together) and as toxic as its worst word.

Training is multiple-instance: every sentence of a clean document is clean, a
toxic document has at least one toxic sentence, whose worst word stands for
it.  Landmarks are words that set toxic documents apart, picked by pivoted
Cholesky, and the clean words most like them.  Because the kernel is a sum over
subsequences, the SVM over landmarks folds into one weight for each
subsequence of four letters, and scoring a word is a short sum of table
look-ups.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship_code

#: Letters of a subsequence, the longest stretch it may span, and its weight for each letter of that.
ORDER, SPAN, DECAY = 4, 7, 0.75
#: Labelled documents of each class that the classifier is fitted on (the bound of its sample).
SAMPLE_DOCS = 2000
#: Landmarks from toxic and from clean words; words considered for them.
TOXIC_LANDMARKS, CLEAN_LANDMARKS, CANDIDATES = 128, 48, 400
#: Longer words are read through overlapping windows of this many letters.
LONGEST = 24
#: Clean words in the fit, rounds of choosing witnesses, weight of the regulariser.
CLEAN_WORDS, ROUNDS, RIDGE = 15_000, 3, 1e-3
#: Weight of a blurred insult in the fit, and the letter put in (none that landmarks know).
VARIANT_WEIGHT, FILLER = 1.0, "\u25e6"
#: Share of the toxic documents that a word must occur in to be taken as an insult at the outset.
LEAST_SHARE = 0.012
#: Toxic documents that a word must occur in to be a witness: labels are noisy.
LEAST_WITNESS = 8
#: Loss of balanced accuracy accepted for a lower border when the scores are set.
SLACK = 0.005
#: Weight of all toxic words in the fit, as a share of that of the clean ones.
TOXIC_SHARE = 0.5
#: Words remembered by a task while it scores.
MEMO_WORDS = 400_000
FOLDS = 5

_WORD = re.compile(r"[^\W_]+(?:(?:[^\w\s]|_)+[^\W_]+)*")
_SPACED = re.compile(r"(?<!\w)\w(?:[^\S\n]\w){2,}(?!\w)")
_SIGNS = re.compile(r"[\W_]+")


def words(text: str) -> set[str]:
    """The distinct words of a text's sentences, lower-cased."""
    text = text.lower()
    out = set()
    for w in set(_WORD.findall(text)):
        if w.isalnum():
            out.add(w)
        else:  # joined by signs: the parts, and all of it squeezed
            parts = _SIGNS.split(w)
            out.update(parts)
            out.add("".join(parts))
    for w in _SPACED.findall(text):
        out.add(_SIGNS.sub("", w))
    long = [w for w in out if len(w) > LONGEST]
    for w in long:
        out.remove(w)
        out.update(w[i:i + LONGEST] for i in range(0, len(w) - LONGEST // 2, LONGEST // 2))
    return {w for w in out if len(w) >= ORDER}


class Alphabet:
    """Letters known to the landmarks; all others are one."""

    def __init__(self, letters: str):
        self.letters = letters
        self.size = len(letters) + 1
        self.number = {c: i + 1 for i, c in enumerate(letters)}

    def parts(self, group: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """For words of equal length: the code of each subsequence of ORDER
        letters (rows: words), and each one's weight.  Code 0 holds those with an
        unknown letter."""
        get = self.number.get
        c = np.array([[get(x, 0) for x in w] for w in group], dtype=np.int64)
        at, weight = places(len(group[0]))
        code = np.zeros((len(group), at.shape[1]), dtype=np.int64)
        known = np.ones(code.shape, dtype=bool)
        for letter in at:
            code = code * self.size + c[:, letter]
            known &= c[:, letter] > 0
        return np.where(known, code, 0), weight


_PLACES: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def places(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The places of the letters of each subsequence in a word of ``n``, and its weight."""
    if n not in _PLACES:
        _PLACES[n] = _places(n)
    return _PLACES[n]


def _places(n: int) -> tuple[np.ndarray, np.ndarray]:
    at = [(i, *(i + j for j in rest)) for i in range(n) for rest in combinations(range(1, min(SPAN, n - i)), ORDER - 1)]
    places = np.array(at).T
    return places, DECAY ** (places[-1] - places[0] + 1.0)


def by_length(group: Iterable[str], size: int = 4096) -> Iterator[list[str]]:
    lengths: dict[int, list[str]] = {}
    for w in group:
        lengths.setdefault(len(w), []).append(w)
    for n, same in sorted(lengths.items()):
        step = max(1, size * 84 // places(n)[0].shape[1])
        for at in range(0, len(same), step):
            yield same[at:at + step]


def self_kernel(group: list[str]) -> np.ndarray:
    """K(w, w) for words of equal length, letters compared as they are."""
    c = np.array([[ord(x) for x in w] for w in group], dtype=np.uint64)
    at, weight = places(len(group[0]))
    code = np.zeros((len(group), at.shape[1]), dtype=np.uint64)
    for letter in at:
        code = code * np.uint64(0x9E3779B97F4A7C15) + c[:, letter]
    weight = np.broadcast_to(weight, code.shape)
    order = np.argsort(code, axis=1)
    code, weight = np.take_along_axis(code, order, 1), np.take_along_axis(weight, order, 1)
    total = np.cumsum(weight, axis=1)
    last = np.ones(code.shape, dtype=bool)
    last[:, :-1] = code[:, 1:] != code[:, :-1]
    upto = np.maximum.accumulate(np.where(last, total, 0), axis=1)
    upto = np.hstack([np.zeros((len(group), 1)), upto[:, :-1]])
    return (np.where(last, total - upto, 0) ** 2).sum(axis=1)


def kernel_rows(group: list[str], landmarks: list[str], alphabet: Alphabet) -> np.ndarray:
    """Normalised kernel between words (rows) and landmarks (columns)."""
    number, entries = np.zeros(alphabet.size ** ORDER, dtype=np.int32), [np.zeros(len(landmarks), dtype=np.float32)]
    for col, z in enumerate(landmarks):
        code, weight = alphabet.parts([z])
        norm = math.sqrt(self_kernel([z])[0])
        for x, part in zip(code[0], weight / norm, strict=True):
            if x:
                if not number[x]:
                    number[x] = len(entries)
                    entries.append(np.zeros(len(landmarks), dtype=np.float32))
                entries[number[x]][col] += part
    table = np.array(entries)
    at = {w: i for i, w in enumerate(group)}
    out = np.zeros((len(group), len(landmarks)), dtype=np.float32)
    for same in by_length(group):
        code, weight = alphabet.parts(same)
        entry = number[code]
        row, place = np.nonzero(entry)  # few subsequences are a landmark's
        if len(row):
            shared = table[entry[row, place]] * weight.astype(np.float32)[place, None]
            first = np.flatnonzero(np.diff(row, prepend=-1))
            hit = row[first]
            norm = np.sqrt(self_kernel([same[i] for i in hit])).astype(np.float32)
            out[[at[same[i]] for i in hit]] = np.add.reduceat(shared, first, axis=0) / norm[:, None]
    return out


@dataclass(frozen=True)
class Model:
    """Weights of subsequences, the SVM's bias, and the logistic
    curve from margins to scores."""

    letters: str
    weights: np.ndarray
    bias: float
    slope: float
    centre: float

    def margins(self, group: Iterable[str]) -> dict[str, float]:
        """The margin of each word that is more toxic than no word at all."""
        alphabet = Alphabet(self.letters)
        out: dict[str, float] = {}
        for same in by_length(group):
            code, weight = alphabet.parts(same)
            sums = self.weights[code] @ weight
            more = np.flatnonzero(sums > 1e-12)
            if len(more):
                close = [same[i] for i in more]
                norm = np.sqrt(self_kernel(close))
                out.update(zip(close, (self.bias + sums[more] / norm).tolist(), strict=True))
        return out

    def score(self, margin: float) -> float:
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, self.slope * (margin - self.centre)))))


def _svm(x: np.ndarray, y: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, float]:
    """Linear SVM with squared hinge loss by Newton's method; c: weights of the rows."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], RIDGE)
    ridge[-1] = 1e-9
    for _ in range(30):
        active = y * (x @ w) < 1
        a, b = x[active] * c[active, None], y[active]
        new = np.linalg.solve(x[active].T @ a + np.diag(ridge), a.T @ b)
        if np.allclose(new, w, atol=1e-9):
            break
        w = new
    return w[:-1], float(w[-1])


def _pivots(kernel: np.ndarray, worth: np.ndarray, most: int) -> list[int]:
    """Rows chosen by pivoted Cholesky, the most worth with the most left to
    explain first, until little is left."""
    left, factors, chosen = kernel.diagonal().astype(float), np.zeros((0, len(kernel))), []
    while len(chosen) < most and left.max(initial=0.0) > 0.1:
        p = int((left * worth).argmax())
        f = (kernel[p] - factors[:, p] @ factors) / math.sqrt(left[p])
        factors = np.vstack([factors, f])
        chosen.append(p)
        left = np.maximum(left - f * f, 0)
        left[p] = 0
    return chosen


def _blurred(word: str) -> list[str]:
    """A word with one letter put in or doubled, at every inner place."""
    return [v for at in range(1, len(word)) for v in (word[:at] + FILLER + word[at:], word[:at] + word[at - 1:])]


def fit(bags: list[tuple[int, list[str]]]) -> Model:
    """Train on documents given as (toxic 0/1, words)."""
    toxic = [b for y, b in bags if y]
    clean = [b for y, b in bags if not y]
    if not toxic or not clean:
        return Model("", np.zeros(1), -1.0, 1.0, 0.0)  # nothing to tell apart: every text scores the same, low
    seen, usual = _support(toxic), Counter(w for b in clean for w in b)

    def odds(w: str) -> float:
        return math.log((seen[w] + 0.5) / (len(toxic) + 1)) - math.log((usual[w] + 0.5) / (len(clean) + 1))

    def telling(w: str) -> float:  # odds that hold up with few documents
        return odds(w) - 2.0 / math.sqrt(seen[w])

    candidates = sorted((w for w in seen if seen[w] >= max(4, LEAST_SHARE * len(toxic)) and telling(w) > 1),
                        key=lambda w: (-telling(w) * math.log1p(seen[w]), w))[:CANDIDATES]
    if not candidates:
        return Model("", np.zeros(1), -1.0, 1.0, 0.0)
    letters = Alphabet("".join(sorted({c for w in candidates for c in w})))
    worth = np.array([telling(w) * math.log1p(seen[w]) for w in candidates])
    picked = [candidates[p] for p in _pivots(kernel_rows(candidates, candidates, letters), worth, TOXIC_LANDMARKS)]
    # the clean words by how often they occur, then alphabet: a bounded part of the sample
    pool = sorted(usual, key=lambda w: (-usual[w], zlib.crc32(w.encode())))[:CLEAN_WORDS]
    near = kernel_rows(pool, picked, letters).max(axis=1)
    landmarks = picked + [pool[i] for i in np.argsort(-near, kind="stable")[:CLEAN_LANDMARKS]]
    base = kernel_rows(landmarks, landmarks, letters)
    values, vectors = np.linalg.eigh(base)
    keep = values > 1e-6
    root = (vectors[:, keep] / np.sqrt(values[keep])) @ vectors[:, keep].T
    rows: dict[str, np.ndarray] = {}

    def features(group: list[str]) -> np.ndarray:
        new = [w for w in dict.fromkeys(group) if w not in rows]
        if new:
            rows.update(zip(new, kernel_rows(new, landmarks, letters) @ root, strict=True))
        return np.array([rows[w] for w in group])

    # sentences of toxic documents that hold a telling word are toxic; where a document has
    # none, the sentence that the SVM finds worst
    told = Counter({x: seen[x] for x in candidates if usual[x] == 0 and telling(x) > 1.5})
    rest = [b for b in toxic if not any(x in told for x in b)]
    w, bias = np.zeros(len(landmarks)), 0.0
    for _ in range(ROUNDS):
        group = sorted(told)
        variants = sorted({v for x in group for v in _blurred(x)} - set(usual) - set(group))
        x = features(group + variants + pool)
        y = np.concatenate([np.ones(len(group) + len(variants)), -np.ones(len(pool))])
        c = np.concatenate([[math.sqrt(told[g]) for g in group], np.full(len(variants), VARIANT_WEIGHT),
                            np.ones(len(pool))])
        c[y > 0] *= TOXIC_SHARE * len(pool) / c[y > 0].sum()
        w, bias = _svm(x, y, c)
        margin = Model(letters.letters, _fold(landmarks, root @ w, letters), bias, 1.0, 0.0).margins(
            usual.keys() | {x for b in rest for x in b})
        # clean words on the wrong side of their margin join the fit
        hard = sorted((x for x in usual if margin.get(x, -1.0) > -0.9), key=lambda x: (-margin[x], x))[:CLEAN_WORDS]
        pool += sorted(set(hard) - set(pool))
        for b in rest:
            best = max((x for x in b if x not in usual and seen[x] >= LEAST_WITNESS and margin.get(x, -1.0) > 0),
                       key=lambda x: (margin[x], x), default=None)
            if best is not None:
                told[best] = max(told[best], 1)
    return _calibrate(Model(letters.letters, _fold(landmarks, root @ w, letters), bias, 1.0, 0.0), toxic, clean)


def _fold(landmarks: list[str], beta: np.ndarray, letters: Alphabet) -> np.ndarray:
    """The landmarks' coefficients as one weight for each subsequence."""
    weights = np.zeros(letters.size ** ORDER)
    for z, part in zip(landmarks, beta, strict=True):
        code, weight = letters.parts([z])
        np.add.at(weights, code[0], part * weight / math.sqrt(self_kernel([z])[0]))
    weights[0] = 0
    return weights


def _support(bags: list[list[str]]) -> Counter:
    """In how many documents each word occurs, copies of one document counted
    once: documents are told apart by the smallest hash of their words, twice,
    and the smaller count is taken."""
    counts = []
    for seed in (b"1", b"2"):
        marks: dict[str, set[int]] = {}
        for b in bags:
            mark = min((zlib.crc32(seed + x.encode()) * 0x9E3779B1 % (1 << 32) for x in b), default=0)
            for x in b:
                marks.setdefault(x, set()).add(mark)
        counts.append(Counter({x: len(m) for x, m in marks.items()}))
    return counts[0] & counts[1]


def _calibrate(model: Model, toxic: list[list[str]], clean: list[list[str]]) -> Model:
    """Put the score's middle at the lowest margin that parts the classes as well as
    any other (balanced accuracy, SLACK aside), and let it pass 0.9 halfway from
    there to the median of the toxic documents."""
    margin = model.margins({w for b in toxic + clean for w in b})
    low, high = (np.sort([max((margin.get(w, model.bias) for w in b), default=model.bias) for b in bags])
                 for bags in (clean, toxic))
    at = np.unique(low)
    balance = np.searchsorted(low, at, "right") / len(low) - np.searchsorted(high, at, "right") / len(high)
    centre, middle = float(at[np.flatnonzero(balance >= balance.max() - SLACK)[0]]), float(np.median(high))
    if middle <= centre:
        return model  # not separable: the SVM's own border
    return Model(model.letters, model.weights, model.bias, 2.2 / (0.45 * (middle - centre)),
                 centre + 0.05 * (middle - centre))


def held_out(id_col: Column) -> Column:
    """The fold that is never learned from; false for a null id, which has no label."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          sample_docs: int = SAMPLE_DOCS) -> Model:
    """Fit on at most ``sample_docs`` labelled documents of each class, drawn by a
    hash of their id, none from the held-out fold.  Conflicting labels of one
    document count as toxic; null labels don't count."""
    ship_code(__name__)
    told = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy(
        F.col("doc_id").alias("id")).agg(F.max("toxic").alias("toxic")).filter(~held_out(F.col("id")))
    picked = None
    for y in (0, 1):
        part = told.filter(F.col("toxic") == y).orderBy(F.xxhash64("id"), "id").limit(sample_docs)
        picked = part if picked is None else picked.union(part)
    split = F.arrow_udf(_bag, "array<string>")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(
        F.broadcast(picked), "id")  # at most 2 * sample_docs ids
    return fit([(r.toxic, sorted(r.words)) for r in
                rows.select("id", "toxic", split("text").alias("words")).dropDuplicates(["id"]).orderBy("id").collect()])


def _bag(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        yield pa.array([sorted(words(t or "")) for t in batch.to_pylist()], pa.list_(pa.string()))


def scorer(docs: DataFrame, model: Model):
    """A function from a text column to its score, 0 to 1."""
    ship_code(__name__)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # one table of subsequences

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = sent.value
        known: set[str] = set()
        toxic: dict[str, float] = {}
        for batch in batches:
            out: list[float] = []
            for at in range(0, len(batch), 512):
                bags = [words(t or "") for t in batch.slice(at, 512).to_pylist()]
                new = set().union(*bags) - known
                toxic.update(own.margins(new))
                known |= new
                out += [own.score(max((toxic[w] for w in b if w in toxic), default=own.bias)) for b in bags]
                if len(known) > MEMO_WORDS:
                    known.clear()
                    toxic.clear()
            yield pa.array(out, pa.float64())

    return score


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id_col``, held_out, score, predicted.

    Whole texts of any length; null and empty texts get the score of a text
    without a toxic word.  Only the text is scored.  Repeated rows score alike;
    an empty table gives an empty result; without labels of both classes every
    score is the same, below 0.5.
    """
    score = scorer(docs, train(docs, labels, id_col, text_col))
    scored = docs.select(F.col(id_col).alias(id_col), held_out(F.col(id_col)).alias("held_out"),
                         score(F.col(text_col)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
