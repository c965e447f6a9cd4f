"""Benchmark decontamination by q-gram lemma filtering.

Benchmark items are cut into overlapping windows of code points: long ones, and
short ones at a small stride, so that every verbatim run of ``SHORT + SHORT_STRIDE
- 1`` characters of an item holds a whole window, wherever it begins.  A stretch of
a document within ``e`` edits of a window of length ``m`` shares at least
``m + 1 - q - q * e`` of its q-grams, on diagonals (document position minus
window position) that differ by at most ``e``.  So shared q-grams are counted
in overlapping bands of diagonals, bands that reach that number are regions,
and a banded alignment of window and region decides.

The benchmark is the stated query set: it goes to the tasks in blocks of about
``BLOCK_CHARS`` characters, and every document meets every block, in a pass of
its own for each, so that a task holds one block at a time.  Documents never
move in a pass: each is without a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_IDS, cut, ship_code, small_side, tidy

#: Characters of a q-gram, of a window and between windows; edits allowed per character.
Q, WINDOW, STRIDE, RATE = 8, 100, 50, 0.1
#: The same of the short windows.
SHORT, SHORT_STRIDE = 50, 10
#: Characters of the benchmark that a task holds at a time.
BLOCK_CHARS = 1_000_000
#: Characters of documents examined together in a task, and texts taken from a batch at a time.
CHUNK_CHARS, TEXTS = 1 << 19, 256
SLOT_BITS = 22
#: No code point; diagonals of a unit (those of a long window's band at least) and counters of units.
OUTSIDE, UNIT, COUNTER_BITS = 0x110000, 2 * (WINDOW // 10 + 1), 20
#: A q-gram that some window holds more often is repetitive, and fewest other q-grams that
#: the ordinary search of a window needs; pairs and bands that are looked at together.
OFTEN, LEAST, PAIRS, BANDS = 3, 3, 2_000_000, 200_000
#: Most windows of an item that hold the same q-gram.
COVER = WINDOW // STRIDE + SHORT // SHORT_STRIDE + 2
#: Bits for a start in an alignment's values; regions aligned together, and looked at together before
#: that; characters between looks at their edits.
BITS, ALIGNED, TOGETHER, ROWS = 20, 20_000, 4000, 12
LEAK = "struct<item_id:long,start:int,end:int,edits:int,windows:int>"


def _fold_table() -> np.ndarray:
    """Lower case (where it is one character) and one kind of white space, for
    the first 65,536 code points; positions stay as they are."""
    table = np.arange(65536, dtype=np.uint32)
    for c in range(65536):
        low = chr(c).lower() if not 0xD800 <= c < 0xE000 else chr(c)
        table[c] = 32 if chr(c).isspace() else ord(low) if len(low) == 1 else c
    return table


def codes(text: str, table: np.ndarray) -> np.ndarray:
    """The folded code points of a text."""
    raw = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    low = raw < 65536
    return table[raw] if low.all() else np.where(low, table[np.minimum(raw, 65535)], raw)


def _wordy(point: int) -> bool:
    return chr(point).isalnum()


def gram_hashes(c: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the eight code points from each position on."""
    h, base = c.astype(np.uint64), 0x9E3779B97F4A7C15
    for step in (1, 2, 4):
        h = h[:-step] * np.uint64(base) + h[step:] if len(h) > step else h[:0]
        base = base * base % (1 << 64)
    return h ^ (h >> np.uint64(29))


def cuts(n: int) -> list[tuple[int, int]]:
    """Start and end of the windows of an item of ``n`` characters."""
    return sorted({(at, min(at + size, n)) for size, stride in ((WINDOW, STRIDE), (SHORT, SHORT_STRIDE))
                   for at in [*range(0, max(1, n - size), stride), max(0, n - size)]})


def edits_allowed(m: int, rate: float = RATE) -> int:
    """Edits for a window of ``m`` characters; short ones get so few that they
    still must share a q-gram."""
    return max(0, min(int(rate * m), (m - Q) // Q))


def align(windows: np.ndarray, text: np.ndarray, low: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """Banded alignment of many windows (rows of equal length) with any stretch
    of ``text``, on the ``width`` diagonals from ``low`` on: the fewest edits and
    the stretch's start and end.  A value holds the edits above BITS and the
    diagonal on which the stretch starts below."""
    d = np.arange(width)
    one = np.int64(1) << BITS
    row = np.broadcast_to(d.astype(np.int64), (len(low), width)).copy()
    last = len(text) - 1
    for i in range(windows.shape[1]):
        at = low[:, None] + (d + i)
        differs = (text[np.clip(at, 0, last)] != windows[:, i:i + 1]) | (at < 0) | (at > last)
        new = row + differs * one
        new[:, :-1] = np.minimum(new[:, :-1], row[:, 1:] + one)
        row = np.minimum.accumulate(new - d * one, axis=1) + d * one
    best = row.argmin(axis=1)
    value = row[np.arange(len(low)), best]
    return value >> BITS, low + (value & (one - 1)), low + best + windows.shape[1]


def within(letters: np.ndarray, place: np.ndarray, text: np.ndarray, low: np.ndarray, width: int,
           most: int) -> np.ndarray:
    """Which of the windows (columns ``place`` of ``letters``) ``align`` finds with at
    most ``most`` edits; in bytes, and those that exceed it midway are left early."""
    left = np.arange(len(low))
    row = np.zeros((width, len(low)), dtype=np.int8)
    for begin in range(0, len(letters), ROWS):
        rows = letters[begin:begin + ROWS].take(place[left], axis=1)
        at = low[left] + np.arange(begin, begin + len(rows) + width - 1)[:, None]
        part = text.take(at, mode="clip")
        if len(left) and (at[0].min() < 0 or at[-1].max() >= len(text)):
            part[(at < 0) | (at >= len(text))] = OUTSIDE
        for i, letter in enumerate(rows):
            new = row + (part[i:i + width] != letter)
            np.minimum(new[:-1], row[1:] + np.int8(1), out=new[:-1])
            for d in range(1, width):
                np.minimum(new[d], new[d - 1] + np.int8(1), out=new[d])
            row = new
        good = row.min(axis=0) <= most
        left, row = left[good], row[:, good]
    found = np.zeros(len(low), dtype=bool)
    found[left] = True
    return found


class Searcher:
    """One block of benchmark items, indexed by q-gram."""

    def __init__(self, items: Sequence[tuple[int, str]], rate: float = RATE):
        self.table, self.rate = _fold_table(), rate
        self.item: list[int] = []
        self.windows: list[np.ndarray] = []
        self.exact: list[tuple[int, np.ndarray]] = []
        whole: list[np.ndarray] = []
        begins: list[int] = []
        covers: list[np.ndarray] = []  # for each q-gram of an item the windows that hold it, padded with -1
        for item, text in items:
            c = codes(text, self.table)
            if 0 < len(c) < Q:
                self.exact.append((item, c))
            elif len(c) >= Q:
                held = np.full((len(c) + 1 - Q, COVER), -1, dtype=np.int32)
                used = np.zeros(len(held), dtype=np.int64)
                for at, to in cuts(len(c)):
                    inside = np.arange(at, to + 1 - Q)
                    held[inside, used[inside]] = len(self.windows)
                    used[inside] += 1
                    self.item.append(item)
                    self.windows.append(c[at:to])
                    begins.append(at)
                whole.append(c)
                covers.append(held)
        self.length = np.array([len(w) for w in self.windows], dtype=np.int64)
        self.edits = np.array([edits_allowed(len(w), rate) for w in self.windows], dtype=np.int64)
        self.least = self.length + 1 - Q - Q * self.edits
        self.begin = np.array(begins, dtype=np.int64)
        # the windows of each length side by side (columns), and each one's column
        self.letters, self.place = {}, np.zeros(len(self.windows), dtype=np.int64)
        for m in np.unique(self.length):
            same = np.flatnonzero(self.length == m)
            self.letters[m] = np.stack([self.windows[x] for x in same], axis=1)
            self.place[same] = np.arange(len(same))
        grams = [gram_hashes(c) for c in whole]
        self._set_apart(whole, grams, covers)
        all_grams = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        order = np.argsort(all_grams, kind="stable")
        self.grams = all_grams[order]
        self.of_item = np.repeat(np.arange(len(grams), dtype=np.int32), [len(g) for g in grams])[order]
        self.offset = np.concatenate([np.arange(len(g), dtype=np.int32) for g in grams])[order] if grams else order
        self.covers = np.concatenate(covers)[order] if covers else np.zeros((0, COVER), np.int32)
        self.longest = max(map(len, whole), default=0)
        if len(self.often):                        # repetitive q-grams are not looked up
            rare = ~np.isin(self.grams, self.often)
            self.grams, self.of_item, self.offset, self.covers = (x[rare] for x in (self.grams, self.of_item, self.offset, self.covers))
        self.slots = np.zeros(1 << SLOT_BITS, dtype=bool)
        self.slots[self._slot(self.grams)] = True

    def _set_apart(self, whole: list[np.ndarray], grams: list[np.ndarray], covers: list[np.ndarray]) -> None:
        """Repetitive q-grams (``often``) would pair every repetition in a text with every one
        in an item, so they are left out of the search.  A stretch that shares ``least``
        q-grams with a window shares as many without them less those that the window
        has, and ``least`` is lowered by that.  Windows that would be left with fewer than
        LEAST are ``apart``: for these the q-grams' positions alone are counted, and
        windows of one text count once (``like``: the windows that a window stands for)."""
        doubtful = [n for n, g in enumerate(grams) if len(g) and np.unique(g, return_counts=True)[1].max() > OFTEN]
        number = np.cumsum([0, *(len(cuts(len(c))) for c in whole)])
        spans = {n: [(int(number[n]) + k, at, to + 1 - Q) for k, (at, to) in enumerate(cuts(len(whole[n])))] for n in doubtful}
        found = [np.zeros(0, np.uint64)]
        for n in doubtful:
            for _, at, to in spans[n]:
                g, times = np.unique(grams[n][at:to], return_counts=True)
                found.append(g[times > OFTEN])
        self.often = np.unique(np.concatenate(found))
        self.like: dict[int, list[int]] = {}
        self.apart: list[tuple[int, np.ndarray]] = []       # a window and its distinct q-grams
        first: dict[bytes, int] = {}
        for n, g in enumerate(grams if len(self.often) else []):
            held = np.isin(g, self.often)
            if not held.any():
                continue
            upto = np.concatenate([[0], np.cumsum(held)])
            for k, (at, end) in enumerate(cuts(len(whole[n]))):
                w, to = int(number[n]) + k, end + 1 - Q
                many = int(upto[to] - upto[at])
                if not many:
                    continue
                if self.least[w] - many >= LEAST:
                    self.least[w] -= many
                    continue
                covers[n][covers[n] == w] = -1
                own = first.setdefault(self.windows[w].tobytes(), w)
                self.like.setdefault(own, []).append(w)
                if own == w:
                    self.apart.append((w, np.unique(g[at:to])))
        self.known = np.unique(np.concatenate([np.zeros(0, np.uint64), *(g for _, g in self.apart)]))

    def _bands_apart(self, c: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Window and lowest diagonal of the bands in whose stretch of text enough positions
        hold one of the window's q-grams, for the windows set apart."""
        if not self.apart or len(c) < Q:
            return
        h = gram_hashes(c)
        place = np.minimum(np.searchsorted(self.known, h), len(self.known) - 1)
        at = np.flatnonzero(self.known[place] == h)
        if not len(at):
            return
        place = place[at]
        windows, lows, held = [], [], 0
        for w, g in self.apart:
            if len(at) < self.least[w]:
                continue
            mine = np.zeros(len(self.known), dtype=bool)
            mine[np.searchsorted(self.known, g)] = True
            marks = at[mine[place]]
            if len(marks) < self.least[w]:
                continue
            step = self.edits[w] + 1
            low = np.arange((int(marks[0]) - 2 * step - self.length[w]) // step, int(marks[-1]) // step + 1) * step
            n = np.searchsorted(marks, low + 2 * step + self.length[w] - Q, "right") - np.searchsorted(marks, low)
            low = low[n >= self.least[w]]
            windows.append(np.full(len(low), w))
            lows.append(low)
            held += len(low)
            if held > BANDS:
                yield np.concatenate(windows), np.concatenate(lows)
                windows, lows, held = [], [], 0
        if held:
            yield np.concatenate(windows), np.concatenate(lows)

    @staticmethod
    def _slot(h: np.ndarray) -> np.ndarray:
        return (h * np.uint64(0xD1342543DE82EF95)) >> np.uint64(64 - SLOT_BITS)

    def _hits(self, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Window and diagonal of every shared q-gram that can belong to a region."""
        h = gram_hashes(c)
        at = np.flatnonzero(self.slots[self._slot(h)])
        first = np.searchsorted(self.grams, h[at], "left")
        count = np.searchsorted(self.grams, h[at], "right") - first
        at, first, count = at[count > 0], first[count > 0], count[count > 0]
        # a region's diagonals lie in two neighbouring units of an item; units that share a
        # counter only keep more
        size = 1 << COUNTER_BITS
        n = np.zeros(size, dtype=np.int32)
        ends = np.flatnonzero(np.diff(np.cumsum(count) // PAIRS)) + 1
        slices = list(zip([0, *ends], [*ends, len(at)]))

        def pairs(low: int, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            k = count[low:high]
            entry = np.repeat(first[low:high] - np.cumsum(k) + k, k) + np.arange(k.sum())
            diagonal = np.repeat(at[low:high], k) - self.offset[entry]
            unit = (diagonal + self.longest) // UNIT + self.of_item[entry].astype(np.int64) * 0x9E3779B1
            return entry, diagonal, unit % size

        for low, high in slices:
            n += np.bincount(pairs(low, high)[2], minlength=size).astype(np.int32)
        two = n + np.roll(n, -1)
        enough = np.maximum(two, np.roll(two, 1)) >= self.least.min(initial=1 << 30)
        windows, diagonals = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for low, high in slices:
            entry, diagonal, unit = pairs(low, high)
            keep = enough[unit]
            held = self.covers[entry[keep]]
            row, column = np.nonzero(held >= 0)
            window = held[row, column].astype(np.int64)
            windows.append(window)
            diagonals.append(diagonal[keep][row] + self.begin[window])
        return np.concatenate(windows), np.concatenate(diagonals)

    def regions(self, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Window and lowest diagonal of the bands that share enough q-grams.
        Bands are 2 (e + 1) diagonals wide, every e + 1, so one of them holds the
        whole alignment of any stretch within the budget."""
        window, diagonal = self._hits(c)
        step = self.edits[window] + 1
        unit = (diagonal + WINDOW) // step
        size = len(c) + 2 * WINDOW + 4
        units, n = np.unique(window * size + unit + 1, return_counts=True)
        # a band is two units: add up what begins at it and at the next one
        keys, counts = np.concatenate([units, units - 1]), np.concatenate([n, n])
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else keys
        total = np.add.reduceat(counts, first) if len(keys) else counts
        w, unit = keys[first] // size, keys[first] % size - 1
        enough = total >= self.least[w]
        return w[enough], unit[enough] * (self.edits[w[enough]] + 1) - WINDOW

    def _spans(self, pieces: list[np.ndarray]) -> Iterator[tuple[int, int, int, int, int]]:
        """(piece, item, start, end, edits) of the windows found in some pieces of text."""
        # laid end to end with gaps that no window bridges and no item contains
        gap = np.full(2 * WINDOW, OUTSIDE, dtype=np.uint32)
        starts = np.cumsum([0, *(len(c) + len(gap) for c in pieces)])
        joined = np.concatenate([x for c in pieces for x in (c, gap)])
        for window, low in chain([self.regions(joined)], self._bands_apart(joined)):
            yield from self._aligned(joined, starts, pieces, window, low)
        yield from self._short(pieces)

    def _aligned(self, joined: np.ndarray, starts: np.ndarray, pieces: list[np.ndarray], window: np.ndarray,
                 low: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
        """The spans that alignment of some bands finds."""
        for m in np.unique(self.length[window]):
            group = np.flatnonzero(self.length[window] == m)
            for at in range(0, len(group), ALIGNED):
                w, first = window[group[at:at + ALIGNED]], low[group[at:at + ALIGNED]]
                most = edits_allowed(int(m), self.rate)
                near = np.concatenate([
                    within(self.letters[m], self.place[w[k:k + TOGETHER]], joined, first[k:k + TOGETHER],
                           2 * (most + 1), most) for k in range(0, len(w), TOGETHER)])
                if not near.any():
                    continue
                w, first = w[near], first[near]
                edits, start, end = align(self.letters[m].T[self.place[w]], joined, first, 2 * (most + 1))
                ok = edits <= self.edits[w]
                # by the end: a stretch that lacks a window's first characters may start in the gap before
                piece = np.searchsorted(starts, end - 1, "right") - 1
                for x, k, i, j, n in zip(w[ok], piece[ok], start[ok], end[ok], edits[ok], strict=True):
                    for item in dict.fromkeys(self.item[y] for y in self.like.get(int(x), [x])):
                        yield (int(k), item, int(max(i - starts[k], 0)), int(min(j - starts[k], len(pieces[k]))), int(n))

    def _short(self, pieces: list[np.ndarray]) -> Iterator[tuple[int, int, int, int, int]]:
        """Items too short for a q-gram."""
        for item, short in self.exact:  # too short for a q-gram: looked for as they are, as whole words or texts
            part, wordy = short.astype("<u4").tobytes(), any(map(_wordy, short))
            for k, c in enumerate(pieces):
                whole = c.astype("<u4").tobytes()
                at = whole.find(part)
                while at >= 0:
                    i, j = at // 4, at // 4 + len(short)
                    if at % 4 == 0 and (j - i == len(c) or wordy and not any(map(_wordy, c[max(i - 1, 0):i]))
                                        and not any(map(_wordy, c[j:j + 1]))):
                        yield k, item, i, j, 0
                    at = whole.find(part, at + 1)

    def search(self, texts: Sequence[str]) -> list[list[dict]]:
        """The leaks of each text, ordered by item and start.  Long texts are cut
        into overlapping pieces, so that memory stays bounded."""
        pieces = [(k, at, t[at:at + CHUNK_CHARS + 4 * WINDOW])
                  for k, t in enumerate(texts) for at in range(0, len(t), CHUNK_CHARS)]
        spans: dict[tuple[int, int], set[tuple[int, int, int]]] = {}
        todo: list[tuple[int, int, str]] = []
        chars = 0
        for n, piece in enumerate(pieces, 1):
            todo.append(piece)
            chars += len(piece[2])
            if n == len(pieces) or chars > CHUNK_CHARS:
                for k, item, i, j, edits in self._spans([codes(p[2], self.table) for p in todo]):
                    doc, base, _ = todo[k]
                    # what a border cuts is whole in the piece before or after
                    if (base and i < WINDOW) or (base + CHUNK_CHARS < len(texts[doc]) and i >= CHUNK_CHARS + 2 * WINDOW):
                        continue
                    spans.setdefault((doc, item), set()).add((base + i, base + j, edits))
                todo, chars = [], 0
        out: list[list[dict]] = [[] for _ in texts]
        for (doc, item), found in sorted(spans.items()):
            for start, end, edits in sorted(found):
                last = out[doc][-1] if out[doc] else None
                if last and last["item_id"] == item and start <= last["end"]:
                    last |= {"end": max(end, last["end"]), "edits": max(edits, last["edits"]),
                             "windows": last["windows"] + 1}
                else:
                    out[doc].append({"item_id": item, "start": start, "end": end, "edits": edits, "windows": 1})
        return out


def _blocks(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[int, str]]]:
    """The items with text, in blocks of about BLOCK_CHARS characters."""
    items = benchmark.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).filter(
        "id is not null and length(text) > 0").distinct()
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = chars // BLOCK_CHARS + 1
    for k in range(n):
        block = items if n == 1 else items.filter(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == k)
        yield sorted((r.id, r.text) for r in block.collect())  # bounded by BLOCK_CHARS


def leak_finders(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text",
                 rate: float = RATE) -> list[Callable[[Column], Column]]:
    """For each block of the benchmark a function from a text column to its leaks."""
    ship_code(__name__)

    def finder(items: list[tuple[int, str]]) -> Callable[[Column], Column]:
        sent = benchmark.sparkSession.sparkContext.broadcast(items)
        leak = pa.struct([("item_id", pa.int64()), ("start", pa.int32()), ("end", pa.int32()), ("edits", pa.int32()),
                          ("windows", pa.int32())])

        @F.arrow_udf(f"array<{LEAK}>")
        def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            def run(batches):
                searcher = Searcher(sent.value, rate)
                for batch in batches:
                    found: list[list[dict]] = []
                    for at in range(0, len(batch), TEXTS):
                        found += searcher.search([t or "" for t in batch.slice(at, TEXTS).to_pylist()])
                    yield pa.array(found, pa.list_(leak))

            yield from tidy(run)(batches)

        return find

    return [finder(items) for items in _blocks(benchmark, id_col, text_col)]


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per stretch of a document that repeats part of a benchmark item:
    ``id_col``, item_id, start, end, edits, windows.

    Every verbatim run of 59 characters of an item is found, a whole item however
    short it is, and so is a window (100 characters of the item every 50, and 50
    every 10, or an item shorter than that) within a tenth of edits.  ``start``
    and ``end`` are code points; ``edits`` is the most that one of the matched
    windows needed, ``windows`` the number of stretches merged.  Letter case and kinds of white space don't count.
    Items under eight characters match as whole words (no letter or digit next to
    them) or whole texts, without a letter or digit only as whole texts.  Null and
    empty texts and items match nothing, and items without an id are not searched;
    an empty benchmark finds nothing.  Rows with null ids and repeated rows are searched like others.
    Other columns are not read.
    """
    finders = leak_finders(benchmark)
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    passes = [slim.select("id", F.explode(find(F.col("text"))).alias("leak")) for find in finders]
    found = reduce(DataFrame.union, passes)
    return found.select(F.col("id").alias(id_col), "leak.*")


def drop_leaked(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` without the documents that repeat part of a benchmark item; rows
    and columns of the others stay as they are."""
    finders = leak_finders(benchmark)
    if len(finders) == 1:
        row = docs.select(F.struct(*docs.columns).alias("row"), docs[text_col].alias("text"))
        return row.select("row", finders[0](F.col("text")).alias("leaks")).filter(F.size("leaks") == 0).select("row.*")
    # a leak depends on the text alone, so digests of the texts tell the passes' results
    digest = F.unhex(F.sha2(docs[text_col], 256))
    text = docs.select(docs[text_col].alias("text"))
    gone = [cut(text.select("text", find(F.col("text")).alias("leaks")).filter(F.size("leaks") > 0).select(
        F.unhex(F.sha2("text", 256)).alias("gone_text")).distinct()) for find in finders]
    leaked = cut(reduce(DataFrame.union, gone).distinct())
    return docs.join(small_side(leaked, BROADCAST_IDS), digest == leaked["gone_text"], "left_anti")
