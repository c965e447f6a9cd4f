"""Near duplicates: an exact n-gram Jaccard join with PartEnum signatures.

Documents become sets of distinct five-word shingles; equal sets are one vertex
(a 64-bit digest of the set).  The steps, all keyed shuffles of numbers:

1. Sign: every set's signatures (``partenum``).  Within a batch of documents,
   sets that share a signature are paired with the batch's smallest vertex
   there, and only that one goes on, so however large a group of near copies
   is, a signature's key receives one row from each batch.
2. Gather: by signature, each vertex is paired with the smallest one.  So each
   signature's sets hang together by a star (a tree of two levels) of candidate
   pairs, never all pairs.
3. Filter: a set's sketch is a row of parity bits, one toggled by each element.
   Two sketches never differ in more bits than the sets differ in elements, so
   a pair whose sketches differ in too many bits is surely not similar.
4. Verify: exact intersections, for each vertex's most frequent candidate
   first.  Linked vertices form components; of the other candidates only those
   between different components are verified.
5. A signature is settled when all its sets are in one component.  Of those
   that are not, all pairs of sets from different components that pass the
   filter are verified too.  So no link between different texts is lost.

Texts travel only for verification, to the pair's task; a vertex with very many
partners has them dealt to many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import partenum
from .common import (
    BROADCAST_IDS,
    BROADCAST_ROWS,
    cut,
    few,
    remove_folder,
    scratch_folder,
    ship_code,
    small_side,
    tidy,
    without_ids,
)

WORDS = 5
#: Documents signed together; words remembered by a task; shares of a partition's signatures
#: that are sorted one after another; texts verified at a time.
CHUNK, MEMO_WORDS, SHARES, TEXTS = 1024, 100_000, 16, 128
#: Partners of one vertex verified together.
PARTNERS = 256
#: Fewest words of 64 parity bits in a sketch (they double until there are two bits for each
#: element); sketches that may be broadcast.
SKETCH, BROADCAST_SKETCHES = 32, 10_000
#: Unsettled signatures that a set carries to see under which one a pair is made.
LOWEST = 64
_ROW = "sig long, a long, b long, n int"
_SEEDS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F],
                  dtype=np.uint64)


class _Memo(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


class Shingler:
    """Texts to sets of shingle hashes (sorted, distinct, 64 bits)."""

    def __init__(self):
        self.memo = _Memo()

    def shingles(self, text: str | None) -> np.ndarray:
        """A-Z are lower-cased; words are parted by ASCII white space.  A text of
        fewer words than a shingle is one shingle; one without words has none."""
        words = (text or "").encode().lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        if len(self.memo) > MEMO_WORDS:
            self.memo.clear()
        h = np.fromiter(map(self.memo.__getitem__, words), np.uint64, len(words))
        size = min(WORDS, len(words))
        out = np.full(len(words) - size + 1, size, dtype=np.uint64)
        for j in range(size):
            out = (out ^ h[j:len(h) - size + 1 + j]) * _SEEDS[j]
            out ^= out >> np.uint64(29)
        return np.unique(out)


def _pairs_by_key(key: np.ndarray, vertex: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sorted by key, then vertex: the first vertex of each key (key, vertex), and
    for all its other vertices the pair with that first one (key, first, other)."""
    order = np.lexsort((vertex, key))
    key, vertex = key[order], vertex[order]
    new = np.ones(len(key), dtype=bool)
    new[1:] = (key[1:] != key[:-1]) | (vertex[1:] != vertex[:-1])
    key, vertex = key[new], vertex[new]
    first = np.ones(len(key), dtype=bool)
    first[1:] = key[1:] != key[:-1]
    centre = vertex[np.maximum.accumulate(np.where(first, np.arange(len(key)), 0))] if len(key) else vertex
    return key[first], vertex[first], key[~first], centre[~first], vertex[~first]


def _rows(sig: np.ndarray, a: np.ndarray, b: np.ndarray | None, n: np.ndarray | None = None) -> pa.RecordBatch:
    """Rows of the one stream: a vertex under its signature (b null), a candidate
    pair (n null), a document (sig 1 if it has no id, a its key, b its vertex, n
    its set's size), or a word of a sketch (sig the word, a and b the vertex, n
    -1 for the first, -2 for the second, and so on)."""
    k = len(sig)
    return pa.RecordBatch.from_arrays([
        pa.array(sig, pa.int64()), pa.array(a, pa.int64()),
        pa.nulls(k, pa.int64()) if b is None else pa.array(b, pa.int64()),
        pa.nulls(k, pa.int32()) if n is None else pa.array(n, pa.int32())], ["sig", "a", "b", "n"])


def sketch_words(sizes: np.ndarray) -> np.ndarray:
    """Words in the sketches of sets of these sizes: a power of two, at least two
    bits for each element."""
    return np.maximum(SKETCH, 1 << np.ceil(np.log2(np.maximum(sizes, 1) / 32)).clip(0).astype(np.int64))


def sketches(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words of the sets' parity sketches: value, set and place of each.  The
    sketch of half as many words is the two halves' exclusive or."""
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    words = sketch_words(sizes)
    first = np.cumsum(words) - words
    flat = np.concatenate([*sets, np.zeros(0, np.uint64)])
    at = np.repeat(np.arange(len(sets)), sizes)
    bit = (partenum.mix(flat, 9) >> np.uint64(24)).astype(np.int64) & (words[at] * 64 - 1)
    odd = np.bincount(first[at] * 64 + bit, minlength=int(words.sum()) * 64).astype(np.uint8) & 1
    owner = np.repeat(np.arange(len(sets)), words)
    return np.packbits(odd, bitorder="little").view(np.int64), owner, np.arange(len(owner)) - first[owner]


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shingler = Shingler()
    for batch in batches:
        for at in range(0, batch.num_rows, CHUNK):
            part = batch.slice(at, CHUNK)
            sets = [shingler.shingles(t.as_py()) for t in part.column(2)]
            vertex = partenum.digest(sets).view(np.int64)
            sizes = np.array([len(s) for s in sets], dtype=np.int32)
            vertex = np.where(sizes > 0, vertex, 0)
            key, none = (part.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(2))
            yield _rows(none, key, vertex, sizes)
            _, once = np.unique(vertex, return_index=True)
            once = once[sizes[once] > 0]
            word, owner, place = sketches([sets[i] for i in once])
            own = vertex[once][owner]
            yield _rows(word, own, own, (-1 - place).astype(np.int32))
            sig, owner = partenum.signatures([sets[i] for i in once])
            k1, v1, k2, c2, v2 = _pairs_by_key(sig.view(np.int64), vertex[once][owner])
            yield _rows(k1, v1, None)
            if len(k2):
                yield _rows(k2, c2, v2)


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    keys, vertices = [], []
    for batch in batches:
        single = np.asarray(batch.column(2).is_null())
        if not single.all():
            yield batch.filter(pa.array(~single))
        keys.append(batch.column(0).to_numpy(zero_copy_only=False)[single])
        vertices.append(batch.column(1).to_numpy(zero_copy_only=False)[single])
    if not keys:
        return
    key, vertex = (np.concatenate(c).astype(np.int64, copy=False) for c in (keys, vertices))
    del keys, vertices
    share = (key % SHARES).astype(np.int8)
    for n in range(SHARES):                        # all rows of a key are in one share
        mine = share == n
        _, _, k, centre, other = _pairs_by_key(key[mine], vertex[mine])
        for at in range(0, len(k), 1 << 15):
            yield _rows(k[at:at + (1 << 15)], centre[at:at + (1 << 15)], other[at:at + (1 << 15)])


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, lot, vertex, text) sorted by (key, lot, not the key itself): pairs
    (key, vertex) that are similar enough.  Holds one set and one batch at a time."""
    shingler, held, centre = Shingler(), None, np.zeros(0, np.uint64)
    for batch in (b.slice(at, TEXTS) for b in batches for at in range(0, b.num_rows, TEXTS)):
        a, b = [], []
        for key, lot, vertex, text in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            own = shingler.shingles(text)
            if partenum.digest([own]).view(np.int64)[0] != vertex:
                continue  # another text with the same id
            if vertex == key:
                held, centre = (key, lot), own
                continue
            assert held == (key, lot), "a pair without its first set"
            at = np.searchsorted(centre, own)
            common = int((centre[np.minimum(at, len(centre) - 1)] == own).sum())
            if common >= partenum.least_common(len(own) + len(centre)):
                a.append(key)
                b.append(vertex)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Of the distinct ``pairs`` (a, b; materialised) those similar enough.
    ``texts``: vertex, text, a text for each vertex."""
    # partners of a vertex are dealt into lots of about PARTNERS, each with a copy of its text
    rows = pairs.count()
    pairs = few(pairs, rows)
    lots = cut(few(pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / PARTNERS).cast("int").alias("lots")), rows))
    dealt = cut(few(pairs.join(small_side(lots), "a").select(
        F.col("a").alias("key"), "b", F.pmod(F.xxhash64("b"), F.col("lots")).cast("int").alias("lot")), rows))
    to = dealt.select(F.col("b").alias("vertex"), "key", "lot").union(
        dealt.select(F.col("key").alias("vertex"), "key", "lot").distinct())
    if rows <= BROADCAST_ROWS:                     # dealt has a row for each pair
        to = F.broadcast(to)
    sent = texts.join(to, "vertex").select("key", "lot", "vertex", "text")
    met = sent.repartition("key", "lot").sortWithinPartitions("key", "lot", F.col("vertex") != F.col("key"))
    return cut(met.mapInArrow(tidy(_verify), "a long, b long"))


def _may_link(x: str, y: str) -> Column:
    """Whether two sets (aliases with n and sketch) may be similar: their sketches
    differ in no more bits than similar sets of these sizes do in elements."""
    total = F.col(f"{x}.n") + F.col(f"{y}.n")
    common = F.ceil(total * partenum.NUMERATOR / (partenum.NUMERATOR + partenum.DENOMINATOR))
    limit = total - 2 * common

    def folded(own: str, other: str) -> Column:  # sizes of similar sets differ by one doubling at most
        w = F.col(f"{own}.sketch")
        half = (F.size(w) / 2).cast("int")
        return F.when(F.size(w) > F.size(f"{other}.sketch"), F.zip_with(
            F.slice(w, 1, half), F.slice(w, half + 1, half), lambda p, q: p.bitwiseXOR(q))).otherwise(w)

    differ = F.aggregate(F.zip_with(folded(x, y), folded(y, x), lambda p, q: F.bit_count(p.bitwiseXOR(q))),
                         F.lit(0), lambda s, d: s + d)
    # nested, so that sketches of unlike sizes are never compared
    return F.when(F.abs(F.col(f"{x}.n") - F.col(f"{y}.n")) <= limit, differ <= limit).otherwise(F.lit(False))


def components(links: DataFrame) -> DataFrame:
    """(vertex, root): the smallest vertex of each vertex's component.  ``links``:
    a, b (materialised).  Labels spread along links and jump to their label's
    label until nothing changes; every round is checkpointed."""
    rows = 2 * links.count()
    links = few(links, rows)
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
        links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    label = cut(few(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("root")), rows))
    while True:
        near = both.join(label, "u").groupBy(F.col("v").alias("u")).agg(F.min("root").alias("near"))
        hooked = cut(few(label.join(near, "u").select("u", F.col("root").alias("old"),
                                                      F.least("root", "near").alias("root")), rows))
        up = hooked.select(F.col("u").alias("root"), F.col("root").alias("above"))
        jumped = cut(few(hooked.join(up, "root").select("u", "old", F.col("above").alias("root")), rows))
        label = jumped.select("u", "root")
        if jumped.filter("root < old").isEmpty():
            return label.withColumnRenamed("u", "vertex")


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The rows of ``pairs`` (a, b, ...) whose ends are in different components,
    with those components' roots."""
    known = small_side(roots)
    side = lambda c: known.select(F.col("vertex").alias(c), F.col("root").alias(f"{c}_root"))
    return pairs.join(side("a"), "a", "left").join(side("b"), "b", "left").withColumns({
        "a_root": F.coalesce("a_root", "a"), "b_root": F.coalesce("b_root", "b")}).filter("a_root != b_root")


def merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """The components (vertex, root) after more ``links``: those between components
    are links of roots, and only these few are worked out anew."""
    rows = links.count()
    between = cut(few(_apart(few(links, rows), roots).select(
        F.col("a_root").alias("a"), F.col("b_root").alias("b")).distinct(), rows))
    if between.isEmpty():
        return roots
    above = components(between)
    up = small_side(above.select(F.col("vertex").alias("root"), F.col("root").alias("above")))
    moved = roots.join(up, "root", "left").select("vertex", F.coalesce("above", "root").alias("root"))
    more = above.join(small_side(roots), "vertex", "left_anti").select("vertex", "root")
    return cut(few(moved.union(more), roots.count() + 2 * rows))


def _held(tagged: DataFrame, counted: DataFrame, roots: DataFrame, rows: int) -> DataFrame | None:
    """(sig, vertex) of the unsettled signatures, those with sets from different
    components; None if there are none.  ``rows``: those of ``counted``."""
    apart = cut(few(_apart(counted.select("a", "b"), roots).select("a", "b"), rows))
    if apart.isEmpty():
        return None
    sigs = cut(tagged.join(small_side(apart), ["a", "b"], "left_semi").select("sig").distinct())
    held = tagged.join(small_side(sigs), "sig", "left_semi")
    return cut(held.select("sig", F.col("a").alias("vertex")).union(
        held.select("sig", F.col("b").alias("vertex"))).distinct())


def _cross_pairs(held: DataFrame, counted: DataFrame, sketch: DataFrame, roots: DataFrame) -> DataFrame:
    """All pairs of sets from different components that share an unsettled
    signature, pass the filter and were no candidates yet.

    Each set carries its LOWEST smallest unsettled signatures.  Under a signature a
    pair is left out if both carry a smaller one in common: it is made under that
    one.  So a pair is made at its smallest shared signature, and hardly ever at
    the others."""
    low = held.groupBy("vertex").agg(F.slice(F.array_sort(F.collect_set("sig")), 1, LOWEST).alias("low"))
    known = sketch.join(low, "vertex")
    placed = cut(held.join(small_side(roots), "vertex", "left").select(
        "sig", "vertex", F.coalesce("root", "vertex").alias("root")).join(known, "vertex"))
    one, other = placed.alias("one"), placed.alias("other")
    first = F.coalesce(F.array_min(F.array_intersect("one.low", "other.low")) >= F.col("one.sig"), F.lit(True))
    pairs = one.join(other, F.expr("one.sig = other.sig and one.vertex < other.vertex and one.root != other.root")
                     & F.when(_may_link("one", "other"), first).otherwise(F.lit(False)))
    pairs = pairs.select(F.col("one.vertex").alias("a"), F.col("other.vertex").alias("b")).distinct()
    return cut(pairs.join(counted, ["a", "b"], "left_anti"))


def _filtered(pairs: DataFrame, sketch: DataFrame) -> DataFrame:
    """The rows of ``pairs`` (a, b, ...) that the sketches let pass."""
    return pairs.join(sketch.alias("x"), F.expr("a = x.vertex")).join(
        sketch.alias("y"), F.expr("b = y.vertex")).filter(_may_link("x", "y")).select(*pairs.columns)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id_col``, n_shingles, component_id.

    ``component_id`` is the smallest id reachable over links (Jaccard similarity
    of five-word shingles at least 0.8), the document's own included.  Null,
    empty and blank texts have no shingles and link with nothing.  Ids are
    integers; a null id never counts as smallest, and a component of null ids
    only has a null component_id.  Repeated rows are equal texts.  An empty
    table gives an empty result; other columns are not read.
    """
    spark = docs.sparkSession
    ship_code(__name__, "tillroll.llm.partenum")
    text, none = F.col(text_col), F.col(id_col).isNull()
    # a document without an id goes by a hash of its text
    slim = docs.select(F.coalesce(F.col(id_col).cast("long"), F.xxhash64(text)).alias("key"),
                       none.cast("long").alias("none"), text.alias("text"))
    folder, kept = scratch_folder(spark, "partenum"), scratch_folder(spark, "partenum-texts")
    # vertices go by signature, whatever is paired already by pair, documents by themselves
    by = F.when(F.col("b").isNull(), F.col("sig")).otherwise(F.xxhash64("sig", "a", "b"))
    slim.mapInArrow(tidy(_sign), _ROW).repartition(by).mapInArrow(tidy(_gather), _ROW).write.parquet(folder)
    stream = spark.read.parquet(folder)
    members = cut(stream.filter("n >= 0").select(
        F.col("sig").alias("none"), F.col("a").alias("key"), F.col("b").alias("vertex"), "n"))
    tagged = stream.filter("n is null").select("sig", "a", "b")

    # one document for each candidate vertex (more only where ids repeat; their sets are compared then)
    counted = cut(tagged.groupBy("a", "b").agg(F.count(F.lit(1)).alias("shared")))
    rows = counted.count()
    counted = few(counted, rows)
    ends = counted.select(F.col("a").alias("vertex")).union(counted.select(F.col("b").alias("vertex"))).distinct()
    ends = cut(few(ends, 2 * rows))
    known = few(cut(members.filter("n > 0").groupBy("vertex").agg(
        F.min(F.struct("none", "key")).alias("doc"), F.max("n").alias("n")).join(
        ends, "vertex", "left_semi").select("vertex", "doc.*", "n")), 2 * rows)
    words = stream.filter("n < 0").select(F.col("a").alias("vertex"), (-1 - F.col("n")).alias("place"), "sig").join(
        ends, "vertex", "left_semi").groupBy("vertex", "place").agg(F.max("sig").alias("word"))
    words = words.groupBy("vertex").agg(F.array_sort(F.collect_list(F.struct("place", "word"))).alias("words"))
    sketch = cut(known.select("vertex", "n").join(words, "vertex").select(
        "vertex", "n", F.transform("words", lambda w: w["word"]).alias("sketch")))
    sketch = small_side(sketch, BROADCAST_SKETCHES)
    likely = few(cut(_filtered(counted, sketch)), rows)
    chosen = cut(few(likely.select(F.explode(F.array("a", "b")).alias("vertex")).distinct().join(
        known, "vertex").select("vertex", "none", "key"), 2 * rows))
    slim.join(small_side(chosen, BROADCAST_IDS), ["key", "none"]).select("vertex", "text").write.parquet(kept)
    texts = spark.read.parquet(kept)

    first = cut(few(likely.groupBy("b").agg(F.max_by("a", F.struct("shared", "a")).alias("a")).select("a", "b"), rows))
    roots = components(verified(first, texts))
    second = cut(few(_apart(likely.select("a", "b"), roots).select("a", "b").join(first, ["a", "b"], "left_anti"), rows))
    if not second.isEmpty():
        roots = merged(roots, verified(second, texts))

    def checked(pairs: DataFrame, roots: DataFrame) -> DataFrame:
        """The components after verifying ``pairs``, which may hold vertices without a text yet."""
        if pairs.isEmpty():
            return roots
        more = pairs.select(F.explode(F.array("a", "b")).alias("vertex")).distinct().join(known, "vertex")
        more = cut(more.join(chosen, "vertex", "left_anti").select("vertex", "none", "key"))
        own = texts.union(slim.join(small_side(more, BROADCAST_IDS), ["key", "none"]).select("vertex", "text"))
        return merged(roots, verified(pairs, own))

    held = _held(tagged, counted, roots, rows)
    if held is not None:
        roots = checked(_cross_pairs(held, counted, sketch, roots), roots)
    remove_folder(spark, folder)
    remove_folder(spark, kept)

    rooted = cut(members.join(roots, "vertex", "left").select(
        F.when(F.col("none") == 0, F.col("key")).alias("id"), "n", F.coalesce("root", "vertex").alias("root")))
    alone = rooted.filter("n = 0").select("id", "n", F.col("id").alias("component"))
    smallest = cut(rooted.filter("n > 0").groupBy("root").agg(F.min("id").alias("component")))
    grouped = rooted.filter("n > 0").join(smallest, "root").select("id", "n", "component")
    return alone.union(grouped).select(F.col("id").alias(id_col), F.col("n").cast("long").alias("n_shingles"),
                                       F.col("component").alias("component_id"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each component, the one with the smallest id.
    Documents without shingles and documents without an id all stay; rows and
    columns stay as they are."""
    found = near_duplicates(docs, id_col, text_col)
    return without_ids(docs, found.filter(F.col(id_col) != F.col("component_id")).select(id_col), id_col)
