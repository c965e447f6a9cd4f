"""Byte-level BPE with forced boundaries.

A pair of bytes that occurs inside no token of the vocabulary can never be
merged across, so a text may be cut there: the fragments are encoded
independently and their ids concatenated.  The vocabulary's own splitting
pattern is respected too, by cutting only

* after a character that is not white space (a cut inside or after white space
  could change how a run of spaces is shared out), and
* not before an apostrophe (it could start a contraction).

Every other cut either falls on a border of the pattern or splits a run of
letters, of digits or of signs, and both halves are again such runs.  Special
tokens are cut out first, as the tokenizer itself does.  Fragments repeat a
great deal, so each is encoded once and remembered in a bounded table.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ship_code, tidy

#: Fragments remembered by a worker, bytes that they and their ids may take, and the
#: longest one worth remembering (bytes).
MEMO_FRAGMENTS, MEMO_TOTAL, MEMO_BYTES = 150_000, 8 << 20, 48
#: Characters of the texts encoded at a time (one text at least), bytes of a text cut into
#: fragments at a time, ids of a text decoded at a time.
CHUNK_CHARS, SLICE, IDS = 1 << 20, 1 << 18, 1 << 16


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level
    vocabulary: printable bytes stand for themselves, the others follow from
    256 upwards."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


class Codec:
    """Encoder and decoder of one tokenizer file (its JSON text)."""

    def __init__(self, text: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        spec = json.loads(text)
        self.tokenizer = Tokenizer.from_str(text)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        alphabet = byte_alphabet()
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        vocab = {t: i for t, i in spec["model"]["vocab"].items() if t not in special}
        self.token_bytes: list[bytes] = [b""] * (max([*vocab.values(), *special.values()]) + 1)
        for t, i in vocab.items():
            self.token_bytes[i] = bytes(alphabet[c] for c in t)
        self.special = {t.encode(): i for t, i in special.items()}
        for t, i in self.special.items():
            self.token_bytes[i] = t
        self.cuts = self._cut_table(self.token_bytes[i] for i in vocab.values())
        self.split_special = re.compile(b"(" + b"|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))
                                        + b")").split if self.special else None
        self.memo: dict[bytes, bytes] = {}
        self.memo_bytes = 0

    @staticmethod
    def _cut_table(tokens: Iterator[bytes]) -> np.ndarray:
        """For each pair of bytes (left * 256 + right): may a text be cut between?"""
        cut = np.ones((256, 256), dtype=bool)
        for t in tokens:
            b = np.frombuffer(t, dtype=np.uint8)
            cut[b[:-1], b[1:]] = False
        cut[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32], :] = False  # after white space
        cut[:, ord("'")] = False
        cut[:, 0x80:0xC0] = False  # inside a character
        return cut.reshape(-1)

    def boundaries(self, raw: bytes) -> np.ndarray:
        """Where ``raw`` (valid UTF-8) may be cut, its end included."""
        b = np.frombuffer(raw, dtype=np.uint8)
        if not len(b):
            return np.zeros(0, np.int64)
        at = np.flatnonzero(self.cuts[(b[:-1].astype(np.uint16) << 8) | b[1:]])
        # multi-byte white space has a lead byte C2 (two bytes) or E1 to E3 (three)
        wide = at[b[at] >= 0x80]
        if len(wide):
            two, three = b[np.maximum(wide - 1, 0)], b[np.maximum(wide - 2, 0)]
            at = np.setdiff1d(at, wide[(two == 0xC2) | ((three >= 0xE1) & (three <= 0xE3))], assume_unique=True)
        return np.append(at + 1, len(b))

    def fragments(self, raw: bytes) -> list[bytes]:
        """Cut ``raw`` (valid UTF-8) at its forced boundaries."""
        ends = self.boundaries(raw).tolist()
        return [raw[i:j] for i, j in zip([0, *ends], ends)]

    def _pieces(self, raw: bytes) -> Iterator[list[bytes]]:
        """The fragments of a text in lists of about SLICE bytes, special tokens alone.
        A list ends at a forced boundary, so nothing is cut elsewhere; only a text
        without boundaries makes a longer one."""
        for part in self.split_special(raw) if self.split_special else [raw]:
            if part in self.special:
                yield [part]
                continue
            low = 0
            while low < len(part):
                # a boundary needs two bytes before it and one behind: SLICE bytes and a margin tell
                size = SLICE
                while True:
                    piece = part[low:low + size]
                    ends = self.boundaries(piece)
                    last = low + size >= len(part)
                    ends = ends if last else ends[:-1]          # a slice's own end is no boundary
                    if len(ends):
                        break
                    size *= 2
                ends = ends.tolist()
                yield [piece[i:j] for i, j in zip([0, *ends], ends)]
                low += ends[-1]

    def _learn(self, missing: Sequence[bytes]) -> dict[bytes, bytes]:
        found = self.tokenizer.encode_batch([m.decode() for m in missing], add_special_tokens=False)
        return {m: np.array(e.ids, dtype=np.int32).tobytes() for m, e in zip(missing, found, strict=True)}

    def _ids(self, pieces: list[list[bytes]]) -> list[bytes]:
        """The ids of each list of fragments."""
        memo = self.memo
        missing = list({f for p in pieces for f in p if f not in memo and f not in self.special})
        known = self._learn(missing) | {t: np.int32(i).tobytes() for t, i in self.special.items()}
        out = [b"".join([memo.get(f) or known[f] for f in p]) for p in pieces]
        new = {f: i for f, i in known.items() if len(f) <= MEMO_BYTES}
        size = sum(map(len, new)) + sum(map(len, new.values()))
        if len(memo) + len(new) > MEMO_FRAGMENTS or self.memo_bytes + size > MEMO_TOTAL:
            memo.clear()
            self.memo_bytes = 0
        memo.update(new)
        self.memo_bytes += size
        return out

    def encode(self, raws: Sequence[bytes]) -> list[bytes]:
        """The ids of each text, as the bytes of an int32 array."""
        out: list[list[bytes]] = [[] for _ in raws]
        held: list[tuple[int, list[bytes]]] = []
        size = 0

        def flush():
            for (k, _), ids in zip(held, self._ids([p for _, p in held]), strict=True):
                out[k].append(ids)
            held.clear()

        for k, raw in enumerate(raws):
            for piece in self._pieces(raw):
                held.append((k, piece))
                size += sum(map(len, piece))
                if size > SLICE:
                    flush()
                    size = 0
        flush()
        return [b"".join(ids) for ids in out]

    def decode(self, ids: Sequence[int] | np.ndarray) -> str:
        table = self.token_bytes
        some = lambda at: np.asarray(ids[at:at + IDS]).tolist()
        return b"".join([b"".join([table[i] for i in some(at)]) for at in range(0, len(ids), IDS)]).decode("utf-8", "replace")


def _codec(text: str) -> Codec:
    """The codec of a worker process: a reused worker loads it once, and keeps what
    it remembers.  This module travels to workers by value and anew with each
    task, so the codec stays with the tokenizer library's module."""
    import tokenizers

    kept = getattr(tokenizers, "_codec_of_worker", None)
    if kept is None or kept[0] != text:
        kept = tokenizers._codec_of_worker = (text, Codec(text))
    return kept[1]


def _ship(spark: SparkSession, path: str):
    """The tokenizer file as a broadcast: its size is that of the vocabulary."""
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


def _ids_array(done: list[bytes]) -> pa.ListArray:
    ends = np.cumsum([0, *(len(d) // 4 for d in done)], dtype=np.int64)
    values = pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(done))])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)


def _chunks(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """The texts of a column, about CHUNK_CHARS characters at a time."""
    for batch in batches:
        sizes = pa.compute.coalesce(pa.compute.utf8_length(batch), 0).to_numpy(zero_copy_only=False)
        lot = np.cumsum(sizes) // CHUNK_CHARS
        for at in np.split(np.arange(len(batch)), np.flatnonzero(np.diff(lot)) + 1) if len(batch) else []:
            yield batch.slice(at[0], len(at))


def encoder(spark: SparkSession, path: str) -> Callable[[Column], Column]:
    """A function from a text column to its ids (array<int>).  Null text is empty."""
    ship_code(__name__)
    file = _ship(spark, path)

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = _codec(file.value)
        def run(batches):
            for texts in _chunks(batches):
                yield _ids_array(codec.encode([(t or "").encode() for t in texts.to_pylist()]))

        yield from tidy(run)(batches)

    return encode


def decoder(spark: SparkSession, path: str) -> Callable[[Column], Column]:
    """A function from a column of ids to its text; special tokens are kept."""
    ship_code(__name__)
    file = _ship(spark, path)

    @F.arrow_udf("string")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = _codec(file.value)
        def run(batches):
            for batch in batches:
                for at in range(0, len(batch), 64):
                    rows = batch.slice(at, 64)
                    yield pa.array([codec.decode(ids.values.to_numpy(zero_copy_only=False) if ids.is_valid else ()) for ids in rows], pa.string())

        yield from tidy(run)(batches)

    return decode


def both_ways(spark: SparkSession, path: str) -> Callable[[Column], Column]:
    """A function from a text column to struct<ids, decoded>: encoder and decoder in
    one Python worker, so that ids don't travel twice."""
    ship_code(__name__)
    file = _ship(spark, path)

    @F.arrow_udf("struct<ids:array<int>,decoded:string>")
    def there_and_back(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = _codec(file.value)
        def run(batches):
            for texts in _chunks(batches):
                ids = codec.encode([(t or "").encode() for t in texts.to_pylist()])
                back = [codec.decode(np.frombuffer(i, dtype=np.int32)) for i in ids]
                yield pa.StructArray.from_arrays([_ids_array(ids), pa.array(back, pa.string())], ["ids", "decoded"])

        yield from tidy(run)(batches)

    return there_and_back


def encode(docs: DataFrame, path: str, text_col: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` with its texts' ids in a new column ``out`` (it must not exist).

    Whole texts of any length; null and empty texts have no ids.  All rows and
    columns stay as they are, so nulls, ties and repeated rows need no rule.
    """
    if out in docs.columns:
        raise ValueError(f"column {out} exists")
    return docs.withColumn(out, encoder(docs.sparkSession, path)(docs[text_col]))


def decode(tokens: DataFrame, path: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``tokens`` with the text of ``ids_col`` in a new column ``out``; null ids give
    the empty text."""
    if out in tokens.columns:
        raise ValueError(f"column {out} exists")
    return tokens.withColumn(out, decoder(tokens.sparkSession, path)(tokens[ids_col]))


def _digests(docs: DataFrame, path: str, text_col: str, keep: list[str]) -> DataFrame:
    row = docs.select(F.struct(*[docs[c] for c in keep]).alias("row"), docs[text_col].alias("text"))
    done = row.select("row", both_ways(docs.sparkSession, path)(F.col("text")).alias("done"))
    return done.select(
        "row.*", F.size("done.ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("done.ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("done.decoded", 256).alias("decoded_sha256"), F.col("done.ids").alias("ids"))


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode every text: ``id_col``, n_tokens, ids_sha256, decoded_sha256.

    One row per input row, repeated rows and null ids too; null texts are empty, and
    an empty table gives an empty result.  Other columns are not read.
    """
    return _digests(docs, path, text_col, [id_col]).drop("ids")


def tokens(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """``docs`` with its text replaced by n_tokens, ids_sha256, decoded_sha256 and ids.

    Rows stay one by one, repeated ones too; null texts are empty.  A column of
    ``docs`` that has one of the new names gives way to the new one.
    """
    new = ("n_tokens", "ids_sha256", "decoded_sha256", "ids")
    return _digests(docs, path, text_col, [c for c in docs.columns if c != text_col and c not in new])
