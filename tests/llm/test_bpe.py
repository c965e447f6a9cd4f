import hashlib
import random

import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from tillroll.llm import bpe
from tillroll.llm.queries import op4_bpe

from .conftest import SF

PATH = P.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def codec():
    with open(PATH, encoding="utf-8") as f:
        return bpe.Codec(f.read())


def encode(codec, texts):
    return [bpe.np.frombuffer(x, bpe.np.int32).tolist() for x in codec.encode([t.encode() for t in texts])]


def test_random_texts_match_the_library(codec, library):
    rng = random.Random(7)
    alphabet = list("abcdefghijklmnopqrstuvwxyzABCXYZ0123456789   \n\t'.,!?#$%&*|éèüßñ“”…—  　👍中文"
                    "\r\x1c\x85½²_-<>'") + ["<|endoftext|>", "'s", "'re", " '", "  ", "#'s"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(20_000)]
    texts += ["", "a" * 5000, " " * 300, "<|endoftext|>", "x <|endoftext|>  y", "ab" * 40_000]
    for t, mine, want in zip(texts, encode(codec, texts), library.encode_batch(texts, add_special_tokens=False),
                             strict=True):
        assert mine == want.ids, repr(t)
        assert codec.decode(mine) == library.decode(mine, skip_special_tokens=False)


def test_cuts_are_where_no_token_reaches(codec):
    parts = codec.fragments("the cat, 中文 sat".encode())
    assert b"".join(parts).decode() == "the cat, 中文 sat" and parts[0] == b"the" and len(parts) > 3
    tokens = {t for t in codec.token_bytes if t}
    for left, right in zip(parts, parts[1:], strict=False):
        pair = left[-1:] + right[:1]
        assert not any(pair in t for t in tokens)


def test_query_matches_the_library(spark, docs, library):
    want = {}
    for r in docs.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        want[r.doc_id] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                          hashlib.sha256(back.encode()).hexdigest())
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in op4_bpe(spark, SF).collect()}
    assert got == want


def test_nulls_repeats_and_other_columns(saved, library):
    df = saved([(None, None, "x"), (1, "", "y"), (1, "two words", "z"), (1, "two words", "z")],
               "doc_id long, text string, done string")
    out = bpe.decode(bpe.encode(df, PATH), PATH).collect()
    assert sorted((r.done, r.ids, r.decoded) for r in out) == sorted(
        (k, library.encode(t, add_special_tokens=False).ids, t) for k, t in
        (("x", ""), ("y", ""), ("z", "two words"), ("z", "two words")))
    assert [r.n_tokens for r in bpe.tokens(df.filter("doc_id is null"), PATH).collect()] == [0]
    with pytest.raises(ValueError):
        bpe.encode(df, PATH, out="done")


def test_empty_table(spark):
    assert bpe.round_trip(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0


def test_slices_cut_only_at_boundaries(codec, library, monkeypatch):
    """Texts far longer than a slice, without boundaries for long, and special tokens at slices' ends."""
    rng = random.Random(3)
    alphabet = list("ab 1.,'\n\té中  　") + ["<|endoftext|>", "supercalifragilistic"]
    texts = ["".join(rng.choice(alphabet) for _ in range(400)) for _ in range(60)] + ["a" * 3000, " " * 700 + "x", "中" * 500]
    for size in (8, 33, 256):
        monkeypatch.setattr(bpe, "SLICE", size)
        for t, mine in zip(texts, encode(codec, texts), strict=True):
            assert mine == library.encode(t, add_special_tokens=False).ids, (size, t)


def test_memo_is_bounded_in_bytes(codec, monkeypatch):
    monkeypatch.setattr(bpe, "MEMO_TOTAL", 2000)
    encode(codec, [f"word{i} other{i}" for i in range(3000)])
    encode(codec, ["x"])
    assert sum(map(len, codec.memo)) + sum(map(len, codec.memo.values())) <= 2 * bpe.SLICE


def test_clashing_names_give_way(saved):
    df = saved([(1, "two words", "x", 5)], "doc_id long, text string, ids string, n_tokens int")
    out = bpe.tokens(df, PATH)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"]
    assert out.first().n_tokens == 2 and len(out.first().ids) == 2
