import hashlib
import re

from tillroll.llm import pii
from tillroll.llm.queries import op9_pii

from .conftest import SF

ODD = ["a@b.c_d@e.fx y@z.com@q.r.s", "1.2.3.4.5.6.7.8 999.1.1.1 001.002.3.4", "4465758382889437 4465758382889437 x",
       "4111 1111 1111 1111-5", "+1 (743) 555-3824 +12 +1+2345678901", "é@x.de 👍 a.b+c@d-e.f.g. +49 170 1234567",
       "iban GB82 WEST 1234 5698 7654 32 ok, GB83 WEST 1234 5698 7654 32", "", None,
       "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6  7", "0" * 30 + " 5-5-5", "a" * 50_000 + "@x", "1" * 50_000 + ".2.3.4",
       "256.1.1.1 00000255.1.1.1 1.2.3.٣", "+1234567 89\n", "x" * 200_000 + " me@home.org"]


def luhn(d):
    total = 0
    for k, c in enumerate(reversed(d)):
        n = int(c) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base(t):
    t, out = t or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t if "@" in t[:40_000] or len(t) < 40_000
                         else t[-1000:]):
        out.append((m.start() + (len(t) - 1000 if m.string is not t else 0), 0, "email",
                    m.end() + (len(t) - 1000 if m.string is not t else 0)))
    for m in re.finditer(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m[0].split(".")):
            out.append((m.start(), 1, "ip", m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[ -]", "", m[0])
        if 12 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, "card", m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, "phone", m.end()))
    return sorted(out)


def check(rows, texts):
    assert len(rows) == len(texts)
    for r in rows:
        spans = base(texts[r.doc_id])
        text = ",".join(f"{k}:{a}:{b}" for a, _, k, b in spans)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest(), (r, text)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[2] == k for s in spans)
                                                            for k in ("email", "ip", "card", "phone")]


def test_odd_texts_match_brute_force(saved):
    df = saved(list(enumerate(ODD)), "doc_id long, text string")
    check(pii.digest(pii.find(df)).collect(), dict(enumerate(ODD)))


def test_query_matches_brute_force(spark, docs):
    check(op9_pii(spark, SF).collect(), {r.doc_id: r.text for r in docs.collect()})


def test_checksums_and_context(saved):
    df = saved([(1, "my card 4465758382889437"), (2, "4465758382889437"), (3, "4465758382889438"),
                (4, "GB82 WEST 1234 5698 7654 32"), (5, "GB83 WEST 1234 5698 7654 32")], "doc_id long, text string")
    rows = {r.doc_id: r for r in pii.digest(pii.find(df)).collect()}
    assert rows[1].max_score > rows[2].max_score > 0 and rows[3].max_score == 0
    assert rows[4].n_iban == 1 and rows[5].n_iban == 0


def test_redact_keeps_other_columns(saved):
    df = saved([(1, "a@b.de and +49 170 1234567.", "x"), (2, None, "y")], "doc_id long, text string, row string")
    out = {r.doc_id: r for r in pii.redact(df).collect()}
    assert out[1].text == "<email> and <phone>." and out[1].row == "x" and out[2].text == ""


def test_empty_nulls_and_native_plan(spark, saved):
    assert pii.find(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    df = saved([(None, "a@b.de"), (None, "a@b.de")], "doc_id long, text string")
    assert [r.n_email for r in pii.digest(pii.find(df)).collect()] == [1, 1]
    plan = pii.digest(pii.find(df))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_context_counts_on_both_sides_and_beyond_other_matches(spark):
    card, far = "4111 1111 1111 1111", " ." * 30
    texts = [f"{card} is my card", f"card: {card}, {card}", f"{card}, {card} - visa", f"{card}{far}card", f"card{far}{card}",
             f"no word: {card}"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: [round(s.score, 2) for s in r.spans if s.kind == "card"] for r in pii.find(df).collect()}
    assert got == {0: [.75], 1: [.75, .75], 2: [.75, .75], 3: [.6], 4: [.6], 5: [.6]}


def test_many_matches_take_linear_time(saved):
    """Four times the addresses in one text, far less than sixteen times the work."""
    import time
    took = []
    for n in (8_000, 32_000):
        df = saved([(1, " ".join(f"user{i}@home{i % 7}.org" for i in range(n)))], "doc_id long, text string", 1)
        for _ in range(2):
            t = time.perf_counter()
            r = pii.digest(pii.find(df)).first()
        took.append(time.perf_counter() - t)
        assert r.n_email == n
    assert took[1] < 8 * max(took[0], 0.5), took


def test_blocks_change_nothing(saved, monkeypatch):
    texts = [*ODD, " mail ".join(f"a{i}@b.de 4111 1111 1111 1111 +1 (743) 555-38{i % 90 + 10}" for i in range(40))]
    df = saved(list(enumerate(texts)), "doc_id long, text string")
    want = {r.doc_id: r for r in pii.digest(pii.find(df)).collect()}
    whole = {r.doc_id: r.text for r in pii.redact(df).collect()}
    monkeypatch.setattr(pii, "FOLD", 3)
    assert {r.doc_id: r for r in pii.digest(pii.find(df)).collect()} == want
    assert {r.doc_id: r.text for r in pii.redact(df).collect()} == whole
    assert whole[len(texts) - 1].count("<email>") == 40 and "@" not in whole[len(texts) - 1]
