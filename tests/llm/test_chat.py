from tillroll.llm import chat
from tillroll.llm.queries import op3_chat

from .conftest import SF

SCHEMA = "conv_id long, turn long, role string, text string, speaker string"


def test_rotation_and_masks(saved):
    df = saved([(1, 0, "ann", "Hi", "z"), (1, 1, "bob", "Yo <|im_end|>", "z"), (1, 2, "ann", "Bye", "z")], SCHEMA)
    rows = {r.speaker: r for r in chat.rotate(df).collect()}
    assert rows["ann"].dialogue == ("<|im_start|>assistant\nHi<|im_end|>\n<|im_start|>user name=bob\nYo < |im_end|>"
                                    "<|im_end|>\n<|im_start|>assistant\nBye<|im_end|>\n")
    for r in rows.values():
        own = [r.dialogue[int(a):int(b)] for a, b in (m.split(":") for m in r.mask.split(","))]
        assert own == {"ann": ["Hi<|im_end|>\n", "Bye<|im_end|>\n"], "bob": ["Yo < |im_end|><|im_end|>\n"]}[r.speaker]
        assert r.n_spoken == len(own) and r.n_turns == 3


def test_nulls_ties_and_repeats(saved):
    df = saved([(1, None, None, None, ""), (1, 0, "b", "x", ""), (1, 0, "a", "x", ""), (1, 0, "a", "x", ""),
                (None, 0, "a", "one", ""), (None, 0, "a", "two", "")], SCHEMA)
    rows = chat.rotate(df).collect()
    one = [r for r in rows if r.conv_id == 1]
    assert {r.speaker for r in one} == {"unknown", "a", "b"} and {r.n_turns for r in one} == {3}
    assert next(r for r in one if r.speaker == "a").dialogue.startswith("<|im_start|>user name=unknown\n<|im_end|>")
    assert sorted(r.n_turns for r in rows if r.conv_id is None) == [1, 1]


def test_long_dialogues_come_in_parts(saved):
    df = saved([(1, t, "ab"[t % 2], f"t{t}", "") for t in range(25)], SCHEMA)
    rows = chat.rotate(df, part_turns=10).collect()
    assert sorted((r.part, r.speaker, r.n_turns) for r in rows) == [
        (p, s, n) for p, n in ((0, 10), (1, 10), (2, 5)) for s in "ab"]
    assert sum(r.n_spoken for r in rows) == 25


def test_query_matches_sql(spark, same):
    same(op3_chat(spark, SF), chat.SQL)


def test_empty_table(spark):
    assert chat.rotate(spark.createDataFrame([], SCHEMA)).count() == 0


def test_ordered_parts_are_the_whole_rendering(saved):
    said = [(1, t, "cass" if t in (3, 17) else "ab"[t % 2], f"t{t} é", "") for t in range(25)] + [
        (2, 0, "a", "x", ""), (2, 30, "dd", "y", ""), (3, 0, "e", "z", ""), (None, 0, "f", "w", ""), (None, 30, "f", "v", "")]
    df = saved(said, SCHEMA)
    whole = {(r.conv_id, r.speaker): r for r in chat.rotate(df, part_turns=1000).collect() if r.conv_id}
    parts = {}
    for r in sorted((r for r in chat.rotate(df, part_turns=5).collect() if r.conv_id), key=lambda r: r.part):
        parts.setdefault((r.conv_id, r.speaker), []).append(r)
    assert set(parts) == set(whole) and len(parts[1, "cass"]) == 5
    for key, rows in parts.items():
        assert "".join(r.dialogue for r in rows) == whole[key].dialogue
        assert ",".join(r.mask for r in rows if r.mask) == whole[key].mask
        assert sum(r.n_spoken for r in rows) == whole[key].n_spoken
        assert sum(r.n_turns for r in rows) == whole[key].n_turns


def test_null_and_tied_turns_are_cut_by_rows(saved):
    said = [(1, None, "ab"[k % 2], f"null {k}", "") for k in range(23)] + [
        (1, 4, "ab"[k % 2], f"tie {k}", "") for k in range(23)] + [(1, -3, "a", "minus", ""), (2, 9999, "a", "far", "")]
    df = saved(said, SCHEMA)
    whole = {(r.conv_id, r.speaker): r for r in chat.rotate(df, part_turns=1000).collect()}
    rows = sorted(chat.rotate(df, part_turns=10).collect(), key=lambda r: r.part)
    assert [(r.part, r.n_turns) for r in rows if r.conv_id == 1 and r.speaker == "a"] == [
        (0, 10), (1, 10), (2, 10), (3, 10), (4, 7)]
    assert [r.part for r in rows if r.conv_id == 2] == [0]
    for key, one in whole.items():
        mine = [r for r in rows if (r.conv_id, r.speaker) == key]
        assert "".join(r.dialogue for r in mine) == one.dialogue
        assert ",".join(r.mask for r in mine if r.mask) == one.mask


def test_sql_agrees_on_long_and_odd_dialogues(spark):
    import duckdb
    rows = [(1, 600 + k // 3, "abc"[k % 3], f"said <| {k}") for k in range(1300)]       # turn numbers repeat, three parts
    rows += [(2, t, "only", "x") for t in (600, 601, 3)] + [(3, None, None, None), (3, 1, "a\nb", "é👍"), (None, 1, "a", "y"), (None, 2, "b", "y")]
    rows += rows[:5]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    con = duckdb.connect()
    con.execute("create table conversations (conv_id bigint, turn int, role varchar, text varchar)")
    con.executemany("insert into conversations values (?, ?, ?, ?)", rows)
    cur = con.execute(chat.SQL)
    names = [d[0] for d in cur.description]
    want = sorted(map(repr, cur.fetchall()))
    got = sorted(repr(tuple(r)) for r in chat.rotate(df).select(*names).collect())
    assert got == want and len([r for r in got if r.startswith("(1, ")]) == 9
