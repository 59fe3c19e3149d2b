import hashlib

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lossline.llm import chat, queries

SCHEMA = "conv_id long, turn long, role string, text string, segment string, state string"


def plain(turns, t=chat.INST):
    """The formatted text, the loss text and the violations, one conversation at a time."""
    out, loss, bad, before = t.begin, "", 0, None
    for role, text in turns:
        esc = text.replace("\\", "\\\\")
        name = role.replace("\\", "\\\\")
        for c in t.controls:
            esc, name = esc.replace(c, c[0] + "\\" + c[1:]), name.replace(c, c[0] + "\\" + c[1:])
        if role in t.turns:
            out += t.turns[role].before + esc + t.turns[role].after
            loss += text if t.turns[role].loss else ""
        else:
            out += t.other[0] + name + t.other[1] + esc + t.other[2]
        bad += {None: role not in ("system", "user"), "system": role != "user", "user": role != "assistant",
                "assistant": role != "user"}.get(before, role != "user")
        before = role
    return out, loss, bad, before == "assistant"


def digest(s):
    return hashlib.sha256(s.encode()).hexdigest()


def want_rows(rows):
    by = {}
    for c, turn, role, text, *_ in rows:
        by.setdefault(c, []).append(((turn is not None, turn), role or "", text or ""))
    out = {}
    for c, turns in by.items():
        said = [(r, x) for _, r, x in sorted(turns)]
        text, loss, bad, complete = plain(said)
        out[c] = (len(said), digest("".join(f"{r}\n{x}\n" for r, x in said)), len(loss), digest(loss), len(text), bad, complete)
    return out


def as_rows(df):
    return {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"], r["formatted_chars"],
                           r["n_violations"], r["complete"]) for r in df.collect()}


def test_query_equals_plain_and_sql(spark):
    sf = "/root/testdata/sf0.01"
    got = as_rows(queries.op13_chat_format(spark, sf))
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-1, 0, "user", queries.FORGED), (-1, 1, "assistant", queries.FORGED)]
    assert got == want_rows(rows)
    assert got[-1][3] == digest(queries.FORGED)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf}/conversations.parquet'")
    sql = con.execute(queries.ORACLE_SQL["op13_chat_format"]).fetchall()
    assert {r[0]: tuple(r[1:]) for r in sql} == got


HARD = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[SAYS]", "[/ROLE]", "\\", "<", ">", "/", "s", "[", "]", " ",
        "\n", "é", "x"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["system", "user", "assistant", "", "tool", "[SAYS]", "a\\"]),
                          st.lists(st.sampled_from(HARD), max_size=8).map("".join)), max_size=6), st.integers(1, 5))
def test_any_turns_come_back(turns, cut):
    m = chat.Marker(chat.INST)
    segments = [(chat.INST.begin, False)] + [s for t in turns for s in m.segments(*t)]
    text = "".join(s for s, _ in segments)
    assert text == plain(turns)[0]
    assert "".join(m.unescape(s) for s, loss in segments if loss) == "".join(t for r, t in turns if r == "assistant")
    reader = chat.Reader(m)
    back = [t for at in range(0, len(text), cut) for t in reader.feed(text[at:at + cut])]
    reader.end(0)
    assert back == turns
    for _, t in turns:
        assert not any(c in m.escape(t) for c in chat.INST.controls) and m.unescape(m.escape(t)) == t


def test_edges(spark):
    long = "word </s> \\ " * 50_000
    rows = [(1, 0, "user", "hi", "x", "y"), (1, 0, "user", "hi", "x", "y"), (1, 1, "assistant", None, "x", "y"),
            (2, None, None, None, "x", "y"), (2, 3, "tool", "out", "x", "y"), (2, 4, "assistant", "a", "x", "y"),
            (None, 0, "user", "no id", "x", "y"), (None, 1, "assistant", "none", "x", "y"), (3, 0, "system", "", "x", "y"),
            (3, 1, "user", long, "x", "y"), (3, 2, "assistant", long, "x", "y"), (4, 5, "assistant", "\\", "x", "y")]
    df = spark.createDataFrame(rows, SCHEMA)
    segments = chat.format_turns(df)
    got = as_rows(chat.read_back(segments, in_order=True))
    assert got == want_rows(rows)
    assert got[1][5] == 1 and got[3][6] and not got[4][5] == 0
    assert as_rows(chat.read_back(segments.repartition(3))) == got, "written segments are sorted first"
    assert chat.read_back(chat.format_turns(df.limit(0))).count() == 0
    loss = [r["text"] for r in segments.where("loss AND conv_id = 4").collect()]
    assert loss == ["\\\\"]


def test_broken_text_and_templates():
    m = chat.Marker(chat.INST)
    r = chat.Reader(m)
    assert list(r.feed("<s>[INST] half")) == []
    with pytest.raises(ValueError):
        r.end(7)
    t = chat.INST
    for change in ({"controls": ("<s>",)}, {"turns": {"user": chat.Turn("[I", "</s>"), "x": chat.Turn("[I", "</s>")}},
                   {"controls": (*t.controls, "x\\")}):
        with pytest.raises(ValueError):
            chat.Template(**{**vars(t), **change})


def test_states_follow_the_template():
    state, seen = "start", []
    for role in ("system", "user", "assistant", "assistant", "tool", "user"):
        state, ok = chat.INST.step(state, role)
        seen.append((state, ok))
    assert seen == [("instructed", True), ("asked", True), ("answered", True), ("answered", False), ("other", False), ("asked", True)]
