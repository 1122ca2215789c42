"""Operator 11 against a sequential fold of whole logs."""

import hashlib
import random

import pytest
from hypothesis import given
from hypothesis import strategies as st

import compare
from tidemark.llm import chat

EVENT = "conv_id long, message long, seq long, kind string, role string, text string"
SIGNS = ["<", ">", "[", "]", "\\", "/", "s", "INST", "SYS", "ROLE", "TEXT", " ", "\n", "é", "🙂", "</s>", "[/INST]", "<<TEXT>>", "<\\s>", "[\\\\INST]"]
said = st.lists(st.sampled_from(SIGNS), max_size=12).map("".join)
roles = st.one_of(st.sampled_from(["user", "assistant", "system", "", "tool"]), said)


@given(st.lists(st.tuples(roles, said), max_size=6))
def test_template_is_reversible(messages):
    formatted, mask = chat.render(messages)
    assert chat.parse(formatted) == messages
    learned = [chat.unescape(formatted[a:b]) for a, b in mask]
    assert learned == [text for role, text in messages if role == "assistant"]


@given(said)
def test_escaped_text_holds_no_control_string(text):
    escaped = chat.escape(text)
    assert chat.unescape(escaped) == text
    assert not any(mark in escaped for mark in ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<<ROLE>>", "<<TEXT>>", "<</ROLE>>"))


def test_control_strings_in_the_template():
    formatted, mask = chat.render([("user", chat.PROBE), ("assistant", chat.PROBE)])
    assert formatted == "[INST] <\\/s>[\\INST] ok [\\/INST] [/INST]\n<s> <\\/s>[\\INST] ok [\\/INST] </s>\n" and mask == [(44, 68)]
    with pytest.raises(ValueError, match="no message begins"):
        chat.parse(formatted[1:])


def folded(events):
    """Messages of each conversation: events in order of seq over the whole conversation."""
    least = -(2**63)
    kinds = {"regenerate": 1, "message": 2, "edit": 3, "delta": 4}
    logs = {}
    for conv, number, seq, kind, role, text in events:
        row = (least if seq is None else seq, least if number is None else number, kind or "message", role or "", text or "")
        logs.setdefault(conv, []).append(row)
    out = {}
    for conv, log in logs.items():
        entries = {}
        for _, number, kind, role, text in sorted(log, key=lambda e: (e[0], kinds[e[2]], e[3], e[4])):
            if kind == "regenerate":
                entries = {k: v for k, v in entries.items() if k < number}
                continue
            own = entries.setdefault(number, [])
            if kind == "message" or not own:
                own.append((role, text))
            elif kind == "delta":
                own[-1] = (own[-1][0], own[-1][1] + text)
            else:
                own[-1] = (role or own[-1][0], text)
        if messages := [entry for number in sorted(entries) for entry in entries[number]]:
            out[conv] = messages
    return out


def random_log(seed, conversations=30, hot=2_000):
    rng = random.Random(seed)
    text = lambda: "".join(rng.choice(SIGNS) for _ in range(rng.randint(0, 8)))
    events = []
    for conv in range(conversations):
        top, size = (1_200, hot) if conv == 0 else (rng.choice([1, 5, 600]), rng.randint(1, 60))
        for seq in rng.sample(range(10 * size), size):
            kind = rng.choices(["message", "delta", "edit", "regenerate"], [6, 6, 2, 0.4])[0]
            events.append((conv, rng.randrange(top) - 3, seq, kind, rng.choice(["user", "assistant", "system", "tool", None]), text()))
    rng.shuffle(events)
    return events


def pieces_of(frame):
    rows = sorted(frame.collect(), key=lambda r: (str(r.conv_id), r.block, r.piece))
    out = {}
    for row in rows:
        messages = chat.parse(row.formatted)
        assert len(messages) == row.n_turns
        assert [chat.unescape(row.formatted[s.start : s.end]) for s in row["mask"]] == [t for r, t in messages if r == "assistant"]
        out.setdefault(row.conv_id, []).extend(messages)
    return out, rows


@pytest.mark.parametrize("seed, limit", [(1, 4 << 20), (2, 40), (3, 0)])
def test_logs_equal_a_sequential_fold(spark, seed, limit):
    events = random_log(seed)
    frame = spark.createDataFrame(events, EVENT)
    found, rows = pieces_of(chat.format_conversations(frame, limit))
    assert found == folded(events)
    assert len({row.block for row in rows if row.conv_id == 0}) == 6
    if limit <= 40:
        assert len(rows) > len(found)


def test_odd_events(spark):
    events = [
        (1, 0, 0, None, "user", "null kind"), (1, 0, 0, None, "user", "null kind"), (1, None, None, "message", None, None),
        (None, 1, 1, "delta", "assistant", "opens"), (None, 1, 2, "edit", None, "keeps the role"), (None, 1, 3, "edit", "user", "new role"),
        (2, 5, 1, "message", "assistant", "first"), (2, 5, 2, "regenerate", None, None), (2, 5, 3, "delta", "assistant", "sec"), (2, 5, 4, "delta", None, "ond"),
        (2, 700, 1, "message", "user", "gone with it"), (2, 700, 9, "message", "user", "stays"), (3, 1, 1, "message", "user", "x" * 300_000),
        (4, 1, 1, "message", "user", "all gone"), (4, 0, 2, "regenerate", None, None),
    ]
    frame = spark.createDataFrame([(*e, 1, "rank") for e in events], EVENT + ", block int, piece string")
    found, _ = pieces_of(chat.format_conversations(frame))
    assert found == folded(events) and 4 not in found
    assert found[2] == [("assistant", "second"), ("user", "stays")] and found[None] == [("user", "new role")]
    assert found[1] == [("", ""), ("user", "null kind"), ("user", "null kind")]
    assert chat.format_conversations(frame.limit(0)).collect() == []
    assert chat.digests(chat.format_conversations(frame.limit(0))).collect() == []
    with pytest.raises(Exception, match="unknown kind of event: typo"):
        chat.format_conversations(spark.createDataFrame([(1, 1, 1, "typo", "user", "")], EVENT)).collect()


def test_digests_equal_the_messages(spark):
    events = random_log(7)
    done = {row.conv_id: row for row in chat.digests(chat.format_conversations(spark.createDataFrame(events, EVENT), 100)).collect()}
    wanted = folded(events)
    assert done.keys() == wanted.keys()
    for conv, messages in wanted.items():
        learned = "".join(text for role, text in messages if role == "assistant")
        assert tuple(done[conv])[1:] == (
            len(messages),
            hashlib.sha256("".join(f"{role}\n{text}\n" for role, text in messages).encode()).hexdigest(),
            len(learned),
            hashlib.sha256(learned.encode()).hexdigest(),
            len(chat.render(messages)[0]),
        )


def test_query_over_odd_conversations(spark, tmp_path):
    rows = [(1, 1, "user", "b"), (1, 0, "system", "</s>"), (1, 1, "assistant", "tie"), (2, None, None, None), (2, 3, "tool<s>", "x"), (2, 3, "tool<s>", "x"), (None, 0, "assistant", "")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    engine = compare.duckdb.connect()
    engine.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    assert compare.difference(chat.op11, chat.OP11_SQL, spark, engine, str(tmp_path)) is None
    assert {row.conv_id for row in chat.op11(spark, str(tmp_path)).collect()} == {1, 2, None, -7}
