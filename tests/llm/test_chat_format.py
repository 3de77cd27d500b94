"""Chat formatting: the log's rules, the template's round trip, and the given conversations."""

import hashlib
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from oracle_check import compare, duckdb_on
from pyspark.sql import functions as F

from tripweave.llm import chat_format, queries

SF_DIR = "/root/testdata/sf0.001"
EVENTS = "conv_id long, seq long, part long, message long, kind string, role string, text string"
TURNS = "conv_id long, turn long, role string, text string"


def test_given_conversations(spark):
    name = "op9_chat_formatting"
    assert compare(spark, duckdb_on(SF_DIR), SF_DIR, queries.QUERIES[name], queries.ORACLES[name]) == []


def folded_by_hand(events):
    """One conversation's events applied in order to a list of messages."""
    messages = []
    for _, seq, part, message, kind, role, text in sorted(events, key=lambda e: e[1:3]):
        at = next((i for i, m in enumerate(messages) if m[0] == message), None)
        if kind in ("edit", "regenerate"):
            del messages[at + 1 :]
            messages[at][2] = text or ""
        elif at is None:
            messages.append([message, role, text or ""])
        else:
            messages[at][2] += text or ""
    return [tuple(m) for m in messages]


def test_fold_equals_applying_events_in_order(spark):
    draw = random.Random(2)
    rows, expected = [], {}
    # Every second conversation numbers its messages from 1; one has no id.
    for conv in [*range(30), None]:
        events, live, number = [], [], (conv or 0) % 2 * 1000
        for seq in range(draw.randrange(1, 25)):
            kind = draw.choice(["start", "start", "delta", "delta", "edit", "regenerate"]) if live else "start"
            if kind == "start":
                number += 1
                live.append(number)
                events.append((conv, seq, 0, number, kind, draw.choice(["user", "assistant"]), None))
            elif kind == "delta":
                events.append((conv, seq, 0, live[-1], kind, None, draw.choice(["a", "bc", None, ""])))
            else:
                target = draw.randrange(len(live))
                del live[target + 1 :]
                events.append((conv, seq, 0, live[target], kind, None, draw.choice(["new", None])))
        rows += events
        expected[conv] = folded_by_hand(events)
    draw.shuffle(rows)
    got: dict[int, list] = {}
    for r in chat_format.fold(spark.createDataFrame(rows, EVENTS)).orderBy("conv_id", "at").collect():
        got.setdefault(r.conv_id, []).append((r.message, r.role, r.text))
    assert got == expected


def test_messages_of_one_number_in_two_conversations(spark):
    """An edit in one conversation takes nothing from the other."""
    rows = [(c, n, 0, n, "start", "user", f"{c}{n}") for c in (1, 2) for n in (1, 2, 3)]
    rows.append((1, 9, 0, 1, "edit", None, "new"))
    got = chat_format.fold(spark.createDataFrame(rows, EVENTS))
    assert got.columns == ["conv_id", "message", "at", "role", "text"]
    assert sorted((r.conv_id, r.message, r.text) for r in got.collect()) == [
        (1, 1, "new"), (2, 1, "21"), (2, 2, "22"), (2, 3, "23"),
    ]


def test_edited_log_of_given_conversations(spark):
    name = "chat_log_folding"
    assert compare(spark, duckdb_on(SF_DIR), SF_DIR, queries.QUERIES[name], queries.ORACLES[name]) == []


def test_events_without_message_and_no_events(spark):
    rows = [(1, 0, 0, None, "delta", "user", "lost"), (1, 1, 0, 5, "delta", "user", "early")]
    got = chat_format.fold(spark.createDataFrame(rows, EVENTS)).collect()
    assert [(r.message, r.text) for r in got] == [(5, "early")]
    empty = spark.createDataFrame([], EVENTS)
    assert chat_format.fold(empty).collect() == []
    assert chat_format.read_back(chat_format.render(chat_format.fold(empty))).collect() == []


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["\\", "<", "/", "turn>", "</turn>", "<turn>", "\n", "n", "é", " "])).map("".join))
def test_unescaping_gives_the_text_back(text):
    code = text.replace("\\", "\\\\").replace("<turn>", "<\\turn>").replace("</turn>", "<\\/turn>")
    assert chat_format.OPEN not in code and chat_format.CLOSE not in code
    assert chat_format.unescaped(code) == text


def test_turns_and_loss_come_back_from_the_output(spark):
    turns = [
        (1, 1, "assistant", "</turn>\n<turn>assistant\n\\"), (1, 0, "user", "\\### Assistant: </turn> ok"),
        (1, 2, "od\\d\nrole", "x" * 5000), (1, None, "system", None), (None, 0, None, "no conversation"),
        (2, 0, "assistant", ""), (2, 0, "assistant", ""), (3, 0, "assistant", "é😀" * 1500),
    ]
    frame = spark.createDataFrame(turns, TURNS).selectExpr("*", "1 as message", "2 as seq", "'k' as kind")
    rendered = chat_format.format_turns(frame)
    got = {r.conv_id: tuple(r)[1:] for r in chat_format.read_back(rendered).collect()}
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    for conv in {t[0] for t in turns}:
        own = sorted((t[1] is not None, t[1] or 0, t[2] or "", t[3] or "") for t in turns if t[0] == conv)
        learned = "".join(t[3] for t in own if t[2] == "assistant")
        n, digest, chars, loss, _ = got[conv]
        assert (n, digest) == (len(own), sha("".join(f"{t[2]}\n{t[3]}\n" for t in own)))
        assert (chars, loss) == (len(learned), sha(learned))
    sizes = rendered.groupBy("conv_id").agg(F.sum(F.length("formatted")).alias("n")).collect()
    assert {r.conv_id: r.n for r in sizes} == {conv: row[4] for conv, row in got.items()}
    whole = "".join(r.formatted for r in rendered.where("conv_id = 1").orderBy("at", "formatted").collect())
    assert whole.count(chat_format.OPEN) == whole.count(chat_format.CLOSE) == 4
