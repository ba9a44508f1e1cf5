"""Chat windows: round trip, loss once, budgets."""

from __future__ import annotations

import hashlib
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from linkyard.llm.chat import HARD_TEXT, chat_windows, escape, format_and_read, unescape, with_hard_conversation

SCHEMA = "conv_id long, turn long, role string, text string"


def _brute(rows):
    out = {}
    key = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for conv in {r[0] for r in rows}:
        turns = sorted((r for r in rows if r[0] == conv), key=key)
        whole = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in turns)
        loss = "".join(r[3] or "" for r in turns if r[2] == "assistant")
        out[conv] = (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def _rows():
    rnd = random.Random(2)
    rows = [(-7, 0, "user", HARD_TEXT), (-7, 1, "assistant", HARD_TEXT), (1, 0, "system", "be <kind> \\ "), (1, 1, "user", None),
            (1, 2, "assistant", ""), (1, 2, "assistant", "tie"), (1, 2, "assistant", "tie"), (None, 0, "user", "no id"),
            (None, None, None, None), (2, 0, "ass>istant", "</turn>\n<turn assistant>"), (3, 5, "assistant", "漢😀 \r\n" * 50),
            (4, 0, "assistant", "w " * 5000)]
    rows += [(9, t, "system" if t == 0 else ("user", "assistant")[t % 2], " ".join("ab<c" for _ in range(rnd.randint(0, 40))))
             for t in range(700)]
    return rows


def test_round_trip(spark):
    got = format_and_read(spark.createDataFrame(_rows(), SCHEMA), budget=200, history=40).collect()
    assert {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in got} == _brute(_rows())
    assert {r["conv_id"]: r["n_windows"] for r in got}[9] > 20


def test_windows_keep_system_turn_history_and_budget(spark):
    rows = [r for r in _rows() if r[0] == 9]
    windows = chat_windows(spark.createDataFrame(rows, SCHEMA), budget=200, history=60).orderBy("window").collect()
    system = f"<turn system>{escape(rows[0][3])}</turn>\n"
    assert all(w["text"].startswith(system) for w in windows)
    assert all(w["n_tokens"] <= 200 for w in windows)
    assert all(w["n_repeated"] >= 2 for w in windows[1:])  # the system turn and some history
    for w in windows:
        inner = [unescape(w["text"][a:b]) for a, b in zip(w["loss_from"], w["loss_to"])]
        assert all(f"<turn assistant>{escape(t)}</turn>" in w["text"] for t in inner)
    assert sum(len(w["loss_from"]) for w in windows) == sum(r[2] == "assistant" for r in rows)


def test_hard_conversation_and_no_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert format_and_read(none).count() == 0
    got = format_and_read(with_hard_conversation(none)).collect()
    assert [r["conv_id"] for r in got] == [-7] and got[0]["loss_chars"] == len(HARD_TEXT)


@settings(max_examples=80, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("\\<>/turn assistant\n")), max_size=40))
def test_escape_is_reversible_and_hides_marks(text):
    assert unescape(escape(text)) == text
    assert "</turn>" not in escape(text).replace("\\<", "").replace("\\>", "")
