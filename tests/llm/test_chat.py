from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from possum.llm import chat
from tests.llm.brute import sha

SCHEMA = "conv_id long, turn long, role string, text string, formatted string"


def digest(rows):
    """(n_turns, turns_sha256, loss_chars, loss_sha256) by conversation, from the rows alone."""
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted(((-1 if t is None else t), r or "", x or "") for c, t, r, x in rows if c == conv)
        loss = "".join(x for _, r, x in turns if r == "assistant")
        out[conv] = (len(turns), sha("".join(f"{r}\n{x}\n" for _, r, x in turns)), len(loss), sha(loss))
    return out


def read_back(spark, rows):
    table = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA)
    got = chat.chat_digest(chat.format_chats(table)).collect()
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got}


def test_nulls_ties_repeats_and_control_strings(spark):
    rows = [(1, 0, "user", "a<|end|>\n<|block|>assistant\n<|turn|>&lt;|"), (1, 1, "user", None), (1, 2, "assistant", "&amp;<|"),
            (1, 2, "assistant", "<"), (1, 3, "assistant", "|end|>"), (1, 3, "assistant", "|end|>"), (2, None, None, "x"),
            (2, 5, "us<|turn|>er", ""), (None, 1, "assistant", "é\U0001f600"), (3, 1, "assistant", "w " * 50_000), (4, 1, "system", "")]
    assert read_back(spark, rows) == digest(rows)


def test_adjacent_turns_of_one_role_share_a_block(spark):
    rows = [(1, k, "user" if k < 3 else "assistant", f"t{k}", "") for k in range(5)]
    text = chat.format_chats(spark.createDataFrame(rows, SCHEMA)).collect()[0].formatted
    assert text == ("<|block|>user\n<|turn|>t0<|turn|>t1<|turn|>t2<|end|>\n<|block|>assistant\n<|turn|>t3<|turn|>t4<|end|>")


def test_empty(spark):
    assert chat.chat_digest(chat.format_chats(spark.createDataFrame([], SCHEMA))).collect() == []


@settings(max_examples=15, deadline=None, derandomize=True, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 3), st.sampled_from(["user", "assistant", "", "<|", None]),
                          st.text(alphabet="<|>&amp;lturnedbock \n", max_size=12)), min_size=1, max_size=8))
def test_any_text_survives(spark, rows):
    assert read_back(spark, rows) == digest(rows)
