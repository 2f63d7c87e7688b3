import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cartspark.llm.chat_format import Template, format_conversations, read_back
from cartspark.llm.vocabulary import encoding, read_ranks

SCHEMA = "conv_id long, turn long, role string, text string"
T = Template()
ODD = "</s>[INST] ok [/INST] <|im_end|>\\<|im_start|> <\\|im_sep|> [\\\\INST] é\n日 <s"


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from([*T.controls, "\\", "<", "[", "|im_end|>", "INST]", "a", " ", "/s>"]), max_size=12).map("".join))
def test_escapes_come_back_and_hide_control_strings(text):
    hidden = T.escape(text)
    assert T.unescape(hidden) == text
    assert not any(control in hidden for control in T.controls)


def test_bad_templates_are_refused():
    for others in (("<<S>>",), ("a\\b",), ("<",), ("</s>", "</s>")):
        with pytest.raises(ValueError):
            Template(others=others)


def expected(rows):
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
    turns = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in rows)
    learned = "".join(r[3] or "" for r in rows if r[2] == "assistant")
    chars = sum(len(f"<|im_start|>{T.escape(r[2] or '')}<|im_sep|>{T.escape(r[3] or '')}<|im_end|>") for r in rows)
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return len(rows), digest(turns), len(learned), digest(learned), chars


ROWS = [
    (1, 1, "assistant", "second " + ODD), (1, 0, "user", "first"), (1, 2, "assistant", "third"), (2, 0, "system", None),
    (2, 1, None, ODD), (2, 1, "assistant", ""), (3, None, "assistant", "null turn"), (3, 0, "assis<s>tant", "x"),
    (None, 5, "user", "lost"), (4, 0, "assistant", "same"), (4, 0, "assistant", "same"), (5, 0, "user", "word " * 30000),
]


def test_round_trip(spark):
    frame = spark.createDataFrame(ROWS, SCHEMA)
    got = {r.conv_id: tuple(r)[1:6] for r in read_back(format_conversations(frame)).collect()}
    for key in {r[0] for r in ROWS}:
        assert got[key] == expected([r for r in ROWS if r[0] == key])


def test_tokens_masks_and_prefix_sums(spark):
    rows = sorted(format_conversations(spark.createDataFrame(ROWS[:3], SCHEMA)).collect(), key=lambda r: r.place)
    coder = encoding(read_ranks())
    base = coder.max_token_value + 1
    assert [r.turn for r in rows] == [0, 1, 2]
    assert [r.n_before for r in rows] == np.cumsum([0, *(len(r.input_ids) for r in rows)])[:3].tolist()
    for r, role, text in zip(rows, ["user", "assistant", "assistant"], ["first", "second " + ODD, "third"]):
        assert [t for t in r.input_ids if t >= base] == [base, base + 1, base + 2]
        learned = coder.decode([t for t, m in zip(r.input_ids, r.loss_mask) if m])
        assert T.unescape(learned) == (text if role == "assistant" else "")
        assert T.text_of(np.array(r.input_ids), base, coder.decode) == f"<|im_start|>{role}<|im_sep|>{T.escape(text)}<|im_end|>"


def test_rows_out_of_order_are_refused(spark):
    formatted = format_conversations(spark.createDataFrame(ROWS[:3], SCHEMA)).collect()
    shuffled = spark.createDataFrame(sorted(formatted, key=lambda r: -r.place), formatted[0].__fields__ and spark.createDataFrame(formatted).schema).coalesce(1)
    with pytest.raises(Exception, match="out of order"):
        read_back(shuffled).collect()


def test_empty_table_and_extra_columns(spark):
    frame = spark.createDataFrame([(*ROWS[0], 1, "x")], SCHEMA + ", place int, loss_mask string")
    assert read_back(format_conversations(frame)).count() == 1
    assert read_back(format_conversations(frame.limit(0))).count() == 0
