from __future__ import annotations

import hashlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from dispersa.llm import chat_windows as C
from tests.llm import cases

SCHEMA = "conv_id long, turn long, role string, text string, segment long, window string, long string, loss string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "w", "l", "x") for r in rows], SCHEMA)


def digests(rows):
    """The contract's columns without ``formatted_chars``, straight from the rows."""
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        convs[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = set()
    for conv, turns in convs.items():
        turns.sort()
        loss = "".join(t for _, _, r, t in turns if r == "assistant")
        whole = "".join(f"{r}\n{t}\n" for _, _, r, t in turns)
        out.add((conv, len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss),
                 hashlib.sha256(loss.encode()).hexdigest()))
    return out


PARTS = ["\\", "#", "##", "###", "### ", "</turn>", "</turn", "<", "/", "turn>", "\n", ": ", ":", " ", "a", "é", "𝒳",
         "assistant", "### assistant: ", "<\\/turn>", "##\\#"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.lists(st.sampled_from(PARTS)).map("".join), st.lists(st.sampled_from(PARTS)).map("".join))))
def test_template_is_reversible(turns):
    pieces = [f"### {C.escape_role(r)}: {C.escape(t)}{C.END}" for r, t in turns]
    assert C.turns_of("".join(pieces)) == turns
    for (r, t), piece in zip(turns, pieces):
        assert "</turn>" not in C.escape(t) and "###" not in C.escape(t) and piece.count(C.END) == 1


CASES = [(1, 0, "user", "hi"), (1, 1, "assistant", "one two"), (1, 1, "assistant", "one two"), (1, None, "system", "be kind"),
         (2, 0, None, None), (2, 1, "assistant", None), (3, 5, "ro: le\n###", "\\### Assistant: </turn> ok"),
         (None, 0, "user", "no id"), (None, 1, "assistant", "still read"), (4, 0, "assistant", "w " * 5000),
         (-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok"),
         (6, -3, "user", "before"), (6, 2, "assistant", "after")]


def test_read_back_equals_the_rows(spark):
    rows = CASES + [(5, t, ("user", "assistant")[t % 2], f"turn {t} " * (t % 40)) for t in range(60)]
    got = C.read_back(C.format_windows(frame(spark, rows).repartition(4), budget=60, history=20)).collect()
    assert {tuple(r)[:5] for r in got} == digests(rows) and len(got) == len({r[0] for r in rows})


def test_long_conversation_is_cut_into_segments(spark):
    rows = [(9, t, "system" if t == 0 else ("user", "assistant")[t % 2], f"text {t}") for t in range(3000)] + CASES
    windows = C.format_windows(frame(spark, rows), budget=100, history=30)
    got = windows.where("conv_id = 9").collect()
    assert {r.segment for r in got} == {0, 1, 2} and all(r.long for r in got)
    for r in got:  # all windows but the first start with the system turn
        assert C.turns_of(r.text)[0] == ("system", "text 0")
    assert {tuple(r)[:5] for r in C.read_back(windows).collect()} == digests(rows)


def test_budget_history_and_mask(spark):
    rows = [(1, 0, "system", "s " * 4)] + [(1, t, ("assistant", "user")[t % 2], f"x{t} " * (1 + t % 7)) for t in range(1, 50)]
    got = sorted(C.format_windows(frame(spark, rows), budget=40, history=12).collect(), key=lambda r: r.window)
    seen, targets = [], []
    for r in got:
        turns = C.turns_of(r.text)
        assert C.count_words(r.text) <= 40 and len(turns) == r.n_repeated + r.n_new
        lead = turns[: r.n_repeated]
        if r.window:
            assert lead[0] == ("system", "s " * 4)
            history = lead[1:]
            assert history == seen[len(seen) - len(history):]  # the latest turns, in order
            size = lambda ts: sum(C.count_words(f"### {a}: {b}</turn>") for a, b in ts)
            assert size(history) <= 12
        seen += turns[r.n_repeated:]
        targets += [C.unescape(r.text[s.start: s.end]) for s in r.loss]
    assert seen == [(r[2], r[3]) for r in rows]
    assert targets == [t for _, _, role, t in rows if role == "assistant"]
    assert any(r.n_repeated > 1 for r in got)


def test_a_turn_above_the_budget_stands_alone(spark):
    got = C.format_windows(frame(spark, [(1, 0, "user", "a b"), (1, 1, "assistant", "w " * 50), (1, 2, "user", "c")]),
                           budget=20, history=20).collect()
    assert sorted((r.window, r.n_new) for r in got) == [(0, 1), (1, 1), (2, 1)]


def test_empty_table_and_bad_parameters(spark):
    empty = frame(spark, CASES).where("conv_id > 100")
    assert C.format_windows(empty).count() == 0 and C.read_back(C.format_windows(empty)).count() == 0
    with pytest.raises(ValueError):
        C.format_windows(empty, budget=0)


def test_awkward_documents_as_turns(spark):
    rows = [(i, n, "assistant", t) for n, (i, t) in enumerate(cases.awkward())]
    assert {tuple(r)[:5] for r in C.read_back(C.format_windows(frame(spark, rows))).collect()} == digests(rows)
