from __future__ import annotations

import re
from collections import Counter

from dispersa.llm import quality_rules as Q
from tests.llm import cases


def counts(text):
    w = cases.words(text)
    three = [tuple(w[i: i + 3]) for i in range(len(w) - 2)]
    often, again = Counter(three), [0] * len(w)
    for i, x in enumerate(three):
        if often[x] > 1:
            again[i: i + 3] = [1, 1, 1]
    lines = [x for x in (text or "").split("\n") if cases.words(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), sum(again),
            len(w) < 50 or 100 * sum(again) > 50 * len(w))


PROSE = ["The river ran past the old mill and nobody had opened its heavy door for many long years.",
         "In spring the children came down from the village to look at the wheel that no longer turned.",
         "They said that a miller had lived there with two dogs, a clock and a very bad memory for names.",
         "When rain fell, water still found its way over the stones and made the same low sound as before."]


def test_counts_match_brute_force(spark):
    rows = cases.awkward() + [(20, "\n".join(PROSE + PROSE[:2])), (21, "a b c a b c\n\n a b c\n#x# | <y>\nx\nx \nx")]
    cols = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert cases.rows_of(Q.judge_lines(cases.frame(spark, rows)), *cols) == Counter((i, *counts(t)) for i, t in rows)


def test_lines_are_judged_and_documents_that_lose_much_go(spark):
    clean = "\n".join(PROSE)
    rows = [(1, clean), (2, clean + "\nHome | News | Sport | Contact"), (3, "\n".join(PROSE).upper()),
            (4, "\n".join("Home | News | Sport | Shop | Contact | About | Login | Help | Map | Jobs." + f" {i}" for i in range(9))),
            (5, clean + "\nWe use JavaScript on this page."), (6, clean + "\n" + PROSE[0]), (7, None)]
    verdict = {r.doc_id: r for r in Q.judge_lines(cases.frame(spark, rows), with_text=True).collect()}
    assert {i for i, r in verdict.items() if r.kept} == {1, 2, 5, 6}
    assert verdict[1].clean_text == clean and verdict[1].n_bad_lines == 0
    assert all(verdict[i].clean_text.strip() == clean for i in (2, 5, 6))


def test_clean_documents_keeps_columns_and_rows(spark):
    clean = "\n".join(PROSE)
    out = Q.clean_documents(cases.frame(spark, [(1, clean), (1, clean), (None, clean), (2, "x")]))
    assert out.columns == cases.empty(spark).columns
    assert cases.rows_of(out) == Counter({(1, clean, "h", 7, "t", "l"): 2, (None, clean, "h", 7, "t", "l"): 1})
    assert Q.judge_lines(cases.empty(spark)).count() == 0 and Q.clean_documents(cases.empty(spark)).count() == 0


def test_phrases_are_whole_words(spark):
    clean = "\n".join(PROSE)
    lines = ["The catalog index of the old library was kept in a drawer.", "Its design includes a long hall and two small towers.",
             "Her blog introduced the readers to the old mill.", "Please LOG IN, to see the old mill.", "Log in.",
             "To see more of the mill, sign in"]
    rows = [(i, f"{clean}\n{x}") for i, x in enumerate(lines)] + [(9, "log")]
    bad = {r.doc_id: r.n_bad_lines for r in Q.judge_lines(cases.frame(spark, rows).coalesce(1)).collect()}
    assert bad == {0: 0, 1: 0, 2: 0, 3: 1, 4: 1, 5: 1, 9: 1}
