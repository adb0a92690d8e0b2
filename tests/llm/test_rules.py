"""Quality rules against plain Python, the SQL and other orders of the cascade."""

import re
from collections import Counter

import pytest
from checks.compare import difference, duck
from revrecon.llm.queries import ORACLES, REGISTRY
from revrecon.llm.quality_rules import BASE, MEASURES, RULES, Cascade, Page, Rule, judge_documents
from revrecon.llm.common import table

SF = "/root/testdata/sf0.001"
SPACE = "[\x20\x09-\x0d]"


def measured(text):
    words = re.findall("[^\x20\x09-\x0d]+", text)
    windows = list(zip(words, words[1:], words[2:], strict=False))
    often, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if often[w] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


TEXTS = [
    "",
    None,
    " \t\n\x0b\x0c\r ",
    "one",
    "a b c a b c",
    "a a a a",
    "a b a b a b",
    "x y z w",  # white space beyond ASCII does not end a word
    "line one\nline one\n\n \nline one ",
    "# $ % & | < > *** a",
    "été été été œuvre 東京 🙂🙂",
    "word " * 60,
    " ".join(f"w{i}" for i in range(70)),
    " ".join(f"W{i}" for i in range(70)),
    "\n".join(f"clean line number {i} of many with words" for i in range(40)),
    ("lorem ipsum dolor " * 300_000) + "end",
]


def test_measures_and_base_match_plain_python(make_docs):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "no id"), (4, "a b c a b c"), (4, "a b c a b c")]
    got = judge_documents(make_docs(rows)).collect()
    assert len(got) == len(rows)
    want = []
    for i, t in rows:
        m = measured(t or "")
        want.append((i, *m, m[0] < 50 or 100 * m[4] > 50 * m[0]))
    key = lambda r: repr(r)
    assert sorted(((r.doc_id, *[r[m] for m in MEASURES], r.base_failed) for r in got), key=key) == sorted(want, key=key)
    assert all(not r.kept for r in got if r.base_failed)
    assert all((r.rejected_by is None) == r.kept for r in got)


def test_words_are_cut_out_in_pieces(monkeypatch):
    monkeypatch.setattr("revrecon.llm.quality_rules.PIECE", 7)
    text = "alpha beta  gamma\nalpha verylongwordindeed beta\t\n gamma delta "
    words = text.split()
    ids = Page(text).word_ids
    assert len(ids) == len(words)
    assert all((ids[i] == ids[j]) == (words[i] == words[j]) for i in range(len(words)) for j in range(len(words)))


def test_an_empty_table(make_docs):
    assert judge_documents(make_docs([])).collect() == []


@pytest.mark.parametrize("order", [0, 1, 2])
def test_the_verdict_is_the_same_in_any_order(spark, order):
    rules = [RULES, RULES[::-1], (*RULES[3:], *RULES[:3])][order]
    docs = table(spark, SF, "documents")
    got = {(r.doc_id, r.kept) for r in judge_documents(docs, rules=rules).select("doc_id", "kept").collect()}
    plain = set()
    for r in docs.select("doc_id", "text").collect():
        page = Page(r.text or "")
        plain.add((r.doc_id, not any(rule.rejects(page) for rule in (*BASE, *RULES))))
    assert got == plain


def test_the_cascade_runs_cheap_and_rejecting_rules_first():
    def slow(page):
        sum(range(20_000))
        return False

    calls = []
    rules = [Rule("slow", slow), Rule("never", lambda p: False), Rule("half", lambda p: calls.append(1) or "x" in p.text)]
    cascade = Cascade(rules, (), first=20, every=10**9, trials=16)
    for i in range(400):
        assert cascade.judge(Page("x" if i % 2 else "y")) == ("half" if i % 2 else None)
    assert [rules[k].name for k in cascade.order] == ["half", "never", "slow"]
    assert len(calls) == 420  # once for every page, and once more for each of the sample
    assert cascade.calls < 400 * 2 + 60


def test_a_cascade_without_rules_rejects_nothing():
    assert Cascade((), ()).judge(Page("x")) is None


def test_labels_agree_with_the_rules(spark):
    docs, labels = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")
    got = judge_documents(docs).join(labels, "doc_id").where("n_words >= 50").select("quality", "kept").collect()
    good, bad = [r.kept for r in got if r.quality == 1], [r.kept for r in got if r.quality == 0]
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.05 * len(bad)


def test_query_equals_sql(spark):
    assert difference(REGISTRY["op13_quality_rules"](spark, SF), duck(SF), ORACLES["op13_quality_rules"]) is None
