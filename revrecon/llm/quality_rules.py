"""Quality rules over whole texts: a short-circuit cascade that orders its rules by what they reject for what they cost."""

from __future__ import annotations

import re
import time
from array import array
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revrecon.llm.common import table, text_of

#: White space between words, characters that count as symbols, capital and small letters.
SPACE, SYMBOLS = b" \t\n\x0b\x0c\r", b"#*$%&|<>"
CAPITALS, SMALL = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
#: A word without a letter; every character beyond ASCII counts as one.
NO_LETTER = re.compile(rb"(?<![^ \t\n\x0b\x0c\r])[^ \t\n\x0b\x0c\rA-Za-z\x80-\xff]+(?![^ \t\n\x0b\x0c\r])")
#: Bytes of text whose words are objects at one time.
PIECE = 1 << 20
#: Every task tries all rules on its first so many documents and on one of so many later ones, and keeps the last so many trials.
FIRST, EVERY, TRIALS = 64, 200, 256


def _taken(data: bytes, some: bytes) -> int:
    return len(data) - len(data.translate(None, some))


class Page:
    """A text and what rules ask of it; each measure is taken when it is first asked for."""

    def __init__(self, text: str):
        self.text, self.data = text, text.encode()

    @cached_property
    def word_ids(self) -> np.ndarray:
        """The words as numbers, equal words alike; words are cut out piece by piece, so a long text is never a list of words."""
        known, ids, at = {}, array("q"), 0
        while at < len(self.data):
            end = at + PIECE
            while end < len(self.data) and self.data[end] not in SPACE:
                end += 1
            ids.extend(known.setdefault(w, len(known)) for w in self.data[at:end].split())
            at = end
        return np.frombuffer(ids, np.int64) if ids else np.zeros(0, np.int64)

    @cached_property
    def n_words(self) -> int:
        return len(self.word_ids)

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - _taken(self.data, SPACE)

    @cached_property
    def n_symbols(self) -> int:
        return _taken(self.data, SYMBOLS)

    @cached_property
    def worded_lines(self) -> tuple[int, int]:
        """Lines that hold a word, and how many of them differ."""
        lines = [line for line in self.data.split(b"\n") if line.strip()]
        return len(lines), len(set(lines))

    @cached_property
    def n_dup_lines(self) -> int:
        return self.worded_lines[0] - self.worded_lines[1]

    def windows(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Which kind of window begins at each word, and how often each kind stands in the text."""
        ids, most = self.word_ids, int(self.word_ids.max(initial=0)) + 1
        n = len(ids) - width + 1
        if n < 1:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        kind = ids[:n]
        for k in range(1, width):
            if len(kind) and int(kind.max()) >= (1 << 62) // most:  # numbered anew before the next step could overflow
                _, kind = np.unique(kind, return_inverse=True)
            kind = kind * most + ids[k : n + k]
        _, kind, counts = np.unique(kind, return_inverse=True, return_counts=True)
        return kind, counts

    @cached_property
    def n_repeat_words(self) -> int:
        kind, counts = self.windows(3)
        again = np.flatnonzero(counts[kind] > 1) if len(kind) else kind
        covered = np.zeros(self.n_words, bool)
        for k in range(3):
            covered[again + k] = True
        return int(covered.sum())

    @cached_property
    def n_top_pair(self) -> int:
        return int(self.windows(2)[1].max(initial=0))

    @cached_property
    def n_letterless(self) -> int:
        return sum(1 for _ in NO_LETTER.finditer(self.data))

    @cached_property
    def n_capitals(self) -> int:
        return _taken(self.data, CAPITALS)

    @cached_property
    def n_small(self) -> int:
        return _taken(self.data, SMALL)


@dataclass(frozen=True)
class Rule:
    """A name and the test that a rejected page meets."""

    name: str
    rejects: Callable[[Page], bool]


#: What every document is measured by, whichever rules run.
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
BASE = (
    Rule("few words", lambda p: p.n_words < 50),
    Rule("repeated words", lambda p: 100 * p.n_repeat_words > 50 * p.n_words),
)
RULES = (
    Rule("short or long words", lambda p: not 2 * p.n_words <= p.word_chars <= 15 * p.n_words),
    Rule("symbols", lambda p: 5 * p.n_symbols > p.n_words),
    Rule("repeated lines", lambda p: 10 * p.n_dup_lines > 5 * p.worded_lines[0]),
    Rule("words without letters", lambda p: 10 * p.n_letterless > 4 * p.n_words),
    Rule("capitals", lambda p: p.n_capitals > p.n_small),
    Rule("exclamations", lambda p: 4 * p.data.count(b"!") > p.n_words),
    Rule("one pair of words", lambda p: 10 * p.n_top_pair > 2 * p.n_words),
)


class Cascade:
    """Rules in the order of rejections per second, as a running sample of the pages shows them.

    On a sampled page every rule is run and timed by itself, on a page that has the common measures only. The order is
    greedy: first the rule that rejects most sampled pages per second, then the one that rejects most of what that one
    left, and so on; rules that reject none of the rest come last, the cheapest of them first. Every other page ends at the first rule that rejects it. The
    verdict is the same in any order.
    """

    def __init__(self, rules: Sequence[Rule], measures: Sequence[str], first: int = FIRST, every: int = EVERY, trials: int = TRIALS):
        self.rules, self.measures, self.first, self.every = list(rules), measures, first, every
        self.order, self.seen, self.calls = list(range(len(rules))), 0, 0
        self.hits, self.seconds = np.zeros((trials, len(rules)), bool), np.zeros((trials, len(rules)))
        self.tried = 0

    def _try_all(self, page: Page) -> None:
        at, known = self.tried % len(self.hits), {m: getattr(page, m) for m in self.measures}
        known |= {m: page.__dict__[m] for m in ("word_ids", "worded_lines") if m in page.__dict__}
        for k, rule in enumerate(self.rules):
            fresh = Page(page.text)
            fresh.__dict__.update(known)
            begin = time.perf_counter()
            self.hits[at, k] = rule.rejects(fresh)
            self.seconds[at, k] = time.perf_counter() - begin
        self.tried += 1
        n = min(self.tried, len(self.hits))
        cost = self.seconds[:n].mean(axis=0) + 1e-9
        left, rest, self.order = np.ones(n, bool), list(range(len(self.rules))), []
        while rest:
            best = max(rest, key=lambda k: (self.hits[:n][left, k].sum() / cost[k], -cost[k]))
            self.order.append(best)
            rest.remove(best)
            left &= ~self.hits[:n, best]

    def judge(self, page: Page) -> str | None:
        """The rule that rejects the page, or None."""
        sampled = self.seen < self.first or self.seen % self.every == 0
        self.seen += 1
        if sampled and self.rules:
            self._try_all(page)
        for k in self.order:
            self.calls += 1
            if self.rules[k].rejects(page):
                return self.rules[k].name
        return None


def judge_documents(docs: DataFrame, base: Sequence[Rule] = BASE, rules: Sequence[Rule] = RULES) -> DataFrame:
    """doc_id, the measures, base_failed, kept, rejected_by for every row, by whole texts.

    A document that a base rule rejects goes; the others go through a :class:`Cascade` of ``rules``, one per task, whose
    sample is the task's own: ``FIRST`` documents and one of ``EVERY`` after these. The sample sets the order of the
    rules only, so kept never depends on it. ``rejected_by`` names the rule that ended the cascade; where several would
    reject a document, that may differ from run to run.

    A null text is empty: no words, so the base rejects it. Rows with equal or null doc_id and equal texts are judged
    one by one. An empty table gives an empty result. Very long texts are read as a whole, their words in pieces. Other
    columns are not read, whatever their names. One pass, no shuffle.
    """

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cascade = Cascade(rules, MEASURES)
        for pdf in batches:
            out = []
            for text in pdf["text"]:
                page = Page(text)
                measures = [getattr(page, m) for m in MEASURES]
                failed = next((r.name for r in base if r.rejects(page)), None)
                name = cascade.judge(page) if failed is None else failed
                out.append((*measures, failed is not None, name is None, name))
            yield pd.concat([pdf[["doc_id"]].reset_index(drop=True), pd.DataFrame(out, columns=[*MEASURES, "base_failed", "kept", "rejected_by"])], axis=1)

    rows = docs.select("doc_id", text_of().alias("text"))
    shape = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, " + ", ".join(f"{m} long" for m in MEASURES)
    return rows.mapInPandas(work, f"{shape}, base_failed boolean, kept boolean, rejected_by string")


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality rules over all documents."""
    return judge_documents(table(spark, sf_dir, "documents")).drop("rejected_by")


OP13_SQL = r"""
with docs as (select row_number() over () as n, doc_id, coalesce(text, '') as text from documents),
words as (
  select n, unnest(w) as word, generate_subscripts(w, 1) as pos
  from (select n, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as w from docs)
),
ids as (select n, pos, word, lead(word) over o as two, lead(word, 2) over o as three from words window o as (partition by n order by pos)),
kinds as (
  select n, pos, count(*) over (partition by n, word, two, three) as times from ids where three is not null
),
covered as (select n, count(distinct pos + k) as n_repeat_words from kinds, unnest([0, 1, 2]) as s(k) where times > 1 group by n),
pairs as (select n, max(c) as top from (select n, word, two, count(*) as c from ids where two is not null group by all) group by n),
counted as (
  select n, count(*) as n_words, sum(length(word)) as word_chars,
         count(*) filter (where not regexp_matches(word, '[^\x00-\x40\x5B-\x60\x7B-\x7F]')) as letterless
  from words group by n
),
lines as (
  select n, count(*) as n_lines, count(*) - count(distinct line) as n_dup_lines
  from (select n, unnest(string_split(text, chr(10))) as line from docs)
  where regexp_matches(line, '[^\x20\x09-\x0D]') group by n
),
measured as (
  select doc_id, text, coalesce(n_words, 0) as n_words, coalesce(word_chars, 0)::bigint as word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
         coalesce(n_dup_lines, 0) as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words,
         coalesce(n_lines, 0) as n_lines, coalesce(letterless, 0) as letterless, coalesce(top, 0) as top,
         length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) as capitals,
         length(text) - length(regexp_replace(text, '[a-z]', '', 'g')) as small,
         length(text) - length(replace(text, '!', '')) as exclamations
  from docs left join counted using (n) left join lines using (n) left join covered using (n) left join pairs using (n)
),
judged as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from measured)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not (base_failed or word_chars < 2 * n_words or word_chars > 15 * n_words or 5 * n_symbols > n_words
            or 10 * n_dup_lines > 5 * n_lines or 10 * letterless > 4 * n_words or capitals > small
            or 4 * exclamations > n_words or 10 * top > 2 * n_words) as kept
from judged
"""
