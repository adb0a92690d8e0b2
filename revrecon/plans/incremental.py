"""Monthly tables kept up to date: only the months that changed source files touch are derived again."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revrecon.functions.dates import in_month, month_key
from revrecon.sources.commits import CommitConflict
from revrecon.sources.versions import FileTable

#: The part that holds what has no date.
UNDATED = "undated"
_FACTS = "facts_version"


@dataclass(frozen=True)
class MonthsDone:
    """The version of the monthly table, the version of the facts it shows, and the months that were derived again."""

    version: int
    facts_version: int
    months: tuple[str, ...]


def _part(date: str) -> Column:
    return F.coalesce(month_key(date), F.lit(UNDATED))


def _of_months(date: str, months: Sequence[str]) -> Column:
    """Rows of these months, as date ranges that reach the scan."""
    tests = [in_month(date, m) if m != UNDATED else F.col(date).isNull() for m in months]
    return reduce(or_, tests)


def touched_months(facts: FileTable, older: int, newer: int, date: str = "dos") -> list[str]:
    """Months of the rows that changed files had in the older version or have in the newer one, sorted.

    Only the rows of those files are read, in both versions, and only months reach the driver.
    """
    changed = facts.changed_between(older, newer).collect()  # one row per changed file
    parts = []
    for version, side in ((older, "old_place"), (newer, "new_place")):
        sources = [r["source_id"] for r in changed if r[side] is not None]
        if sources:
            parts.append(facts.rows_of(sources, version).select(_part(date).alias("part")).distinct())
    if not parts:
        return []
    return sorted(r[0] for r in reduce(DataFrame.union, parts).distinct().collect())


def refresh_months(
    facts: FileTable, monthly: FileTable, derive: Callable[[DataFrame], DataFrame], date: str = "dos", tries: int = 5
) -> MonthsDone:
    """Brings a monthly table up to the last version of its facts.

    ``derive`` makes rows with a column ``month`` (``YYYY-MM``, null for undated facts) from facts of whole months; a
    month's rows must follow from that month's facts alone. The commit of the monthly table names the facts' version it
    shows, so the next call compares from there: the months of changed files, before and after, are derived from all
    facts of those months and replace their former rows. All other months stay on disk as they are. Of two runs at once
    one starts again on the other's result.
    """
    newest = facts.log.latest()
    for _ in range(tries):
        commit = monthly.log.read()
        base, shown = (commit.version, commit.facts.get(_FACTS, 0)) if commit else (0, 0)
        if shown >= newest:
            return MonthsDone(base, shown, ())
        months = touched_months(facts, shown, newest, date)
        rows, place = None, F.lit(0)
        if months:
            rows = derive(facts.read(newest).filter(_of_months(date, months)))
            place = F.array_position(F.array(*[F.lit(m) for m in months]), F.coalesce(F.col("month"), F.lit(UNDATED))) - 1
        version = monthly.replace(base, months, rows, place, dt.datetime.now(), {_FACTS: newest})
        if version is not None:
            return MonthsDone(version, newest, tuple(months))
    raise CommitConflict(f"{monthly.log.folder.root}: other writers were first {tries} times")
