"""Stage classes, facilities and flags."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from revrecon import rules


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def is_billing(col: str | Column = "visit_stage") -> Column:
    return _col(col).isin(*rules.BILLING_STAGES)


def is_operational(col: str | Column = "visit_stage") -> Column:
    return _col(col).isin(*rules.OPERATIONAL_STAGES)


def is_canceled(col: str | Column = "visit_stage") -> Column:
    return _col(col).isin(*rules.CANCELED_STAGES)


def is_commercial(visit_type: str | Column = "visit_type") -> Column:
    return F.upper(_col(visit_type)).contains("COM")


def stage_class(col: str | Column = "visit_stage") -> Column:
    return (
        F.when(is_billing(col), "billing").when(is_operational(col), "operational").otherwise("other")
    )


def facility_normalized(col: str | Column, mapping: Mapping[str, str]) -> Column:
    """Short facility name; unknown or null -> ``Unknown``. The map is a literal of a few entries."""
    table = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return F.coalesce(F.try_element_at(table, F.trim(_col(col))), F.lit(rules.UNKNOWN_FACILITY))


def facility_from_office(col: str | Column, office_rules: Sequence[tuple[Sequence[str], str]]) -> Column:
    """First rule with a word contained in the upper-cased office text; else ``Unknown``."""
    office = F.upper(_col(col))
    result = F.when(F.lit(False), F.lit(None).cast("string"))
    for words, facility in office_rules:
        result = result.when(reduce(or_, [office.contains(word) for word in words]), facility)
    return result.otherwise(rules.UNKNOWN_FACILITY)


def yes_no(condition: Column) -> Column:
    return F.when(condition, "YES").otherwise("NO")
