"""Check flags as column expressions.

Every flag is a three-valued string: ``'Y'`` (passed), ``'N'`` (failed) or ``''`` (not checkable,
because the value the check is anchored on is missing). All are plain ``CASE WHEN`` expressions, so
they stay inside whole-stage codegen.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tablewatch.functions.time import AsOf, hours_before

PASS, FAIL, BLANK = "Y", "N", ""


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def match_flag(anchor: Column | str, *others: Column | str) -> Column:
    """``''`` when ``anchor`` is null; ``'Y'`` when ``anchor`` equals every other value; else ``'N'``.

    A null among ``others`` makes the equality unknown, which ``CASE`` treats as false, so it gives
    ``'N'``. With two others this is the three-way rule (target = replica AND replica = legacy).
    """
    a = _col(anchor)
    same = reduce(lambda x, y: x & y, [a == _col(o) for o in others])
    return F.when(a.isNull(), F.lit(BLANK)).when(same, F.lit(PASS)).otherwise(F.lit(FAIL))


def freshness_flag(changed_at: Column | str, as_of: AsOf, hours: float = 24) -> Column:
    """``''`` when no change time is known; ``'Y'`` when strictly newer than ``as_of - hours``."""
    t = _col(changed_at)
    return (
        F.when(t.isNull(), F.lit(BLANK))
        .when(t > hours_before(as_of, hours), F.lit(PASS))
        .otherwise(F.lit(FAIL))
    )


def equal_flag(left: Column | str, right: Column | str) -> Column:
    """``'Y'`` when equal, else ``'N'`` (a null on either side gives ``'N'``)."""
    return F.when(_col(left) == _col(right), F.lit(PASS)).otherwise(F.lit(FAIL))


def type_length_flag(
    replica_type: Column | str,
    replica_length: Column | str,
    target_type: Column | str,
    target_length: Column | str,
    replica_column: Column | str,
    exempt_suffix: str | None,
) -> Column:
    """Type-and-length check of a column pair.

    Type and length are compared as one text, a missing length counting as ``1`` (so ``TEXT`` with no
    length equals ``TEXT(1)``). A replica column whose right-trimmed name ends with ``exempt_suffix``
    (case-sensitive) passes whatever its type.
    """

    def typed(t: Column | str, n: Column | str) -> Column:
        return F.concat(_col(t), F.coalesce(_col(n), F.lit(1)).cast("string"))

    flag = F.when(typed(replica_type, replica_length) == typed(target_type, target_length), F.lit(PASS))
    if exempt_suffix:
        flag = flag.when(F.rtrim(_col(replica_column)).endswith(exempt_suffix), F.lit(PASS))
    return flag.otherwise(F.lit(FAIL))


def any_equals(columns: list[str], value: str) -> Column:
    """``c1 = value OR c2 = value OR ...``; false for an empty list."""
    if not columns:
        return F.lit(False)
    return reduce(lambda x, y: x | y, [F.col(c) == F.lit(value) for c in columns])
