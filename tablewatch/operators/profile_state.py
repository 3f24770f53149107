"""One measured state of many profiles: each base table is scanned once, whatever is reported of it.

A validation run profiles the same tables several times over: as target, as replica, in the inventory, as
source; whole or up to a cut-off, as they are or with derived columns. Here each of these is a
``Variant`` of a base table: a filter, column expressions, a time of change. All variants of a base are
extra expressions of **one** aggregate over it -- counts, null counts, longest values, latest change --
with partial sums in the tasks, and all bases are measured in one job. The reports' profiles are
projections of the result, a few numbers a column.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField

from tablewatch.functions.time import utc_ntz, utc_ntz_of
from tablewatch.operators.profile import BASE_TABLE, DEFAULT_EXCLUDE, _column_rows, _excluded, _is_text, _q
from tablewatch.schemas import COLUMN_PROFILE, LEGACY_STATS, SOURCE_PROFILE, TABLE_PROFILE
from tablewatch.session import local_frame


@dataclass(frozen=True)
class Variant:
    """A table as one report sees it.

    ``columns``: its columns as ``{name: expression}`` of the base (``None``: the base's own); ``where``: the rows
    it has; ``changed``: the column (its own or the base's) that holds a row's last change; ``observe``: whether its
    columns' nulls and lengths are measured (else the declared ones are reported)."""

    base: str
    columns: Mapping[str, Column] | None = None
    where: Column | None = None
    changed: str | None = None
    observe: bool = False


Key = tuple[str, str, str]  # catalog, schema, table


def _fields(base: DataFrame, v: Variant) -> list[StructField]:
    if v.columns is None:
        return base.schema.fields
    return base.select(*[c.alias(n) for n, c in v.columns.items()]).schema.fields


def _changed(base: DataFrame, v: Variant) -> Column:
    own = (v.columns or {}).get(v.changed)
    return utc_ntz(base, v.changed) if own is None else utc_ntz_of(own, base.select(own).schema[0].dataType)


def _measures(base: DataFrame, v: Variant) -> Column:
    """The variant's numbers as one struct of aggregates."""
    inside = (lambda c: c) if v.where is None else (lambda c: F.when(v.where, c))
    out = [F.count(inside(F.lit(1))).alias("rows")]
    if v.changed:
        out.append(F.max(inside(_changed(base, v))).cast("string").alias("changed"))
    if v.observe:
        for i, f in enumerate(_fields(base, v)):
            c = _q(f.name) if v.columns is None else v.columns[f.name]
            out.append(F.count(inside(F.when(c.isNull(), F.lit(1)))).alias(f"n{i}"))
            if _is_text(f):
                out.append(F.max(inside(F.length(c))).alias(f"l{i}"))
    return F.struct(*out)


def state_plan(bases: Mapping[str, DataFrame], variants: Mapping[tuple[str, Key], Variant]) -> DataFrame:
    """The measuring job: one aggregate for each base that a variant needs, as a union."""
    parts = []
    for name, base in bases.items():
        own = [(i, v) for i, v in enumerate(variants.values()) if v.base == name]
        if own:
            packed = F.to_json(F.struct(*[_measures(base, v).alias(f"v{i}") for i, v in own]))
            parts.append(base.agg(packed.alias("state")))
    return reduce(DataFrame.unionByName, parts)


@dataclass
class ProfileState:
    """Measured variants, by (group, (catalog, schema, table)). A group is a set of variants one report reads;
    the same table may be in several groups with different filters."""

    spark: SparkSession
    variants: dict[tuple[str, Key], Variant]
    fields: dict[tuple[str, Key], list[StructField]]
    measured: dict[tuple[str, Key], dict]

    def _of(self, group: str, keep: Callable[[Key], bool] | None) -> list[tuple[tuple[str, Key], Key]]:
        return [(k, k[1]) for k in self.variants if k[0] == group and (keep is None or keep(k[1])) and not _excluded(k[1][2], DEFAULT_EXCLUDE)]

    def table_profile(self, group: str, keep: Callable[[Key], bool] | None = None, table_type: str = BASE_TABLE) -> DataFrame:
        rows = []
        for k, key in self._of(group, keep):
            m = self.measured[k]
            changed = dt.datetime.fromisoformat(m["changed"]) if m.get("changed") else None
            rows.append((*key, table_type, m["rows"], len(self.fields[k]), changed))
        return local_frame(self.spark, rows, TABLE_PROFILE)

    def column_profile(self, group: str, keep: Callable[[Key], bool] | None = None) -> DataFrame:
        rows = []
        for k, key in self._of(group, keep):
            rows += _column_rows(self.fields[k], self.measured[k] if self.variants[k].observe else None, *key)
        return local_frame(self.spark, rows, COLUMN_PROFILE)

    def source_profile(self, group: str, keep: Callable[[Key], bool] | None = None) -> DataFrame:
        rows = [(key[2].upper(), self.measured[k]["rows"], len(self.fields[k])) for k, key in self._of(group, keep)]
        return local_frame(self.spark, rows, SOURCE_PROFILE)

    def legacy_stats(self, group: str, keep: Callable[[Key], bool] | None = None) -> DataFrame:
        rows = [(key[2], self.measured[k]["rows"], len(self.fields[k])) for k, key in self._of(group, keep)]
        return local_frame(self.spark, rows, LEGACY_STATS)


def measure_profiles(
    spark: SparkSession, bases: Mapping[str, DataFrame], variants: Mapping[tuple[str, Key], Variant]
) -> ProfileState:
    """Measure all variants in one job that scans each base once; one row a base reaches the driver."""
    variants = dict(variants)
    keys = list(variants)
    measured: dict[tuple[str, Key], dict] = {}
    if variants:
        for row in state_plan(bases, variants).collect():
            for name, numbers in json.loads(row["state"]).items():
                measured[keys[int(name[1:])]] = numbers
    fields = {k: _fields(bases[v.base], v) for k, v in variants.items()}
    return ProfileState(spark, variants, fields, measured)
