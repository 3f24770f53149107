"""Column-name and value helpers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lower_columns(df: DataFrame) -> DataFrame:
    """Lower-case every column name (the reports use lower-case names throughout)."""
    return df.toDF(*[c.lower() for c in df.columns])


def prefixed(df: DataFrame, prefix: str, columns: list[str] | None = None) -> DataFrame:
    """Select ``columns`` (default all) renamed ``prefix + name``, to disambiguate a self-join."""
    if columns is None:
        return df.toDF(*[prefix + c for c in df.columns])  # one rename of every column
    return df.select(*[F.col(c).alias(prefix + c) for c in columns])


def extract_paths(
    raw: Column | str, paths: Mapping[str, str | tuple[str, str]], cast: str = "string"
) -> list[Column]:
    """One column per ``{name: json_path}`` (or ``{name: (json_path, type)}``) read out of a VARIANT
    column; the type defaults to ``cast``.

    ``try_variant_get`` is used, not ``variant_get``: a path through a non-object and a value that
    cannot be cast both give null instead of failing the job.
    """
    v = F.col(raw) if isinstance(raw, str) else raw
    out = []
    for name, spec in paths.items():
        path, type_name = spec if isinstance(spec, tuple) else (spec, cast)
        out.append(F.try_variant_get(v, path, type_name).alias(name))
    return out


def typed_null(type_name: str) -> Column:
    return F.lit(None).cast(type_name)
