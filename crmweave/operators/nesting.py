"""Flat columns with dotted or bracketed names into structs and arrays."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crmweave.functions.text import named

ARRAY_MARK = "[*]"
# Null children of a nested value are left out of its JSON form, unlike null top-level fields.
SPARSE = {"sparse": True}


def _any_present(columns: list[str]) -> Column:
    return reduce(or_, [named(c).isNotNull() for c in columns])


def nest_dotted(df: DataFrame) -> DataFrame:
    """``p.c`` columns become struct ``p`` with field ``c``; all null gives a null struct."""
    groups: dict[str, dict[str, str]] = {}
    for name in df.columns:
        if "." in name and ARRAY_MARK not in name:
            parent, child = name.split(".", 1)
            groups.setdefault(parent, {})[child] = name
    built = {
        parent: F.when(
            _any_present(list(children.values())),
            F.struct(*[named(src).alias(child) for child, src in children.items()]),
        )
        for parent, children in groups.items()
    }
    used = {src for children in groups.values() for src in children.values()}
    return _replace(df, built, used)


def nest_arrays(df: DataFrame) -> DataFrame:
    """``p[*].f`` and ``p[*].n[*]`` columns become array ``p`` of one object.

    ``f`` becomes a field; all columns of ``n`` become one array of their non-null values, in
    column order. A bare ``p[*]`` names the parent only and stays.
    """
    fields: dict[str, dict[str, list[str]]] = {}
    plain: dict[str, dict[str, str]] = {}
    for name in df.columns:
        if ARRAY_MARK not in name:
            continue
        parent, rest = name.split(ARRAY_MARK, 1)
        fields.setdefault(parent, {})
        plain.setdefault(parent, {})
        if not rest.startswith("."):
            continue
        inner, mark, _ = rest[1:].partition(ARRAY_MARK)
        if mark:
            fields[parent].setdefault(inner, []).append(name)
        else:
            plain[parent][inner] = name

    built: dict[str, Column] = {}
    used: set[str] = set()
    for parent in fields:
        sources = [*plain[parent].values(), *(s for g in fields[parent].values() for s in g)]
        used.update(sources)
        if not sources:
            built[parent] = F.lit(None).cast("array<string>")
            continue
        members = {child: named(src) for child, src in plain[parent].items()}
        for inner, group in fields[parent].items():
            present = F.filter(F.array(*[named(s) for s in group]), lambda x: x.isNotNull())
            members[inner] = F.when(F.size(present) > 0, present)
        item = F.struct(*[value.alias(child) for child, value in members.items()])
        built[parent] = F.when(_any_present(sources), F.array(item))
    return _replace(df, built, used)


def nest_columns(df: DataFrame) -> DataFrame:
    """Both nestings; where both claim a parent the array one wins."""
    arrays = {c.split(ARRAY_MARK, 1)[0] for c in df.columns if ARRAY_MARK in c}
    nested = nest_dotted(df)
    clash = [p for p in arrays if p in nested.columns and p not in df.columns]
    return nest_arrays(nested.drop(*clash))


def _replace(df: DataFrame, built: dict[str, Column], used: set[str]) -> DataFrame:
    """Swap the source columns for the built ones; a plain column of a built name is replaced."""
    if not built:
        return df
    kept = [named(c) for c in df.columns if c not in used and c not in built]
    return df.select(*kept, *[c.alias(name, metadata=SPARSE) for name, c in built.items()])
