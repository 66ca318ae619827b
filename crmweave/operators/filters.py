"""Row filters and the predicates they are made of."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crmweave.functions.jsontext import is_json_sql
from crmweave.functions.text import WHITESPACE, is_blank, named, strip

# Words that stand for "nothing" or "yes" in text fields.
TRUE_WORDS = ["true", "1"]
NO_REASON = ["", "null", "none"]
NOTHING_PENDING = ["", "null", "none", "[]"]

# Names of the approval columns.
PENDING_COLUMN = "pendingCriticalFieldsForCrmSync"
REJECTION_COLUMN = "rejectionReason"


def truthy_flag(c: Column, dtype: T.DataType) -> Column:
    """Flag of any type as a boolean, null and NaN as false."""
    if isinstance(dtype, T.StringType):
        return F.coalesce(F.lower(strip(c)).isin(TRUE_WORDS), F.lit(False))
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        c = F.nanvl(c, F.lit(0).cast(dtype))
    return F.coalesce(c.cast("boolean"), F.lit(False))


def is_flagged(df: DataFrame, name: str) -> Column:
    """``truthy_flag`` of a column by name; an absent column is false."""
    if name not in df.columns:
        return F.lit(False)
    return truthy_flag(named(name), df.schema[name].dataType)


def drop_flagged(df: DataFrame, name: str) -> DataFrame:
    """Remove rows whose flag is set; without the column the frame is unchanged."""
    if name not in df.columns:
        return df
    if isinstance(df.schema[name].dataType, T.BooleanType):
        # In this form the filter reaches the parquet reader.
        return df.where(named(name).isNull() | (named(name) == F.lit(False)))
    return df.where(~is_flagged(df, name))


def drop_archived(df: DataFrame) -> DataFrame:
    return drop_flagged(df, "archived")


def drop_deleted(df: DataFrame) -> DataFrame:
    return drop_flagged(df, "IsDeleted")


def has_lookup_key(name: str) -> Column:
    return ~is_blank(named(name))


def require_lookup_key(df: DataFrame, name: str) -> DataFrame:
    """Keep rows whose lookup value is neither null nor blank."""
    # The null test by itself reaches the parquet reader.
    return df.where(named(name).isNotNull() & has_lookup_key(name))


def not_pending(value: str, dtype: T.DataType, field: str) -> Column:
    """True unless ``field`` waits for approval; ``value`` is a SQL expression.

    The list of waiting fields is an array, JSON array text, or free text that names them.
    """
    name = "'" + field.replace("\\", "\\\\").replace("'", "\\'") + "'"
    if isinstance(dtype, T.ArrayType):
        return F.expr(f"NOT coalesce(array_contains({value}, {name}), false)")
    if not isinstance(dtype, T.StringType):
        return F.lit(True)
    text = f"btrim({value}, '{WHITESPACE}')"
    nothing = ", ".join(f"'{word}'" for word in NOTHING_PENDING)
    return F.expr(
        f"NOT coalesce(CASE WHEN lower({text}) IN ({nothing}) THEN false"
        f" WHEN startswith({text}, '[') AND {is_json_sql(text)} THEN"
        f" array_contains(from_json({text}, 'array<string>'), {name})"
        f" ELSE contains({text}, {name}) END, false)"
    )


def not_rejected(c: Column, dtype: T.DataType) -> Column:
    """True where no rejection reason is given; a reason that is not text does not count."""
    if not isinstance(dtype, T.StringType):
        return F.lit(True)
    return F.coalesce(F.lower(strip(c)), F.lit("")).isin(NO_REASON)


def approval_state(df: DataFrame, field: str) -> tuple[Column, Column]:
    """(not pending, not rejected) for ``field``; an absent column imposes nothing."""
    types = {f.name: f.dataType for f in df.schema.fields}
    free = F.lit(True)
    pending, rejected = free, free
    if PENDING_COLUMN in types:
        pending = not_pending(PENDING_COLUMN, types[PENDING_COLUMN], field)
    if REJECTION_COLUMN in types:
        rejected = not_rejected(named(REJECTION_COLUMN), types[REJECTION_COLUMN])
    return pending, rejected


def approval_gate(df: DataFrame, field: str) -> DataFrame:
    """Keep rows where ``field`` is neither pending approval nor rejected."""
    pending_ok, rejected_ok = approval_state(df, field)
    return df.where(pending_ok & rejected_ok)
