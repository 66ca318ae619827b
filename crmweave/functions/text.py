"""Scalar text functions over single columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from crmweave.functions.jsontext import is_json_sql, quoted

# Every character the sync treats as blank space.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Format of the unsubscribe request path.
UNSUBSCRIBE_PREFIX = "communication-preferences/v4/statuses/"
UNSUBSCRIBE_SUFFIX = "/unsubscribe-all?channel=EMAIL"


def named(name: str) -> Column:
    """Column by exact name."""
    return F.col(quoted(name))


def strip(c: Column) -> Column:
    """Trim all white space, not only blanks as ``trim`` does."""
    return F.btrim(c, F.lit(WHITESPACE))


def is_blank(c: Column) -> Column:
    """Null, empty or white space only."""
    return F.coalesce(strip(c.cast("string")), F.lit("")) == ""


def id_as_text(c: Column) -> Column:
    """Ids of any type are compared as text; null stays null."""
    return c.cast("string")


def domain_from_website(website: Column) -> Column:
    """Bare host of a website; port and fragment are kept, an empty host is null."""
    host = F.regexp_extract(strip(website), r"^(?i:https?://)?(?i:www\.)?([^/?]*)", 1)
    return F.nullif(F.lower(host), F.lit(""))


def company_from_email(email: Column) -> Column:
    """Domain of an address as stand-in company name; null without ``@``."""
    domain = F.lower(strip(F.substring_index(email, "@", -1)))
    return F.when(F.contains(email, F.lit("@")), F.nullif(domain, F.lit("")))


def owner_full_name(first: Column, last: Column, email: Column) -> Column:
    """First and last name, else the email."""
    part = lambda c: strip(F.coalesce(c.cast("string"), F.lit("")))
    full = strip(F.concat(part(first), F.lit(" "), part(last)))
    return F.coalesce(F.nullif(full, F.lit("")), email.cast("string"))


def percent_encode(c: Column) -> Column:
    """Percent-encode everything but unreserved characters.

    ``url_encode`` does form encoding, which differs in three characters.
    """
    encoded = F.url_encode(c)
    encoded = F.replace(encoded, F.lit("+"), F.lit("%20"))
    encoded = F.replace(encoded, F.lit("*"), F.lit("%2A"))
    return F.replace(encoded, F.lit("%7E"), F.lit("~"))


def unsubscribe_path(email: Column) -> Column:
    """Request path that unsubscribes one address from all mail."""
    return F.concat(
        F.lit(UNSUBSCRIBE_PREFIX), percent_encode(email.cast("string")), F.lit(UNSUBSCRIBE_SUFFIX)
    )


def list_ids_sql(memberships: str, is_array: bool = False) -> str:
    """SQL for the list ids in a membership field, null where there are none.

    The field is a native array, a JSON array, one JSON scalar, or comma-separated text.
    """
    if is_array:
        items = f"filter(cast({memberships} AS array<string>), x -> x IS NOT NULL)"
    else:
        text = f"cast({memberships} AS string)"
        # In brackets, so that text after the array is noticed; parsed once, as variable ``a``.
        arrays = (
            f"from_json(concat('[', {text}, ']'), 'array<array<string>>',"
            " map('allowSingleQuotes', 'false'))"
        )
        split = f"filter(transform(split({text}, ','), x -> btrim(x, '{WHITESPACE}')), x -> x <> '')"
        listed = (
            f"get(transform(array({arrays}), a -> CASE WHEN size(a) = 1 AND get(a, 0) IS NOT NULL"
            f" THEN filter(get(a, 0), x -> x IS NOT NULL) ELSE {split} END), 0)"
        )
        items = (
            f"CASE WHEN startswith(btrim({text}, '{WHITESPACE}'), '[') THEN {listed}"
            f" WHEN {is_json_sql(text)} THEN array({text}) ELSE {split} END"
        )
    return f"get(filter(array({items}), ids -> size(ids) > 0), 0)"


def parse_list_ids(memberships: str, is_array: bool = False) -> Column:
    """List ids in a membership field, given as a SQL expression."""
    return F.expr(list_ids_sql(memberships, is_array))
