"""Identifiers, lists and patterns in text (ids C6, C15, C18-C20, C26, L8)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from railloom.functions.coerce import strip


def first_of_list(c: Column, sep: str = ",") -> Column:
    """First element of a separated list, stripped."""
    return strip(F.element_at(F.split(c, re.escape(sep)), 1))


def last_of_list(c: Column, sep: str = ",") -> Column:
    """Last element of a separated list, stripped."""
    return strip(F.element_at(F.split(c, re.escape(sep)), -1))


def stable_id(c: Column, prefix: str = "", digits: int = 8) -> Column:
    """Prefix + leading hex digits of the md5 of the text; NULL stays NULL."""
    return F.concat(F.lit(prefix), F.substring(F.md5(c.cast("string").cast("binary")), 1, digits))


def natural_key_id(*parts: Column, prefix: str = "", digits: int = 16) -> Column:
    """Id from a natural key instead of a row position.

    Every part is written with its length, so no text moves between parts, and NULL differs from empty.
    """
    texts = [p.cast("string") for p in parts]
    marked = [F.coalesce(F.concat(F.char_length(p).cast("string"), F.lit(":"), p), F.lit("-")) for p in texts]
    return stable_id(F.concat_ws("|", *marked), prefix, digits)


def labelled_pair(origin: Column, destination: Column) -> Column:
    """C18: 'origin - destination', NULL when either end is NULL."""
    return F.concat(origin, F.lit(" - "), destination)


def contains_pattern(term: str) -> str:
    """LIKE pattern for 'contains term'; % and _ in the term stay wildcards.

    A backslash before an ordinary character stands for that character, and is taken out because
    Spark rejects such an escape.
    """
    body = re.sub(
        r"\\(.)",
        lambda m: m.group(0) if m.group(1) in "%_\\" else m.group(1),
        f"%{term}%",
        flags=re.DOTALL,
    )
    return body


def id_list(c: Column) -> Column:
    """C26: '{1,2}' to array<int>; any other text and NULL give the empty array."""
    inner = F.regexp_replace(c, r"[{}\s]", "")
    ids = F.transform(F.split(inner, ","), lambda x: x.try_cast("int"))
    return F.when(c.startswith("{"), F.filter(ids, lambda x: x.isNotNull())).otherwise(
        F.array().cast("array<int>")
    )


def never_null_ids(c: Column) -> Column:
    """A missing id array is the empty array."""
    return F.coalesce(c, F.array().cast("array<int>"))
