"""Text cleaning expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean(c: str | Column) -> Column:
    """Trim blanks on both sides."""
    return F.trim(col(c))


def upper_clean(c: str | Column) -> Column:
    return F.upper(clean(c))


def lower_clean(c: str | Column) -> Column:
    return F.lower(clean(c))


def text_or(c: str | Column, default: str) -> Column:
    """Trimmed text, or the stated default where it is NULL."""
    return F.coalesce(clean(c), F.lit(default))


def zip5(c: str | Column) -> Column:
    """Numeric postcode to five characters with leading zeros; NULL stays NULL."""
    digits = F.concat(F.lit("00000"), col(c).cast("long").cast("string"))
    return F.right(digits, F.lit(5))


def title_case(c: str | Column) -> Column:
    """snake_case to Title Case; blank words vanish and an empty result is NULL."""
    words = F.split(F.lower(F.replace(col(c), F.lit("_"), F.lit(" "))), " ")
    kept = F.filter(words, lambda w: F.trim(w) != "")
    capital = F.transform(kept, lambda w: F.concat(F.upper(F.left(w, F.lit(1))), F.substring(w, 2, 1 << 20)))
    return F.nullif(F.array_join(capital, " "), F.lit(""))


def from_vocabulary(c: str | Column, labels: Mapping[str, str], default: str) -> Column:
    """Label of a controlled vocabulary; anything unknown or NULL gets the default."""
    key = lower_clean(c)
    out = None
    for raw, label in labels.items():
        out = F.when(key == raw, label) if out is None else out.when(key == raw, label)
    return out.otherwise(default)


def null_if_text(c: str | Column, marker: str) -> Column:
    """NULL where the text equals the marker, letter case ignored."""
    return F.when(F.lower(col(c)) != marker.lower(), col(c))


def state_name(c: str | Column, names: Mapping[str, str]) -> Column:
    """Display name of a state code; unknown codes give NULL."""
    pairs = [F.lit(x) for kv in names.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), col(c))
