"""Names and code labels (EXP-4..8)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def joined_name(first: Column, last: Column) -> Column:
    """NULL when either part is NULL."""
    return F.concat(F.trim(first), F.lit(" "), F.trim(last))


def code_map(text: Column, labels: Mapping[str, Sequence[str]], default: str | None = None) -> Column:
    """Label of the trimmed, upper-cased code. Without ``default`` an unknown code is kept, trimmed."""
    code = F.upper(F.trim(text))
    branches = [(code.isin(*codes), F.lit(label)) for label, codes in labels.items()]
    mapped = F.when(*branches[0])
    for condition, label in branches[1:]:
        mapped = mapped.when(condition, label)
    return mapped.otherwise(F.trim(text) if default is None else F.lit(default))
