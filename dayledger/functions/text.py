"""Text predicates and labels, all built from JVM-side expressions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank(name: str) -> Column:
    """NULL, empty or nothing but spaces."""
    return F.length(F.trim(F.coalesce(F.col(name), F.lit("")))) == 0


def normalised(name: str) -> Column:
    return F.lower(F.trim(F.col(name)))


def outside_vocabulary(name: str, words: Iterable[str]) -> Column:
    """Blank, or not one of the words once case and padding are ignored."""
    return blank(name) | ~normalised(name).isin(*words)


def labelled(name: str, labels: Mapping[str, str]) -> Column:
    """The label of a code; a code outside the dictionary passes through, NULL stays NULL."""
    raw = F.col(name)
    (first_code, first_label), *rest = labels.items()
    chosen = F.when(raw == first_code, F.lit(first_label))
    for code, label in rest:
        chosen = chosen.when(raw == code, F.lit(label))
    return chosen.otherwise(raw)
