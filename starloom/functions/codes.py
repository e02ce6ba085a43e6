"""Labels of the small fixed code lists."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, functions as F

# Fixed values of the immigration data dictionary.
TRAVEL_MODES = {1: "Air", 2: "Sea", 3: "Land", 9: "Not reported"}
VISA_CLASSES = {1: "Business", 2: "Pleasure", 3: "Student"}


def label(code: Column, labels: dict[int, str]) -> Column:
    """The label of a code, null for a code that has none."""
    pairs = F.create_map(*[F.lit(x) for x in chain.from_iterable(labels.items())])
    return F.try_element_at(pairs, code.cast("int"))
