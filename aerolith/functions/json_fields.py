"""JSON text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import ColumnOrName, _col


def json_text(c: ColumnOrName, field: str) -> Column:
    """The text of one top-level field of a JSON object column (numbers come
    back as their text; malformed JSON or a missing field gives NULL).
    Parsing against a one-field schema lets the reader skip everything else,
    which is cheaper than a path lookup per row."""
    return F.from_json(_col(c), f"`{field}` string").getField(field)
