"""``${name}`` text filled from an attribute map."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_REFERENCE = re.compile(r"\$\{([^}]*)\}")


def render(template: str, attributes: Column | str = "attributes") -> Column:
    """The template with each reference replaced; an absent attribute leaves nothing."""
    source = F.col(attributes) if isinstance(attributes, str) else attributes
    # re.split with one group alternates literal text and attribute names
    pieces = _REFERENCE.split(template)
    parts = [
        F.coalesce(source.getItem(piece.strip()), F.lit("")) if i % 2 else F.lit(piece)
        for i, piece in enumerate(pieces)
        if i % 2 or piece
    ]
    return F.concat(*parts) if parts else F.lit("")


def is_blank(text: Column) -> Column:
    """True for null, empty and all-whitespace text."""
    return F.coalesce(text.rlike(r"^\s*$"), F.lit(True))
