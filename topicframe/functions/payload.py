"""Byte-exact splitting and joining of payloads."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# every byte is one character in this charset, so text functions cannot damage payloads
_BYTEWISE = "ISO-8859-1"


def bytes_literal(text: str) -> str:
    """SQL literal for the UTF-8 bytes of ``text``."""
    return f"X'{text.encode('utf-8').hex().upper()}'"


def byte_length(text: str) -> int:
    return len(text.encode("utf-8"))


def is_filled(data: Column | str = "data") -> Column:
    """True for a payload with at least one byte; null counts as empty."""
    column = F.col(data) if isinstance(data, str) else data
    return F.coalesce(F.octet_length(column) > 0, F.lit(False))


def joined(data: str, demarcator: str, order: str) -> Column:
    """Payloads of a group joined by the demarcator in ``order``; for use in ``agg``.

    The result is one value, so the payloads of a group must stay under 2 GB together: with
    payloads of megabytes, choose a smaller receive batch.
    """
    return F.expr(f"listagg({data}, {bytes_literal(demarcator)}) within group (order by {order})")


def _quoted(pattern: Column) -> Column:
    """A regular expression that matches ``pattern`` itself."""
    return F.concat(F.lit(r"\Q"), F.replace(pattern, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))


def _literal(pattern: str) -> Column:
    """The same for a constant; a single character is left in the form split handles fastest."""
    if len(pattern) == 1 and not pattern.isalnum() and pattern.isascii():
        return F.lit(pattern if pattern.isspace() else "\\" + pattern)
    return F.lit(r"\Q" + pattern.replace(r"\E", r"\E\\E\Q") + r"\E")


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` uses it."""
    return F.transform(F.array(value), body).getItem(0)


def _without_empty_end(pieces: Column) -> Column:
    return bind(
        pieces,
        lambda p: F.when(F.element_at(p, -1) == "", F.slice(p, F.lit(1), F.size(p) - 1)).otherwise(p),
    )


def token_count(content: Column, demarcator: Column | str) -> Column:
    """How many tokens ``tokens`` gives, without cutting."""
    if isinstance(demarcator, str) and demarcator == "":
        return F.lit(1).cast("bigint")
    mark = F.lit(demarcator) if isinstance(demarcator, str) else demarcator
    text = content.cast("string")

    def counted(value: Column, by: Column) -> Column:
        cuts = (F.length(value) - F.length(F.replace(value, by, F.lit("")))) / F.length(by)
        behind = F.when(value.endswith(by), 1).otherwise(0)
        return F.when(F.length(value) == 0, 0).otherwise(cuts + 1 - behind).cast("bigint")

    bytewise = counted(F.decode(content, _BYTEWISE), F.decode(mark.cast("binary"), _BYTEWISE))
    of_any = F.when(F.is_valid_utf8(text), counted(text, mark)).otherwise(bytewise)
    return F.when(is_filled(mark.cast("binary")), of_any).otherwise(F.lit(1).cast("bigint"))


def tokens(content: Column, demarcator: Column | str) -> Column:
    """Content cut at each demarcator, without the empty piece behind a last one.

    Empty pieces in between stay. Empty content has no tokens. An empty or null demarcator
    (a per-row Column may hold either) leaves the content whole.

    Content that is valid UTF-8 is cut as text, where a demarcator can only match at a
    character's edge; any other content is cut byte by byte.
    """
    if isinstance(demarcator, str):
        if demarcator == "":
            return F.array(content)
        as_text = _literal(demarcator)
        as_bytes = _literal(demarcator.encode("utf-8").decode(_BYTEWISE))
        cuttable = F.lit(True)
    else:
        as_text = _quoted(demarcator)
        as_bytes = _quoted(F.decode(demarcator.cast("binary"), _BYTEWISE))
        cuttable = is_filled(demarcator.cast("binary"))
    text = content.cast("string")
    of_text = _without_empty_end(F.split(text, as_text, -1)).cast("array<binary>")
    of_bytes = F.transform(
        _without_empty_end(F.split(F.decode(content, _BYTEWISE), as_bytes, -1)),
        lambda piece: F.encode(piece, _BYTEWISE),
    )
    return (
        F.when(~cuttable, F.array(content)).when(F.is_valid_utf8(text), of_text).otherwise(of_bytes)
    )
