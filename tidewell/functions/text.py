"""Text columns: cutting, cleaning, matching, masking."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .dates import ColumnLike, col

PHONE_DIGITS = 9


def last_chars(c: ColumnLike, n: int) -> Column:
    """The last ``n`` characters, or the whole text when it is shorter."""
    return F.right(col(c), F.lit(n))


def drop_first(c: ColumnLike, n: int = 1) -> Column:
    return F.substr(col(c), F.lit(n + 1))


def drop_last(c: ColumnLike, n: int) -> Column:
    """All but the last ``n`` characters; empty when there are no more than ``n``."""
    return F.left(col(c), F.greatest(F.length(col(c)) - n, F.lit(0)))


def keep_alnum(c: ColumnLike) -> Column:
    """Trimmed text with everything but ASCII letters and digits removed."""
    return F.regexp_replace(F.trim(col(c)), "[^0-9A-Za-z]", "")


def normalize_phone(c: ColumnLike) -> Column:
    """The comparable part of a phone number: cleaned, last nine characters."""
    return last_chars(keep_alnum(c), PHONE_DIGITS)


def fold(c: ColumnLike) -> Column:
    """Trimmed upper case, the form two text keys are compared in."""
    return F.upper(F.trim(col(c)))


def contains(c: ColumnLike, part: str) -> Column:
    """True when the text holds ``part``."""
    return F.instr(col(c), part) > 0


def like_any(c: ColumnLike, patterns: Iterable[str]) -> Column:
    """True when the lowered text matches any of the ``LIKE`` patterns."""
    lowered = F.lower(col(c))
    return reduce(lambda a, b: a | b, [lowered.like(p) for p in patterns])


def sha256_text(c: ColumnLike) -> Column:
    """SHA-256 as lower-case hex of the value's text; null stays null."""
    return F.sha2(col(c).cast("string"), 256)


def cut_percent(c: ColumnLike) -> Column:
    """``'12%'`` from a share, digits after the point cut off."""
    return F.concat((col(c) * 100).cast("int").cast("string"), F.lit("%"))
