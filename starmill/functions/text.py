"""Text columns: LIKE patterns with character classes, blank-padded text, null text."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F


def like_to_regex(pattern: str) -> str:
    """A LIKE pattern that may hold ``[0-9]`` classes as an anchored regular expression."""
    out = []
    for piece in re.split(r"(\[[^\]]+\]|%|_)", pattern):
        if piece == "%":
            out.append(".*")
        elif piece == "_":
            out.append(".")
        elif piece.startswith("["):
            out.append(piece)
        else:
            out.append(re.escape(piece))
    return "^(?s:" + "".join(out) + r")\z"


def like_class(c: Column, pattern: str) -> Column:
    """LIKE with character classes. A pattern without any is a plain LIKE, which Spark can push down."""
    return c.rlike(like_to_regex(pattern)) if "[" in pattern else c.like(pattern)


def unpad(c: Column) -> Column:
    """Blank-padded text without its trailing blanks, which never count in comparisons."""
    return F.rtrim(c)


def null_as_text(c: Column, text: str | None) -> Column:
    return c if text is None else F.coalesce(c, F.lit(text))
