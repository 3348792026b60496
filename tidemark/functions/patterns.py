"""Key patterns as predicates that the optimizer can push down where possible."""

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def like_match(column: Column, pattern: str, escape: str = "\\") -> Column:
    """SQL ``LIKE``; ``p%`` becomes a pushed ``StringStartsWith``."""
    return F.like(column, F.lit(pattern), F.lit(escape))


def glob_match(column: Column, pattern: str) -> Column:
    """Shell-style pattern: ``*``, ``?``, ``[abc]``, ``[a-z]``, ``[^a]``, ``\\x``.

    Without brackets the pattern is rewritten to ``LIKE``, so that ``p*`` is
    planned as a prefix test and reaches the scan; with brackets it is a regular
    expression over the whole key.
    """
    if "[" not in pattern:
        return like_match(column, _glob_to_like(pattern))
    return column.rlike(_glob_to_regex(pattern))


def _glob_to_like(pattern: str) -> str:
    out, chars = [], iter(pattern)
    for char in chars:
        if char == "*":
            out.append("%")
        elif char == "?":
            out.append("_")
        else:
            literal = next(chars, "\\") if char == "\\" else char
            out.append("\\" + literal if literal in "%_\\" else literal)
    return "".join(out)


def _glob_to_regex(pattern: str) -> str:
    out, at = [], 0
    while at < len(pattern):
        char = pattern[at]
        closing = pattern.find("]", at + 2) if char == "[" else -1
        if char == "*":
            out.append("[\\s\\S]*")
        elif char == "?":
            out.append("[\\s\\S]")
        elif closing > 0:
            members = pattern[at + 1 : closing]
            negated = members.startswith("^")
            members = re.sub(r"([\[\]\\&^~])", r"\\\1", members[1:] if negated else members)
            out.append("[" + ("^" if negated else "") + members + "]")
            at = closing
        elif char == "\\" and at + 1 < len(pattern):
            at += 1
            out.append(re.escape(pattern[at]))
        else:
            out.append(re.escape(char))
        at += 1
    # Not a dollar sign, which also matches before a last line break.
    return "^" + "".join(out) + r"\z"
