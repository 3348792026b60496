"""Storage-key text for a row, in the layouts that key stores use."""

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Layout name -> (text between prefix and parts, text between parts).
#: ``None`` for the first means that the layout takes no prefix.
KEY_LAYOUTS: dict[str, tuple[str | None, str]] = {
    "colon": (":", ":"),                 # prefix:a:b
    "colon_joined": ("", ":"),           # prefix + a:b, separator is in the prefix
    "double_colon": (None, "::"),        # a::b
    "path": ("/", "/"),                  # prefix/a/b
    "dot": (".", "."),                   # prefix.a.b
    "underscore": ("_", "_"),            # prefix_a_b
    "double_underscore": (None, "__"),   # a__b
    "record": (":", "__"),               # table:a__b, blanks become _
    "file_name": (None, "_"),            # a_b, every / becomes _
    "document": (":", ":"),              # prefix:a:b, then : becomes __ and / becomes _
}


def key_text(
    parts: Sequence[str],
    layout: str = "colon",
    prefix: str | None = None,
    suffix: str = "",
) -> Column:
    """Key of a row in ``layout``, built from the columns ``parts``.

    A null part gives a null key.  ``suffix`` is appended as it is, e.g.
    ``.json`` for object stores.
    """
    if layout not in KEY_LAYOUTS:
        raise ValueError(f"unknown key layout {layout!r}; one of {sorted(KEY_LAYOUTS)}")
    lead, between = KEY_LAYOUTS[layout]
    if prefix and lead is None:
        raise ValueError(f"layout {layout!r} takes no prefix")

    pieces = [F.col(parts[0]).cast("string")]
    for name in parts[1:]:
        pieces += [F.lit(between), F.col(name).cast("string")]
    body = F.concat(*pieces)

    if layout == "record":
        body = F.replace(body, F.lit(" "), F.lit("_"))
    if prefix:
        if layout == "path":
            # Object prefixes are given with or without their closing slash.
            prefix = prefix.rstrip("/")
        body = F.concat(F.lit(prefix + lead), body)
    if layout == "file_name":
        body = F.replace(body, F.lit("/"), F.lit("_"))
    if layout == "document":
        body = F.replace(F.replace(body, F.lit(":"), F.lit("__")), F.lit("/"), F.lit("_"))
    return F.concat(body, F.lit(suffix)) if suffix else body


def key_tail(key: str | Column, prefix: str = "", suffix: str = "") -> Column:
    """What is left of ``key`` without ``prefix`` and ``suffix``.

    Keys that do not carry the prefix (or suffix) are left as they are at that end.
    """
    column = F.col(key) if isinstance(key, str) else key
    if prefix:
        column = F.when(
            column.startswith(prefix), F.substring(column, len(prefix) + 1, 2**31 - 1)
        ).otherwise(column)
    if suffix:
        column = F.when(
            column.endswith(suffix),
            F.substring(column, F.lit(1), F.length(column) - F.lit(len(suffix))),
        ).otherwise(column)
    return column


def prefix_end(prefix: str) -> str | None:
    """Smallest text greater than every text that starts with ``prefix``.

    ``None`` when there is none.  Spark compares strings by their UTF-8 bytes,
    which is code point order, so the last code point that can grow is raised.
    """
    for cut in range(len(prefix), 0, -1):
        code = ord(prefix[cut - 1])
        if code < 0x10FFFF:
            # Surrogates are no characters; the next one after them is U+E000.
            following = 0xE000 if code == 0xD7FF else code + 1
            return prefix[: cut - 1] + chr(following)
    return None


def stable_id(key: str | Column) -> Column:
    """Identifier of a key that is the same in every process and every engine."""
    return F.md5(F.col(key) if isinstance(key, str) else key)
