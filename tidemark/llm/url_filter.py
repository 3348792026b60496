"""Op 4: captures judged by the filter list that was in force when they were fetched.

A list is a log of dated entries: from an instant on, a host (with its subdomains) or a URL
prefix is blocked or allowed. The entries of one rule become validity intervals, each up to
the next entry of that rule; a capture is joined with the interval of each of its hosts and
prefixes that holds its fetch time. Of the rules in force the most specific decides.

DataFrame functions only.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.storage import written

#: Parts of a URL.
_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"
_PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)"


def host_of(url: Column) -> Column:
    """Host in lower case, without user, port and final dot; empty if there is none."""
    return F.regexp_replace(F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), _HOST, 1)), r"\.+$", "")


def _key(host: Column, path: Column) -> Column:
    """A rule's or a key's name: 128 bits of its host and its path."""
    return F.struct(F.xxhash64(host, path).alias("k1"), F.xxhash64(F.lit(1), host, path).alias("k2"))


def _starts(host: Column) -> Column:
    """Places at which a domain starts in the bytes of a host."""
    after_dot = lambda i: (i == 1) | (F.substr(host, i - 1, F.lit(1)) == F.lit(b"."))
    return F.filter(F.sequence(F.lit(1), F.greatest(F.octet_length(host), F.lit(1))), after_dot)


def _ends(path: Column) -> Column:
    """Places at which a folder or the path ends in the bytes of a path, but for the first slash."""
    n = F.octet_length(path)
    ends = F.filter(
        F.sequence(F.lit(2), F.greatest(n, F.lit(2))),
        lambda i: (i == n) | (F.substr(path, i, F.lit(1)) == F.lit(b"/")),
    )
    return F.when(n > 1, ends).otherwise(F.array().cast("array<int>"))


def rule_keys(host: Column, path: Column) -> Column:
    """The names of all rules that may concern a URL, most general first.

    For ``http://a.b.org/x/y.html`` those of ``org``, ``b.org``, ``a.b.org``, ``a.b.org/x/`` and
    ``a.b.org/x/y.html``. Their number is that of the URL's labels and path segments; each is
    16 bytes, however long the URL, and is cut from it by position. ``host`` and ``path`` are
    columns of bytes, not expressions: they are read once for each place.
    """
    domains = F.transform(_starts(host), lambda i: _key(F.substr(host, i, F.octet_length(host)), F.lit(b"")))
    folders = F.transform(_ends(path), lambda i: _key(host, F.substr(path, F.lit(1), i)))
    none = F.array().cast("array<struct<k1: bigint, k2: bigint>>")
    return F.when(F.octet_length(host) > 0, F.concat(domains, folders)).otherwise(none)


def validity(entries: DataFrame) -> DataFrame:
    """``rule, action, valid_from, valid_to``: from each entry to the next of its rule.

    ``entries``: ``rule, action, since``. Of entries of one rule and instant the one whose
    action sorts last holds (``block`` over ``allow``); entries with a null rule, action or
    instant are no entries. Hosts are lower-cased, paths are not. The last interval has no end.
    """
    known = entries.where("rule is not null and action is not null and since is not null")
    host = F.substring_index("rule", "/", 1)
    rule = F.concat(F.lower(host), F.col("rule").substr(F.length(host) + 1, F.length("rule")))
    one = known.groupBy(rule.alias("rule"), "since").agg(F.max("action").alias("action"))
    following = F.lead("since").over(Window.partitionBy("rule").orderBy("since"))
    return one.select("rule", "action", F.col("since").alias("valid_from"), following.alias("valid_to"))


def _cell(moment: Column) -> Column:
    """The cell of a rule's time that holds a moment; those before its first entry have none."""
    micros = F.unix_micros(moment.cast("timestamp"))
    return F.least(F.call_function("div", micros - F.col("first"), F.col("width")), F.col("cells"))


def timeline(intervals: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rules with the cells that their time is cut into, and the intervals of each cell.

    A rule has as many cells as entries, of equal width between the first and the last of them;
    an interval is in each cell that it touches, which makes fewer than three rows for each
    entry. A moment then meets the entries of its cell only, however many its rule has.
    """
    micros = F.unix_micros(F.col("valid_from").cast("timestamp"))
    entries = F.count(F.lit(1))
    rules = intervals.groupBy("k1", "k2").agg(
        F.min(micros).alias("first"),
        F.greatest(F.ceil((F.max(micros) - F.min(micros)) / entries), F.lit(1)).cast("long").alias("width"),
        entries.alias("cells"),
    )
    rules = written(rules, "rules")
    last = F.when(F.col("valid_to").isNull(), F.col("cells")).otherwise(_cell(F.col("valid_to")))
    cells = intervals.join(rules, ["k1", "k2"]).select(
        *intervals.columns, F.explode(F.sequence(_cell(F.col("valid_from")), last)).alias("cell")
    )
    return rules, written(cells, "cells")


def judge_captures(
    captures: DataFrame, entries: DataFrame, url_col: str = "url", time_col: str = "fetched", id_col: str = "page_id"
) -> DataFrame:
    """``id_col, fetched, host, n_active, rule, action, blocked`` for every row of ``captures``.

    ``rule`` is the longest key in force at the fetch time, ``action`` what it says; without
    one both are null and the capture is not blocked. Null or unreadable URLs have an empty
    host and no rules; without a fetch time no rule is in force. Null ids and repeated rows
    stay; other columns are not read. Empty tables give no rows, or no rules in force. Times are
    timestamps.

    URLs that repeat with their time are judged once. URLs, and the keys of rules, are named by
    128 bits in the joins, so a URL of many steps is not copied for each. The intervals of a rule
    are rows of their own, found by rule and cell of its time (:func:`timeline`), of which a key
    of a URL meets one in force at most; Spark can split the side that a hot host or a rule with
    many entries fills. Entries that crowd one cell are compared with all captures of that cell.
    """
    known = validity(entries)
    # Where a rule has no slash its path is empty.
    host = F.substring_index("rule", "/", 1)
    path = F.col("rule").substr(F.length(host) + 1, F.length("rule"))
    named = known.select("*", _key(F.encode(host, "utf-8"), F.encode(path, "utf-8")).alias("key"))
    # Tables of their own: beside an aggregate Spark does not split the keys of a hot site.
    rules, cells = timeline(written(named.select(*known.columns, "key.*"), "intervals"))
    url = F.col("url")
    rows = captures.select(
        F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(time_col).alias("fetched")
    ).select("*", *[F.when(url.isNotNull(), F.xxhash64(F.lit(seed), url)).alias(f"u{seed}") for seed in (1, 2)])
    capture = ["u1", "u2", "fetched"]
    asked = rows.where("url is not null and fetched is not null").dropDuplicates(capture)
    parts = asked.select(
        *capture,
        F.encode(host_of(url), "utf-8").alias("host"),
        F.encode(F.regexp_extract(url, _PATH, 1), "utf-8").alias("path"),
    )
    keyed = parts.select(*capture, F.explode(rule_keys(F.col("host"), F.col("path"))).alias("key")).select(*capture, "key.*")
    placed = keyed.join(rules, ["k1", "k2"]).select(*capture, "k1", "k2", _cell(F.col("fetched")).alias("cell"))
    holds = (F.col("valid_from") <= F.col("fetched")) & (F.col("valid_to").isNull() | (F.col("fetched") < F.col("valid_to")))
    active = placed.join(cells, ["k1", "k2", "cell"]).where(holds).select(*capture, "rule", "action")
    # The keys of one URL are prefixes or suffixes of each other: none has another's length.
    best = active.groupBy(*capture).agg(
        F.count(F.lit(1)).alias("n_active"),
        F.max(F.struct(F.contains("rule", F.lit("/")).alias("path"), F.length("rule").alias("n"), "rule", "action")).alias("best"),
    )
    return rows.join(best, capture, "left").select(
        F.col("id").alias(id_col),
        F.col("fetched").alias(time_col),
        host_of(url).alias("host"),
        F.coalesce("n_active", F.lit(0)).cast("long").alias("n_active"),
        F.col("best.rule").alias("rule"),
        F.col("best.action").alias("action"),
        F.coalesce(F.col("best.action") == "block", F.lit(False)).alias("blocked"),
    )
