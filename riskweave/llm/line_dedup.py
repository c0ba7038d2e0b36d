"""Line dedup by site-relative frequency (native).

A line is boilerplate on a host when the pages that hold it, divided by the pages of the host,
exceed `ratio`, and at least `min_pages` pages hold it. Every row with a text is a page, copies
too. RATIO: lines of prose are all but unique to their page, so a line that one page in twenty of
a host shares is a template, whatever the size of the host; min_pages keeps small hosts whole,
where one page is more than that share. The share among different texts, where copies are one
page, is counted beside it (by_text): a line above `ratio` only by pages is one that copies repeat.

Lines are split at line feeds and compared without leading and trailing spaces; blank lines
always stay. Kept lines are joined in order, so a text without boilerplate is returned as it was.

Defined cases: null text stays null (0 lines, no page); a null host is a host of its own; a host
below `min_pages` pages loses nothing; a line twice on a page is on one page; a share of exactly
`ratio` stays; repeated rows are pages of their own and treated alike; extra columns pass through;
an empty table gives an empty table; a very long text is one row's array of lines.

Scale: (host, line) counts are aggregates with map-side combine, so a hot host or line is summed
before the shuffle; texts are never shuffled unless the table of dropped lines outgrows the
session's broadcast threshold. A host's dropped lines number at most (its mean lines per page) /
ratio, because each lies on more than ratio of its pages. Lines travel as 64-bit hashes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import fresh_name, stored

RATIO = 0.05
MIN_PAGES = 5


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _key(line: Column) -> Column:
    return F.xxhash64(F.trim(line))


def boilerplate(
    docs: DataFrame, host: str = "source", text: str = "text", ratio: float = RATIO, min_pages: int = MIN_PAGES
) -> DataFrame:
    """Dropped lines: host, line key, pages that hold it, pages of the host."""
    return _shares(docs, host, text, min_pages).where(_above("pages", "host_pages", ratio, min_pages))


def _above(held: str, of: str, ratio: float, min_pages: int) -> Column:
    return (F.col(held) >= min_pages) & (F.col(held) > F.lit(ratio) * F.col(of))


def _shares(docs: DataFrame, host: str, text: str, min_pages: int, by_text: bool = False) -> DataFrame:
    """Lines on at least min_pages pages: host, line key, pages that hold it, pages of the host;
    by_text adds the different texts that hold it and those of the host."""
    base = docs.where(F.col(text).isNotNull()).select(F.col(host).alias("host"), F.col(text).alias("text"))
    filled = F.filter(_lines(F.col("text")), lambda x: F.trim(x) != "")
    each = F.explode(F.array_distinct(F.transform(filled, _key))).alias("line")
    if by_text:
        # copies of a text are counted first, so one sum gives the pages and one count the texts
        page = F.xxhash64("text").alias("page")
        total = base.groupBy("host", page).agg(F.count("*").alias("n")).groupBy("host").agg(F.sum("n").alias("host_pages"), F.count("*").alias("host_texts"))
        held = base.select("host", page, each).groupBy("host", "line", "page").agg(F.count("*").alias("n"))
        held = held.groupBy("host", "line").agg(F.sum("n").alias("pages"), F.count("*").alias("texts"))
    else:
        total = base.groupBy("host").agg(F.count("*").alias("host_pages"))
        held = base.select("host", each).groupBy("host", "line").agg(F.count("*").alias("pages"))
    t = total.withColumnRenamed("host", "total_host")
    return held.where(F.col("pages") >= min_pages).join(t, F.col("host").eqNullSafe(F.col("total_host"))).select(
        "host", "line", "pages", "host_pages", *(["texts", "host_texts"] if by_text else [])
    )


def drop_boilerplate(
    docs: DataFrame, host: str = "source", text: str = "text", ratio: float = RATIO, min_pages: int = MIN_PAGES,
    counts: bool = False, by_text: bool = False,
) -> DataFrame:
    """docs with boilerplate lines removed from `text`; n_chars, if there, follows the new text.
    With counts, the columns n_lines and n_dropped are added; with by_text, n_dropped_by_text: the
    lines that would be removed if copies of a text were one page."""
    dropped, once = fresh_name(docs, "dropped"), fresh_name(docs, "once")
    site = fresh_name(docs, "site")
    rules = {dropped: _above("pages", "host_pages", ratio, min_pages)}
    if by_text:
        rules[once] = _above("texts", "host_texts", ratio, min_pages)
    found = _shares(docs, host, text, min_pages, by_text).where(reduce(Column.__or__, rules.values()))
    per_host = found.groupBy("host").agg(*(F.sort_array(F.collect_set(F.when(rule, F.col("line")))).alias(name) for name, rule in rules.items()))
    per_host = stored(per_host, "boilerplate").withColumnRenamed("host", site)
    joined = docs.join(per_host, F.col(host).eqNullSafe(F.col(site)), "left")
    lines = _lines(F.col(text))
    kept = F.filter(lines, lambda x: (F.trim(x) == "") | ~F.array_contains(F.col(dropped), _key(x)))
    touched = F.coalesce(F.size(dropped) > 0, F.lit(False)) & F.col(text).isNotNull()
    new = F.when(touched, F.array_join(kept, "\n")).otherwise(F.col(text))
    out = []
    for c in docs.columns:
        if c == text:
            out.append(new.alias(c))
        elif c == "n_chars":
            out.append(F.when(touched, F.char_length(new)).otherwise(F.col(c)).cast("long").alias(c))
        else:
            out.append(F.col(c))
    if counts:
        total = F.when(F.col(text).isNull(), 0).otherwise(F.size(lines))
        out.append(total.cast("long").alias("n_lines"))
        out.append(F.when(touched, F.size(lines) - F.size(kept)).otherwise(0).cast("long").alias("n_dropped"))
    if by_text:
        again = F.filter(lines, lambda x: (F.trim(x) != "") & F.array_contains(F.col(once), _key(x)))
        counted = F.col(once).isNotNull() & F.col(text).isNotNull()
        out.append(F.when(counted, F.size(again)).otherwise(0).cast("long").alias("n_dropped_by_text"))
    return joined.select(*out)


__all__ = ["RATIO", "MIN_PAGES", "boilerplate", "drop_boilerplate"]
