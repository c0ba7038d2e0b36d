"""Interaction audit of document filters: what each filter removes in every order of them.

A document's failing filters are one bit each. The conditions on the text alone are expressions;
the last filter, exact duplicates, is an existential self-join: a document fails it if some
document of equal hash and equal text has a smaller doc_id (a left-semi join). Its ids are united
with the ids that fail other filters, the bits of an id are or-ed, and documents are counted by
part and bit combination. All orders are told from these counts: at most 2**k rows a part for k
filters.

The smaller-id side of the self-join is first reduced to one row per text, its smallest doc_id;
that row has a smaller id than a document exactly if any row has. Texts are taken to the join only
for hashes that occur twice. A hash with more rows than total / HOT is dealt over salts of that
many rows each, and its one text row is copied to them.

Defined cases: null text is empty (0 words); null part is the empty string; a null doc_id is never
smaller or larger than another, so it neither fails the duplicate filter nor makes others fail,
and it has no labels; repeated rows are documents of their own that have one id, so none is the
other's duplicate; a doc_id with several label rows has a label that any of them gives; ties do not
occur, as ids are compared strictly; very long texts are compared whole; extra columns are ignored;
an empty table gives no rows.

Scale: documents are read twice, once for the thin rows (id, digests, bits) and once for the texts
of repeated hashes; thin rows are shuffled by hash, then by id. The broadcast table of hot hashes
has at most HOT rows, because each holds more than total / HOT of them.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import stored

HOT = 50_000
# a hash is not dealt over salts below this many rows
LEAST_CHUNK = 100
WORDS = r"([^\x20\x09-\x0D]+)"


def text_conditions(text: Column) -> dict[str, Column]:
    """Failure conditions on the text alone: too short, repetitive, shouting, symbols."""
    words = F.regexp_extract_all(text, F.lit(WORDS), F.lit(1))
    n = F.size(words)
    capitals = F.char_length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {
        "A": n < 200,
        "B": F.size(F.array_distinct(words)) * 100 < n * 50,
        "C": capitals.cast("long") * 100 > F.char_length(text).cast("long") * 3,
        "D": text.rlike("[#$%&*|]"),
    }


def _rows(docs: DataFrame, text: str, doc_id: str, part: str) -> DataFrame:
    return docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.coalesce(F.col(text), F.lit("")).alias("text"))


def duplicates(rows: DataFrame, thin: DataFrame, least_chunk: int = LEAST_CHUNK) -> DataFrame:
    """Rows (id, part, text) whose text a smaller id has too -> id, part, own (digest of the text).
    thin holds the hash h of every row."""
    chunk = max(thin.count() // HOT, least_chunk)
    sizes = stored(thin.where("id IS NOT NULL").groupBy("h").agg(F.count("*").alias("n")).where("n > 1"), "hash-sizes")
    salts = F.ceil(F.col("n") / chunk).cast("int")
    hot = F.broadcast(sizes.where(F.col("n") > chunk).select("h", salts.alias("salts")))
    every_salt = F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)).alias("salt")
    keys = sizes.join(hot, "h", "left").select("h", every_salt)
    salt = F.pmod(F.xxhash64("id"), F.coalesce("salts", F.lit(1))).cast("int")
    salted = rows.where("id IS NOT NULL").withColumn("h", F.xxhash64("text")).join(hot, "h", "left").withColumn("salt", salt).drop("salts")
    # stored: read for the smallest ids and as the side that is judged
    texts = stored(salted.join(keys, ["h", "salt"], "left_semi"), "repeated-hashes")
    least = texts.groupBy("h", "text").agg(F.min("id").alias("least"))
    least = least.join(hot, "h", "left").select("h", every_salt, F.col("text").alias("same"), "least")
    on = (F.col("t.h") == F.col("l.h")) & (F.col("t.salt") == F.col("l.salt")) & (F.col("t.text") == F.col("l.same")) & (F.col("l.least") < F.col("t.id"))
    return texts.alias("t").join(least.alias("l"), on, "left_semi").select("id", "part", F.md5("text").alias("own"))


def combinations(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", part: str = "lang", least_chunk: int = LEAST_CHUNK) -> tuple[DataFrame, str]:
    """Documents by id, part, own (digest of the text) and mask, the bits of the filters they fail,
    with the number n of equal rows; and the filters' letters, lowest bit first."""
    rows = _rows(docs, text, doc_id, part)
    conditions = text_conditions(F.col("text"))
    bits = sum((F.when(c, 1 << k).otherwise(0) for k, c in enumerate(conditions.values())), F.lit(0))
    thin = stored(rows.select("id", "part", F.xxhash64("text").alias("h"), F.md5("text").alias("own"), bits.alias("bit")), "failures")
    last = duplicates(rows, thin, least_chunk).select("id", "part", "own", F.lit(1 << len(conditions)).alias("bit"), F.lit(0).alias("n"))
    ids = thin.select("id", "part", "own", "bit", F.lit(1).alias("n")).union(last)
    return ids.groupBy("id", "part", "own").agg(F.bit_or("bit").alias("mask"), F.sum("n").alias("n")), "".join(conditions) + "E"


def cells(masks: DataFrame, labels: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """part, mask, documents n, those labelled good and those labelled toxic."""
    known = labels.groupBy(F.col(doc_id).alias("id")).agg(F.max(F.expr("int(quality <=> 1)")).alias("good"), F.max(F.expr("int(toxic <=> 1)")).alias("toxic"))
    # a null id meets no label, so the inner join holds all that count
    labelled = masks.join(known, "id").select("part", "mask", F.lit(0).alias("n"), (F.col("n") * F.col("good")).alias("good"), (F.col("n") * F.col("toxic")).alias("toxic"))
    counted = masks.select("part", "mask", "n", F.lit(0).alias("good"), F.lit(0).alias("toxic")).union(labelled)
    return counted.groupBy("part", "mask").agg(*(F.sum(c).alias(c) for c in ("n", "good", "toxic")))


def orders(cell: DataFrame, letters: str) -> DataFrame:
    """cells -> per part, order of the filters and step: what the step keeps, removes and loses."""
    every = ["".join(p) for p in permutations(letters)]
    bits = lambda names: sum((F.when(F.contains(names, F.lit(x)), 1 << k).otherwise(0) for k, x in enumerate(letters)), F.lit(0))
    per_part = cell.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    steps = (
        per_part.select("part", "cells", F.explode(F.array(*map(F.lit, every))).alias("filter_order"))
        .select("*", F.explode(F.sequence(F.lit(1), F.lit(len(letters)))).alias("step"))
        .withColumn("own", bits(F.expr("substring(filter_order, step, 1)")))
        .withColumn("earlier", bits(F.expr("substring(filter_order, 1, step - 1)")))
    )

    def total(which, value=lambda c: c.n) -> Column:
        return F.aggregate("cells", F.lit(0).cast("long"), lambda s, c: s + F.when(which(c.mask), value(c)).otherwise(0))

    has = lambda m, b: m.bitwiseAND(F.col(b)) != 0
    here = lambda m: has(m, "own") & ~has(m, "earlier")
    return steps.select(
        "part", "filter_order", "step",
        total(lambda m: ~has(m, "own") & ~has(m, "earlier")).alias("kept"),
        total(here).alias("removed"),
        total(lambda m: has(m, "own") & has(m, "earlier")).alias("redundant"),
        total(lambda m: m == F.col("own")).alias("unique_fails"),
        total(here, lambda c: c.good).alias("good_lost"),
        total(here, lambda c: c.toxic).alias("toxic_lost"),
        # of the k! orders, a filter is the first of the m that a document fails in k! / m
        total(lambda m: has(m, "own"), lambda c: c.n * (F.lit(len(every)) / F.bit_count(c.mask)).cast("long")).alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", part: str = "lang", least_chunk: int = LEAST_CHUNK) -> DataFrame:
    masks, letters = combinations(docs, text, doc_id, part, least_chunk)
    return orders(cells(stored(masks, "masks"), labels, doc_id), letters)


__all__ = ["HOT", "text_conditions", "duplicates", "combinations", "cells", "orders", "audit"]
