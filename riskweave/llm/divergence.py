"""Divergence of sources from each other and from their language, with late terms.

Terms are runs of letters A-Z and characters beyond ASCII, A-Z lower-cased. Each language keeps
the terms in at least min_docs of its documents. A source's share of a kept term is
p = 1 + floor(SCALE * (count + 1) / (N + V)); two shares p and q differ by f = floor((p-q)**2 / q).
Reported are, for each source, the sums of f over all kept terms against every other source of the
language, and the terms it uses more than the language does, by f, to rank `top`.

Late terms. A task counts the terms of its documents by language and source, a block of texts at a
time by one sort, and writes them with a 64-bit digest. From then on counts are shuffled, joined and ranked by digest alone. Per digest the
smallest and largest term are compared: where they differ, the digest is that of several terms,
and its rows take the term itself as a second key, so shares are those of terms whatever the
digests do. Terms are joined back for the rows that are reported, and for those that tie with them.

Sums without all terms of all pairs. A term that both sources lack adds the same for all such
terms; one that only a has depends on its share in a alone, so the number of a's terms by share is
enough; only terms that both have are met pair by pair, in bounded blocks of terms, where their f
replaces the two one-sided ones. The sum is exact, and no row is made for a term and a pair.

Defined cases: null text, language and source are empty; a language that keeps no term has pairs
of value 0 and no terms; a source without kept terms has pairs, no terms; ties go to the smaller
item by its bytes; repeated rows are documents of their own; extra columns are ignored; an empty
table gives no rows; very long texts are split in steps of STEP_BYTES.

Scale: texts are not shuffled, a term once per task, source and language at most. The counts of a
hot source are spread by digest. Pairs of sources are the result; those of a language are dealt
over blocks of at most PAIR_ROWS sources. The shares of all groups are joined by a table of one
row per source and language, which the planner broadcasts while it is small; beyond, adaptive
execution splits a hot source's terms.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskweave.llm.common import BLOCK_BYTES, blocks, bounded_batches, stored

MIN_DOCS = 3
SCALE = 1_000_000_000
TOP = 200
STEP_BYTES = 4_000_000
# terms of groups, and bytes of terms, that a task holds before it writes them
HELD_TERMS = 1_000_000
HELD_BYTES = 64 << 20
# texts that a task is given at a time
BATCH_BYTES = 8 << 20
BLOCK_ROWS = 200_000
PAIR_ROWS = 64

_FOLD = bytes(c if c >= 128 or 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))
COUNTS = "lang string, source string, digest long, n long, docs long, term string, new boolean"
KEY = ["digest", "tag"]
# group, term, n, docs: a row per group and term
Counts = tuple[np.ndarray, pa.DictionaryArray, np.ndarray, np.ndarray]


def digest_of(term: bytes) -> int:
    return xxhash.xxh64_intdigest(term) - (1 << 63)


def term_steps(raw: bytes, step: int = STEP_BYTES) -> Iterator[list[bytes]]:
    """The terms of a UTF-8 text, in steps of whole terms."""
    folded, at = raw.translate(_FOLD), 0
    while at < len(folded):
        end = len(folded) if len(folded) - at <= step else folded.find(b" ", at + step)
        end = len(folded) if end < 0 else end
        yield folded[at:end].split()
        at = end


def block_terms(raw: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The terms of a block of UTF-8 texts in their order, and the number of the text that each is from."""
    folded = np.frombuffer(raw.tobytes().translate(_FOLD), np.uint8)
    kept = folded != 32
    inside = np.concatenate([[False], kept, [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    # a term at the end of a text and one at the start of the next are two
    meet = np.unique(offsets)
    meet = meet[inside[meet] & inside[meet + 1]]
    if len(meet):
        starts, ends = np.sort(np.append(starts, meet)), np.sort(np.append(ends, meet))
    at = np.append(0, np.cumsum(ends - starts)).astype(np.int32)
    terms = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(at), pa.py_buffer(folded[kept])])
    return terms, np.repeat(np.arange(len(offsets) - 1), np.diff(np.searchsorted(starts, offsets)))


def block_counts(terms: pa.Array, text: np.ndarray, group: np.ndarray) -> Counts:
    """Occurrences and texts of each group's terms, by one sort; text numbers the texts in group."""
    coded = terms.dictionary_encode()
    names, own = np.unique(group, return_inverse=True)
    width, shift = len(coded.dictionary), len(group).bit_length()
    key = ((own[text] * width + coded.indices.to_numpy()) << shift) | text
    key.sort()
    of_text = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])
    of_term = key[of_text] >> shift
    first = np.flatnonzero(np.append(True, of_term[1:] != of_term[:-1])[: len(of_term)])
    n, docs = (np.diff(x).astype(np.int32) for x in (np.append(of_text[first], len(key)), np.append(first, len(of_term))))
    own, code = np.divmod(of_term[first], max(width, 1))
    return names[own], pa.DictionaryArray.from_arrays(pa.array(code, pa.int32()), coded.dictionary), n, docs


def merged(parts: list[Counts]) -> Counts:
    """The sums of several counts, a row per group and term."""
    terms = pa.chunked_array([x[1] for x in parts]).unify_dictionaries().combine_chunks()
    width = max(len(terms.dictionary), 1)
    key = np.concatenate([x[0] for x in parts]) * np.int64(width) + terms.indices.to_numpy()
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])
    column = lambda k: np.concatenate([x[k] for x in parts])[order]
    n, docs = (np.add.reduceat(column(k), first, dtype=np.int64) if len(first) else np.empty(0, np.int64) for k in (2, 3))
    group, code = np.divmod(key[first], width)
    return group.astype(np.int32), pa.DictionaryArray.from_arrays(pa.array(code, pa.int32()), terms.dictionary), n, docs


def term_counts(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """Occurrences n and documents docs of each term, as the tasks counted them (a term may have
    several rows; `new` marks each term once per task or more), stored."""
    bounded_batches(docs.sparkSession, BATCH_BYTES)
    digest = digest_of

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers: dict[tuple[str, str], int] = {}
        held: list[Counts] = []

        def over(limit: int) -> bool:
            return sum(len(x[0]) for x in held) > limit * HELD_TERMS or sum(x[1].dictionary.nbytes for x in held) > limit * HELD_BYTES

        def rows() -> Iterator[pa.RecordBatch]:
            if not held:
                return
            group, terms, n, docs_ = merged(held) if len(held) > 1 else held[0]
            held.clear()
            langs, sources = (pa.array(x, pa.string()) for x in zip(*numbers, strict=True))
            code, texts = terms.indices.to_numpy(), terms.dictionary.cast(pa.string())
            digests = np.fromiter(map(digest, terms.dictionary.to_pylist()), np.int64, len(texts))
            new = np.zeros(len(code), bool)
            new[np.unique(code, return_index=True)[1]] = True
            for k in range(0, len(code), 50_000):
                part = slice(k, k + 50_000)
                yield pa.RecordBatch.from_arrays(
                    [langs.take(pa.array(group[part])), sources.take(pa.array(group[part])), pa.array(digests[code[part]]), pa.array(n[part], pa.int64()), pa.array(docs_[part], pa.int64()),
                     texts.take(pa.array(code[part])), pa.array(new[part])],
                    ["lang", "source", "digest", "n", "docs", "term", "new"],
                )

        for batch in batches:
            named = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            group = np.array([numbers.setdefault(x, len(numbers)) for x in named], np.int32)
            for row, end, raw, offsets in blocks(batch.column(2), min(BLOCK_BYTES, STEP_BYTES)):
                if len(raw) > STEP_BYTES:  # one long text
                    steps = (pa.array(x, pa.binary()) for x in term_steps(raw.tobytes()))
                    *counts, _ = merged([block_counts(x, np.zeros(len(x), np.int64), group[row:end]) for x in steps])
                    held.append((*counts, np.ones_like(counts[2])))
                else:
                    held.append(block_counts(*block_terms(raw, offsets), group[row:end]))
                # merged at twice the limit and written if more than the limit remain: a row is merged a few times at most
                if over(2):
                    held[:] = [merged(held)]
                    if over(1):
                        yield from rows()
            if len(numbers) > HELD_TERMS:
                yield from rows()
                numbers.clear()
        yield from rows()

    named = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(x) for c, x in ((lang, "lang"), (source, "source"), (text, "text"))]
    return stored(docs.select(*named).mapInArrow(count, COUNTS), "term-counts")


def keyed(counted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The counts by (digest, tag), one key per term, and the terms: digest, tag, term. tag is the
    term where its digest has several, else empty."""
    # a task names a term once, so there is little to combine before the shuffle
    ends = stored(counted.where("new").repartition("digest").groupBy("digest").agg(F.min("term").alias("least"), F.max("term").alias("most")), "terms")
    several = F.col("least") != F.col("most")
    shared = stored(ends.where(several).select("digest", F.lit(True).alias("several")), "shared-digests")
    rows = counted.join(shared, "digest", "left").withColumn("tag", F.when(F.col("several"), F.col("term")).otherwise(""))
    split = rows.where("several").select("digest", "tag", "term").distinct()
    return rows.select("lang", "source", *KEY, "n", "docs"), ends.where(~several).select("digest", F.lit("").alias("tag"), F.col("least").alias("term")).union(split)


def _share(count: str, total: str) -> Column:
    """1 + floor(SCALE * (count + 1) / (total + v)), exact; null where nothing is kept."""
    exact = f"cast({SCALE} as decimal(10,0)) * cast({count} + 1 as decimal(20,0)) div cast({total} + v as decimal(20,0))"
    return F.expr(f"CASE WHEN v > 0 THEN 1 + {exact} END")


def _f(p: str, q: str) -> str:
    return f"(({p}) - ({q})) * (({p}) - ({q})) div ({q})"


def weights(docs: DataFrame, lang: str, source: str, text: str, min_docs: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Kept terms of every source with its share p, the share p0 of a term it lacks and the
    language's share q; the groups (source, language) with v kept terms of the language and k of
    the source; and the terms."""
    rows, terms = keyed(term_counts(docs, lang, source, text))
    # one shuffle by term and language: the sums of sources, of the language and the choice of terms
    of_term = Window.partitionBy(*KEY, "lang")
    counts = rows.repartition(*KEY, "lang").groupBy(*KEY, "lang", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    counts = counts.select(
        *KEY, "lang", "source", "n", F.sum("n").over(of_term).alias("n_lang"), F.sum("docs").over(of_term).alias("docs"),
        (F.col("source") == F.min("source").over(of_term)).alias("first"),
    )
    present = stored(counts.where(F.col("docs") >= min_docs).drop("docs"), "present-terms")
    own = present.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("k"))
    of_lang = present.groupBy("lang").agg(F.count_if("first").alias("v"), F.sum("n").alias("total_lang"))
    named = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(x) for c, x in ((lang, "lang"), (source, "source"))]
    groups = docs.select(*named).distinct().join(own, ["lang", "source"], "left").join(of_lang, "lang", "left").fillna(0, ["total", "k", "v", "total_lang"])
    groups = stored(groups.withColumn("p0", _share("0L", "total")), "groups")
    full = present.join(groups, ["lang", "source"]).withColumn("p", _share("n", "total")).withColumn("q", _share("n_lang", "total_lang"))
    return stored(full.select("lang", "source", *KEY, "p", "p0", "q"), "shares"), groups, terms


def common_terms(shares: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """lang, source a, other b, the number of kept terms that both have, and the sum over them of
    f(p_a, p_b) - f(p_a, p0_b) - f(p0_a, p_b)."""
    parts = max(1, -(-shares.count() // block_rows))

    def summed(rows: pa.Table) -> pa.Table:
        sums = rows.group_by("key", use_threads=False).aggregate([("common", "sum"), ("change", "sum")])
        return sums.select(["key", "common_sum", "change_sum"]).rename_columns(["key", "common", "change"])

    def meet(block: pa.Table) -> pa.Table:
        block = block.sort_by([("digest", "ascending"), ("tag", "ascending")]).combine_chunks()
        digest, tag = block["digest"].to_numpy(), block["tag"].to_numpy()
        term = np.append(0, np.cumsum((digest[1:] != digest[:-1]) | (tag[1:] != tag[:-1])))
        names = block["source"].combine_chunks().dictionary_encode()
        source, sources = names.indices.to_numpy().astype(np.int64), len(names.dictionary)
        p, p0 = block["p"].to_numpy(), block["p0"].to_numpy()
        f = lambda x, y: (x - y) ** 2 // y
        met = pa.table([pa.array([], pa.int64())] * 3, names=["key", "common", "change"])
        # rows of one term lie together: neighbours at distance 1, 2, ... until no term has so many
        for step in range(1, sources):
            i = np.flatnonzero(term[step:] == term[:-step])
            if not len(i):
                break
            a, b = np.concatenate([i, i + step]), np.concatenate([i + step, i])
            change = f(p[a], p[b]) - f(p[a], p0[b]) - f(p0[a], p[b])
            here = pa.table([source[a] * sources + source[b], np.ones(len(a), np.int64), change], names=met.column_names)
            met = summed(pa.concat_tables([met, summed(here)]))
        key = met["key"].to_numpy()
        take = lambda k: names.dictionary.take(pa.array(k))
        lang = pa.array([block["lang"][0].as_py()] * len(key), pa.string())
        return pa.table([lang, take(key // sources), take(key % sources), met["common"], met["change"]], names=["lang", "source", "other", "common", "change"])

    blocks = shares.select("lang", "source", *KEY, "p", "p0", F.pmod("digest", F.lit(parts)).alias("block")).groupBy("lang", "block")
    met = blocks.applyInArrow(meet, "lang string, source string, other string, common long, change long")
    return met.groupBy("lang", "source", "other").agg(F.sum("common").alias("common"), F.sum("change").alias("change"))


def source_pairs(shares: DataFrame, groups: DataFrame, block_rows: int = BLOCK_ROWS, pair_rows: int = PAIR_ROWS) -> DataFrame:
    """lang, source, item (another source of the language), value."""
    by_share = shares.groupBy("lang", "source", "p").agg(F.count("*").alias("n"))
    by_share = by_share.groupBy("lang", "source").agg(F.collect_list(F.struct("p", "n")).alias("by_share"))
    blocks = groups.groupBy("lang").agg(F.ceil(F.count("*") / pair_rows).cast("int").alias("blocks"))
    own = stored(groups.join(by_share, ["lang", "source"], "left").join(blocks, "lang"), "sources")
    a = own.withColumn("block", F.pmod(F.xxhash64("source"), "blocks")).select("lang", "block", "source", F.col("k").alias("k_a"), "v", F.col("p0").alias("p0_a"), F.col("by_share").alias("shares_a"))
    b = own.select("lang", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.col("source").alias("other"), F.col("k").alias("k_b"), F.col("p0").alias("p0_b"), F.col("by_share").alias("shares_b"))
    pairs = a.join(b, ["lang", "block"]).where("source <> other").join(common_terms(shares, block_rows), ["lang", "source", "other"], "left")

    def one_sided(of: str, p: str, q: str) -> str:
        return f"aggregate(coalesce({of}, array()), 0L, (s, x) -> s + x.n * ({_f(p, q)}))"

    value = f"""CASE WHEN v = 0 THEN 0L ELSE {one_sided('shares_a', 'x.p', 'p0_b')} + {one_sided('shares_b', 'p0_a', 'x.p')} + coalesce(change, 0L)
      + (v - k_a - k_b + coalesce(common, 0L)) * ({_f('p0_a', 'p0_b')}) END"""
    return pairs.select("lang", "source", F.col("other").alias("item"), F.expr(value).alias("value"))


def marked_terms(shares: DataFrame, terms: DataFrame, top: int = TOP) -> DataFrame:
    """lang, source, item (a term that the source uses more than the language), value, rank."""
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    best = shares.where("p > q").select("lang", "source", *KEY, F.expr(_f("p", "q")).alias("value"))
    # ties at the last rank stay until their terms are known
    best = best.withColumn("rank", F.rank().over(by_value)).where(F.col("rank") <= top).drop("rank")
    named = stored(best, "best-terms").join(terms, KEY).select("lang", "source", F.col("term").alias("item"), "value")
    return named.withColumn("rank", F.row_number().over(by_value.orderBy(F.desc("value"), "item"))).where(F.col("rank") <= top)


def audit(
    docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", min_docs: int = MIN_DOCS, top: int = TOP,
    block_rows: int = BLOCK_ROWS, pair_rows: int = PAIR_ROWS,
) -> DataFrame:
    """lang, source, part (pair or term), item, value, rank."""
    shares, groups, terms = weights(docs, lang, source, text, min_docs)
    every = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = source_pairs(shares, groups, block_rows, pair_rows).withColumn("rank", F.row_number().over(every))
    columns = lambda df, part: df.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")
    return columns(pairs, "pair").union(columns(marked_terms(shares, terms, top), "term"))


__all__ = ["digest_of", "term_steps", "block_terms", "block_counts", "merged", "term_counts", "keyed", "weights", "common_terms", "source_pairs", "marked_terms", "audit"]
