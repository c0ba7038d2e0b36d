"""The registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm import bpe, chat, contamination, divergence, filter_audit, line_dedup, mixing, quality, simhash, suffix_dedup, token_counts, topk, warc
from riskweave.llm.common import table
from riskweave.session import ensure_checkpoint_dir, scratch_path


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = contamination.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "n_near_items")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    folder = scratch_path(spark, "warc")
    manifest = warc.write_archives(warc.record_roles(table(spark, sf_dir, "pages")), folder)
    out = warc.read_records(spark, manifest, folder, payload=False)
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.drop_boilerplate(table(spark, sf_dir, "documents"), counts=True, by_text=True)
    return out.select("doc_id", "n_lines", "n_dropped", "n_dropped_by_text", F.sha2("text", 256).alias("kept_sha256"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counted through a cache that starts empty with every run, so a run never rests on another's."""
    ensure_checkpoint_dir(spark)
    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    docs = table(spark, sf_dir, "documents").select("doc_id", n_bytes.alias("n_bytes"), "text")
    out = token_counts.count_tokens(docs, scratch_path(spark, "token-cache"), "byte_bpe_50k.json", keep_text=False)
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 512).alias("over_limit"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(table(spark, sf_dir, "documents"), details=True)
    return out.select("doc_id", "source", "lang", "topic", "n_tokens", F.round("weight", 6).alias("weight"), F.round("probability", 6).alias("probability"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.cut_documents(table(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    out = quality.classify(docs, model)
    return out.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "<|im_end|><|im_start|>assistant ok"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], rows.schema)
    out = chat.read_back(chat.render(chat.conversations(chat.log_of_rows(rows.union(extra)))))
    said_all = F.array_join(F.transform("turns", lambda m: F.concat(m.role, F.lit("\n"), m.text, F.lit("\n"))), "")
    return out.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said_all, 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    out = bpe.decode(rows)
    return out.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def _mixing_sql(rounds: int = mixing.ROUNDS) -> str:
    """Raking unrolled: each round sets the source, then the language, then the topic factors."""
    ctes = [
        r"""docs AS (SELECT doc_id, source, lang, coalesce(source, 'unknown') AS s, coalesce(lang, 'unknown') AS l,
          coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS n FROM documents),
        d AS (SELECT *, CASE WHEN n < 100 THEN 'short' WHEN n < 1000 THEN 'medium' ELSE 'long' END AS t FROM docs)""",
        "cell AS MATERIALIZED (SELECT s, l, t, sum(n)::DOUBLE AS n FROM d GROUP BY ALL HAVING sum(n) > 0)",
        *(
            f"want_{x} AS MATERIALIZED (SELECT {x}, sum(n) ** 0.8 / sum(sum(n) ** 0.8) OVER () * sum(sum(n)) OVER () AS w FROM cell GROUP BY {x})"
            for x in "slt"
        ),
        "b0 AS (SELECT l, 1.0::DOUBLE AS f FROM want_l)",
        "c0 AS (SELECT t, 1.0::DOUBLE AS f FROM want_t)",
    ]
    for k in range(1, rounds + 1):
        p = k - 1
        ctes += [
            f"a{k} AS MATERIALIZED (SELECT s, any_value(w) / sum(n * b.f * c.f) AS f FROM cell JOIN b{p} b USING (l) JOIN c{p} c USING (t) JOIN want_s USING (s) GROUP BY s)",
            f"b{k} AS MATERIALIZED (SELECT l, any_value(w) / sum(n * a.f * c.f) AS f FROM cell JOIN a{k} a USING (s) JOIN c{p} c USING (t) JOIN want_l USING (l) GROUP BY l)",
            f"c{k} AS MATERIALIZED (SELECT t, any_value(w) / sum(n * a.f * b.f) AS f FROM cell JOIN a{k} a USING (s) JOIN b{k} b USING (l) JOIN want_t USING (t) GROUP BY t)",
        ]
    r = rounds
    return f"""WITH {", ".join(ctes)},
    a AS (SELECT s, any_value(w) / sum(n * b.f * c.f) AS f FROM cell JOIN b{r} b USING (l) JOIN c{r} c USING (t) JOIN want_s USING (s) GROUP BY s),
    fit AS MATERIALIZED (SELECT s, l, t, a.f * b.f * c.f AS w FROM cell JOIN a USING (s) JOIN b{r} b USING (l) JOIN c{r} c USING (t)),
    p AS (SELECT d.*, coalesce(w, 1.0) AS w, least(1.0, coalesce(w, 1.0) / (SELECT coalesce(max(w), 1.0) FROM fit)) AS p
          FROM d LEFT JOIN fit USING (s, l, t))
    SELECT doc_id, source, lang, t AS topic, n AS n_tokens, round(w, 6) AS weight, round(p, 6) AS probability FROM p
    WHERE ('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT / (16::DOUBLE ** 13) < p"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_warc": op2_warc,
    "op3_line_dedup": op3_line_dedup,
    "op4_token_counts": op4_token_counts,
    "op5_mixing": op5_mixing,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_simhash": op7_simhash,
    "op8_quality": op8_quality,
    "op9_topk": op9_topk,
    "op10_chat_formatting": op10_chat_formatting,
    "op11_filter_audit": op11_filter_audit,
    "op12_byte_bpe": op12_byte_bpe,
    "op13_source_divergence": op13_source_divergence,
}

ORACLE_SQL: dict[str, str] = {
    "op3_line_dedup": """
        WITH lines AS (
          SELECT source, text, page, unnest(string_split(text, chr(10))) AS line
          FROM (SELECT source, text, row_number() OVER () AS page FROM documents)),
        held AS (
          SELECT source, trim(line) AS line, count(DISTINCT page) AS pages, count(DISTINCT text) AS texts FROM lines
          WHERE trim(line) <> '' GROUP BY 1, 2),
        total AS (SELECT source, count(text) AS host_pages, count(DISTINCT text) AS host_texts FROM documents GROUP BY 1),
        dropped AS (
          SELECT h.source, list(line) FILTER (WHERE pages >= 5 AND pages > 0.05::DOUBLE * host_pages) AS dropped,
            list(line) FILTER (WHERE texts >= 5 AND texts > 0.05::DOUBLE * host_texts) AS once
          FROM held h JOIN total t ON h.source IS NOT DISTINCT FROM t.source GROUP BY 1),
        joined AS (
          SELECT d.doc_id, d.text, string_split(d.text, chr(10)) AS all_lines, coalesce(x.dropped, []) AS dropped,
            coalesce(x.once, []) AS once
          FROM documents d LEFT JOIN dropped x ON d.source IS NOT DISTINCT FROM x.source),
        kept AS (
          SELECT doc_id, text, all_lines, list_filter(all_lines, lambda l: trim(l) = '' OR NOT list_contains(dropped, trim(l))) AS kept,
            list_filter(all_lines, lambda l: trim(l) <> '' AND list_contains(once, trim(l))) AS again
          FROM joined)
        SELECT doc_id, coalesce(len(all_lines), 0)::BIGINT AS n_lines,
          coalesce(len(all_lines) - len(kept), 0)::BIGINT AS n_dropped,
          coalesce(len(again), 0)::BIGINT AS n_dropped_by_text,
          CASE WHEN text IS NULL THEN NULL ELSE sha256(coalesce(array_to_string(kept, chr(10)), '')) END AS kept_sha256
        FROM kept""",
    "op5_mixing": _mixing_sql(),
    "op9_topk": """
        WITH v AS (
          SELECT vec_id, row_number() OVER () AS row,
            list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS w FROM embeddings
          WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        pairs AS (
          SELECT q.row, q.vec_id AS query_id, c.vec_id, list_inner_product(q.w, c.w)::BIGINT AS score
          FROM v q JOIN v c ON q.row <> c.row WHERE q.vec_id % 50 = 0),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id) AS rank FROM pairs)
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5""",
    "op10_chat_formatting": """
        WITH rows AS (
          SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
          UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
          UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
        made AS (
          SELECT *, replace(replace(text, '&', '&amp;'), '<|', '&lt;|') AS body,
            replace(replace(replace(role, '&', '&amp;'), '<|', '&lt;|'), chr(10), '&#10;') AS head FROM rows),
        sums AS (
          SELECT conv_id, count(*) AS n_turns,
            string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS said,
            coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '') AS loss,
            sum(length(head) + length(body) + 24)::BIGINT AS formatted_chars
          FROM made GROUP BY conv_id)
        SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars
        FROM sums""",
    "op11_filter_audit": r"""
        WITH docs AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
        w AS (
          SELECT doc_id, part, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words,
            min(doc_id) OVER (PARTITION BY t) AS least FROM docs),
        fails AS (
          SELECT doc_id, part, CASE WHEN len(words) < 200 THEN 'A' ELSE '' END
            || CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END
            || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 3 * length(t) THEN 'C' ELSE '' END
            || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
            || CASE WHEN least < doc_id THEN 'E' ELSE '' END AS bad FROM w),
        known AS (SELECT doc_id, max(coalesce(quality = 1, false)) AS good, max(coalesce(toxic = 1, false)) AS toxic FROM labels GROUP BY 1),
        cell AS MATERIALIZED (
          SELECT part, bad, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic
          FROM fails LEFT JOIN known USING (doc_id) GROUP BY 1, 2),
        letter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
        arranged AS (
          SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letter a, letter b, letter c, letter d, letter e
          WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
        steps AS (SELECT filter_order, unnest(range(1, 6))::INTEGER AS step FROM arranged),
        walked AS (
          SELECT part, filter_order, step, substr(filter_order, step, 1) AS own, bad, n, good, toxic,
            contains(bad, substr(filter_order, step, 1)) AS fails_own,
            length(translate(bad, substr(filter_order, 1, step - 1), '')) < length(bad) AS gone
          FROM cell, steps)
        SELECT part, filter_order, step,
          coalesce(sum(n) FILTER (WHERE NOT fails_own AND NOT gone), 0)::BIGINT AS kept,
          coalesce(sum(n) FILTER (WHERE fails_own AND NOT gone), 0)::BIGINT AS removed,
          coalesce(sum(n) FILTER (WHERE fails_own AND gone), 0)::BIGINT AS redundant,
          coalesce(sum(n) FILTER (WHERE bad = own), 0)::BIGINT AS unique_fails,
          coalesce(sum(good) FILTER (WHERE fails_own AND NOT gone), 0)::BIGINT AS good_lost,
          coalesce(sum(toxic) FILTER (WHERE fails_own AND NOT gone), 0)::BIGINT AS toxic_lost,
          coalesce(sum(n * (120 // greatest(length(bad), 1))) FILTER (WHERE fails_own), 0)::BIGINT AS shapley
        FROM walked GROUP BY ALL""",
    "op13_source_divergence": r"""
        WITH docs AS (
          SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
            regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
        said AS (SELECT doc, lang, source, unnest(terms) AS term FROM docs),
        kept AS (SELECT lang, term, count(*) AS n FROM said GROUP BY ALL HAVING count(DISTINCT doc) >= 3),
        here AS (SELECT lang, source, term, count(*) AS n FROM said SEMI JOIN kept USING (lang, term) GROUP BY ALL),
        grp AS (SELECT DISTINCT lang, source FROM docs),
        every AS (
          SELECT lang, source, term, coalesce(h.n, 0) AS n, k.n AS n_lang
          FROM grp JOIN kept k USING (lang) LEFT JOIN here h USING (lang, source, term)),
        p AS MATERIALIZED (
          SELECT lang, source, term, n,
            1 + (1000000000::HUGEINT * (n + 1)) // (sum(n) OVER g + count(*) OVER g) AS p,
            1 + (1000000000::HUGEINT * (n_lang + 1)) // (sum(n_lang) OVER g + count(*) OVER g) AS q
          FROM every WINDOW g AS (PARTITION BY lang, source)),
        sums AS (
          SELECT lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
          FROM p a JOIN p b USING (lang, term) WHERE a.source <> b.source GROUP BY ALL),
        pair AS (
          SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
          FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
        term AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // q)::BIGINT AS value FROM p WHERE n > 0 AND p > q),
        ranked AS (
          SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
          FROM (FROM pair UNION ALL FROM term))
        SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200""",
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)


__all__ = ["queries", "oracle_sql"]
