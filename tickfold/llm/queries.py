"""The registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tickfold.llm.best_fit import pack_tokens
from tickfold.llm.chosen_path import near_duplicates
from tickfold.llm.common import table, utf8, words
from tickfold.llm.filter_audit import audit, failure_cells
from tickfold.llm.heavy_copies import exact_copies
from tickfold.llm.histogram_sort import histogram_sort
from tickfold.llm.multi_index import nearest
from tickfold.llm.periodic_runs import periodic_runs, planted, run_digest
from tickfold.llm.prefix_doubling import digest, repeats
from tickfold.llm.quality_rules import RULES, STOP_WORDS, quality_rules
from tickfold.llm.raking import form_topic, mix
from tickfold.llm.secret_scan import secret_spans, span_digest
from tickfold.llm.token_counts import Rollup, event
from tickfold.llm.token_files import encode, token_digest, write_tokens
from tickfold.session import shared_folder

TOKENIZER = "word_bpe_49k.json"
END_ID = 2
SHARDS = 40
#: Exponents that flatten the token shares of the values of a dimension.
POWERS = {"source": 0.8, "lang": 0.9, "topic": 0.9}
#: The tokens that a mixed sample keeps, as a share of all.
SAMPLE_SHARE = 0.75


def packed_documents(docs: DataFrame) -> DataFrame:
    return pack_tokens(encode(docs, public_tokenizers.path(TOKENIZER), END_ID))


def op1_multi_index(spark: SparkSession, d: str) -> DataFrame:
    return nearest(table(spark, d, "embeddings"), F.col("id") % 20 == 0, k=20)


def op2_token_files(spark: SparkSession, d: str) -> DataFrame:
    docs, path = table(spark, d, "documents"), shared_folder(spark, "tokens")
    files = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    write_tokens(docs, path, public_tokenizers.path(TOKENIZER), END_ID, files)
    return token_digest(spark, path)


def op3_chosen_path(spark: SparkSession, d: str) -> DataFrame:
    return near_duplicates(table(spark, d, "documents"), width=2, percent=80)


def op4_token_counts(spark: SparkSession, d: str) -> DataFrame:
    """Three batches and a repeated one: every document is counted by white space (version 1),
    those whose text has a character outside ASCII are revised to a count of letter runs
    (version 2), and every later copy of a text is deleted."""
    t = utf8(F.col("text"))
    docs = table(spark, d, "documents").select(
        "doc_id",
        "source",
        "lang",
        F.size(words(F.col("text"))).alias("v1"),
        F.size(F.regexp_extract_all(t, F.lit("\\p{L}+"), F.lit(0))).alias("v2"),
        t.rlike("[^\\x00-\\x7F]").alias("revised"),
        F.sha2(t, 256).alias("text_key"),
    )
    first = docs.groupBy("text_key").agg(F.min("doc_id").alias("first_id"))
    group = {"source": F.col("source"), "lang": F.col("lang")}
    one = group | {"version": F.lit("1"), "tokens": F.col("v1")}
    two = group | {"version": F.lit("2"), "tokens": F.col("v2")}
    now = {
        "source": F.col("source"),
        "lang": F.col("lang"),
        "version": F.when(F.col("revised"), "2").otherwise("1"),
        "tokens": F.when(F.col("revised"), F.col("v2")).otherwise(F.col("v1")),
    }
    rollup = Rollup(spark, shared_folder(spark, "rollup"))
    rollup.commit(1, docs.select(*event("insert", one, {})))
    revisions = docs.where("revised").select(*event("revise", two, one))
    rollup.commit(2, revisions)
    # By text and id, so that a frequent text is not one group.
    stays = first.select("text_key", F.col("first_id").alias("doc_id"))
    copies = docs.where("doc_id IS NOT NULL").join(stays, ["text_key", "doc_id"], "left_anti")
    rollup.commit(3, copies.select(*event("delete", {}, now)))
    rollup.commit(2, revisions)
    return rollup.totals()


def op5_histogram_sort(spark: SparkSession, d: str) -> DataFrame:
    placed = histogram_sort(table(spark, d, "documents"), SHARDS)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_quality_rules(spark: SparkSession, d: str) -> DataFrame:
    return quality_rules(table(spark, d, "documents"))


def op7_raking(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    counted = docs.select(
        "doc_id",
        "source",
        "lang",
        form_topic(F.col("text")).alias("topic"),
        F.size(words(F.col("text"))).alias("n_tokens"),
    )
    return mix(counted, POWERS, share=SAMPLE_SHARE)


def op8_secret_scan(spark: SparkSession, d: str) -> DataFrame:
    found = secret_spans(table(spark, d, "documents"))
    spans = F.col("found")
    base = F.filter(spans, lambda s: s["kind"] < 3)
    count = lambda k: F.size(F.filter(spans, lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(span_digest(base), 256).alias("base_sha256"),
        span_digest(spans).alias("spans"),
        count(3).alias("n_random"),
    )


def op9_best_fit(spark: SparkSession, d: str) -> DataFrame:
    """Token ids with an end id, packed into sequences of 512 to 8,192."""
    return packed_documents(table(spark, d, "documents"))


def op10_prefix_doubling(spark: SparkSession, d: str) -> DataFrame:
    return digest(repeats(table(spark, d, "documents")))


def op11_periodic_runs(spark: SparkSession, d: str) -> DataFrame:
    """Every tenth document, by a hash of its id, is made periodic from some word on."""
    text = planted(F.col("doc_id"), F.coalesce(F.col("text"), F.lit("")))
    return run_digest(periodic_runs(table(spark, d, "documents"), text=text))


def op12_heavy_copies(spark: SparkSession, d: str) -> DataFrame:
    return exact_copies(table(spark, d, "documents"))


def op13_filter_audit(spark: SparkSession, d: str) -> DataFrame:
    return audit(failure_cells(table(spark, d, "documents"), table(spark, d, "labels")))


_W = "regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')"

_OP4 = f"""WITH d AS (SELECT doc_id, source, lang, coalesce(text, '') AS t,
 len({_W}) AS v1, len(regexp_extract_all(coalesce(text, ''), '\\p{{L}}+')) AS v2,
 regexp_matches(coalesce(text, ''), '[^\\x00-\\x7F]') AS revised FROM documents),
 k AS (SELECT *, min(doc_id) OVER (PARTITION BY t) AS first_id FROM d)
 SELECT source, lang, CASE WHEN revised THEN '2' ELSE '1' END AS version,
 count(*) AS n_docs, CAST(sum(CASE WHEN revised THEN v2 ELSE v1 END) AS BIGINT) AS n_tokens
 FROM k WHERE doc_id = first_id GROUP BY ALL"""


def _rules_sql() -> str:
    tests = []
    for r in RULES:
        if r.low is not None:
            tests.append(f"{r.measure} * {r.scale} >= {r.base} * {r.low}")
        if r.high is not None:
            tests.append(f"{r.measure} * {r.scale} <= {r.base} * {r.high}")
    return " AND ".join(tests)


_STOP = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))
_OP6 = f"""WITH a AS (SELECT doc_id, coalesce(text, '') AS t, {_W} AS w,
 list_filter(string_split(coalesce(text, ''), chr(10)),
  lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM documents),
 p AS (SELECT doc_id, generate_subscripts(w, 1) AS i, w FROM a WHERE len(w) >= 8),
 q AS (SELECT doc_id, i, w[i:i+7] AS g FROM p WHERE i <= len(w) - 7),
 r AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM q),
 c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 8)) AS j FROM r WHERE n > 1),
 x AS (SELECT doc_id, count(*) AS n_repeat_words FROM c GROUP BY doc_id),
 m AS (SELECT a.doc_id, CAST(1 AS BIGINT) AS one, CAST(len(w) AS BIGINT) AS n_words,
 CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
 CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
 CAST(len(lines) AS BIGINT) AS n_lines,
 CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
 CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
 CAST(len(list_filter(w, lambda x: regexp_matches(x, '\\p{{L}}'))) AS BIGINT) AS n_alpha_words,
 CAST(len(list_filter(w, lambda x: lower(x) IN ({_STOP}))) AS BIGINT) AS n_stop_words,
 CAST(len(list_filter(w, lambda x: x LIKE '%!')) AS BIGINT) AS n_bang_words
 FROM a LEFT JOIN x USING (doc_id)),
 f AS (SELECT *, n_words < 20 OR n_repeat_words * 100 > n_words * 30 AS base_failed FROM m)
 SELECT * EXCLUDE (one), NOT base_failed AND {_rules_sql()} AS kept FROM f"""

_OP12 = """WITH h AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''),
 '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
 SELECT doc_id, min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
 count(*) OVER (PARTITION BY text_sha256) AS group_size,
 doc_id = min(doc_id) OVER (PARTITION BY text_sha256) AS kept, text_sha256 FROM h"""

_OP13 = f"""WITH w AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, {_W} AS w
 FROM documents),
 l AS (SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic
 FROM labels GROUP BY doc_id),
 m AS (SELECT part, CAST(len(w) < 100 AS INT) + 2 * CAST(100 * len(list_distinct(w)) < 80 * len(w) AS INT)
 + 4 * CAST(100 * len(regexp_extract_all(t, '[A-Z]')) > 10 * length(t) AS INT)
 + 8 * CAST(regexp_matches(t, '[#$%&*|]') AS INT)
 + 16 * CAST(doc_id > min(doc_id) OVER (PARTITION BY t) AS INT) AS mask,
 coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic FROM w LEFT JOIN l USING (doc_id)),
 c AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY 1, 2),
 f(x, b) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
 o AS (SELECT p.x || q.x || r.x || s.x || u.x AS filter_order, [p.b, q.b, r.b, s.b, u.b] AS bits
 FROM f p, f q, f r, f s, f u WHERE p.b + q.b + r.b + s.b + u.b = 31 AND p.b | q.b | r.b | s.b | u.b = 31),
 z AS (SELECT filter_order, CAST(step AS INT) AS step, bits[step] AS bit,
 CAST(coalesce(list_sum(bits[1:step - 1]), 0) AS INT) AS before FROM o, range(1, 6) t(step)),
 a AS (SELECT part, filter_order, step, bit,
 coalesce(sum(n) FILTER (mask & (before + bit) = 0), 0) AS kept,
 coalesce(sum(n) FILTER (mask & before = 0 AND mask & bit > 0), 0) AS removed,
 coalesce(sum(n) FILTER (mask & before > 0 AND mask & bit > 0), 0) AS redundant,
 coalesce(sum(n) FILTER (mask = bit), 0) AS unique_fails,
 coalesce(sum(good) FILTER (mask & before = 0 AND mask & bit > 0), 0) AS good_lost,
 coalesce(sum(toxic) FILTER (mask & before = 0 AND mask & bit > 0), 0) AS toxic_lost
 FROM c, z GROUP BY ALL)
 SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
 CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
 CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
 CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley FROM a"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_multi_index,
        op2_token_files,
        op3_chosen_path,
        op4_token_counts,
        op5_histogram_sort,
        op6_quality_rules,
        op7_raking,
        op8_secret_scan,
        op9_best_fit,
        op10_prefix_doubling,
        op11_periodic_runs,
        op12_heavy_copies,
        op13_filter_audit,
    )
}
ORACLES: dict[str, str] = {
    "op4_token_counts": _OP4,
    "op6_quality_rules": _OP6,
    "op12_heavy_copies": _OP12,
    "op13_filter_audit": _OP13,
}
