"""The operators of this package as queries over the benchmark tables, and their SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corridor_metrics.context import shared_dir
from corridor_metrics.llm import (
    byte_bpe, byte_cnn, exact_dedup, filter_audit, licences, ring, secrets, simhash, suffix_dedup, token_files, warc, word_runs, wu_manber,
)
from corridor_metrics.llm.common import ship, table

SHARDS = 40
END_ID = 1

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def wrap(fn: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return wrap


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A new folder as a URI below the one all executors share."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    return path if ":" in path.split("/")[0] else f"file://{path}"


@query("op1_token_files")
def token_files_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents, written to files and read back."""
    folder = fresh_folder(spark, "tokens")
    manifest = token_files.write_token_files(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), folder, END_ID
    )
    return token_files.read_token_files(manifest, folder).select("doc_id", "start", "n_tokens", "ids_crc32")


@query("op2_licence_scan")
def licence_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of all documents; every tenth stands for the licence file of its folder."""
    docs = table(spark, sf_dir, "documents")
    folder = F.concat_ws("/", "source", "lang", (F.col("doc_id") / 1000).cast("long"), ((F.col("doc_id") % 1000) / 100).cast("long"))
    path = (
        F.when(F.col("doc_id") % 1000 == 0, F.concat_ws("/", "source", "lang", F.lit("LICENSE")))
        .when(F.col("doc_id") % 10 == 0, F.concat_ws("/", folder, F.lit("LICENSE")))
        .otherwise(F.concat_ws("/", folder, F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))))
    )
    found = licences.scan_licences(docs.select("doc_id", "text", path.alias("path")))
    return found.withColumn("score", F.round("score", 6))


@query("op3_suffix_dedup")
def suffix_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of all documents that repeat a 100-byte string from before."""
    found = suffix_dedup.drop_repeats(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )


@query("op4_ring_shards")
def ring_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards whose row counts differ by at most one."""
    placed = ring.shard_rows(table(spark, sf_dir, "documents"), SHARDS)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "home"
    )


@query("op5_byte_bpe")
def bpe_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded and decoded."""
    return byte_bpe.bpe_round_trip(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    )


@query("op6_decontamination")
def decontamination_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents that lie in ten-word windows of benchmark items."""
    found = wu_manber.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return wu_manber.contamination_report(found)


@query(
    "op7_warc",
    """
    WITH p AS (
        SELECT page_id, coalesce(html, '') AS html FROM pages
    ), r AS (
        SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest,
               max(page_id) OVER (PARTITION BY html) AS top
        FROM p
    )
    SELECT page_id, payload_bytes, payload_digest,
           CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM top AND top IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM top THEN top END AS refers_to
    FROM r
    """,
)
def warc_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as whole-file gzip archives, normalised, and read by offset."""
    folder = fresh_folder(spark, "warc")
    captures = warc.capture(warc.mark_revisits(table(spark, sf_dir, "pages")), f"{folder}/captures")
    files = warc.normalise(captures, f"{folder}/archive")
    return warc.read_records(files, f"{folder}/archive").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query(
    "op8_exact_dedup",
    """
    WITH d AS (
        SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
    )
    SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
           doc_id IS NOT DISTINCT FROM max(doc_id) OVER g AND row_number() OVER (PARTITION BY t, doc_id) = 1 AS kept,
           sha256(t) AS text_sha256
    FROM d WINDOW g AS (PARTITION BY t)
    """,
)
def exact_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal documents."""
    return exact_dedup.duplicate_groups(table(spark, sf_dir, "documents"))


@query("op9_quality_cnn")
def quality_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents."""
    return byte_cnn.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op10_simhash")
def simhash_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and the components of close ones."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_print("print").alias("fingerprint"), "component_id")


def planted_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text) in which every tenth text, by the hash of its id, repeats one period from some word on."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    seed = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.when(seed % 10 == 0, F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), 1))
    n, g = F.size("words"), F.floor(seed / 10)
    rows = rows.withColumn("words", words).withColumn("first", F.when(n > 0, g % n).cast("int"))
    period = (F.floor((n - F.col("first")) / (3 + g % 8)) + 1).cast("int")
    tail = F.slice("words", F.col("first") + 1, F.col("period"))
    times = F.ceil((n - F.col("first")) / F.col("period")).cast("int")
    made = F.concat(F.slice("words", F.lit(1), F.col("first")), F.slice(F.flatten(F.array_repeat(tail, times)), F.lit(1), n - F.col("first")))
    text = F.when(F.col("first").isNotNull(), F.array_join(made, " ")).otherwise(F.col("text"))
    return rows.withColumn("period", F.when(n > 0, period)).select("doc_id", text.alias("text"))


@query("op11_word_runs")
def runs_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of all documents, with planted ones."""
    found = word_runs.find_runs(planted_runs(table(spark, sf_dir, "documents")))
    best = F.reduce("runs", F.get("runs", 0), lambda best, run: F.when(run.length * best.period > best.length * run.period, run).otherwise(best))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(F.col("best.length") * 1000 / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query("op12_secret_scan")
def secrets_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents."""
    found = secrets.scan_secrets(table(spark, sf_dir, "documents"))

    def of(*kinds):
        return F.filter("spans", lambda s: s.kind.isin(*kinds))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")

    return found.select(
        "doc_id", *[F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in secrets.PLAIN],
        F.sha2(joined(of(*secrets.PLAIN)), 256).alias("base_sha256"), joined("spans").alias("spans"),
    )


@query(
    "op13_filter_audit",
    r"""
    WITH texts AS (
        SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents
    ), worded AS (
        SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM texts
    ), failing AS (
        SELECT doc_id, part,
               CASE WHEN len(w) < 100 THEN 1 ELSE 0 END
               + CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 2 ELSE 0 END
               + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 4 ELSE 0 END
               + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
               + CASE WHEN coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) THEN 16 ELSE 0 END AS mask
        FROM worded
    ), marks AS (
        SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
        FROM labels GROUP BY doc_id
    ), cells AS (
        SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
        FROM failing LEFT JOIN marks USING (doc_id) GROUP BY part, mask
    ), letters AS (
        SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(letter, bit)
    ), orders AS (
        SELECT [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits, a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order
        FROM letters a, letters b, letters c, letters d, letters e
        WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND len(list_distinct([a.bit, b.bit, c.bit, d.bit, e.bit])) = 5
    ), steps AS (
        SELECT filter_order, step, bits[step] AS bit, CAST(coalesce(list_sum(bits[1:step - 1]), 0) AS INTEGER) AS before
        FROM orders, (SELECT CAST(unnest(range(1, 6)) AS INTEGER) AS step)
    ), counted AS (
        SELECT part, filter_order, step, bit,
               sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END) AS kept,
               sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN n ELSE 0 END) AS removed,
               sum(CASE WHEN mask & bit <> 0 AND mask & before <> 0 THEN n ELSE 0 END) AS redundant,
               sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
               sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN good ELSE 0 END) AS good_lost,
               sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN toxic ELSE 0 END) AS toxic_lost
        FROM cells, steps GROUP BY part, filter_order, step, bit
    )
    SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
           CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
           CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
    FROM counted
    """,
)
def audit_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters do to all documents, in every order."""
    return filter_audit.audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def load() -> tuple[dict[str, Callable[[SparkSession, str], DataFrame]], dict[str, str]]:
    """All queries and statements, with the pipeline at the top of the repository."""
    import corpus_pipeline

    extra = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return {**QUERIES, "pipeline": corpus_pipeline.run}, {**ORACLES, **extra}
