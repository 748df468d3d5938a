"""Registered queries of the operators: thin readings of the operators' results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, chat, decontaminate, difference_cover, language_id, pii, quality, secret_scan, simhash, structure, suffix_array,
               url_filter, whitening)
from .storage import cut, moderate_batches


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    moderate_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learnt from those not held out."""
    docs = _table(spark, sf_dir, "documents")
    fold = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(3))
    docs = docs.withColumn("held_out", fold == 1)
    model = language_id.fit(docs.where(~F.col("held_out")).select("text", "lang"))
    return language_id.identify(model, docs.select("doc_id", "held_out", "text")).select("doc_id", "held_out", "found.*")


def tokenizer() -> tuple[list[bytes], str]:
    """Ranks and pattern of the public multilingual byte-level vocabulary."""
    import public_tokenizers

    return bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), public_tokenizers.PATTERN


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count and digests of the ids and of the decoded bytes of every document."""
    docs = _table(spark, sf_dir, "documents")
    return docs.select("doc_id", bpe.encode(F.col("text"), *tokenizer()).alias("found")) \
        .select("doc_id", "found.n_tokens", "found.ids_sha256", "found.decoded_sha256")


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The maximal conversations, rendered."""
    return chat.format_chats(_table(spark, sf_dir, "conversations")).withColumnRenamed("id", "conv_id")


def op4_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every run of 50 words or more of a document that another document has, too."""
    found = suffix_array.repeated_spans(_table(spark, sf_dir, "documents"), words=50)
    return found.select(F.col("id").alias("doc_id"), "first_word", "end_word",
                        (F.col("end_word") - F.col("first_word")).alias("n_words"), F.col("other").alias("other_doc_id"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: counts and digest of the base spans, and all spans."""
    found = pii.find(_table(spark, sf_dir, "documents"))
    order = F.array(*(F.lit(k) for k in pii.KINDS))
    every = F.array_sort(F.concat("spans", "added"), lambda a, b: F.when(a["start"] != b["start"], a["start"] - b["start"])
                         .otherwise(F.array_position(order, a["kind"]) - F.array_position(order, b["kind"])).cast("int"))
    return found.withColumn("every", every).select(
        F.col("id").alias("doc_id"), *(_count_kind("spans", k) for k in pii.KINDS[:4]),
        F.sha2(_joined("spans"), 256).alias("base_sha256"), _joined("every").alias("spans"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document: 4-word shingles, 4 differing bits."""
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle=4, distance=4)
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        F.col("component").alias("component_id"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item that it contains to 0.8 or more, in 5-word shingles."""
    found = decontaminate.contained_items(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "n_shared", "n_shingles", "containment")


def _joined(spans: str) -> Column:
    return F.array_join(F.transform(F.col(spans), lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def _count_kind(spans: str, kind: str) -> Column:
    return F.size(F.filter(F.col(spans), lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: counts and digest of the base spans, and all spans."""
    docs = _table(spark, sf_dir, "documents")
    found = docs.select("doc_id", secret_scan.scan(F.col("text")).alias("found"))
    return found.select("doc_id", *(_count_kind("found.spans", k) for k in ("assign", "access", "hex")),
                        "found.base_sha256", _joined("found.spans").alias("spans"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base statistics of every document, and the verdict of rules and n-gram ratio; trusted: quality 1."""
    docs, trusted = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels").where("quality = 1")
    ratio = quality.fit(docs, trusted)
    found = docs.select("doc_id", quality.measure(F.col("text"), ratio, F.col("doc_id")).alias("x")).select("doc_id", "x.*")
    found = cut(found, "quality")  # texts are measured once, for the threshold and for the verdicts
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return found.withColumn("base_failed", failed) \
        .withColumn("kept", ~F.col("base_failed") & (F.col("score") >= quality.threshold(found, trusted))).drop("unseen")


def op10_difference_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 50-word windows that start in a document with a smaller id, too."""
    found = difference_cover.remove_repeats(_table(spark, sf_dir, "documents"), words=50, keep=False)
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_removed", "kept_sha256")


#: (host, path, verdict) of the rules that the contract of op11 fixes.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page's url."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(pages, url_filter.rule_table(spark, URL_RULES)).select("page_id", "found.*")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First four whitened values of every embedding."""
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return whitening.whiten(vectors, whitening.fit(vectors)).select("vec_id", "found.*")


def op13_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults of every damaged conversation, its cheapest edits and the digest of what they give."""
    damaged, here = structure.damage(_table(spark, sf_dir, "conversations"))
    return structure.repair(damaged, present=F.col(here)).withColumnRenamed("id", "conv_id").drop("repaired")


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_chat_format": op3_chat_format,
    "op4_suffix_array": op4_suffix_array,
    "op5_pii": op5_pii,
    "op6_simhash": op6_simhash,
    "op7_decontaminate": op7_decontaminate,
    "op8_secret_scan": op8_secret_scan,
    "op9_quality_rules": op9_quality_rules,
    "op10_difference_cover": op10_difference_cover,
    "op11_url_filter": op11_url_filter,
    "op12_whitening": op12_whitening,
    "op13_structure_repair": op13_structure_repair,
}

#: DuckDB SQL of the queries that SQL can express.
ORACLE_SQL: dict[str, str] = {
    "op3_chat_format": """
        with turns as (
            select distinct conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text
            from conversations where conv_id is not null),
        placed as (
            select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as pos,
                   count(*) over (partition by conv_id) as n
            from turns),
        upto as (
            select conv_id, pos, n, list(struct_pack(role := role, text := text)) over (partition by conv_id order by pos) as so_far
            from placed),
        whole as (select min(conv_id) as conv_id, n, so_far from upto where pos = n group by n, so_far),
        kept as (
            select conv_id from whole w
            where not exists (select 1 from upto u where u.pos = w.n and u.n > u.pos and u.so_far = w.so_far))
        select conv_id, count(*) as n_turns,
               string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '' order by pos) as chat
        from placed semi join kept using (conv_id) group by conv_id""",
    "op7_decontaminate": r"""
        with items as (
            select item_id, w, least(5, len(w)) as k from (
                select item_id, regexp_extract_all(lower(text), '[a-z0-9\x{80}-\x{10FFFF}]+') as w from benchmark where text is not null)
            where len(w) > 0),
        wanted as (
            select distinct item_id, k, array_to_string(list_slice(w, i, i + k - 1), ' ') as shingle
            from (select *, unnest(range(1, len(w) - k + 2)) as i from items)),
        docs as (
            select doc_id, regexp_extract_all(lower(text), '[a-z0-9\x{80}-\x{10FFFF}]+') as w from documents where text is not null),
        found as (
            select distinct doc_id, k, array_to_string(list_slice(w, i, i + k - 1), ' ') as shingle
            from (select doc_id, w, k, unnest(range(1, len(w) - k + 2)) as i from docs, (select distinct k from items) where len(w) >= k)),
        totals as (select item_id, count(*) as n_shingles from wanted group by item_id)
        select doc_id, item_id, count(*) as n_shared, any_value(n_shingles) as n_shingles, count(*) / any_value(n_shingles) as containment
        from found join wanted using (k, shingle) join totals using (item_id)
        group by doc_id, item_id having count(*) >= 0.8 * any_value(n_shingles)""",
    "op10_difference_cover": r"""
        with docs as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
        windows as (
            select doc_id, i, array_to_string(list_slice(w, i, i + 49), ' ') as words
            from (select doc_id, w, unnest(range(1, len(w) - 48)) as i from docs where len(w) >= 50)),
        least_id as (select words, min(doc_id) as least_id from windows group by words),
        gone as (
            select distinct doc_id, i + k as pos
            from windows join least_id using (words), (select unnest(range(50)) as k)
            where least_id < doc_id),
        placed as (select doc_id, unnest(w) as word, generate_subscripts(w, 1) as pos from docs),
        kept as (
            select doc_id, string_agg(word, ' ' order by pos) as kept, count(*) as n_kept
            from placed anti join gone using (doc_id, pos) group by doc_id)
        select d.doc_id, len(w) as n_words, len(w) - coalesce(n_kept, 0) as n_removed, sha256(coalesce(kept, '')) as kept_sha256
        from docs d left join kept k on d.doc_id = k.doc_id""",
    "op11_url_filter": r"""
        with parts as (
            select page_id,
                   translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
                   regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) as path
            from pages),
        ruled as (
            select *, case
                when (host = 'example.net' or suffix(host, '.example.net')) and prefix(path, '/en/') then 'example.net/en/'
                when (host = 'example.com' or suffix(host, '.example.com')) and prefix(path, '/de/') then 'example.com/de/'
                when (host = 'org' or suffix(host, '.org')) and prefix(path, '/fr/') then 'org/fr/'
                when (host = 'net' or suffix(host, '.net')) and prefix(path, '/') then 'net/' end as rule
            from parts)
        select page_id, host, path, rule, case when rule in ('net/', 'example.com/de/') then 'block' else 'allow' end as verdict
        from ruled""",
}
