"""The registered queries: each operator with its production parameters over its whole table."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ordertide.llm import (
    alignment, chat, decontaminate, gam, hamming, near_dedup, packing, ranked_search, shards, substrings, toxicity, transducer, warc,
)
from ordertide.llm.common import bounded, drop_tables, read_table

SHARD_BYTES = 2**20
WARC_RECORDS = 1000
NEIGHBOURS = 10
TOXIC_FROM, QUALITY_FROM = 0.3, 0.5
TOKENIZER, END_TOKEN = "word_bpe_49k.json", 1
BYTE_TOKENIZER, PIECE_TOKENIZER = "byte_bpe_50k.json", "piece_bpe_32k.model"
MOST_TOKENS, RANKED = 1024, 10
CONTROL_TEXT = "\\### Assistant: </turn> ok"


def chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts hold the template's control strings, formatted and read back."""
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL_TEXT).alias("text"))
    chats = chat.read_back(chat.format_chats(chat.chain_nodes(turns.unionByName(control))))
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return chats.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, "").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents that benchmark windows of ten words hit, and the items found."""
    found = decontaminate.contamination(
        read_table(spark, sf_dir, "documents"), "doc_id", "text", read_table(spark, sf_dir, "benchmark"), "item_id", "text")
    lengths = F.transform("spans", lambda x, i: F.when(i % 2 == 0, -x).otherwise(x).cast("long"))
    n_hit = F.aggregate(lengths, F.lit(0).cast("long"), lambda total, x: total + x)
    return found.select(
        F.col("id").alias("doc_id"), "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def id_share(column: str, parts: int) -> Column:
    """The part an id falls to, by the CRC-32 of its text."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % parts


def toxicity_model(docs: DataFrame, labels: DataFrame) -> toxicity.Model:
    """The toxicity classifier, learnt from three quarters of the labelled ids."""
    return toxicity.train(docs, labels, "doc_id", "text", "toxic", id_share("doc_id", 4) != 2)


def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of all documents."""
    docs = read_table(spark, sf_dir, "documents")
    model = toxicity_model(docs, read_table(spark, sf_dir, "labels"))
    found = toxicity.scored(docs, "doc_id", "text", model).withColumnRenamed("id", "doc_id")
    return found.select(
        "doc_id", F.coalesce(id_share("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"))


def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of all documents, learnt from two thirds of the labelled ids."""
    docs = read_table(spark, sf_dir, "documents")
    model = gam.train(docs, read_table(spark, sf_dir, "labels"), "doc_id", "text", "quality", id_share("doc_id", 3) != 1)
    found = gam.scored(docs, "doc_id", "text", model).withColumnRenamed("id", "doc_id")
    return found.select(
        "doc_id", F.coalesce(id_share("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= QUALITY_FROM).cast("int").alias("predicted"))


def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What all documents keep when words of windows seen in a smaller document are removed."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = substrings.with_spans(docs, "doc_id", "text", "spans").select("doc_id", F.col("text").cast("binary").alias("text"), "spans")
    return marked.mapInArrow(bounded(_kept_digests), "doc_id long, n_words long, n_removed long, kept_sha256 string")


def _kept_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text, spans) to how many words a text has and loses, and the digest of those that it keeps."""
    for batch in batches:
        rows = []
        for text, spans in zip(batch.column(1), batch.column(2)):
            kept, lost = substrings.kept_words(text.as_py(), spans.as_py())
            rows.append((len(kept) + lost, lost, hashlib.sha256(b" ".join(kept)).hexdigest()))
        kinds = (pa.int64(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *[pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]],
            names=["doc_id", "n_words", "n_removed", "kept_sha256"])


def minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate class of all documents."""
    found = near_dedup.classes(read_table(spark, sf_dir, "documents"), "doc_id", "text")
    return found.select(F.col("id").alias("doc_id"), F.col("class").alias("class_id"), "links")


def packed_documents(docs: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens."""
    import public_tokenizers

    path = tokenizer_path or public_tokenizers.path(TOKENIZER)
    return packing.pack(docs, "doc_id", "text", path, END_TOKEN).select(
        F.col("id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed."""
    return packed_documents(read_table(spark, sf_dir, "documents"))


def sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards of at most 1 MiB of text."""
    placed = shards.shards(read_table(spark, sf_dir, "documents"), "doc_id", "text", SHARD_BYTES)
    return placed.withColumnRenamed("key", "doc_id")


def warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as archive records, audited against a replica in which some records were damaged or lost."""
    text = lambda name: F.coalesce(F.col(name), F.lit(""))
    head = F.concat(
        F.lit("WARC/1.0\nWARC-Type: response\nWARC-Target-URI: "), text("url"), F.lit("\nContent-Length: "),
        F.octet_length(text("html")).cast("string"), F.lit("\n\n"))
    content = F.concat(head, text("html"), F.lit("\n\n"))
    fate = F.conv(F.substring(F.md5(F.col("page_id").cast("string").cast("binary")), 1, 8), 16, 10).cast("long") % 97
    damaged = F.when(F.col("fate") == 3, F.concat(F.lit("#"), F.substr("content", F.lit(2)))).when(
        F.col("fate") == 7, F.left("content", F.lit(20))).otherwise(F.col("content"))
    pages = read_table(spark, sf_dir, "pages").select("page_id", content.alias("content"), fate.alias("fate"))
    pages = pages.withColumn("damaged", damaged).select(
        "page_id", "fate", F.floor(F.col("page_id") / WARC_RECORDS).alias("nr"),
        F.octet_length("content").cast("long").alias("length"), warc.record_digest(F.col("content")).alias("digest"),
        F.octet_length("damaged").cast("long").alias("found_length"), warc.record_digest(F.col("damaged")).alias("found_digest"))
    before = Window.partitionBy("nr").orderBy("page_id").rowsBetween(Window.unboundedPreceding, -1)
    file = F.concat(F.lit("crawl-"), F.lpad(F.col("nr").cast("string"), 8, "0"), F.lit(".warc"))
    placed = pages.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0))).withColumn("file", file)
    replica = placed.where(~F.coalesce(F.col("fate") == 5, F.lit(False)))
    found = warc.audit(placed, replica.drop("length", "digest").withColumnsRenamed(
        {"found_length": "length", "found_digest": "digest"}))
    return found.fillna(0, ["expected_length", "found_length"])


def hamming_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest sign codes of every 20th vector among all vectors."""
    codes = read_table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), hamming.sign_code(F.col("embedding")).alias("code"))
    return hamming.top_k(codes, codes.where(F.col("id") % 20 == 0), NEIGHBOURS)


def lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten documents that rank highest for each benchmark item."""
    index = ranked_search.build_index(read_table(spark, sf_dir, "documents"), "doc_id", "text")
    found = ranked_search.search(index, read_table(spark, sf_dir, "benchmark"), "item_id", "text", RANKED)
    if index:
        drop_tables(spark, index.postings)
    return found.withColumnRenamed("id", "item_id")


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of all documents."""
    import public_tokenizers

    counts = transducer.token_counts(read_table(spark, sf_dir, "documents"), "doc_id", "text", public_tokenizers.path(BYTE_TOKENIZER))
    return counts.select(F.col("id").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > MOST_TOKENS).alias("over_limit"))


class GroupsDigest:
    """The SHA-256 of a text's groups, written as ``a1,a2|b1;a3|b2,b3``; empty without tokens."""

    def __init__(self) -> None:
        self.texts: list[str] = []

    def __call__(self, found: alignment.Aligned) -> str:
        if not len(found.a):
            return ""
        # Each id is written with what follows it: tokens of A and B alternate group by group.
        size = int(max(found.a.max(), found.b.max())) + 1
        if len(self.texts) < 3 * size:
            self.texts = [f"{i}{mark}" for mark in ",|;" for i in range(size)]
        width = len(self.texts) // 3
        in_a, in_b = found.sizes()
        marked_a, marked_b = found.a.copy(), found.b.copy()
        marked_a[found.a_cut - 1] += width
        marked_b[found.b_cut - 1] += 2 * width
        parts = np.empty(len(found.a) + len(found.b), np.int64)
        parts[np.arange(len(found.a)) + np.repeat(found.b_cut - in_b, in_a)] = marked_a
        parts[np.arange(len(found.b)) + np.repeat(found.a_cut, in_b)] = marked_b
        return hashlib.sha256("".join(map(self.texts.__getitem__, parts.tolist()))[:-1].encode()).hexdigest()


def cross_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the tokens of two tokenizers align in all documents."""
    import public_tokenizers

    paths = [public_tokenizers.path(name) for name in (BYTE_TOKENIZER, PIECE_TOKENIZER)]
    found = alignment.scored(read_table(spark, sf_dir, "documents"), "doc_id", "text", *paths, GroupsDigest())
    return found.select(
        F.col("id").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("description").alias("groups_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_formatting": chat_formatting,
    "op2_decontamination": decontamination,
    "op3_sharding": sharding,
    "op4_toxicity": toxicity_scores,
    "op5_warc_fixity": warc_fixity,
    "op6_substring_dedup": substring_dedup,
    "op7_minhash_near_dedup": minhash_near_dedup,
    "op8_quality": quality_scores,
    "op9_vector_packing": vector_packing,
    "op10_hamming_search": hamming_search,
    "op11_lexical_search": lexical_search,
    "op12_token_counts": token_counts,
    "op13_cross_alignment": cross_alignment,
}
