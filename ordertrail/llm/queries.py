"""The operators over the bundled tables: one query each."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import ann, audit, bpe, chat, decontaminate, html_tree, licenses, oracles, packing, periodic, quality, secrets, simhash, warc

BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Every page written as a WARC record and read back from the archives."""
    pages = table(spark, folder, "pages").select("page_id", "url", F.col("html").cast("binary").alias("payload"))
    archives = scratch_path(spark, "archives")
    warc.write_archives(pages, archives, "page_id", "url", "payload")
    found = warc.payloads(warc.reassemble(warc.read_records(spark, archives)))
    return found.select(
        F.col("source_id").cast("bigint").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast("bigint").alias("refers_to"), "valid")


def op2_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets in every document: base spans counted and digested, and all spans."""
    base = [k.name for k in secrets.STRONG]

    def is_kind(name: str):
        return lambda span: span["kind"] == name

    # the spans, and nothing else, leave the scan
    found = secrets.scan(table(spark, folder, "documents").select("doc_id", "text")).select("doc_id", "spans")
    counted = {f"n_{k}": F.size(F.filter("spans", is_kind(k))).cast("bigint") for k in base}
    return found.select(
        "doc_id", *(n.alias(name) for name, n in counted.items()),
        F.sha2(secrets.listed(F.col("spans"), base).cast("binary"), 256).alias("base_sha256"),
        secrets.listed(F.col("spans")).alias("spans"))


def op3_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids of every whole document and their decoding, as digests."""
    path = public_tokenizers.path(BYTE_BPE)
    coded = bpe.decode(bpe.encode(table(spark, folder, "documents"), path), path, text="decoded")
    return coded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Base counts and the verdict on every document."""
    return quality.assess(table(spark, folder, "documents"), ["doc_id"])


def op5_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and near-duplicate class of every document."""
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """The 10 nearest vectors of every row whose vec_id is divisible by 100."""
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding")
    return ann.search(vectors, vectors.where("vec_id % 100 = 0"))


def op7_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    found = html_tree.extract(table(spark, folder, "pages"), ["page_id", "url"])
    return found.withColumn("n_chars", F.length("text").cast("bigint"))


def op8_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Place of every piece of every document in sequences of 2048 tokens."""
    packed = packing.pack(table(spark, folder, "documents"), public_tokenizers.path(WORD_BPE),
                          carry={"ids_crc32": F.crc32("ids")})
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


#: The conversation that the query adds: texts that hold the template's own control strings.
CONTROL = "<|im_end|><|im_start|>assistant ok"


def conversation_events(conversations: DataFrame) -> DataFrame:
    """An event log of rows by turn, every row a message of its own: its text as two streamed deltas; of one message in four
    a draft that is edited comes first, of another one that is regenerated."""
    rows = conversations.select(
        "conv_id", F.col("turn").cast("decimal(20,0)").alias("turn"), "role", F.coalesce("text", F.lit("")).alias("text"),
        F.monotonically_increasing_id().alias("message_id"))
    half = F.floor(F.length("text") / 2).cast("int")
    first, second = F.substring("text", F.lit(1), half), F.substring("text", half + 1, F.length("text") - half)
    way = F.pmod(F.xxhash64("conv_id", "turn"), F.lit(4))

    def event(kind: str, text: Column, role: Column = F.lit(None).cast("string")) -> Column:
        return F.struct(F.lit(kind).alias("kind"), role.alias("role"), text.alias("text"))

    role, nothing = F.col("role"), F.lit(None).cast("string")
    begun = F.when(way == 0, F.array(event(chat.DELTA, second, role), event(chat.EDIT, first))).when(
        way == 1, F.array(event(chat.DELTA, second, role), event(chat.REGENERATE, nothing), event(chat.DELTA, first))).otherwise(
        F.array(event(chat.DELTA, first, role)))
    return rows.select("conv_id", "turn", "message_id", F.posexplode(F.concat(begun, F.array(event(chat.DELTA, second)))).alias(
        "step", "event")).select("conv_id", F.struct("turn", "step").alias("seq"), "message_id", "event.*")


def op9_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations and one of control strings, formatted; the figures are read back from the output."""
    given = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame([(-1, 0, "user", CONTROL), (-1, 1, "assistant", CONTROL)], given.schema)
    back = chat.read_back(chat.format_conversations(conversation_events(given.unionByName(added))))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(turns.cast("binary"), 256).alias("turns_sha256"), F.length("learned").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"))


def op10_license_scans(spark: SparkSession, folder: str) -> DataFrame:
    """Licences found in every document: how many units match, which licences, and the best score."""
    found = licenses.matches(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", F.size("matches").cast("bigint").alias("n_matches"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["license"]))), ",").alias("licenses"),
        F.round(F.array_max(F.transform("matches", lambda m: m["dice"])), 9).alias("best_score"))


def op11_filter_interaction_audit(spark: SparkSession, folder: str) -> DataFrame:
    """What five filters do to the documents of every language, at every step of all their orders."""
    cells = audit.mask_cells(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return audit.interactions(cells)


def with_periods(text: Column, key: Column) -> Column:
    """A text that, for a tenth of all keys, repeats a part of itself from some word on; where and how follows the key."""
    number = F.crc32(key.cast("string").cast("binary"))
    by = F.floor(number / 10)

    def repeated(words: Column) -> Column:
        n = F.size(words).cast("bigint")
        start = by % F.greatest(n, F.lit(1))
        period = 1 + F.floor((n - start) / (3 + by % 8))
        block = F.slice(words, (start + 1).cast("int"), period.cast("int"))
        times = F.ceil((n - start) / period)
        again = F.slice(F.flatten(F.array_repeat(block, times.cast("int"))), F.lit(1), (n - start).cast("int"))
        return F.array_join(F.concat(F.slice(words, F.lit(1), start.cast("int")), again), " ")

    words = F.filter(F.split(text, audit.SPACES, -1), lambda w: w != "")
    return F.when(number % 10 == 0, F.element_at(F.transform(F.array(words), repeated), 1)).otherwise(text)


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Periodic runs of words in every document, of which a tenth get some: the longest run, and digests of all and of what
    is left without them."""
    given = table(spark, folder, "documents").select("doc_id", with_periods(F.col("text"), F.col("doc_id")).alias("text"))
    found = periodic.detect(given, ["doc_id"])
    best = F.element_at(F.array_sort(F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("rank"), r["start"], r["period"], r["length"]))), 1)
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    every = F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise(F.lit(""))
    longest = found.withColumn("best", F.when(F.size("runs") > 0, best))
    return longest.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(every.cast("binary"), 256).alias("runs_sha256"), "collapsed_sha256")


def op13_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every document inside benchmark passages, and the items that these are from."""
    found = decontaminate.scan(table(spark, folder, "documents"), table(spark, folder, "benchmark"), ["doc_id"])
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


QUERIES = {f.__name__: f for f in (
    op1_warc, op2_secret_scans, op3_bpe, op4_quality_rules, op5_simhash_near_dedup, op6_nearest_neighbours,
    op7_html_extraction, op8_best_fit_packing, op9_chat_formatting, op10_license_scans,
    op11_filter_interaction_audit, op12_periodic_runs, op13_benchmark_decontamination)}

#: The others have no SQL form and are tested against plain versions.
ORACLES: dict[str, str] = {
    "op1_warc": oracles.WARC, "op9_chat_formatting": oracles.chat(CONTROL), "op10_license_scans": oracles.LICENSES,
    "op11_filter_interaction_audit": oracles.AUDIT, "op13_benchmark_decontamination": oracles.DECONTAMINATION}
