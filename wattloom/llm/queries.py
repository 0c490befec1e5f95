"""Registered queries of this subpackage: thin digests of the operators' results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.llm import byte_bpe, vector_codes, whitening
from wattloom.llm.chat import link_tool_calls, string
from wattloom.llm.common import table
from wattloom.llm.decontaminate import decontaminate
from wattloom.llm.licenses import scan_licenses
from wattloom.llm.lines import line_dedup
from wattloom.llm.ngram_join import ngram_join
from wattloom.llm.oracle import ORACLE
from wattloom.llm.pieces import encode_samples
from wattloom.llm.pii import KINDS, find_pii
from wattloom.llm.quality import quality_rules
from wattloom.llm.substrings import substring_dedup
from wattloom.llm.urls import HOST, PATH, host_of, url_filter

#: Vocabulary file that every executor has; another path may be given to the operator.
PIECES = "/opt/tokenizers/piece_bpe_32k.model"
#: Rank file that the driver has; its bytes go with the job.
RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def op1_line_dedup(spark, sf_dir) -> DataFrame:
    kept = line_dedup(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", F.size(F.split("text", "\n", -1)).cast("long").alias("n_lines"), "n_lines_removed",
                       F.sha2("text", 256).alias("kept_sha256"))


def op2_license_scan(spark, sf_dir) -> DataFrame:
    """Documents laid out as the files of a few projects; every fiftieth is its directory's licence file."""
    d, i = table(spark, sf_dir, "documents"), F.col("doc_id")
    name = F.when(i % 50 == 0, F.lit("LICENSE")).otherwise(F.concat(i.cast("string"), F.lit(".txt")))
    path = F.concat_ws("/", F.col("source"), F.concat(F.lit("p"), F.floor(i / 1000)), F.concat(F.lit("m"), F.floor(i / 100) % 10), name)
    return scan_licenses(d.select("doc_id", path.alias("path"), "text")).withColumn("score", F.round("score", 6))


def op3_decontaminate(spark, sf_dir) -> DataFrame:
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op4_url_filter(spark, sf_dir) -> DataFrame:
    """Pages as captures of one year; the lists name hosts, parent domains and folders seen in them, on and off by date."""
    pages = table(spark, sf_dir, "pages")
    host, folder = host_of(F.col("url")), F.regexp_extract("url", PATH, 1)
    captures = pages.select(F.col("page_id").alias("capture_id"), "url",
                            F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") * 37 % 365).cast("int")).alias("fetched_at"))
    seen = pages.select(host.alias("host"), F.regexp_extract(folder, "^/([^/]+)/", 1).alias("top"), (F.col("page_id") % 20).alias("r")).where("host is not null and r < 9").distinct()
    names = seen.select("r", F.when(F.col("r") < 3, F.col("host")).when(F.col("r") < 6, F.regexp_extract("host", r"([^.]+\.[^.]+)$", 1))
                        .when(F.col("top") != "", F.concat("host", F.lit("/"), "top")).alias("pattern")).where("pattern <> ''").distinct()
    turn = F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("turn")
    entries = names.select("r", "pattern", turn).select(
        F.element_at(F.array(F.lit("spam"), F.lit("adult"), F.lit("malware")), F.col("r").cast("int") % 3 + 1).alias("list"), "pattern",
        F.date_add(F.lit("2023-12-01").cast("date"), (F.col("turn") * 97 + (F.char_length("pattern") * 31 + F.col("r") * 7) % 90).cast("int")).alias("listed_at"),
        (F.col("turn") != 1).alias("active"))
    return url_filter(captures, entries)


def op5_substring_dedup(spark, sf_dir) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents"), size=13).drop("removed")


def op6_quality_rules(spark, sf_dir) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("score")


def op7_pii(spark, sf_dir) -> DataFrame:
    found = find_pii(table(spark, sf_dir, "documents"))
    counts = [F.expr(f"cast(size(filter(base, s -> s.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in KINDS]
    written = lambda spans: f"array_join(transform({spans}, s -> concat(s.kind, ':', s.start, ':', s.stop)), ',')"
    place = "array_position(array('email', 'ip', 'card', 'phone'), s.kind) as place"
    ordered = f"array_sort(transform(concat(base, added), s -> struct({place}, s.start as start, s.stop as stop, s.kind as kind)))"
    return found.select("doc_id", *counts, F.expr(f"sha2({written('base')}, 256)").alias("base_sha256"), F.expr(written(ordered)).alias("spans"))


def op8_tool_calls(spark, sf_dir) -> DataFrame:
    """An assistant's turn as a call, the turn after it as its result; a call needs the conversation's calls 2 and 4 turns back."""
    t = table(spark, sf_dir, "conversations")
    ident = lambda turn: F.concat(F.lit("call-"), F.col("conv_id"), F.lit("-"), turn)
    n = F.char_length("text")
    tool = F.element_at(F.array(F.lit("search"), F.lit("lookup"), F.lit("compute"), F.lit("other")), (n % 4 + 1).cast("int"))
    head = string(F.col("text"))
    args = F.when(n % 4 == 0, F.create_map(F.lit("query"), head, F.lit("limit"), F.when(n % 3 == 0, F.lit('"many"')).otherwise((n % 9).cast("string")))) \
        .when(n % 4 == 1, F.create_map(F.lit("key"), head, F.lit("exact"), F.lit("true"))) \
        .when(n % 4 == 2, F.create_map(F.lit("expression"), head)).otherwise(F.create_map(F.lit("x"), F.lit("1")))
    none = F.lit(None)
    calls = t.where("role = 'assistant'").select(
        "conv_id", "turn", F.lit("call").alias("kind"), ident(F.col("turn")).alias("call_id"), tool.alias("name"), args.alias("arguments"),
        F.array(ident(F.col("turn") - 2), ident(F.col("turn") - 4)).alias("needs"), none.cast("string").alias("content"))
    results = t.where("role <> 'assistant' and turn > 0").select(
        "conv_id", "turn", F.lit("result").alias("kind"), ident(F.col("turn") - 1).alias("call_id"), none.cast("string").alias("name"),
        none.cast("map<string,string>").alias("arguments"), none.cast("array<string>").alias("needs"), F.col("text").alias("content"))
    return link_tool_calls(calls.union(results))


def op9_ngram_join(spark, sf_dir) -> DataFrame:
    return ngram_join(table(spark, sf_dir, "documents"), size=3, percent=90)


def op10_sampled_pieces(spark, sf_dir) -> DataFrame:
    out = encode_samples(table(spark, sf_dir, "documents"), PIECES, k=2)
    return out.select("doc_id", "sample", "n_pieces", F.round("log_prob", 6).alias("log_prob"),
                      F.round("log_inclusion", 6).alias("log_inclusion"), F.sha2("piece_ids", 256).alias("pieces_sha256"))


def op11_vector_codes(spark, sf_dir) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    books = vector_codes.fit_codebooks(vectors)
    return vector_codes.compress(vectors, books).select(
        "vec_id", F.lower(F.hex("code")).alias("code"), F.col("error").cast("long").alias("error"),
        F.col("label_error").cast("long").alias("label_error"), F.lit(vector_codes.digest(books)).alias("codebooks_sha256"))


def op12_byte_bpe(spark, sf_dir) -> DataFrame:
    coded = byte_bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), RANKS)
    return byte_bpe.decode(coded, RANKS).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op13_whitening(spark, sf_dir) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    fitted = whitening.fit(vectors)
    explained = F.lit(fitted.explained).cast("array<double>")
    return whitening.whiten(vectors, fitted).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(fitted.n).cast("long").alias("n"), F.expr("try_cast(deviation as bigint)").alias("deviation"),
        "whitened", F.get(explained, F.col("at")).alias("explained"), F.lit(fitted.identity_error).cast("double").alias("identity_error"))


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_license_scan": op2_license_scan,
    "op3_decontaminate": op3_decontaminate,
    "op4_url_filter": op4_url_filter,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_quality_rules": op6_quality_rules,
    "op7_pii": op7_pii,
    "op8_tool_calls": op8_tool_calls,
    "op9_ngram_join": op9_ngram_join,
    "op10_sampled_pieces": op10_sampled_pieces,
    "op11_vector_codes": op11_vector_codes,
    "op12_byte_bpe": op12_byte_bpe,
    "op13_whitening": op13_whitening,
}

__all__ = ["ORACLE", "QUERIES"]
