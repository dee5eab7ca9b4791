"""One query per text operator, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from ledgersift.llm import (
    collocations, exact_dedup, language_ranks, licence_rules, line_chunks, passage_chains, pfair_mix,
    phrase_index, quality, simhash_trie, suffix_repeats, url_lists, whitening)
from ledgersift.llm.common import read_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_suffix_dedup(spark, d):
    rows = suffix_repeats.remove_repeats(read_table(spark, d, "documents"))
    size = F.length("text").cast("bigint")
    return rows.select(
        F.col("id").alias("doc_id"), size.alias("n_bytes"),
        (size - F.length("kept")).alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"), "kept_sha256")


@query
def op2_passage_chains(spark, d):
    rows = passage_chains.repeated_passages(read_table(spark, d, "documents"))
    return rows.select(
        F.col("id").alias("doc_id"), F.col("o_id").alias("partner_id"), "start_word", "end_word",
        "partner_start", "partner_end", "equal_words")


@query
def op3_ordinal_quality(spark, d):
    docs = read_table(spark, d, "documents")
    model = quality.fit_quality(docs, quality.grades(read_table(spark, d, "labels")))
    return quality.score_quality(docs, model)


YEAR_START, DAY = 1_704_067_200, 86_400


def page_captures(pages: DataFrame) -> DataFrame:
    """Pages with a fetch time within one year, derived from their id."""
    at = F.lit(YEAR_START) + F.expr("(page_id * 104729) % 31536000")
    return pages.select("page_id", "url", at.alias("fetched_at"))


def page_lists(pages: DataFrame) -> DataFrame:
    """Dated list events on the domains, hosts and first folders of the pages, dealt by MD5."""
    host = url_lists.url_host(F.col("url"))
    folder = F.element_at(F.split(url_lists.url_path(F.col("url")), "/"), 2)
    seen = pages.select(host.alias("host"), folder.alias("folder")).filter("host <> ''").distinct()
    domain = F.regexp_extract("host", r"[^.]+\.[^.]+$", 0)
    values = (seen.select(F.lit("domain").alias("scope"), domain.alias("value"))
              .union(seen.select(F.lit("host"), F.col("host")))
              .union(seen.filter("folder <> ''").select(
                  F.lit("prefix"), F.concat_ws("/", "host", "folder"))).filter("value <> ''").distinct()
              .withColumns({"digit": F.substring(F.md5("value"), 1, 1),
                            "day": F.conv(F.substring(F.md5("value"), 2, 2), 16, 10).cast("bigint")}))

    def event(scope: str, digits: str, name: str, action: str, day: str, added: bool) -> DataFrame:
        return values.filter((F.col("scope") == scope) & F.col("digit").isin(list(digits))).select(
            F.lit(name).alias("list"), "scope", "value", F.lit(action).alias("action"),
            F.expr(f"{YEAR_START} + {DAY} * ({day})").alias("at"), F.lit(added).alias("added"))

    events = [event("domain", "012345", "domains", "block", "20", True),
              event("domain", "012", "domains", "block", "140", False),
              event("domain", "0", "domains", "block", "260", True),
              event("host", "0123", "hosts", "block", "day", True),
              event("host", "01", "hosts", "block", "day + 60", False),
              event("host", "ef", "trusted", "allow", "30", True),
              event("prefix", "01", "paths", "block", "50", True),
              event("prefix", "0", "paths", "block", "50 + day", False)]
    out = events[0]
    for e in events[1:]:
        out = out.unionByName(e)
    return out


@query
def op4_url_lists(spark, d):
    pages = read_table(spark, d, "pages")
    rows = url_lists.judge_urls(page_captures(pages), page_lists(pages))
    return rows.select(F.col("id").alias("page_id"), "url", "fetched_at", "action", "scope",
                       F.col("value").alias("entry"), F.col("list").alias("list_name"), "kept")


@query
def op5_phrase_decontamination(spark, d):
    rows = phrase_index.contamination(read_table(spark, d, "documents"),
                                      read_table(spark, d, "benchmark"))
    return rows.select(
        F.col("_id").alias("doc_id"), "n_words", F.size("hit").cast("bigint").alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("hit") > 0).alias("contaminated"))


@query
def op6_line_chunks(spark, d):
    rows = line_chunks.remove_repeated_chunks(read_table(spark, d, "documents"))
    return rows.select(F.col("id").alias("doc_id"), "n_lines", "n_removed",
                       F.sha2("kept", 256).alias("kept_sha256"))


@query
def op7_exact_dedup(spark, d):
    return exact_dedup.exact_dedup(read_table(spark, d, "documents"))


@query
def op8_licence_rules(spark, d):
    rows = licence_rules.scan_licences(read_table(spark, d, "documents"))
    return rows.select(F.col("id").alias("doc_id"), F.array_join("licences", ",").alias("licences"),
                       F.array_join("sentences", ",").alias("sentence_ids"),
                       F.array_join("unused", ",").alias("unused"))


@query
def op9_pfair_mixing(spark, d):
    mixed = pfair_mix.mix_sources(read_table(spark, d, "documents").select("doc_id", "source"))
    return mixed.select("doc_id", "source", "mix_block", "mix_slot", "mix_position")


@query
def op10_simhash_trie(spark, d):
    rows = simhash_trie.simhash_components(read_table(spark, d, "documents"))
    return rows.select(F.col("_id").alias("doc_id"), hex_print(F.col("_print")).alias("fingerprint"),
                       "component_id")


def hex_print(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def held_out() -> Column:
    """Every fifth document by the CRC of its id; a null id counts as the empty text."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return F.crc32(key.cast("binary")) % 5 == 0


@query
def op11_language_ranks(spark, d):
    docs = read_table(spark, d, "documents")
    profiles = language_ranks.learn_profiles(docs.filter(~held_out()))
    rows = language_ranks.identify(docs, profiles)
    return rows.withColumnRenamed("id", "doc_id").select("doc_id", held_out().alias("held_out"),
                                                         "lang_pred", "score")


@query
def op12_jacobi_whitening(spark, d):
    """One row per vector and component; a deviation that does not fit 64 bits is null."""
    vectors = read_table(spark, d, "embeddings")
    model, fit_list = whitening.fit_whitening(vectors)
    error = whitening.identity_error(model, fit_list)
    share = F.array(*[F.lit(float(v) / model.trace) for v in model.values[:whitening.COMPONENTS]])
    rows = whitening.whiten(vectors, model).select(
        F.col("id").alias("vec_id"), F.expr("try_cast(deviation AS bigint)").alias("deviation"),
        F.posexplode("whitened").alias("place", "whitened"))
    return rows.select(
        "vec_id", (F.col("place") + 1).alias("component"), F.lit(model.n).cast("bigint").alias("n"),
        "deviation", "whitened", F.get(share, F.col("place")).cast("double").alias("explained"),
        F.lit(error).alias("identity_error"))


@query
def op13_phrase_automata(spark, d):
    return collocations.collocations(read_table(spark, d, "documents"))


@query
def pipeline(spark, d):
    return corpus_pipeline.run(spark, d)
