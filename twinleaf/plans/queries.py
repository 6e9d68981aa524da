"""Registered queries of the record pipeline over the test tables.

Records are the pages: id is the page's id, the section is made of the address
(scheme / domain / first path segment) and the name is the page's title.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinleaf.config import Config
from twinleaf.functions import ngrams, text
from twinleaf.functions.fuzzy import token_set
from twinleaf.functions.lexicon import PAGES, labels_of, marker_count, strip_labels
from twinleaf.operators import classify, exchange, features, groups, pairs, similarity
from twinleaf.plans.sql import LEMMAS, SQL
from twinleaf.sources import records as source
from twinleaf.sources.exchange import CATEGORIES, VERDICTS, parse_section_labels, parse_verdicts, read_lemmas, write_lemmas
from twinleaf.storage import cut, large, shared_dir

CONFIG = Config()
NEGATIVE = ["st"]


def _table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def records(spark: SparkSession, d: str) -> DataFrame:
    url = F.coalesce("url", F.lit(""))
    host = F.regexp_extract(url, "://([^/?#]*)", 1)
    section = F.concat_ws(" / ", F.regexp_extract(url, "^([a-z]+)://", 1), F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1), F.regexp_extract(url, "://[^/?#]*/([^/?#]*)", 1))
    pages = _table(spark, d, "pages").select(F.col("page_id").cast("string").alias("id"), section.alias("section"), F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("name"), F.col("page_id").alias("pos"))
    return source.clean_records(pages)


def parsed(spark: SparkSession, d: str) -> DataFrame:
    return classify.parse_records(records(spark, d), CONFIG)


def sections(spark: SparkSession, d: str) -> DataFrame:
    return classify.classify_sections(classify.section_profile(parsed(spark, d)), PAGES)


def final_sections(spark: SparkSession, d: str, rows: DataFrame | None = None) -> DataFrame:
    """The outside labels are those of the stand-in, for ambiguous sections of the domain example.net. rows: the table of parsed(), where it is there already."""
    found = sections(spark, d) if rows is None else cut(classify.classify_sections(classify.section_profile(rows), PAGES))
    sure, unsure = classify.route(found, CONFIG)
    return classify.merge_labels(sure, unsure, classify.rule_labels(unsure.where(F.contains("section_path", F.lit("example.net")))))


def feature_rows(spark: SparkSession, d: str) -> DataFrame:
    rows = cut(parsed(spark, d))  # else each of a dozen branches of the plan reads the pages
    return features.feature_table(rows, final_sections(spark, d, rows), PAGES)


def candidate_pairs(spark: SparkSession, d: str) -> DataFrame:
    return pairs.candidates(cut(feature_rows(spark, d)), CONFIG)


def merged(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """(verdicts, features): the stand-in arbiter answers two thirds of the pairs."""
    rows = cut(feature_rows(spark, d))
    found = cut(pairs.candidates(rows, CONFIG))
    given = exchange.rule_verdicts(found.where("(cast(a_id as bigint) + cast(b_id as bigint)) % 3 <> 0"), rows, NEGATIVE, CONFIG.lower)
    return cut(exchange.merge_verdicts(found, given)), rows


def by_section(candidates: DataFrame, rows: DataFrame) -> DataFrame:
    """An arbiter: pairs of unlike sections are of different types, every other of the rest of different functionality, what is left is uncertain."""
    sections = rows.select("id", "section")
    df = candidates.join(large(sections.select(F.col("id").alias("a_id"), F.col("section").alias("sa"))), "a_id").join(large(sections.select(F.col("id").alias("b_id"), F.col("section").alias("sb"))), "b_id")
    apart, even = F.col("sa") != F.col("sb"), (F.col("a_id").cast("bigint") + F.col("b_id").cast("bigint")) % 2 == 0
    return df.select("pair_id", F.when(apart, "different_transfer_type").when(even, "different_functionality").otherwise("uncertain").alias("verdict"), F.when(even, "by section").alias("reason"), F.lit(1).alias("batch_id"), F.lit(0).cast("bigint").alias("line_no"))


def judged(spark: SparkSession, d: str, verdict: str) -> DataFrame:
    rows = cut(feature_rows(spark, d), free=True)
    found = cut(pairs.candidates(rows, CONFIG), free=True)
    return groups.pair_table(exchange.merge_verdicts(found, by_section(found, rows)), rows, verdict)


def _shared(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/cut-{name}-{uuid.uuid4().hex}"


# ---- the queries


def flagship(spark: SparkSession, d: str) -> DataFrame:
    return pairs.in_order(candidate_pairs(spark, d))


def parse_records(spark: SparkSession, d: str) -> DataFrame:
    return parsed(spark, d).select("id", "section", F.array_join("section_segments", "|").alias("segments"), "name", text.secondary_key(F.col("section_segments")).alias("secondary_key"))


def section_profile(spark: SparkSession, d: str) -> DataFrame:
    return classify.section_profile(parsed(spark, d)).select("section", F.array_join("segments", "|").alias("segments"), F.col("count").alias("n"), F.array_join("sample_names", "|").alias("sample_names"))


def repeated_keys(spark: SparkSession, d: str) -> DataFrame:
    return source.duplicate_keys(source.require_columns(_table(spark, d, "orders"), ("o_orderkey", "o_custkey")), "o_custkey").withColumnRenamed("count", "n")


def normalize_documents(spark: SparkSession, d: str) -> DataFrame:
    df = text.with_lemmas(_table(spark, d, "documents").select("doc_id", "text"), "text", "lemmas", PAGES)
    return df.select("doc_id", F.size("lemmas").alias("n_lemmas"), text.short_hash(text.matching_text(F.col("lemmas"))).alias("text_hash"))


def lemma_lookup(spark: SparkSession, d: str) -> DataFrame:
    table = spark.createDataFrame(list(LEMMAS.items()), "token string, lemma string")
    df = _table(spark, d, "part").select(F.col("p_partkey").alias("id"), "p_name")
    return text.with_lemmas(df, "p_name", "lemmas", PAGES, text.Dictionary(table)).select("id", text.matching_text(F.col("lemmas")).alias("lemma_text"))


def label_extract(spark: SparkSession, d: str) -> DataFrame:
    df = text.with_lemmas(records(spark, d), "name", "lemmas", PAGES)
    joined = text.matching_text(F.col("lemmas"))
    return df.select("id", F.array_join(labels_of(joined, PAGES), ",").alias("labels"), marker_count(F.col("section"), PAGES).alias("n_markers"), text.matching_text(strip_labels(F.col("lemmas"), PAGES)).alias("stripped_name"))


def classify_sections(spark: SparkSession, d: str) -> DataFrame:
    return sections(spark, d).select("section_path", "category", F.array_join("transfer_types", ",").alias("types"), "feature_score", "confidence")


def route_sections(spark: SparkSession, d: str) -> DataFrame:
    sure, unsure = classify.route(sections(spark, d), CONFIG)
    return sure.select("section_path", F.lit("classified").alias("route")).unionByName(unsure.select("section_path", F.lit("ambiguous").alias("route")))


def merge_labels(spark: SparkSession, d: str) -> DataFrame:
    return final_sections(spark, d).select("section_path", "category", F.array_join("transfer_types", ",").alias("types"), "source", "reason")


def feature_table(spark: SparkSession, d: str) -> DataFrame:
    key = features.block_key(F.col("transfer_type_set"), F.col("feature_block_key"))
    return feature_rows(spark, d).select("id", "section_category", "name_lemma_text", F.array_join("transfer_type_set", ",").alias("types"), "feature_block_key", F.array_join(key, "|").alias("block_key"))


def char_grams(spark: SparkSession, d: str) -> DataFrame:
    return _table(spark, d, "part").select(F.explode(ngrams.char_grams(F.col("p_name"))).alias("gram")).groupBy("gram").agg(F.count("*").alias("n"))


def word_grams(spark: SparkSession, d: str) -> DataFrame:
    return records(spark, d).select(F.explode(ngrams.word_grams(F.col("name"))).alias("gram")).groupBy("gram").agg(F.count("*").alias("n"))


def _part_items(spark: SparkSession, d: str) -> DataFrame:
    return _table(spark, d, "part").select(F.array("p_brand").alias("block"), F.col("p_partkey").alias("id"), F.col("p_name").alias("text"))


def tfidf_weights(spark: SparkSession, d: str) -> DataFrame:
    w = similarity.weights(_part_items(spark, d), ngrams.word_grams(F.col("text")))
    return w.select(F.col("block")[0].alias("block"), "id", "term", F.round("w", 6).alias("w"))


def cosine_pairs_char(spark: SparkSession, d: str) -> DataFrame:
    items = pairs.items_of(cut(feature_rows(spark, d)))
    found = similarity.every_cosine(items, ngrams.char_grams(F.col("text")))
    return found.select("a_id", "b_id", (F.floor(F.col("sim") * 10000 + 0.5) / 10000).alias("sim"))  # compiled, as round() of a double is not


def cosine_pairs_word(spark: SparkSession, d: str) -> DataFrame:
    items = pairs.items_of(cut(feature_rows(spark, d)))
    return similarity.cosine_pairs(similarity.weights(items, ngrams.word_grams(F.col("text")))).select("a_id", "b_id", F.round("sim", 4).alias("sim"))


def token_set_ratios(spark: SparkSession, d: str) -> DataFrame:
    """Of titles that begin with the same word."""
    r = records(spark, d).select("id", "name", F.substring_index("name", " ", 1).alias("k"))
    a, b = r.select(F.col("id").alias("a_id"), F.col("name").alias("a"), "k"), r.select(F.col("id").alias("b_id"), F.col("name").alias("b"), "k")
    return a.join(b, "k").where("a_id < b_id").select("a_id", "b_id", F.round(token_set("a", "b"), 6).alias("ratio"))


def candidates(spark: SparkSession, d: str) -> DataFrame:
    return candidate_pairs(spark, d).withColumn("block_key", F.array_join("block_key", "|"))


def topk_union_ties(spark: SparkSession, d: str) -> DataFrame:
    items, grams = _part_items(spark, d), ngrams.word_grams(F.col("text"))
    parts = pairs.text_groups(items, CONFIG.top_k)
    alike = parts.where((F.col("n") > 1) & (F.size(grams) > 0)).select("block", F.col("id").alias("a_id"), F.col("id").alias("b_id"), F.lit(1.0).alias("score"))
    scored = similarity.cosine_pairs(similarity.weights(parts, grams), "score").unionByName(alike)
    return pairs.top_pairs_of_groups(scored, parts, items, CONFIG.top_k).select("a_id", "b_id", F.round("score", 4).alias("score"))


def batch_pairs(spark: SparkSession, d: str) -> DataFrame:
    rows = cut(feature_rows(spark, d))
    batched = exchange.batches(pairs.candidates(rows, CONFIG), CONFIG)
    return exchange.hydrated(batched, rows).select("batch_id", "pair_id", "tier", F.col("a.name").alias("a_name"), F.col("b.section").alias("b_section"), F.array_join("a.transfer_types", ",").alias("a_types"))


def batch_manifest(spark: SparkSession, d: str) -> DataFrame:
    return exchange.manifest(exchange.batches(candidate_pairs(spark, d), CONFIG)).withColumnRenamed("count", "n")


def verdict_parse(spark: SparkSession, d: str) -> DataFrame:
    """Verdict lines written out of the events: some malformed, some of an unknown verdict, many for one pair."""
    e = _table(spark, d, "events")
    word = F.element_at(F.array(*map(F.lit, [*VERDICTS, "maybe"])), (F.col("event_id") % 5 + 1).cast("int"))
    reason = F.when(F.col("event_id") % 23 == 0, "").otherwise(F.concat(F.lit(', "reason": "'), "event_type", F.lit('"')))
    good = F.concat(F.lit('{"pair_id": "p_'), "user_id", F.lit('", "verdict": "'), word, F.lit('"'), reason, F.lit("}"))
    every = lambda n: F.col("event_id") % n == 0
    line = F.when(every(7), "not json").when(every(11), "[1]").when(every(13), F.concat(good, F.lit(" xyz"))).when(every(17), F.concat(good, good)).when(every(19), F.translate(good, '"', "'")).otherwise(F.concat(F.lit("\u00a0"), good))
    lines = e.select(line.alias("value"), (F.col("event_id") % 3).cast("int").alias("batch_id"), F.col("event_id").alias("line_no"))
    return exchange.last_verdicts(parse_verdicts(lines).where(F.col("verdict").isin(VERDICTS))).select("pair_id", "verdict", "reason", "batch_id", "line_no")


def merge_verdicts(spark: SparkSession, d: str) -> DataFrame:
    return merged(spark, d)[0]


def pending_pairs(spark: SparkSession, d: str) -> DataFrame:
    verdicts = merged(spark, d)[0]
    return exchange.pending_pairs(verdicts.select("pair_id", "a_id", "b_id"), verdicts.where(F.col("reason") != exchange.NO_VERDICT))


def duplicate_groups(spark: SparkSession, d: str) -> DataFrame:
    found = groups.duplicate_groups(*merged(spark, d))
    shown = F.array_join(F.transform("transfer_type_sets", lambda x: F.concat(F.lit("{"), F.array_join(x, ","), F.lit("}"))), " ")
    return groups.in_order(found).select("number", "size", F.array_join("member_ids", ",").alias("member_ids"), shown.alias("types"), F.size("pair_edges").alias("n_edges"))


def report_summary(spark: SparkSession, d: str) -> DataFrame:
    verdicts, rows = merged(spark, d)
    return groups.summary(rows, verdicts, groups.duplicate_groups(verdicts, rows), final_sections(spark, d))


def uncertain_pairs(spark: SparkSession, d: str) -> DataFrame:
    return judged(spark, d, "uncertain")


def apart_pairs(spark: SparkSession, d: str) -> DataFrame:
    return judged(spark, d, "different_functionality")


def lookalike_pairs(spark: SparkSession, d: str) -> DataFrame:
    return judged(spark, d, "different_transfer_type")


def group_members(spark: SparkSession, d: str) -> DataFrame:
    verdicts, rows = merged(spark, d)
    return groups.member_table(groups.in_order(groups.duplicate_groups(verdicts, rows)), rows)


def group_evidence(spark: SparkSession, d: str) -> DataFrame:
    return groups.evidence_table(groups.in_order(groups.duplicate_groups(*merged(spark, d))))


def unsettled_sections(spark: SparkSession, d: str) -> DataFrame:
    return groups.unsettled_sections(final_sections(spark, d)).select("section_path", "category", "source")


def record_hash(spark: SparkSession, d: str) -> DataFrame:
    return _table(spark, d, "benchmark").select("item_id", text.short_hash(F.col("text")).alias("hash"))


def tsv_scan(spark: SparkSession, d: str) -> DataFrame:
    """Records written as TSV files and read again; names hold quotes, a tab and a line's end."""
    odd = F.concat("name", F.lit(' "'), "id", F.lit('"\t\n end '))
    path = _shared(spark, "tsv")
    records(spark, d).select("id", "section", odd.alias("name"), F.lit("more").alias("extra")).write.csv(path, sep="\t", header=True, quote='"', escape='"', quoteAll=True)
    return source.read_records(spark, path).select("id", "section", "name")


def json_round_trip(spark: SparkSession, d: str) -> DataFrame:
    path = _shared(spark, "json") + ".jsonl"
    source.write_table(_table(spark, d, "benchmark"), path)
    return source.read_table(spark, path).select("item_id", "text")


def lemma_table(spark: SparkSession, d: str) -> DataFrame:
    """The lemma table of the words of part names, written and read again."""
    known = spark.createDataFrame(list(LEMMAS.items()), "token string, lemma string")
    words = _table(spark, d, "part").select(F.explode(F.split("p_name", " ")).alias("token"))
    path = _shared(spark, "lemmas")
    write_lemmas(words.join(known, "token", "left").select("token", F.coalesce("lemma", "token").alias("lemma")), path)
    return read_lemmas(spark, path)


def section_labels(spark: SparkSession, d: str) -> DataFrame:
    """Labels of sections from JSON files of a hundred parts each, every other file a bare list: the last valid one of a section counts."""
    part = _table(spark, d, "part").select(F.col("p_partkey").alias("k"), F.floor(F.col("p_partkey") / 100).alias("file"), "p_type", "p_brand", "p_name")
    category = F.element_at(F.array(*map(F.lit, [*CATEGORIES, "else"])), (F.col("k") % 5 + 1).cast("int"))
    types = F.when(F.col("k") % 3 > 0, F.array(F.upper("p_name"), F.concat(F.lit(" "), "p_brand", F.lit("\t")), F.lit(" "), F.lower("p_name")))
    row = F.struct("k", F.struct(F.concat("file", F.lit(" / "), "p_type").alias("section_path"), category.alias("category"), types.alias("transfer_types"), F.col("p_name").alias("reason")).alias("e"))
    listed = part.groupBy("file").agg(F.transform(F.array_sort(F.collect_list(row)), lambda x: x["e"]).alias("sections"))
    value = F.when(F.col("file") % 2 == 0, F.to_json("sections")).otherwise(F.to_json(F.struct("sections")))
    found = classify.last_labels(parse_section_labels(listed.select(value.alias("value"))))
    return found.select("section_path", "category", F.array_join("transfer_types", ",").alias("types"), "reason", "pos")


def lexicon_digests(spark: SparkSession, d: str) -> DataFrame:
    return spark.createDataFrame([(PAGES.digest(), PAGES.stopwords_digest())], "labels string, stopwords string")


def empty_vocabulary(spark: SparkSession, d: str) -> DataFrame:
    """Blocks of texts without words: the word cosine of their pairs is 0."""
    items = _table(spark, d, "benchmark").select(F.array(F.col("item_id") % 4).cast("array<string>").alias("block"), F.col("item_id").alias("id"), F.expr("repeat('!', 1 + cast(item_id % 7 as int))").alias("text"))
    return pairs.cosines(items, CONFIG).select("a_id", "b_id", F.round("tfidf_char", 4).alias("tfidf_char"), "tfidf_word")


_ALL = [
    tsv_scan, json_round_trip, parse_records, section_profile, repeated_keys, normalize_documents, lemma_lookup, lemma_table, label_extract, classify_sections, route_sections, section_labels, lexicon_digests, merge_labels,
    feature_table, char_grams, word_grams, tfidf_weights, cosine_pairs_char, cosine_pairs_word, empty_vocabulary, token_set_ratios, candidates, topk_union_ties, batch_pairs, batch_manifest, verdict_parse, merge_verdicts,
    pending_pairs, duplicate_groups, group_members, group_evidence, report_summary, uncertain_pairs, apart_pairs, lookalike_pairs, unsettled_sections, record_hash,
]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in _ALL}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
