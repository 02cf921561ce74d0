"""The opN_ queries: each applies its operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .html_text import extract_main_text
from .language_model import held_out_scores
from .mixing import mix
from .ngram_join import jaccard_components
from .personal import KINDS, find_personal_data
from .quality import judge
from .simhash import edited_fingerprints
from .substrings import repeated_passages
from .tokenizer import encode_decode
from .url_filter import filter_urls


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with passages that repeat, across documents or inside one, and the spans to remove. Null and empty texts have no row."""
    return repeated_passages(table(spark, sf_dir, "documents"))


def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and spans of personal data of every document; a null text is empty. Each input row has a row."""
    found = find_personal_data(table(spark, sf_dir, "documents"))
    names = F.array(*[F.lit(k) for k in KINDS])

    def listed(spans: str) -> Column:
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"], x["end"])), ",")

    def count_of(kind: int) -> Column:  # a lambda of two parameters would get the element's index as its second
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")

    counts = [count_of(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(listed("base"), 256).alias("base_sha256"), listed("spans").alias("spans"))


def op3_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict on every page's url; a null url has an empty host and path and is allowed. Each input row has a row."""
    return filter_urls(table(spark, sf_dir, "pages"))


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents linked at a Jaccard likeness of 0.8 of their 5-word shingles. Each input row has a row."""
    return jaccard_components(table(spark, sf_dir, "documents"))


def op5_lm_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of every whole text by a model of those outside fold 2 of 7; a null text is empty. Each input row has a row."""
    return held_out_scores(table(spark, sf_dir, "documents"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and of its edited text, likenesses, and near classes; a null text is empty. Each input row has a row."""
    return edited_fingerprints(table(spark, sf_dir, "documents"))


def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page, empty if there is none or the page is null. Each input row has a row."""
    return extract_main_text(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text statistics, base rules and the learned list's verdict on every document; a null text has no words and fails. Each input row has a row."""
    out = judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return out.select("doc_id", *[F.col(f"stats.{n}") for n in names], "base_failed", "kept", "rule")


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document; a null text has none. Each input row has a row."""
    return mix(table(spark, sf_dir, "documents"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every whole text and the digest of what they decode to; a null text has none. Each input row has a row."""
    import public_tokenizers

    out = encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of corpus_pipeline.run()."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_substring_dedup, op2_personal_data, op3_url_templates, op4_ngram_jaccard, op5_lm_trie, op6_simhash,
        op7_main_text, op8_quality_rules, op9_source_mix, op10_byte_bpe, pipeline,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op4_ngram_jaccard": r"""
with recursive w as (
  select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as words
  from documents
), s as (
  select distinct doc_id, unnest(case when len(words) = 0 then [] when len(words) < 5 then [array_to_string(words, ' ')]
    else list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) end) as g
  from w
), n as (select doc_id, count(*) as n from s group by 1),
sets as (select d.doc_id, coalesce(n, 0) as n from documents d left join n using (doc_id)),
links as (
  select a.doc_id as a, b.doc_id as b
  from s a join s b on a.g = b.g and a.doc_id <> b.doc_id join n na on na.doc_id = a.doc_id join n nb on nb.doc_id = b.doc_id
  where 5 * na.n >= 4 * nb.n and 5 * nb.n >= 4 * na.n
  group by a.doc_id, b.doc_id, na.n, nb.n having 100 * count(*) >= 80 * (na.n + nb.n - count(*))
), reach as (
  select doc_id as a, doc_id as b from documents
  union
  select r.a, l.b from reach r join links l on r.b = l.a
)
select sets.doc_id, sets.n as n_shingles, min(r.b) as component_id
from sets join reach r on r.a = sets.doc_id group by sets.doc_id, sets.n
""",
}
