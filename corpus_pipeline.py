"""A training corpus from `documents`: quality rules, near duplicates, personal data, mixing, tokens."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveyard.llm.common import table, written
from sieveyard.llm.mixing import mix
from sieveyard.llm.ngram_join import jaccard_components
from sieveyard.llm.personal import redact
from sieveyard.llm.quality import judge
from sieveyard.llm.tokenizer import encode_decode
from sieveyard.sources.shared import ship_package


def row_hash(docs: DataFrame) -> Column:
    """A hash of all columns that can be hashed (maps cannot)."""
    return F.xxhash64(*[F.col(f"`{name}`") for name, kind in docs.dtypes if "map<" not in kind])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the learned list reject go; all others stay as they are.

    Null and empty texts have no words and go. Repeated rows stay or go alike. An empty table stays empty. Columns stay,
    whatever their names. Labels of documents that are not in docs do not count.
    """
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__doc"), "doc_id", "text")
    return judge(own, table(spark, sf_dir, "labels")).filter("kept").select("__doc.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by 5-word shingles at 0.8 stays: the one of smallest id.

    Rows that repeat id and text count as one document, and the one with the least hash of all columns stays. A null id is the smallest. Null and
    empty texts are linked with nothing, so they stay. An empty table stays empty. Columns stay, whatever their names.
    """
    own = docs.withColumn("__row", F.struct(F.col("doc_id"), F.xxhash64("text").alias("h")))
    groups = written(jaccard_components(own, "__row"), "pipeline-groups")
    gone = groups.filter("not __row <=> component_id").select("__row").distinct()
    twice = groups.filter("__row <=> component_id").groupBy("__row").count().filter("count > 1").select("__row")
    both = gone.unionByName(twice)
    once = own.join(both, own["__row"].eqNullSafe(both["__row"]), "left_anti")
    again = own.join(twice, own["__row"].eqNullSafe(twice["__row"]), "left_semi")
    least = again.groupBy("__row").agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in docs.columns]), row_hash(docs)).alias("__doc"))
    return once.select(*[F.col(f"`{c}`") for c in docs.columns]).unionByName(least.select("__doc.*"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span of personal data becomes its kind in brackets, and n_chars is counted anew; no document goes.

    Of overlapping spans, the first names all. Null texts stay null, texts without spans stay as they are, repeated rows
    change alike, an empty table stays empty. Other columns stay, whatever their names.
    """
    return redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, always whole.

    The mix takes words: a document in which a quota ends comes once more with a chance of its share of words taken, drawn from a
    hash of its row, so that sources meet their targets on the whole and reruns agree. A document that the mix leaves out goes, as do
    null texts and those without words. Rows that are alike in all columns share what is taken from them, each copy whole.
    Null sources are one source, the last. An empty table stays empty. Columns stay, whatever their names.
    """
    # Written tables take all fields as nullable; a key of the same type needs no cast, which would move the texts twice.
    own = docs.withColumn("__row", F.struct(F.col("doc_id"), F.nullif(row_hash(docs), F.lit(None).cast("long")).alias("h")))
    taken = mix(own, "__row").groupBy("__row").agg(F.sum("taken").alias("__taken"), F.max("size").alias("__size")).filter("__taken > 0")
    chance = F.pmod(F.xxhash64("__row", F.lit(23)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    more = (chance * F.col("__size") < F.col("__taken") % F.col("__size")).cast("long")
    copies = taken.select("__row", (F.expr("__taken div __size") + more).alias("__copies")).filter("__copies > 0")
    # Rows that are alike become one before anything is shuffled; so no key holds many rows.
    alike = own.groupBy("__row").agg(F.first(F.struct(*[F.col(f"`{c}`") for c in docs.columns])).alias("__doc"))
    rows = alike.join(copies, "__row")  # a struct is equal to its like, null fields included
    return rows.select("__doc", F.explode(F.sequence(F.lit(1).cast("long"), "__copies"))).select("__doc.*")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit) and the decoded text's SHA-256, which equals the text's.

    Null and empty texts have no tokens. Repeated rows keep a row each. An empty table gives an empty result. Other columns are left out.
    """
    import public_tokenizers

    out = encode_decode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return out.select("doc_id", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("PII", personal_data),
    ("mixing sources", mix_sources),
    ("byte-level BPE", tokens),
]

#: The learned list, the graph scores, the seeded hashes and the tokenizer have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written as Parquet and read again."""
    ship_package(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "pipeline-" + "-".join(name.split()))
    return docs
