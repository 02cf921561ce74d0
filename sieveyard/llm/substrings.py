"""Substring dedup: content-defined chunks by a gear rolling hash, deduplicated by digest."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import arrow_batches, row_type, written

#: Bytes that the rolling hash sees; a chunk is never shorter, so cuts depend on the chunk's own bytes alone.
WINDOW = 16
_GEAR = np.random.default_rng(11).integers(0, 2**32, 256, dtype=np.uint32)


def gear(data: np.ndarray) -> np.ndarray:
    """The gear hash h = 2h + G[byte] at every byte, over the last WINDOW bytes: bits from WINDOW - 1 down see no others.

    Doubling: the hash over 2k bytes is that over k bytes plus the one k bytes before, shifted by k.
    """
    h, k = _GEAR[data], 1
    while k < WINDOW:
        h[k:] += h[:-k] << np.uint32(k)
        k *= 2
    return h


def cuts(data: bytes, min_bytes: int, mask_bits: int, max_bytes: int) -> list[int]:
    """Ends of the chunks of a text's UTF-8 bytes, the last being the text's end; never inside a character.

    A chunk ends after the first byte at or beyond min_bytes where mask_bits bits of the hash are
    zero, or before max_bytes are exceeded. After an insertion, cuts fall at the same places again.
    """
    own = np.frombuffer(data, np.uint8)
    if not len(own):
        return []
    mask = np.uint32(((1 << mask_bits) - 1) << (WINDOW - mask_bits))
    whole = np.append((own[1:] & 0xC0) != 0x80, True)  # a character ends at this byte
    places = np.flatnonzero(((gear(own) & mask) == 0) & whole) + 1
    ends, start, size = [], 0, len(own)
    for at in places.tolist():
        while at - start > max_bytes:
            start = _back(own, start + max_bytes)
            ends.append(start)
        if at - start >= min_bytes:
            start = at
            ends.append(at)
    while size - start > max_bytes:
        start = _back(own, start + max_bytes)
        ends.append(start)
    if start < size:
        ends.append(size)
    return ends


def _back(own: np.ndarray, at: int) -> int:
    while own[at] & 0xC0 == 0x80:
        at -= 1
    return at


#: Digests that hold more than one in HOT_SHARE of all repeated chunks (so fewer than HOT_SHARE digests) are dealt to HOT_PARTS parts.
HOT_SHARE, HOT_PARTS = 4096, 64
_DIGEST = ["d0", "d1"]


def _cut_up(texts: list[str | None], sizes: tuple[int, int, int]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(place in texts, starts, ends, digests as two long columns) of each text that has chunks; offsets in code points."""
    for k, text in enumerate(texts):
        data = (text or "").encode("utf-8", "surrogatepass")
        own = cuts(data, *sizes)
        if own:
            digests = b"".join(blake2b(data[a:b], digest_size=16).digest() for a, b in zip([0, *own], own, strict=False))
            ends = np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)[np.array(own) - 1]
            yield k, np.append(0, ends[:-1]), ends, np.frombuffer(digests, "<i8").reshape(-1, 2)


def chunks(docs: DataFrame, id_col: str, text_col: str, *sizes: int) -> DataFrame:
    """(row, id, start, end, d0, d1): the chunks of every whole text, offsets in code points, the digest in two longs. No shuffle.

    sizes are min_bytes, mask_bits and max_bytes. row numbers the rows of docs, so that null and repeated ids take part.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                own = list(_cut_up(batch.column(2).to_pylist(), sizes))
                if own:
                    of = pa.array(np.concatenate([np.full(len(starts), k) for k, starts, _, _ in own]))
                    starts, ends, digests = (np.concatenate([x[i] for x in own]) for i in (1, 2, 3))
                    columns = [starts, ends, digests[:, 0].copy(), digests[:, 1].copy()]
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(of), batch.column(1).take(of), *(pa.array(c, pa.int64()) for c in columns)], names=["row", "id", "start", "end", "d0", "d1"])

    own = docs.select(F.monotonically_increasing_id().alias("__row"), F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    return own.mapInArrow(run, row_type(row="long", id=own.schema[1].dataType, start="long", end="long", d0="long", d1="long"))


def digest_counts(docs: DataFrame, text_col: str, *sizes: int) -> DataFrame:
    """(d0, d1, places) of the digests that have several places.

    Places are counted in each Arrow batch first, so a digest is shuffled once a batch, however common it is. (A
    hash table of all of a task's digests beside the Python workers would not fit an executor.)
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [x[3] for x in _cut_up(batch.column(0).to_pylist(), sizes)]
            if own:
                digests = np.concatenate(own)
                digests = digests[np.lexsort((digests[:, 1], digests[:, 0]))]
                first = np.flatnonzero(np.append(True, (digests[1:] != digests[:-1]).any(axis=1)))
                places = np.diff(np.append(first, len(digests)))
                yield pa.RecordBatch.from_arrays([pa.array(digests[first, 0]), pa.array(digests[first, 1]), pa.array(places, pa.int64())], names=["d0", "d1", "places"])

    counted = docs.select(F.col(text_col).alias("__text")).mapInArrow(run, row_type(d0="long", d1="long", places="long"))
    return counted.repartition(*_DIGEST).groupBy(*_DIGEST).agg(F.sum("places").alias("places")).filter("places > 1")


def _repeated(own: DataFrame, counts: DataFrame) -> DataFrame:
    """Chunks whose digest has several places, with the first one: by id (null last), row and start.

    The chunks meet the repeated digests in one shuffle, hot digests in HOT_PARTS parts; the first place is the least of
    the parts' least.
    """
    top = counts.agg(F.sum("places")).first()[0] or 0
    hot = counts.filter(F.col("places") * HOT_SHARE > top).select(*_DIGEST, F.lit(True).alias("hot"))  # fewer than HOT_SHARE
    dealt = own.join(F.broadcast(hot), _DIGEST, "left")
    dealt = dealt.select(*own.columns, F.when(F.col("hot"), F.pmod(F.xxhash64("row", "start"), F.lit(HOT_PARTS)).cast("int")).otherwise(0).alias("part"))

    def in_parts(rows: DataFrame, places: Column) -> DataFrame:
        last = F.when(places * HOT_SHARE > F.lit(top), HOT_PARTS - 1).otherwise(0)
        return rows.withColumn("part", F.explode(F.sequence(F.lit(0), last)))

    key = [*_DIGEST, "part"]
    found = dealt.join(in_parts(counts, F.col("places")), key)
    place = F.struct(F.col("id").isNull().alias("none"), "id", "row", "start")
    # Both readings of `found` take all columns (no end is negative), so that Spark shuffles the chunks once and reads them twice.
    first = found.groupBy(*key).agg(F.min(place).alias("first"), F.max("places").alias("places"), F.max("end").alias("top")).filter("top >= 0")
    first = first.groupBy(*_DIGEST).agg(F.min("first").alias("first"), F.max("places").alias("places"))
    return found.drop("places").join(in_parts(first, F.col("places")).drop("places"), key).drop("part")


def repeated_passages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_bytes: int = 24, mask_bits: int = 4, max_bytes: int = 128, min_chars: int = 100
) -> DataFrame:
    """Passages that repeat, across documents or inside one: a row for each document that has one.

    Returns id_col, n_spans, repeated_chars, removed_chars, spans (start:end by start, comma-joined,
    code points, end exclusive), removed (the spans that are not the passage's first place and
    may go), first_ids (the documents that hold the first places, the row itself left out).

    Chunks of a digest that has several places are repeated; those that touch make one span, and a
    span counts from min_chars. With chunks of about 40 bytes, a passage of 50 words holds several
    whole ones, wherever it stands. Digests are counted, and chunks shuffled, once; islands of chunks are found
    by running sums in each document.

    Null and empty texts have no chunks. Each row is a document of its own, so repeated rows and ids and null ids take
    part and are returned; a null id comes after all others when the first place is chosen. An empty table gives an empty result. Other
    columns are ignored, whatever their names.
    """
    sizes = (min_bytes, mask_bits, max_bytes)
    with arrow_batches(docs.sparkSession):
        counts = written(digest_counts(docs, text_col, *sizes), "substring-digests")
    rows = _repeated(chunks(docs, id_col, text_col, *sizes), counts)
    is_first = (F.col("first.row") == F.col("row")) & (F.col("first.start") == F.col("start"))
    rows = rows.select("row", "id", "start", "end", F.struct(F.col("first.row").alias("row"), F.col("first.id").alias("id")).alias("first"), is_first.alias("is_first"))
    order = W.partitionBy("row").orderBy("start", "end")
    rows = rows.withColumn("new", F.coalesce((F.col("start") > F.max("end").over(order.rowsBetween(W.unboundedPreceding, -1))).cast("int"), F.lit(1)))
    rows = rows.withColumn("island", F.sum("new").over(order.rowsBetween(W.unboundedPreceding, W.currentRow)))
    rows = rows.withColumn("first_run", F.sum(F.coalesce((F.col("is_first") != F.lag("is_first").over(order)).cast("int"), F.lit(0))).over(order.rowsBetween(W.unboundedPreceding, W.currentRow)))
    runs = rows.groupBy("row", "island", "first_run", "is_first").agg(F.first("id").alias("id"), F.min("start").alias("start"), F.max("end").alias("end"), F.collect_set("first").alias("firsts"))
    islands = runs.groupBy("row", "island").agg(
        F.first("id").alias("id"), F.min("start").alias("start"), F.max("end").alias("end"), F.flatten(F.collect_list("firsts")).alias("firsts"),
        F.collect_list(F.when(~F.col("is_first"), F.struct("start", "end"))).alias("removed"),
    ).filter(F.col("end") - F.col("start") >= min_chars)
    out = islands.groupBy("row").agg(
        F.first("id").alias("id"), F.count("*").alias("n_spans"), F.sum(F.col("end") - F.col("start")).alias("repeated_chars"),
        F.sort_array(F.collect_list(F.struct("start", "end"))).alias("all"), F.sort_array(F.flatten(F.collect_list("removed"))).alias("removed"), F.flatten(F.collect_list("firsts")).alias("firsts"),
    )
    removed_chars = F.aggregate("removed", F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"])
    others = F.filter("firsts", lambda x: (x["row"] != F.col("row")) & x["id"].isNotNull())
    return out.select(
        F.col("id").alias(id_col), "n_spans", "repeated_chars", removed_chars.alias("removed_chars"), listed("all").alias("spans"), listed("removed").alias("removed"),
        F.array_sort(F.array_distinct(F.transform(others, lambda x: x["id"]))).alias("first_ids"),
    )


def listed(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["start"], x["end"])), ",")


def remove_spans(text: Column, removed: Column) -> Column:
    """The text without spans given as start:end, comma-joined; a native expression that drops what repeated_passages found."""
    ends = F.transform(F.split(removed, ","), lambda s: F.split(s, ":"))
    kept = F.aggregate(
        F.filter(ends, lambda e: F.size(e) == 2),
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda a, e: F.struct(e[1].cast("int").alias("at"), F.concat(a["out"], F.substring(text, a["at"] + 1, F.greatest(e[0].cast("int") - a["at"], F.lit(0)))).alias("out")),
        lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text))),
    )
    return F.when(removed.isNull() | (removed == ""), text).otherwise(kept)
