"""Language-model scoring with an Elias-Fano n-gram trie, built and queried in shards."""

from __future__ import annotations

import math
import os
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import local_path, new_folder, released_shuffles
from .common import row_type, words
from .elias_fano import Sequence, encode, map_arrays, named, part, write_arrays

#: Hashes that stand for the end and the begin of a text; no word hashes to them but by chance of 2 ** -64.
END, BEGIN = np.uint64(0x9AE16A3B2F90404F), np.uint64(0xC3A5C85C97CB3127)
#: Bits of its word's hash in a child's number: in one context, two words share a count with a chance of 2 ** -40.
#: Sub-shards of one word's children, tokens worked on at once.
CHILD_BITS, FAN, TOKENS_AT_ONCE = 40, 8, 1 << 20
_CHILD_MASK = np.uint64((1 << CHILD_BITS) - 1)


@dataclass(frozen=True)
class Trie:
    """Where a trained model lies, and what its levels share. Level k holds the k-grams, level 1 the words."""

    folder: str
    shards: int
    tokens: int
    types: int
    discount: float
    order: int = 2

    def unigram(self, counts: np.ndarray) -> np.ndarray:
        return (counts + 1) / (self.tokens + self.types + 1)


def _token_hashes(text: str | None) -> np.ndarray:
    from xxhash import xxh3_64_intdigest

    own = words(text or "")
    out = np.empty(len(own) + 1, np.uint64)
    out[:-1] = np.fromiter(map(xxh3_64_intdigest, own), np.uint64, len(own))
    out[-1] = END
    return out


def _groups(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Rows with their tokens' hashes, cut where TOKENS_AT_ONCE are reached."""
    for batch in batches:
        at, own, n = 0, [], 0
        texts = batch.column(column)
        for i in range(batch.num_rows):
            own.append(_token_hashes(texts[i].as_py()))
            n += len(own[-1])
            if n >= TOKENS_AT_ONCE or i == batch.num_rows - 1:
                yield batch.slice(at, i + 1 - at), own
                at, own, n = i + 1, [], 0


def _contexts(tokens: list[np.ndarray], order: int) -> list[np.ndarray]:
    """For each token the hash of the 1, 2, ... order - 1 tokens before it; BEGIN stands before a text's first. One token's is its own."""
    own = np.concatenate(tokens)
    sizes = [len(t) for t in tokens]
    place = np.arange(len(own)) - np.repeat(np.cumsum([0, *sizes[:-1]]), sizes)
    out: list[np.ndarray] = []
    for j in range(1, order):
        last = np.full(len(own), BEGIN)
        last[j:] = own[:-j]
        last[place < j] = BEGIN
        out.append(_mixed(out[-1], last) if out else last)
    return out


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = (a ^ (a >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + b * np.uint64(0xC2B2AE3D27D4EB4F)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _child_shard(context: np.ndarray, own: np.ndarray, shards: int, level: int) -> np.ndarray:
    """A word's children lie in up to FAN shards, so that a hot word is not one task's; longer contexts stay whole."""
    if level > 2:
        return (context % np.uint64(shards)).astype(np.int64)
    fan = own >> np.uint64(53) & np.uint64(FAN - 1)
    return ((context % np.uint64(shards) + fan * np.uint64(shards // FAN + 1)) % np.uint64(shards)).astype(np.int64)


def _by_shard(shard: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(shard, kind="stable")
    edges = np.flatnonzero(np.diff(shard[order])) + 1
    for own in np.split(order, edges) if len(order) else []:
        yield int(shard[own[0]]), own


def _row(shard: int, keys: np.ndarray, runs: np.ndarray | None, children: np.ndarray | None, counts: np.ndarray) -> tuple:
    packed = lambda a: zlib.compress(a.astype("<u4").tobytes(), 1)
    return shard, keys.astype("<u8").tobytes(), None if runs is None else packed(runs), None if children is None else children.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : CHILD_BITS // 8].tobytes(), packed(counts)


_ROW = "shard int, keys binary, runs binary, children binary, counts binary"
_ARROW_ROW = pa.schema([("shard", pa.int32()), ("keys", pa.binary()), ("runs", pa.binary()), ("children", pa.binary()), ("counts", pa.binary())])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _ARROW_ROW, strict=True)], schema=_ARROW_ROW)


def _unpack(blob: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(blob), "<u4").astype(np.int64)


def _count_words(shards: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, tokens in _groups(batches, 0):
            keys, counts = np.unique(np.concatenate([*tokens, np.full(len(tokens), BEGIN)]), return_counts=True)
            rows = [_row(k, keys[i], None, None, counts[i]) for k, i in _by_shard((keys % np.uint64(shards)).astype(np.int64))]
            yield _batch(rows)

    return run


def _count_children(shards: int, level: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, tokens in _groups(batches, 0):
            context, own = _contexts(tokens, level)[-1], np.concatenate(tokens)
            first, counts = _distinct_pairs(context, own)[:2]
            context, own = context[first], own[first]
            rows = []
            for k, i in _by_shard(_child_shard(context, own, shards, level)):
                i = i[np.argsort(context[i], kind="stable")]
                keys, runs = np.unique(context[i], return_counts=True)
                rows.append(_row(k, keys, runs, own[i] & _CHILD_MASK, counts[i]))
            yield _batch(rows)

    return run


def _distinct_pairs(context: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    _, first, inverse, counts = np.unique(_mixed(context, own), return_index=True, return_inverse=True, return_counts=True)
    return first, counts, inverse


def _shards(batches: Iterator[pa.RecordBatch], merge: Callable) -> Iterator[tuple[int, object]]:
    """Rows sorted by shard, merged as they come: one shard at a time is in memory."""
    last, state = None, None
    for batch in batches:
        for i in range(batch.num_rows):
            row = [c[i].as_py() for c in batch.columns]
            if row[0] != last:
                if last is not None:
                    yield last, state
                last, state = row[0], None
            state = merge(state, row)
    if last is not None:
        yield last, state


def _merged(pieces: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """(keys..., counts) with counts summed over equal keys, in order of the keys."""
    columns = [np.concatenate(c) for c in zip(*pieces, strict=True)]
    order = np.lexsort(columns[-2::-1])
    columns = [c[order] for c in columns]
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns[:-1]])
    at = np.flatnonzero(new)
    return (*[c[at] for c in columns[:-1]], np.add.reduceat(columns[-1], at) if len(at) else columns[-1])


def _folding(read: Callable) -> Callable:
    """Fold pieces together whenever those that wait outweigh what is merged, so memory follows the distinct keys."""

    def merge(state, row):
        merged, waiting, n = state or (None, [], 0)
        piece = read(row)
        waiting.append(piece)
        n += len(piece[0])
        if n > max(1 << 20, len(merged[0]) if merged else 0):
            merged, waiting, n = _merged([merged, *waiting] if merged else waiting), [], 0
        return merged, waiting, n

    return merge


def _folded(state) -> tuple[np.ndarray, ...]:
    merged, waiting, _ = state
    return _merged([merged, *waiting] if merged else waiting)


def _read_words(row: list) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(row[1], "<u8"), _unpack(row[4])


def _read_pairs(row: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    raw = np.frombuffer(row[3], np.uint8).reshape(-1, CHILD_BITS // 8)
    children = np.zeros((len(raw), 8), np.uint8)
    children[:, : CHILD_BITS // 8] = raw
    return np.repeat(np.frombuffer(row[1], "<u8"), _unpack(row[2])), children.view("<u8").reshape(-1), _unpack(row[4])


class Words:
    """First level of a shard: word hashes, exact counts as differences of a monotone sequence, back-off weights."""

    def __init__(self, folder: str, shard: int) -> None:
        path = f"{folder}/words-{shard}"
        arrays = map_arrays(path) if os.path.exists(path) else {**named("keys", encode(np.empty(0), 64)), **named("sums", encode(np.zeros(1), 64))}
        self.keys, self.sums = Sequence(part("keys", arrays)), Sequence(part("sums", arrays))
        path = f"{folder}/weights-{shard}"
        self.weights = map_arrays(path) if os.path.exists(path) else None

    def counts(self, i: np.ndarray) -> np.ndarray:
        out = np.zeros(len(i), np.int64)
        known = np.flatnonzero(i >= 0)
        out[known] = (self.sums.get(i[known] + 1) - self.sums.get(i[known])).astype(np.int64)
        return out

    def back_off(self, i: np.ndarray) -> np.ndarray:
        out = np.ones(len(i))
        if self.weights is not None:
            known = np.flatnonzero(i >= 0)
            out[known] = self.weights["book"][self.weights["codes"][i[known]]]
        return out


class Children:
    """A level of a shard from the second on: contexts, and their children by number within their context, with quantised probabilities.

    A child's number is its context's rank, then its own bits. The high part of the sequence codes the
    ranks: these are the monotone pointers from contexts to ranges. The low part is searched inside a range.
    """

    def __init__(self, folder: str, shard: int, level: int) -> None:
        path = f"{folder}/children{level}-{shard}"
        self.empty = not os.path.exists(path)
        if not self.empty:
            self.arrays = map_arrays(path)
            self.contexts, self.children = Sequence(part("contexts", self.arrays)), Sequence(part("children", self.arrays))

    def probability(self, context: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Discounted probability of each child after its context, 0 where that pair is unknown, and the context's back-off weight, 1 where it is unknown (or kept with the words)."""
        out, weight = np.zeros(len(own)), np.ones(len(own))
        if self.empty:
            return out, weight
        contexts, of = np.unique(context, return_inverse=True)
        rank = self.contexts.find(contexts)
        first, end = np.zeros((2, len(contexts)), np.int64)
        known = np.flatnonzero(rank >= 0)
        first[known], end[known] = self.children.bucket(rank[known])
        place = self.children.search(first[of], end[of], own & _CHILD_MASK)
        hit = np.flatnonzero(place >= 0)
        out[hit] = self.arrays["book"][self.arrays["codes"][place[hit]]]
        if "weight.book" in self.arrays:
            seen = np.flatnonzero(rank[of] >= 0)
            weight[seen] = self.arrays["weight.book"][self.arrays["weight.codes"][rank[of][seen]]]
        return out, weight


@lru_cache(maxsize=4096)
def _words(folder: str, shard: int, weighted: bool) -> Words:
    return Words(folder, shard)


@lru_cache(maxsize=4096)
def _children(folder: str, shard: int, level: int) -> Children:
    return Children(folder, shard, level)


def quantised(p: np.ndarray) -> dict[str, np.ndarray]:
    """One byte for each probability: bins of like population in log space, each standing for its mean."""
    logs = np.log(p)
    distinct = np.unique(logs)
    edges = distinct if len(distinct) <= 256 else np.unique(np.quantile(logs, np.arange(256) / 256))
    codes = (np.searchsorted(edges, logs, side="right") - 1).astype(np.uint8)
    counts = np.maximum(np.bincount(codes, minlength=len(edges)), 1)
    return {"codes": codes, "book": np.exp(np.bincount(codes, weights=logs, minlength=len(edges)) / counts)}


def _lookup_words(folder: str, shards: int, keys: np.ndarray, weighted: bool) -> tuple[np.ndarray, np.ndarray]:
    """(counts, back-off weights) of word hashes."""
    counts, weights = np.zeros(len(keys), np.int64), np.ones(len(keys))
    for k, i in _by_shard((keys % np.uint64(shards)).astype(np.int64)):
        level = _words(folder, k, weighted)
        place = level.keys.find(keys[i])
        counts[i] = level.counts(place)
        if weighted:
            weights[i] = level.back_off(place)
    return counts, weights


def train(docs: DataFrame, text_col: str = "text", discount: float = 0.75, shard_bytes: int = 8 << 20, order: int = 2) -> Trie:
    """Train a trie of all n-grams up to `order` words on all rows of docs, in the shared folder.

    N-grams are counted in parts of each task, a level at a time, and shuffled as packed arrays to the
    shard of their context's hash, where they are merged and laid out. Shards grow in number with the input,
    so a shard's memory does not. Pairs of one word are dealt to several shards.
    p(w | h) = max(c(h w) - discount, 0) / c(h) + discount * (types after h) / c(h) * p(w | h without its first word), and p(w) is
    the add-one estimate. A context never seen gives way to the shorter one. No n-gram is pruned. Lost tasks rewrite their own files.
    """
    if order < 2:
        raise ValueError("order must be 2 or more")
    spark = docs.sparkSession
    own = docs.select(F.col(text_col).alias("__text"))
    size = int(str(own._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    shards = max(FAN, math.ceil(size / shard_bytes) if size < 1 << 60 else parts)  # Spark gives a huge size where it knows none
    folder = local_path(new_folder(spark, "trie"))  # the levels are memory-mapped
    os.makedirs(folder)

    def sorted_rows(rows: DataFrame) -> DataFrame:
        n = min(parts, shards)
        return rows.repartitionById(n, F.col("shard") % n).sortWithinPartitions("shard")

    def build_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, state in _shards(batches, _folding(_read_words)):
            keys, counts = _folded(state)
            sums = np.concatenate([[0], np.cumsum(counts)])
            write_arrays(f"{folder}/words-{shard}", {**named("keys", encode(keys, 64)), **named("sums", encode(sums, int(sums[-1]).bit_length()))})
            real = keys != BEGIN
            yield pa.RecordBatch.from_arrays([pa.array([int(counts[real].sum())], pa.int64()), pa.array([int(real.sum())], pa.int64())], names=["tokens", "types"])

    words_rows = sorted_rows(own.mapInArrow(_count_words(shards), _ROW))
    with released_shuffles(spark):
        total = words_rows.mapInArrow(build_words, "tokens long, types long").agg(F.sum("tokens").alias("tokens"), F.sum("types").alias("types")).first()

    def build_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, state in _shards(batches, _folding(_read_pairs)):
            before, own_words, counts = _folded(state)
            contexts, width = np.unique(before, return_counts=True)
            context_counts = _lookup_words(folder, shards, contexts, False)[0]
            rank = np.repeat(np.arange(len(contexts), dtype=np.uint64), width)
            p = (counts - discount) / np.repeat(np.maximum(context_counts, 1), width)
            bits = CHILD_BITS + max(len(contexts), 1).bit_length()
            levels = {**named("contexts", encode(contexts, 64)), **named("children", encode(rank << np.uint64(CHILD_BITS) | own_words, bits, CHILD_BITS))}
            write_arrays(f"{folder}/children2-{shard}", levels | quantised(p))
            rows = [_row(k, contexts[i], None, None, width[i]) for k, i in _by_shard((contexts % np.uint64(shards)).astype(np.int64))]
            yield _batch(rows)

    def build_weights(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, state in _shards(batches, _folding(_read_words)):
            keys, types = _folded(state)
            level = _words(folder, shard, False)
            place = level.keys.find(keys)
            weight = np.ones(level.keys.n)
            weight[place] = discount * types / np.maximum(level.counts(place), 1)
            write_arrays(f"{folder}/weights-{shard}", quantised(weight))
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32())], names=["shard"])

    def build_level(level: int) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for shard, state in _shards(batches, _folding(_read_pairs)):
                context, own_words, counts = _folded(state)
                contexts, first, width = np.unique(context, return_index=True, return_counts=True)
                total = np.add.reduceat(counts, first)
                rank = np.repeat(np.arange(len(contexts), dtype=np.uint64), width)
                bits = CHILD_BITS + max(len(contexts), 1).bit_length()
                levels = {**named("contexts", encode(contexts, 64)), **named("children", encode(rank << np.uint64(CHILD_BITS) | own_words, bits, CHILD_BITS))}
                write_arrays(f"{folder}/children{level}-{shard}", levels | quantised((counts - discount) / np.repeat(total, width)) | named("weight", quantised(discount * width / total)))
                yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32())], names=["shard"])

        return run

    pair_rows = sorted_rows(own.mapInArrow(_count_children(shards, 2), _ROW))
    with released_shuffles(spark):
        sorted_rows(pair_rows.mapInArrow(build_pairs, _ROW)).mapInArrow(build_weights, "shard int").count()
        for level in range(3, order + 1):
            sorted_rows(own.mapInArrow(_count_children(shards, level), _ROW)).mapInArrow(build_level(level), "shard int").count()
    return Trie(folder, shards, int(total.tokens or 0), int(total.types or 0), discount, order)


def score(docs: DataFrame, trie: Trie, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Score every whole text: id_col, the columns to keep, n_tokens, n_known, base_score, score.

    Scores are sums of log10 probabilities over the words, A-Z lower-cased, and one end. base_score takes
    p(w) alone, score the trie's p(w | h). Each task looks its distinct n-grams up in the mapped
    levels, by the Elias-Fano successor search. Null and empty texts are one end. Repeated rows are
    kept. Other columns are ignored, whatever their names.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, tokens in _groups(batches, 0):
            own, contexts = np.concatenate(tokens), _contexts(tokens, trie.order)
            doc = np.repeat(np.arange(len(tokens)), [len(t) for t in tokens])
            keys, at = np.unique(np.concatenate([own, [BEGIN]]), return_inverse=True)
            counts, weights = _lookup_words(trie.folder, trie.shards, keys, True)
            word_of = at[:-1]
            before_of = np.empty(len(own), np.int64)
            before_of[1:] = word_of[:-1]
            before_of[contexts[0] == BEGIN] = at[-1]
            unigram = trie.unigram(counts)
            p = unigram[word_of]
            for level, context in enumerate(contexts, 2):  # each level looks its distinct n-grams up, and leaves the rest to the one below
                first, _, gram_of = _distinct_pairs(context, own)
                found, weight = np.zeros(len(first)), weights[before_of[first]] if level == 2 else np.ones(len(first))
                for k, i in _by_shard(_child_shard(context[first], own[first], trie.shards, level)):
                    found[i], own_weight = _children(trie.folder, k, level).probability(context[first[i]], own[first[i]])
                    if level > 2:
                        weight[i] = own_weight
                p = (found + weight * p[first])[gram_of]
            n = len(tokens)
            base = np.bincount(doc, weights=np.log10(unigram)[word_of], minlength=n)
            full = np.bincount(doc, weights=np.log10(p), minlength=n)
            known = np.bincount(doc, weights=counts[word_of] > 0, minlength=n).astype(np.int64)
            sizes = np.array([len(t) for t in tokens], np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(sizes), pa.array(known), pa.array(base), pa.array(full)], names=[*batch.schema.names[1:], "n_tokens", "n_known", "base_score", "score"])

    own = docs.select(F.col(text_col).alias("__text"), F.col(id_col).alias("__id"), *[F.col(c).alias(f"__{i}") for i, c in enumerate(keep)])
    kinds = {f.name: f.dataType for f in own.schema.fields[1:]}
    out = own.mapInArrow(run, row_type(**kinds, n_tokens="long", n_known="long", base_score="double", score="double"))
    return out.select(F.col("__id").alias(id_col), *[F.col(f"__{i}").alias(c) for i, c in enumerate(keep)], "n_tokens", "n_known", "base_score", "score")


def held_out_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 7, fold: int = 2, order: int = 2) -> DataFrame:
    """Train on the documents whose crc32(id as text) mod folds is not fold, and score all.

    Returns id_col, held_out, n_tokens, n_known, train_tokens, base_score, score. Null ids are in no fold and
    train. An empty table gives an empty result; without training texts every word is unknown.
    """
    own = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    own = own.withColumn("held_out", F.coalesce(F.crc32(F.col("__id").cast("string")) % folds == fold, F.lit(False)))
    trie = train(own.filter("not held_out"), "__text", order=order)
    out = score(own, trie, "__id", "__text", ("held_out",))
    return out.select(F.col("__id").alias(id_col), "held_out", "n_tokens", "n_known", F.lit(trie.tokens).cast("long").alias("train_tokens"), "base_score", "score")
