"""Document fingerprints: SimHash and permuted block tables, and links by shared n-grams. Native expressions alone."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .blocks import block_components, shared_blocks
from .common import let, lower_words, scratch, text_or_empty, written
from .components import connected_components

#: A fingerprint is two longs: 128 signed votes.
BITS = 128
_LANES = 0x0000000100000001
#: Most hashes of 8 bytes that are broadcast to the texts, to find those that stand in a pair; more are joined by a shuffle of all texts.
MOST_SENT = 1 << 21


def terms(text: Column, size: int = 5) -> Column:
    """Hashes of a text's word n-grams, one for each occurrence, so that a term's weight is its frequency; shorter texts are one term."""

    def of(words: Column) -> Column:
        n = F.size(words)
        long = F.transform(F.sequence(F.lit(0), n - size), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(size)]))
        return F.when(n >= size, long).when(n > 0, F.array(F.xxhash64(F.array_join(words, " ")))).otherwise(F.array().cast("array<bigint>"))

    return let(lower_words(text), of)


def vote(rows: DataFrame, key: list[str], hashes: str) -> DataFrame:
    """(key, h0, h1) from rows of key and an array of term hashes.

    Each term votes by its 128 bits. Two 32-bit counts share a long, so 64 sums hold all votes; they
    are summed in each partition before the shuffle, which moves one row for each document. A
    document's terms are never gathered. Ties and texts without terms give zero bits.
    """
    voters = rows.select(*key, F.explode_outer(hashes).alias("h0")).withColumn("h1", F.xxhash64("h0", F.lit(7)))
    sums = [F.sum(F.shiftrightunsigned(h, k).bitwiseAND(F.lit(_LANES))).alias(f"{h}_{k}") for h in ("h0", "h1") for k in range(32)]
    counted = voters.groupBy(*key).agg(F.count("h0").alias("n"), *sums)

    def bits(h: str) -> Column:
        parts = []
        for k in range(32):
            both = F.coalesce(F.col(f"{h}_{k}"), F.lit(0).cast("long"))
            parts.append(F.shiftleft((2 * both.bitwiseAND(F.lit(0xFFFFFFFF)) > F.col("n")).cast("long"), k))
            parts.append(F.shiftleft((2 * F.shiftrightunsigned(both, 32) > F.col("n")).cast("long"), k + 32))
        out = parts[0]
        for p in parts[1:]:
            out = out.bitwiseOR(p)
        return out

    return counted.select(*key, bits("h0").alias("h0"), bits("h1").alias("h1"))


def distance(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    return F.bit_count(a0.bitwiseXOR(b0)) + F.bit_count(a1.bitwiseXOR(b1))


def likeness(bits_apart: Column) -> Column:
    """The cosine that the share of differing bits estimates, at least 0: 1 for equal fingerprints, about 0 for unrelated ones."""
    return F.greatest(F.lit(0.0), F.cos(bits_apart * F.lit(3.141592653589793 / BITS)))


def hexed(h0: str, h1: str) -> Column:
    return F.lower(F.concat(F.lpad(F.hex(h0), 16, "0"), F.lpad(F.hex(h1), 16, "0")))


def block_tables(prints: DataFrame, radius: int) -> DataFrame:
    """(key, node, h0, h1): permuted block tables over distinct fingerprints.

    128 bits fall into radius + 2 blocks. Two fingerprints within the radius differ in at most that many
    blocks, so they agree in two at least: each pair of blocks is a table, its key those two blocks' bits.
    """
    n = radius + 2
    edges = [round(i * BITS / n) for i in range(n + 1)]

    def block(i: int) -> Column:
        parts = []
        for half, h in enumerate(("h0", "h1")):
            low, high = max(edges[i] - 64 * half, 0), min(edges[i + 1] - 64 * half, 64)
            if low < high:
                mask = (1 << (high - low)) - 1
                parts.append(F.col(h) if mask == (1 << 64) - 1 else F.shiftrightunsigned(h, low).bitwiseAND(F.lit(mask)))
        return F.xxhash64(*parts) if len(parts) > 1 else parts[0]

    own = prints.withColumn("__blocks", F.array(*[block(i) for i in range(n)]))
    keys = F.array(*[F.xxhash64(F.lit(i * n + j), F.get("__blocks", F.lit(i)), F.get("__blocks", F.lit(j))) for i, j in combinations(range(n), 2)])
    return own.select(F.explode(keys).alias("key"), "node", "h0", "h1")


def common_terms(texts: DataFrame, size: int, share: int = 16, most: int = 16384) -> list[int]:
    """Hashes of n-grams that many texts hold, by one text in `share`: at most `most` of them go to the driver."""
    some = texts.filter(F.pmod(F.col("h"), F.lit(share)) == 0)
    counts = some.select(F.explode(F.array_distinct(terms(F.col("t"), size))).alias("g")).groupBy("g").count().filter("count > 3")
    return [r.g for r in counts.orderBy(F.col("count").desc(), "g").limit(most).collect()]


def like_texts(texts: DataFrame, percent: int = 80, size: int = 5, rounds: int = 2) -> DataFrame:
    """(h, comp): texts linked by 100 * |A and B| >= percent * |A or B| of their word n-gram sets, as components; texts without links are left out.

    texts: t, and h, its XXH64, by which copies are one. Bits cannot find these: at a likeness of 0.8 two fingerprints
    lie 20 to 26 bits apart, and tables that find all pairs so far apart have keys of 9 bits. So a block is an n-gram, and a text
    stands in those of its first n - ceil(percent * n / 100) + 1 n-grams under one order for all: of two linked
    texts, both then have one of them in common. Common n-grams come last in the order; which ones are known to be
    changes the time, never the links. In the last round, a pair must share as many keys as its sizes ask before its overlap
    is counted on whole sets.
    """
    common = common_terms(texts, size)

    def key(g: Column) -> Column:
        """62 bits of the hash, and one above them that sets common n-grams last."""
        own = F.shiftrightunsigned(g, 2)
        return F.when(g.isin(common), own.bitwiseOR(F.lit(1 << 62))).otherwise(own) if common else own

    def first(own: Column) -> Column:
        n = F.size(own)
        return F.struct(n.alias("n"), F.slice(F.sort_array(F.transform(own, key)), F.lit(1), n - F.ceil(n * percent / F.lit(100)).cast("int") + 1).alias("keys"))

    sets = texts.select(F.col("h").alias("node"), let(F.array_distinct(terms(F.col("t"), size)), first).alias("s")).filter("s.n > 0")
    # Size and place share a long, so that a row of the index, the largest table here, has three of them.
    packed = sets.select("node", F.col("s.n").alias("n"), F.posexplode("s.keys").alias("pos", "key")).select("key", "node", (F.shiftleft(F.col("n").cast("long"), 32) + F.col("pos")).alias("at"))
    index = packed.repartition("key").groupBy("key", "node").agg(F.min("at").alias("at"))
    n_of, pos_of = (lambda at: F.shiftright(at, 32)), (lambda at: at.bitwiseAND(F.lit(0xFFFFFFFF)))
    blocks = shared_blocks(index)

    def bound(a, b):
        """Two sets of sizes n share at most what stands from their first common key on, in either prefix."""
        n, m = n_of(a("at")), n_of(b("at"))
        most = F.least(n - pos_of(a("at")), m - pos_of(b("at")))
        return (F.lit(100 + percent) * most >= F.lit(percent) * (n + m)) & alike(n, m)

    def alike(n: Column, m: Column) -> Column:
        return F.lit(100) * F.least(n, m) >= F.lit(percent) * F.greatest(n, m)

    def enough(keys: Column, n: Column, m: Column) -> Column:
        """As many common keys as a link needs: what two sets share beyond the end of the prefix that ends first lies
        in that set's rest, of ceil(percent * n / 100) - 1 n-grams; all else are common keys."""
        most = keys + F.ceil(F.greatest(n, m) * percent / F.lit(100)) - 1
        return F.lit(100 + percent) * most >= F.lit(percent) * (n + m)

    def overlaps(pairs: DataFrame) -> DataFrame:
        # Written first, so that their number is known: while they are few they go to the texts, and not the texts to them.
        members = written(pairs.select(F.explode(F.array("a", "b")).alias("h")).distinct(), "simhash-named")
        named = F.broadcast(members) if members.count() <= MOST_SENT else members
        held = written(texts.join(named, "h").groupBy("h").agg(F.first("t").alias("t")), "simhash-members")
        joined = pairs.join(held.select(F.col("h").alias("a"), F.col("t").alias("ta")), "a").join(held.select(F.col("h").alias("b"), F.col("t").alias("tb")), "b")
        own, other = F.array_distinct(terms(F.col("ta"), size)), F.array_distinct(terms(F.col("tb"), size))
        counted = joined.select("a", "b", let(F.struct(own.alias("x"), other.alias("y")), lambda s: F.struct(F.size(F.array_intersect(s["x"], s["y"])).alias("both"), (F.size(s["x"]) + F.size(s["y"])).alias("sum"))).alias("c"))
        return counted.filter(F.lit(100) * F.col("c.both") >= F.lit(percent) * (F.col("c.sum") - F.col("c.both")))

    return block_components(blocks, ["at"], bound, overlaps, rounds, (pos_of(F.col("at")),), lambda x: n_of(x("at")), alike, enough).select(F.col("node").alias("h"), "comp")


def near_components(prints: DataFrame, radius: int = 4, rounds: int = 2, groups: DataFrame | None = None) -> DataFrame:
    """(h0, h1, near_class): fingerprints linked within the Hamming radius, as components; the class is the smallest id in it.

    prints: id, h0, h1, in any number of rows. Equal fingerprints become one node first. All pairs within
    the radius count, whatever the size of a block. groups: h0, h1, group; fingerprints of one group are
    linked too. Empty tables give empty results.
    """
    with scratch(prints.sparkSession):
        nodes = prints.groupBy("h0", "h1").agg(F.min("id").alias("id"))
        nodes = written(nodes.withColumn("node", F.monotonically_increasing_id()), "simhash-nodes")
        close = lambda a, b: distance(a("h0"), a("h1"), b("h0"), b("h1")) <= radius
        comp = block_components(shared_blocks(block_tables(nodes, radius)), ["h0", "h1"], close, lambda pairs: pairs, rounds)
        if groups is not None:
            known = nodes.select("h0", "h1", "node").join(groups, ["h0", "h1"])
            lows = known.groupBy("group").agg(F.min("node").alias("low"))
            more = known.join(lows, "group").select(F.col("node").alias("a"), F.col("low").alias("b"))
            links = more.unionByName(comp.select(F.col("node").alias("a"), F.col("comp").alias("b"))).filter("a <> b")
            comp = connected_components(written(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "simhash-links"))
        out = nodes.join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
        return written(out.join(out.groupBy("comp").agg(F.min("id").alias("near_class")), "comp").select("h0", "h1", "near_class"), "simhash-classes", keep=True)


def near_pairs(prints: DataFrame, queries: DataFrame, radius: int = 4) -> DataFrame:
    """(query_id, id, bits_apart): every fingerprint of prints within the radius of each stated query, by the block tables.

    prints and queries: id, h0, h1. Equal fingerprints are looked up once and joined to their ids afterwards.
    """
    print_ids, query_ids = prints.select("id", "h0", "h1"), queries.select(F.col("id").alias("query_id"), F.col("h0").alias("q0"), F.col("h1").alias("q1"))
    left = block_tables(print_ids.select("h0", "h1").distinct().withColumn("node", F.lit(0)), radius).drop("node")
    right = block_tables(queries.select("h0", "h1").distinct().withColumn("node", F.lit(0)), radius).select("key", F.col("h0").alias("q0"), F.col("h1").alias("q1"))
    apart = distance(F.col("h0"), F.col("h1"), F.col("q0"), F.col("q1"))
    found = left.join(right, "key").filter(apart <= radius).select("h0", "h1", "q0", "q1", apart.alias("bits_apart")).distinct()
    return found.join(print_ids, ["h0", "h1"]).join(query_ids, ["q0", "q1"]).select("query_id", "id", "bits_apart")


#: Most ranges that the rows are cut into, and rows that a range's bounds are chosen from: the bound of what goes to the driver.
MOST_RANGES, RANGE_SAMPLE = 16384, 32


def _range_of(rows: DataFrame, range_bytes: int) -> Column:
    """Number of the bounds at or below a row's `__key`; bounds cut the rows into ranges of about range_bytes of the input.

    Bounds are picked from rows by the hash of their key, of any type, and stand in the plan as one literal.
    A row looks among every s-th bound first, then among the s bounds that follow.
    """
    size = int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    unknown = size >= 1 << 60  # Spark gives a huge size where it knows none
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) if unknown else min(-(-size // range_bytes), MOST_RANGES)
    total = rows.count() if n > 1 else 0
    n = min(n, total // 2)
    if n < 2:
        return F.lit(0)
    share = max(total // (n * RANGE_SAMPLE), 1)
    some = rows.select("__key").filter(F.pmod(F.xxhash64("__key", F.lit(5)), F.lit(share)) == 0)
    every = max(total // share // n, 1)
    picked = some.withColumn("k", F.row_number().over(W.orderBy("__key"))).filter(F.col("k") % every == 0)  # n * RANGE_SAMPLE rows or so
    kind = f"array<{rows.schema['__key'].dataType.simpleString()}>"
    listed = picked.agg(F.to_json(F.array_sort(F.collect_set("__key")), {"ignoreNullFields": "false"}).alias("b"), F.count("*").alias("n")).first()
    if not listed.n:
        return F.lit(0)
    step = max(int(listed.n**0.5), 1)
    bounds = F.from_json(F.lit(listed.b), kind)

    def below(some_bounds: Column) -> Column:
        return F.size(F.filter(some_bounds, lambda x: x <= F.col("__key")))

    coarse = F.filter(bounds, lambda _, i: i % step == 0)
    return let(below(coarse), lambda c: F.when(c == 0, 0).otherwise((c - 1) * step + below(F.slice(bounds, (c - 1) * step + 1, F.lit(step)))))


def with_next(docs: DataFrame, range_bytes: int = 16 << 20) -> DataFrame:
    """(bucket, pos, id, text, next_text, next_bucket, next_pos): each document with the next by descending id.

    Rows are cut into ranges of ids, each sorted by itself. The first row of a range also stands, as a
    ghost, at the end of the range before it, and the very first at the end of the last: so no range
    has to see another, and no task sees all. Equal ids go by the text's hash; null ids come last.
    """
    own = docs.withColumn("__key", F.struct(F.col("__id").alias("id"), F.bitwise_not(F.xxhash64("__text")).alias("h")))
    own = own.withColumn("bucket", _range_of(own, range_bytes))
    tops = own.groupBy("bucket").agg(F.max("__key").alias("top"))  # a row for each range
    order = W.orderBy(F.col("bucket").desc())
    tops = tops.withColumns({"first": F.max("bucket").over(W.partitionBy()), "last": F.min("bucket").over(W.partitionBy()), "before": F.lag("bucket").over(order), "after": F.lead("bucket").over(order)})
    tops = written(tops.select("bucket", "top", F.coalesce("before", "last").alias("before"), F.coalesce("after", "first").alias("after")), "simhash-ranges")
    bounds = F.broadcast(tops.withColumnRenamed("bucket", "__b"))  # MOST_RANGES rows at most
    here, ghost = F.struct(F.col("bucket"), F.lit(0).alias("ghost")), F.struct(F.col("before").alias("bucket"), F.lit(1).alias("ghost"))
    places = F.when(F.col("__key") == F.col("top"), F.array(here, ghost)).otherwise(F.array(here))
    every = own.join(bounds, F.col("bucket") == F.col("__b"), "left").select("__id", "__text", "__key", F.inline(places))
    order = W.partitionBy("bucket").orderBy("ghost", F.col("__key").desc(), "__text")
    own = every.withColumns({"pos": F.row_number().over(order), "next_text": F.lead("__text").over(order), "next_ghost": F.lead("ghost").over(order)})
    over = F.col("next_ghost") == 1
    own = own.filter("ghost = 0").join(F.broadcast(tops.select(F.col("bucket").alias("__b"), "after")), F.col("bucket") == F.col("__b"))
    return own.select(
        "bucket", "pos", F.col("__id").alias("id"), F.col("__text").alias("text"), "next_text",
        F.when(over, F.col("after")).otherwise(F.col("bucket")).alias("next_bucket"), F.when(over, 1).otherwise(F.col("pos") + 1).alias("next_pos"),
    )


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5) -> DataFrame:
    """(id_col, h0, h1): the SimHash of every whole text, one row for each input row.

    Null and empty texts have no terms and a fingerprint of zeros; equal texts have equal ones. Repeated
    rows are kept. Other columns are ignored, whatever their names.
    """
    own = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("t"))
    texts = own.groupBy("id", F.xxhash64("t").alias("h"), F.length("t").alias("l")).agg(F.first("t").alias("t"), F.count("*").alias("times"))
    prints = vote(texts.select("id", "h", "l", "times", terms(F.col("t"), size).alias("terms")), ["id", "h", "l", "times"], "terms")
    return prints.select(F.explode(F.sequence(F.lit(1).cast("long"), "times")).alias("k"), "id", "h0", "h1").select(F.col("id").alias(id_col), "h0", "h1")


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, radius: int = 4, range_bytes: int = 16 << 20, percent: int = 80) -> DataFrame:
    """Fingerprints of each text and of its edited text, and how like they are.

    The edited text: the last floor(n / 2) code points replaced by the first as many, or all, of the
    next document by descending id (after the last: the first). Returns id_col, n_chars,
    edited_sha256, fingerprint, edited_fingerprint (hex), near_edited, near_next, near_class (the
    smallest id of those linked to it, within the Hamming radius or by a Jaccard likeness of at
    least percent / 100 of their n-gram sets).

    Null texts count as empty; repeated rows and ids keep a row each, in the order of their texts; null
    ids come last; ids may be of any type that has an order. An empty table gives an empty result. Other columns are ignored, whatever their names.
    Whole texts are shuffled once, by ranges of ids, and those that may be linked with another again.
    """
    own = docs.select(F.col(id_col).alias("__id"), text_or_empty(text_col).alias("__text"))
    n, m = F.length("text"), F.floor(F.length("text") / 2).cast("int")
    paired = with_next(own, range_bytes).withColumn("edited", F.concat(F.substring("text", F.lit(1), n - m), F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), m)))
    both = F.inline(F.array(F.struct(F.lit(0).alias("which"), F.col("text").alias("t")), F.struct(F.lit(1).alias("which"), F.col("edited").alias("t"))))
    key = ["bucket", "pos", "id", "next_bucket", "next_pos", "which", "n_chars", "sha", "h"]
    rows = paired.select("bucket", "pos", "id", "next_bucket", "next_pos", F.xxhash64("text").alias("h"), n.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("sha"), both)
    prints = written(vote(rows.select(*key, terms(F.col("t"), size).alias("terms")), key, "terms"), "simhash-prints")
    mine = prints.filter("which = 0")
    edits = prints.filter("which = 1").select("bucket", "pos", F.col("h0").alias("e0"), F.col("h1").alias("e1"))
    following = mine.select(F.col("bucket").alias("next_bucket"), F.col("pos").alias("next_pos"), F.col("h0").alias("f0"), F.col("h1").alias("f1"))
    out = mine.join(edits, ["bucket", "pos"]).join(following, ["next_bucket", "next_pos"])
    with scratch(docs.sparkSession):
        like = like_texts(own.select(F.col("__text").alias("t"), F.xxhash64("__text").alias("h")), percent, size)
        groups = written(mine.select("h", "h0", "h1").distinct().join(like, "h").select("h0", "h1", F.col("comp").alias("group")).distinct(), "simhash-groups", keep=True)
    out = out.join(near_components(mine.select("id", "h0", "h1"), radius, groups=groups), ["h0", "h1"])
    return out.select(
        F.col("id").alias(id_col), "n_chars", F.col("sha").alias("edited_sha256"), hexed("h0", "h1").alias("fingerprint"), hexed("e0", "e1").alias("edited_fingerprint"),
        likeness(distance(F.col("h0"), F.col("h1"), F.col("e0"), F.col("e1"))).alias("near_edited"), likeness(distance(F.col("h0"), F.col("h1"), F.col("f0"), F.col("f1"))).alias("near_next"), "near_class",
    )
