"""Personal data: checked base patterns, and contextual extraction bootstrapped from what they find."""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, row_type, scratch, spread_join, written

KINDS = ("email", "ip", "card", "phone")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# A run of digits that fails at its first digit fails at every other, so only its start is tried: linear time.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
#: A run with @, or one of digits and the marks that stand between them.
_RUN = re.compile(r"[0-9A-Za-z@._%+()/:-]++")
_DIGIT = re.compile("[0-9]")
_PARTS = re.compile(r"[0-9().+/-]++")
_EDGE = ".,;:!?\"'()[]{}<>|*#$%&="
#: Longer contexts and instances are named by their digest.
_NAME_CHARS = 64


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) << (i & 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches in linear time: from each @ back over the local part, as far as the last match's end."""
    floor, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            floor = m.end()
        else:
            floor = at + 1
        at = text.find("@", floor)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind's number) of every checked base match, by start, then kind."""
    found = [(a, b, 0) for a, b in _emails(text)]
    if re.search("[0-9]", text):
        # int() is asked only about parts of few digits: leading zeros count for nothing
        found += [(*m.span(), 1) for m in _IP.finditer(text) if all(len(p := x.lstrip("0")) <= 3 and int(p or 0) <= 255 for x in m[0].split("."))]
        found += [(*m.span(), 2) for m in _CARD.finditer(text) if 14 <= len(d := m[0].replace(" ", "").replace("-", "")) <= 19 and luhn(d)]
        found += [(*m.span(), 3) for m in _PHONE.finditer(text) if 10 <= sum(c in "0123456789" for c in m[0]) <= 15]
    return sorted(found, key=lambda x: (x[0], x[2]))


def _named(text: str) -> str:
    return text if len(text) <= _NAME_CHARS else "#" + blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()


def coarse(text: str) -> str | None:
    """What a pattern asks of an instance beside its context: an address with @, or a number of 4 to 19 digits or of more.

    Other tokens are of no kind that a base match has: letters without @, and up to three digits.
    """
    if "@" in text:
        return "@"
    digits = sum("0" <= c <= "9" for c in text)
    if digits < 4 or not all(c in "0123456789().+/- " for c in text):
        return None
    return "9" if digits <= 19 else "9-more"


def _trimmed(text: str, a: int, b: int) -> tuple[int, int]:
    """A run without the marks around it; a bracket stays where its other half is inside."""
    while a < b:
        own = text[a:b]
        tail = own.lstrip("./:-_)%" if ")" in own else "./:-_%(")
        head = tail.rstrip("./:-_(%+" if "(" in tail else "./:-_%+)")
        if len(head) == len(own):
            break
        a, b = b - len(tail), b - len(tail) + len(head)
    return a, b


def _candidates(text: str, base: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """Identifier-like spans outside the base matches: runs with a digit or @; numbers one blank apart make one span."""
    k, last, top = 0, None, 0
    for run in _RUN.finditer(text):
        parts = [run] if "@" in run[0] else _PARTS.finditer(text, *run.span()) if _DIGIT.search(run[0]) else ()
        for m in parts:
            while k < len(base) and base[k][0] < m.end():
                top, k = max(top, base[k][1]), k + 1
            if top > m.start():
                continue
            a, b = _trimmed(text, *m.span())
            if a == b:
                continue
            numeric = _PARTS.fullmatch(text, a, b) is not None
            if last and numeric and last[2] and a - last[1] == 1 and text[last[1]] == " ":
                last = (last[0], b, True)
                continue
            if last:
                yield last[:2]
            last = (a, b, numeric)
    if last:
        yield last[:2]


def occurrences(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, str, str, str, str, int]]:
    """Base matches, the seeds, and identifier-like spans, which patterns may discover: (start, end, instance, coarse kind, left, right, base kind or -1).

    left and right are the words beside the span, or what stands beside it in its own word ("tel:"). Linear in the text.
    """
    if not base and not re.search("[0-9@]", text):
        return []
    spans = sorted([*base, *((a, b, -1) for a, b in _candidates(text, base) if coarse(text[a:b]))])
    if not spans:
        return []
    found, words, before, word = [], _TOKEN.finditer(text), "", next(_TOKEN.finditer(text), None)
    next(words, None)
    last_end = 0
    for i, (a, b, kind) in enumerate(spans):
        while word and word.end() <= a:
            before, word = word[0], next(words, None)
        left = _context(text[max(word.start(), min(last_end, a)) : a]) or _context(before)
        stop = spans[i + 1][0] if i + 1 < len(spans) else len(text)
        after = _REST.match(text, b, max(stop, b))
        right = _context(after[0])
        if not right and (following := _NEXT.match(text, after.end())):
            right = _context(following[1])
        found.append((a, b, _named(text[a:b]), coarse(text[a:b]) or "", left, right, kind))
        last_end = max(last_end, b)
    return found


_REST, _NEXT = re.compile(r"[^\x20\x09-\x0D]*+"), re.compile(r"[\x20\x09-\x0D]++([^\x20\x09-\x0D]++)")


def _context(word: str) -> str:
    return _named(word.strip(_EDGE).lower())


_SPAN = "array<struct<start:long,end:long,kind:int>>"
_SEEN = "array<struct<start:long,end:long,instance:string,shape:string,left:string,right:string,kind:int>>"


def scan(docs: DataFrame, id_col: str, text_col: str, keep_text: bool) -> DataFrame:
    """One pass over the whole texts: base spans and identifier-like tokens of each row. No shuffle."""
    span_t = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.int32())]))
    seen_t = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("instance", pa.string()), ("shape", pa.string()), ("left", pa.string()), ("right", pa.string()), ("kind", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                base, seen = [], []
                for text in batch.column(1).to_pylist():
                    text = text or ""
                    spans = base_spans(text)
                    base.append([{"start": a, "end": b, "kind": k} for a, b, k in spans])
                    seen.append([dict(zip(("start", "end", "instance", "shape", "left", "right", "kind"), x, strict=True)) for x in occurrences(text, spans)])
                cols = [batch.column(0), pa.array(base, span_t), pa.array(seen, seen_t)]
                names = ["__id", "__base", "__seen"]
                if keep_text:
                    cols, names = [*cols, batch.column(1)], [*names, "__text"]
                yield pa.RecordBatch.from_arrays(cols, names=names)

    own = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    return own.mapInArrow(run, row_type(__id=own.schema[0].dataType, __base=_SPAN, __seen=_SEEN, **({"__text": "string"} if keep_text else {})))


def bootstrap(seen: DataFrame, rounds: int, min_confidence: float, min_support: int) -> DataFrame:
    """Score the pattern-instance graph and return discovered spans: __row, start, end, kind.

    A pattern is the word to the left or to the right, with the instance's coarse kind; so it reaches
    instances of other forms than the seeds'. In each round a pattern's confidence for a kind is the
    smoothed share of known instances of that kind among all distinct instances that it takes;
    patterns of enough confidence and support pass their kind to the other instances, and an instance becomes
    known if patterns of both sides agree, or one pattern is twice as well supported as asked. Rounds end
    when nothing new is found, or after `rounds`. Everything is joins and grouped sums on the
    occurrence table, which holds only identifier-like spans, not the texts; joins are spread, since one
    context or one instance may hold a large share of them.
    """
    occurrence = seen.select("__row", F.explode("__seen").alias("o")).select("__row", "o.*")
    sides = F.array(*[F.struct(F.lit(s[0]).alias("side"), F.col(s).alias("word")) for s in ("left", "right")])
    edges = occurrence.select(F.explode(sides).alias("p"), "shape", "instance", "kind").filter("p.word <> ''")
    edges = edges.select(F.concat_ws(" ", "p.side", "shape", "p.word").alias("pattern"), "instance", "kind")
    edges = written(edges.groupBy("pattern", "instance").agg(F.max("kind").alias("kind")), "pii-edges")
    known = edges.filter("kind >= 0").groupBy("instance").agg(F.min("kind").alias("known"))
    edges, learned = edges.drop("kind"), None
    for _ in range(rounds):
        state = written(spread_join(edges, known, ["instance"], F.col("pattern"), "left"), "pii-state")
        totals = state.groupBy("pattern").agg(F.count("*").alias("n"), *[F.count_if(F.col("known") == k).alias(f"n{k}") for k in range(len(KINDS))])
        best = F.greatest(*[F.col(f"n{k}") for k in range(len(KINDS))])
        which = F.coalesce(*[F.when(F.col(f"n{k}") == best, F.lit(k)) for k in range(len(KINDS))])
        patterns = totals.select("pattern", which.alias("pkind"), best.alias("support"), (best / (F.col("n") + 1)).alias("confidence"))
        patterns = patterns.filter((F.col("support") >= min_support) & (F.col("confidence") >= min_confidence))
        votes = spread_join(state.filter("known is null"), patterns, ["pattern"], F.col("instance")).groupBy("instance", "pkind")
        votes = votes.agg(F.sum("confidence").alias("score"), F.max("support").alias("support"), F.countDistinct(F.substring("pattern", 1, 1)).alias("sides"))
        found = votes.filter((F.col("sides") == 2) | (F.col("support") >= 2 * min_support))
        found = written(found.groupBy("instance").agg(F.max_by("pkind", F.struct("score", -F.col("pkind"))).alias("known")), "pii-found")
        learned = found if learned is None else learned.unionByName(found)
        if found.isEmpty():
            break
        known = known.unionByName(found)
    return spread_join(occurrence.filter("kind < 0"), learned, ["instance"], F.struct("__row", "start")).select("__row", "start", "end", F.col("known").alias("kind"))


def find_personal_data(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = 20, min_confidence: float = 0.7, min_support: int = 4, keep_text: bool = False
) -> DataFrame:
    """Personal data of every whole text: id_col, base and spans arrays of struct<start, end, kind>.

    base: email, ip, card and phone matches that pass their checks, leftmost and non-overlapping per
    kind; offsets count code points, the end is exclusive. spans: base ones and those that
    bootstrapped patterns add, by start, then kind; those never overlap a base one. Null and empty texts have none. Repeated rows
    and ids are kept, each with its own spans. Other columns are ignored, whatever their names. With
    keep_text, the text comes along for redaction. An empty table gives an empty result.
    """
    with arrow_batches(docs.sparkSession):
        rows = written(scan(docs, id_col, text_col, keep_text).withColumn("__row", F.monotonically_increasing_id()), "pii-scan")
    with scratch(docs.sparkSession):
        more = bootstrap(rows.filter(F.size("__seen") > 0), rounds, min_confidence, min_support)
        more = written(more.groupBy("__row").agg(F.collect_list(F.struct("start", "end", "kind")).alias("__more")), "pii-more", keep=True)
    spans = F.array_sort(
        F.concat("__base", F.coalesce("__more", F.array().cast(_SPAN))),
        lambda x, y: F.when((x.start == y.start) & (x.kind == y.kind), 0).when((x.start < y.start) | ((x.start == y.start) & (x.kind < y.kind)), -1).otherwise(1),
    )
    out = rows.join(more, "__row", "left")
    return out.select(F.col("__id").alias(id_col), F.col("__base").alias("base"), spans.alias("spans"), *(["__text"] if keep_text else []))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """docs with every found span replaced by its kind in brackets, and n_chars (if there) counted anew.

    Columns and rows stay; overlapping spans become one, named by the first. A null text stays null.
    """
    others = [c for c in docs.columns if c != text_col]
    own = docs.select(F.struct(F.lit(0).alias("__"), *[F.col(c) for c in others]).alias("__rest"), F.col(text_col).alias("__text"))
    found = find_personal_data(own, "__rest", "__text", keep_text=True, **options)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                out = []
                for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                    if spans:
                        parts, floor = [], 0
                        for x in spans:
                            if x["start"] >= floor:
                                parts += [text[floor : x["start"]], f"[{KINDS[x['kind']].upper()}]"]
                            floor = max(floor, x["end"])
                        text = "".join(parts) + text[floor:]
                    out.append(text)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=["__rest", "__text"])

    out = found.select("__rest", "__text", "spans").mapInArrow(run, row_type(__rest=own.schema["__rest"].dataType, __text="string"))
    new = {text_col: F.col("__text"), "n_chars": F.length("__text").cast("long")}
    return out.select(*[new.get(c, F.col(f"__rest.`{c}`")).alias(c) for c in docs.columns])
