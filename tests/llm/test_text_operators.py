"""Personal data, quality rules, tokenizer, fingerprints, substring dedup, language model against brute force."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from sieveyard.llm.elias_fano import Sequence, encode, map_arrays, named, part, write_arrays
from sieveyard.llm.language_model import held_out_scores, quantised
from sieveyard.llm.personal import base_spans, find_personal_data, luhn, occurrences, redact
from sieveyard.llm.quality import FEATURES, decision, judge, learn, text_statistics
from sieveyard.llm.simhash import edited_fingerprints, fingerprints, near_components, near_pairs
from sieveyard.llm.substrings import chunks, cuts, remove_spans, repeated_passages
from sieveyard.llm.tokenizer import encode_decode, encoding, pieces

from .helpers import BASE, LONG, RUN, TEXTS, docs, held_out, shingles, words

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")

# --- personal data

PATTERNS = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_spans(text):
    checks = (
        lambda m: True, lambda m: all(int(p) <= 255 for p in m.split(".")), lambda m: 14 <= len(d := re.sub("[^0-9]", "", m)) <= 19 and luhn(d), lambda m: 10 <= len(re.sub("[^0-9]", "", m)) <= 15,
    )
    return sorted(((*m.span(), k) for k, p in enumerate(PATTERNS) for m in re.finditer(p, text) if checks[k](m[0])), key=lambda x: (x[0], x[2]))


def test_base_spans_are_the_plain_patterns():
    r = random.Random(2)
    samples = ["a@b.c@d.e.f g@h", "x@y..z a.b.@c.d", "1.2.3.4.5.6.7.8", "256.1.1.1 01.002.3.255", "4111 1111 1111 1111", "4111-1111-1111-1111-1", "+1 (555) 555-0100.", "++1 2345678901", "@@a@b.c", "é@x.y 1.2.3.4é"]
    samples += ["".join(r.choices("ab1234567890.@+-() é", k=r.randrange(5, 60))) for _ in range(4000)]
    for s in samples:
        assert base_spans(s) == plain_spans(s), s
    assert luhn("4111111111111111") and not luhn("4111111111111112")


def test_base_spans_take_linear_time():
    for s in ("a" * 400_000, "1" * 400_000, "1." * 200_000, "+1" * 200_000, "+1" + "-" * 400_000, "a@" * 200_000, RUN):
        base_spans(s)


def test_patterns_discover_unseen_identifiers(spark):
    r = random.Random(5)
    digits = lambda n: "".join(r.choices("0123456789", k=n))
    rows = [(i, f"filler words here reach me on phone +1 555 {digits(3)} {digits(4)} today please {i} end") for i in range(30)]
    rows += [(100 + i, f"some words then call server address 10.{i}.3.4 now thanks") for i in range(20)]
    rows += [(200, "other text server address 10.11.12.999 now thanks"), (201, "nothing to see 2024-01-05 or 123456 here")]
    out = {x.doc_id: x for x in find_personal_data(docs(spark, rows), min_confidence=0.6).collect()}
    assert [s.kind for s in out[200].base] == [] and [(s.start, s.end, s.kind) for s in out[200].spans] == [(26, 38, 1)]
    assert out[201].spans == [] and all(len(out[i].base) == 1 for i in range(30))
    assert all(set(map(tuple, x.base)) <= set(map(tuple, x.spans)) for x in out.values())


def plain_bootstrap(texts, rounds=20, min_confidence=0.7, min_support=4):
    """{(text's place, start, end): kind} of what the patterns add, by plain loops."""
    seen = [(k, *o) for k, t in enumerate(texts) for o in occurrences(t or "", base_spans(t or ""))]
    edges = defaultdict(set)
    for _, _, _, instance, form, left, right, _ in seen:
        for side, word in (("left", left), ("right", right)):
            if word:
                edges[side, form, word].add(instance)
    with_context = {i for x in edges.values() for i in x}
    known = {}
    for _, _, _, instance, _, _, _, kind in seen:
        if kind >= 0 and instance in with_context:
            known[instance] = max(kind, known.get(instance, -1)) if instance not in known else min(kind, known[instance])
    learned = {}
    for _ in range(rounds):
        votes = defaultdict(list)
        for pattern, instances in edges.items():
            support, kind = max((sum(known.get(i) == k for i in instances), -k) for k in range(4))
            confidence = support / (len(instances) + 1)
            if support >= min_support and confidence >= min_confidence:
                for i in instances - set(known):
                    votes[i, -kind].append((pattern[0], confidence, support))
        found = defaultdict(list)
        for (i, kind), v in votes.items():
            if len({x[0] for x in v}) == 2 or max(x[2] for x in v) >= 2 * min_support:
                found[i].append((sum(x[1] for x in v), -kind))
        if not found:
            break
        new = {i: -max(v)[1] for i, v in found.items()}
        known |= new
        learned |= new
    return {(k, a, b): learned[i] for k, a, b, i, _, _, _, kind in seen if kind < 0 and i in learned}


def test_patterns_reach_identifiers_of_other_forms(spark):
    r = random.Random(6)
    digits = lambda n: "".join(r.choices("0123456789", k=n))
    rows = [(i, f"{r.choice(('please', 'or'))} phone +1 555 {digits(3)} {digits(4)} today {digits(2)} words") for i in range(40)]
    rows += [(100 + i, f"mail: user{i}@site{i}.org for more") for i in range(20)]
    rows += [(200, "phone (743) 555-3824 today"), (201, "the phone 555-3824, today"), (202, "mail: someone@localhost for more"), (203, "x" * 90 + "phone 7435553824 today"), (204, "in 2024 and phone then 1234567 never")]
    rows += [(300 + i, f"reach {t} here") for i, t in enumerate(["(743) 555-3824", "555-3824", "7435553824", f"+1 555 {digits(7)}"] * 2)] + [(310, "reach 98765-4321 here")]  # a second round
    found = {(x.doc_id, s.start, s.end): s.kind for x in find_personal_data(docs(spark, rows), min_confidence=0.6, min_support=3).collect() for s in x.spans if s not in x.base}
    texts = {i: t for i, t in rows}
    assert {texts[i][a:b] for i, a, b in found if i in (200, 201, 202, 310)} == {"(743) 555-3824", "555-3824", "someone@localhost", "98765-4321"}
    assert not {i for i, *_ in found} & {204, *range(40)}
    want = plain_bootstrap([t for _, t in rows], min_confidence=0.6, min_support=3)
    assert found == {(rows[k][0], a, b): kind for (k, a, b), kind in want.items()}


def test_occurrences_take_linear_time():
    for s in ("(" * 100_000 + "12345" + ")(" * 50_000, "1111,2222;" * 30_000, "x1234@" * 50_000, "12345 " * 50_000, "x" * 300_000 + "12345", RUN, "1234)" * 50_000, "tel1234" * 50_000):
        occurrences(s, base_spans(s))


def test_personal_edge_rows(spark):
    out = find_personal_data(docs(spark)).collect()
    assert sorted(str(x.doc_id) for x in out) == sorted(str(i) for i, _ in TEXTS)
    assert [[s.kind for s in x.base] for x in out if x.doc_id == 12] == [[0, 1, 3]]
    assert find_personal_data(docs(spark, [])).collect() == []


def test_redact(spark):
    df = docs(spark).withColumn("n_chars", F.length("text").cast("long"))
    out = redact(df)
    assert out.columns == df.columns and out.schema == df.schema and out.count() == df.count()
    row = out.filter("doc_id = 12").first()
    assert row.text == "mail [EMAIL] and [IP] or [PHONE] ok" and row.n_chars == len(row.text) and row.key == "x"
    assert out.filter("doc_id = 4").first().text is None


# --- quality rules


def plain_statistics(text):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", text or "") if x]
    grams = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {j for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def test_statistics_against_brute_force(spark):
    r = random.Random(4)
    rows = [*TEXTS, *[(i, "".join(r.choices(["a", "b", "c", " ", " ", "\n", "\t", "#", "|"], k=r.randrange(0, 60)))) for i in range(100, 300)], (400, "x y z " * 3), (401, "a a a a"), (402, "p q r s p q r t q r s")]
    out = text_statistics(docs(spark, rows)).select("text", "stats.*").collect()
    for x in out:
        assert (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words) == plain_statistics(x.text)


def test_lists_are_learned_and_applied(spark):
    r = random.Random(6)
    row = lambda bad: dict.fromkeys(FEATURES, 0.0) | {"n_words": r.uniform(60, 500), "symbols_per_word": r.uniform(0.5, 1) if bad else r.uniform(0, 0.3), "upper_share": r.random(), "bad": bad}
    rows = [row(i % 5 == 0) for i in range(400)]
    rules = learn(rows)
    assert len(rules) == 1 and rules[0][0].feature == "symbols_per_word" and 0.3 <= rules[0][0].threshold <= 0.5
    assert learn([r for r in rows if not r["bad"]]) == [] and learn([]) == [] and learn([r for r in rows if r["bad"]]) == []
    texts = [(i, " ".join(f"w{r.randrange(10**5)}" + ("###" if i % 4 == 0 else "") for _ in range(80))) for i in range(200)]
    labels = spark.createDataFrame([(i, int(i % 4 != 0), 0) for i in range(120)] + [(0, 1, 0), (None, 0, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    out = {x.doc_id: x for x in judge(docs(spark, [*texts, (900, None), (901, "a b c " * 100)]), labels).collect()}
    assert all(out[i].kept == (i % 4 != 0) for i in range(200)) and not out[900].kept and out[901].base_failed
    assert spark.range(1).select(decision([], F.lit(None))).first()[0] == 0


def test_quality_without_labels_or_rows(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = judge(docs(spark), none)
    assert out.count() == len(TEXTS) and out.filter("kept <> (not base_failed)").count() == 0
    assert judge(docs(spark, []), none).collect() == []


# --- tokenizer


def test_tokens_equal_the_library_and_round_trip(spark):
    enc = encoding(RANKS, public_tokenizers.PATTERN)
    rows = [*TEXTS, (50, "<|endoftext|> don't  \n\n x" * 9000), (51, "x" * 70_000 + " " * 70_000 + "\n" * 70_000 + "é 1" * 30_000)]
    out = encode_decode(docs(spark, rows), RANKS, public_tokenizers.PATTERN).collect()
    assert len(out) == len(rows)
    want = Counter((i, np.array(enc.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode()) for i, t in rows)
    assert Counter((x.doc_id, bytes(x.ids), bytes(x.decoded)) for x in out) == want
    assert all(x.n_tokens * 4 == len(x.ids) for x in out)
    assert encode_decode(docs(spark, []), RANKS, public_tokenizers.PATTERN).collect() == []


def test_pieces_join_and_do_not_change_tokens():
    enc = encoding(RANKS, public_tokenizers.PATTERN)
    r = random.Random(8)
    for _ in range(300):
        text = "".join(r.choices(["ab", " ", "  ", "\n", "'s", "1", "é", "!", "\x1c", "\x85"], k=200))
        own = list(pieces(text, 20))
        assert "".join(own) == text
        assert [t for p in own for t in enc.encode_ordinary(p)] == enc.encode_ordinary(text)


# --- fingerprints


def test_fingerprints(spark):
    out = edited_fingerprints(docs(spark)).collect()
    assert len(out) == len(TEXTS)
    by_text = {}
    rows = sorted(((i, t or "") for i, t in TEXTS), key=lambda x: -1 if x[0] is None else x[0], reverse=True)
    ids = [i for i, _ in rows]
    for x in out:
        same = [t for i, t in rows if i == x.doc_id]
        assert x.n_chars in {len(t) for t in same} and 0 <= x.near_edited <= 1 and 0 <= x.near_next <= 1
        if ids.count(x.doc_id) == 1:
            t, nxt = same[0], rows[(ids.index(x.doc_id) + 1) % len(rows)][1]
            if ids.count(rows[(ids.index(x.doc_id) + 1) % len(rows)][0]) == 1:
                m = len(t) // 2
                assert x.edited_sha256 == hashlib.sha256((t[: len(t) - m] + nxt[:m]).encode()).hexdigest()
            by_text.setdefault(t.lower(), set()).add(x.fingerprint)
    assert all(len(v) == 1 for v in by_text.values())
    assert {x.near_class for x in out if x.doc_id in (1, 2, 11)} == {1}
    assert edited_fingerprints(docs(spark, [])).collect() == []


@pytest.mark.parametrize("kind", ["string", "date", "double"])
def test_ids_of_any_type_that_has_an_order(spark, kind):
    rows = [(f"{2000 + i}-01-01" if kind == "date" else str(i), f"text number {i} of some") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id string, text string").withColumn("doc_id", F.col("doc_id").cast(kind))
    ordered = sorted(rows, key=lambda x: float(x[0]) if kind == "double" else x[0], reverse=True)
    want = Counter(hashlib.sha256((t[: len(t) - len(t) // 2] + ordered[(k + 1) % 60][1][: len(t) // 2]).encode()).hexdigest() for k, (_, t) in enumerate(ordered))
    assert Counter(x.edited_sha256 for x in edited_fingerprints(df).collect()) == want


def test_one_row_follows_itself(spark):
    x = edited_fingerprints(docs(spark, [(3, "abcd")])).first()
    assert x.near_next == 1.0 and x.edited_sha256 == hashlib.sha256(b"abab").hexdigest()


def test_votes_equal_a_plain_count(spark):
    df = docs(spark, [(1, BASE), (2, "a b c d e f a b c d e g"), (3, "x")])
    hashes = df.select("doc_id", F.explode(F.expr("transform(sequence(0, greatest(size(split(lower(text), ' ')) - 5, 0)), i -> slice(split(lower(text), ' '), i + 1, 5))")).alias("w"))
    hashes = hashes.filter("size(w) = 5").select("doc_id", F.xxhash64(*[F.col("w")[k] for k in range(5)]).alias("h0")).withColumn("h1", F.xxhash64("h0", F.lit(7)))
    got = {r.doc_id: (r.h0, r.h1) for r in fingerprints(df).collect()}
    rows = hashes.collect()
    for doc in (1, 2):
        own = [r for r in rows if r.doc_id == doc]
        for k, name in enumerate(("h0", "h1")):
            bits = sum(1 << b for b in range(64) if 2 * sum(r[name] >> b & 1 for r in own) > len(own))
            assert got[doc][k] & (2**64 - 1) == bits


def test_block_tables_find_all_within_the_radius(spark):
    r = random.Random(9)
    flip = lambda v, n: v ^ sum(1 << b for b in r.sample(range(128), n))
    values = [r.getrandbits(128) for _ in range(30)]
    values += [flip(v, n) for v in values for n in (1, 3, 4, 5, 6)]
    signed = lambda v: v - 2**64 if v >= 2**63 else v
    rows = [(i, signed(v & (2**64 - 1)), signed(v >> 64)) for i, v in enumerate(values)] + [(900, signed(values[0] & (2**64 - 1)), signed(values[0] >> 64))]
    full = values + [values[0]]
    ids = [*range(len(values)), 900]
    df = spark.createDataFrame(rows, "id long, h0 long, h1 long")
    want = {(q, i, bin(a ^ b).count("1")) for q, a in zip(ids, full) for i, b in zip(ids, full) if q % 7 == 0 and bin(a ^ b).count("1") <= 4}
    assert {tuple(x) for x in near_pairs(df, df.filter("id % 7 = 0"), 4).collect()} == want
    parent = {i: i for i in ids}

    def find(i):
        return i if parent[i] == i else find(parent[i])

    for (i, a), (j, b) in ((x, y) for x in zip(ids, full) for y in zip(ids, full)):
        if bin(a ^ b).count("1") <= 4:
            parent[max(find(i), find(j))] = min(find(i), find(j))
    classes = {(x.h0, x.h1): x.near_class for x in near_components(df, 4).collect()}
    assert all(classes[(h0, h1)] == find(i) for i, h0, h1 in rows)


def test_classes_hold_all_pairs_of_jaccard_80(spark):
    r = random.Random(21)
    rows = []
    for k in range(40):
        text = [f"w{r.randrange(5000)}" for _ in range(r.choice((6, 30, 200, 400)))]
        rows.append((10 * k, " ".join(text)))
        for j in range(1, 4):  # each copy has one word in 60, 45 or 30 changed, or one
            edited = list(text)
            for at in r.sample(range(len(text)), max(1, len(text) // (75 - 15 * j))):
                edited[at] = f"v{r.randrange(5000)}"
            rows.append((10 * k + j, " ".join(edited)))
    sets = {i: shingles(t) for i, t in rows}
    like = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    assert len(like) > 20
    got = {x.doc_id: x.near_class for x in edited_fingerprints(docs(spark, rows)).collect()}
    low = {i: i for i in sets}
    for _ in range(5):
        for a, b in like:
            low[a] = low[b] = min(low[a], low[b])
    assert got == low


# --- substring dedup


def test_cuts_depend_on_content_alone():
    data = LONG.encode()[:50_000]
    ends = cuts(data, 24, 4, 128)
    assert ends[-1] == len(data) and all(24 <= b - a <= 128 for a, b in zip([0, *ends], ends[:-1]))
    moved = cuts(b"something inserted " + data, 24, 4, 128)
    shared = {e + 19 for e in ends} & set(moved)
    assert len(shared) > 0.95 * len(ends)
    text = "é漢😀" * 500
    for e in cuts(text.encode(), 24, 4, 128):
        text.encode()[:e].decode()
    assert cuts(b"", 24, 4, 128) == [] and len(cuts(b"\0" * 10_000, 24, 4, 128)) >= 78


def test_passages_that_repeat(spark):
    r = random.Random(10)
    prose = lambda n: " ".join("".join(r.choices("abcdefghij", k=r.randrange(2, 9))) for _ in range(n))
    passage = prose(52)
    rows = [(i, f"{prose(r.randrange(0, 90))} {passage} {prose(r.randrange(0, 90))}") for i in range(12)] + [(100 + i, prose(200)) for i in range(12)]
    rows += [(200, "éè " + prose(100) + " " + passage), (300, None), (301, ""), (None, passage), (302, prose(3) * 2)]
    out = {x.doc_id: x for x in repeated_passages(docs(spark, rows)).collect()}
    assert set(out) == {*range(12), 200, None}
    texts = dict(rows)
    for i, x in out.items():
        for a, b in (map(int, s.split(":")) for s in x.spans.split(",")):
            assert texts[i][a:b].strip() in f" {passage} " and b - a >= 100
    assert out[0].first_ids == [] and out[0].removed == "" and 0 in out[5].first_ids and out[5].removed_chars == out[5].repeated_chars
    kept = docs(spark, rows).join(spark.createDataFrame([(5, out[5].removed)], "doc_id long, removed string"), "doc_id").select(remove_spans(F.col("text"), F.col("removed"))).first()[0]
    assert len(kept) == len(texts[5]) - out[5].removed_chars
    assert repeated_passages(docs(spark, [])).collect() == []


def plain_passages(rows, min_chars=100):
    """The query's rows by a plain count of all chunks."""
    places, own = defaultdict(list), []
    for row, (i, text) in enumerate(rows):
        data, at, mine = (text or "").encode(), 0, []
        for end in cuts(data, 24, 4, 128):
            start = len(data[:at].decode())
            mine.append((start, start + len(data[at:end].decode()), data[at:end]))
            places[data[at:end]].append((i is None, i or 0, row, start, i))
            at = end
        own.append(mine)
    out = Counter()
    for row, (i, _) in enumerate(rows):
        islands = []
        for a, b, c in own[row]:
            if len(places[c]) > 1:
                first = min(places[c], key=lambda x: x[:4])
                if not islands or islands[-1][-1][1] < a:
                    islands.append([])
                islands[-1].append((a, b, first[2:4] == (row, a), first[4] if first[2] != row else None))
        islands = [x for x in islands if x[-1][1] - x[0][0] >= min_chars]
        removed = []
        for x in islands:
            for k, (a, b, is_first, _) in enumerate(x):
                if not is_first and k and not x[k - 1][2]:
                    removed[-1] = (removed[-1][0], b)
                elif not is_first:
                    removed.append((a, b))
        spans = [(x[0][0], x[-1][1]) for x in islands]
        listed = lambda z: ",".join(f"{a}:{b}" for a, b in z)
        if spans:
            firsts = tuple(sorted({f for x in islands for *_, f in x if f is not None}))
            out[i, len(spans), sum(b - a for a, b in spans), sum(b - a for a, b in removed), listed(spans), listed(removed), firsts] += 1
    return out


def test_passages_equal_a_plain_count_of_chunks(spark):
    r = random.Random(12)
    prose = lambda n: " ".join("".join(r.choices("abcdefghij", k=r.randrange(2, 9))) for _ in range(n))
    shared = [prose(60) for _ in range(4)]
    inside = prose(80)
    rows = [(i if i % 5 else None if i % 10 else 3, " ".join(r.choice([prose(20), r.choice(shared)]) for _ in range(6))) for i in range(60)]
    rows += [(900, f"{inside} {prose(30)} {inside}"), (901, prose(50) + " " + "the very same line of a page " * 40), *TEXTS]
    got = Counter((x.doc_id, x.n_spans, x.repeated_chars, x.removed_chars, x.spans, x.removed, tuple(x.first_ids)) for x in repeated_passages(docs(spark, rows)).collect())
    assert got == plain_passages(rows)
    assert any(k[0] == 900 and k[-1] == () and k[3] > 300 for k in got)  # a passage that repeats inside one document


def test_hot_digests_are_dealt_to_parts(spark, monkeypatch):
    rows = [(i, "the very same line of text, longer than a hundred characters, that all of these documents hold in one place or another " + "z" * (i % 7)) for i in range(300)]
    monkeypatch.setattr("sieveyard.llm.substrings.HOT_SHARE", 64)
    got = Counter((x.doc_id, x.n_spans, x.repeated_chars, x.removed_chars, x.spans, x.removed, tuple(x.first_ids)) for x in repeated_passages(docs(spark, rows)).collect())
    assert got == plain_passages(rows)


def test_chunk_edges(spark):
    df = docs(spark)
    own = chunks(df, "doc_id", "text", 24, 4, 128).groupBy("id").agg(F.max("end").alias("n")).collect()
    sizes = {x.id: x.n for x in own if x.id is not None}
    assert sizes == {i: len(t) for i, t in TEXTS if i is not None and t}
    out = {x.doc_id: x for x in repeated_passages(df).collect()}
    assert out[2].spans == f"0:{len(BASE)}" and out[2].first_ids == [1] and {1, 2, 3} <= set(out) and not {4, 5, 7, 13} & set(out)


# --- language model


@pytest.mark.parametrize("n", [0, 1, 2, 500, 70_000])
def test_elias_fano(tmp_path, n):
    rng = np.random.default_rng(n)
    values = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
    write_arrays(str(tmp_path / "a"), named("k", encode(values, 64)))
    own = Sequence(part("k", map_arrays(str(tmp_path / "a"))))
    assert (own.find(values) == np.arange(len(values))).all() and (own.find(values + np.uint64(1))[~np.isin(values + np.uint64(1), values)] == -1).all()
    assert (own.get(np.arange(len(values))) == values).all()
    small = np.sort(rng.integers(0, 50, n).astype(np.uint64))
    assert (Sequence(encode(small, 6)).get(np.arange(n)) == small).all()
    groups = np.sort(rng.integers(0, max(n // 7, 1), n).astype(np.uint64))
    keyed = np.sort(groups << np.uint64(40) | rng.integers(0, 2**40, n).astype(np.uint64))
    if n:
        own = Sequence(encode(keyed, 60, 40))
        first, end = own.bucket(np.arange(own.top))
        assert [list(range(a, b)) for a, b in zip(first, end)] == [np.flatnonzero(keyed >> np.uint64(40) == g).tolist() for g in range(own.top)]
        rank = (keyed >> np.uint64(40)).astype(int)
        assert (keyed[own.search(first[rank], end[rank], keyed & np.uint64(2**40 - 1))] == keyed).all()


def test_quantised_values_are_near():
    p = np.random.default_rng(1).random(20_000) * 0.9 + 1e-4
    q = quantised(p)
    assert np.abs(np.log10(q["book"][q["codes"]]) - np.log10(p)).mean() < 0.01
    few = quantised(np.array([0.5, 0.25, 0.5]))
    assert (few["book"][few["codes"]] == [0.5, 0.25, 0.5]).all()


def test_scores_against_brute_force(spark):
    r = random.Random(11)
    vocabulary = [f"w{i}" for i in range(60)]
    rows = [*TEXTS, *[(i, " ".join(r.choices(vocabulary, range(60, 0, -1), k=r.randrange(0, 80)))) for i in range(1000, 1300)]]
    out = held_out_scores(docs(spark, rows), order=2).collect()
    assert len(out) == len(rows)
    unigrams, pairs = Counter(), Counter()
    for i, t in rows:
        if not held_out(i):
            w = [*words(t), None]
            unigrams.update(w)
            pairs.update(zip([0, *w], w))
    contexts, types = Counter(), Counter()
    for (a, _), n in pairs.items():
        contexts[a] += n
        types[a] += 1
    total, v = sum(unigrams.values()), len(unigrams)
    want = Counter()
    for i, t in rows:
        w = [*words(t), None]
        base = score = 0.0
        for a, b in zip([0, *w], w):
            p = (unigrams[b] + 1) / (total + v + 1)
            base += math.log10(p)
            score += math.log10((max(pairs[a, b] - 0.75, 0) + 0.75 * types[a] * p) / contexts[a] if contexts[a] else p)
        want[(i, held_out(i), len(w), sum(unigrams[x] > 0 for x in w), total, round(base, 6))] += 1
        match = [x for x in out if x.doc_id == i and x.n_tokens == len(w) and abs(x.base_score - base) < 1e-6]
        assert match and min(abs(x.score - score) for x in match) <= 0.03 * len(w)
    assert Counter((x.doc_id, x.held_out, x.n_tokens, x.n_known, x.train_tokens, round(x.base_score, 6)) for x in out) == want


@pytest.mark.parametrize("order", [2, 3, 4])
def test_scores_of_every_order_against_brute_force(spark, order):
    r = random.Random(order)
    vocabulary = [f"w{i}" for i in range(25)]
    rows = [*TEXTS, *[(i, " ".join(r.choices(vocabulary, range(25, 0, -1), k=r.randrange(0, 60)))) for i in range(1000, 1200)]]
    grams = defaultdict(Counter)  # context, a tuple of words: counts of the words after it
    for i, t in rows:
        if not held_out(i):
            w = [0] * (order - 1) + [*words(t), None]
            for at in range(order - 1, len(w)):
                for n in range(order):
                    grams[tuple(w[at - n : at])][w[at]] += 1
    total, v = sum(grams[()].values()), len(grams[()])

    def p(context, word):
        if not context:
            return (grams[()][word] + 1) / (total + v + 1)
        own = grams.get(context)
        lower = p(context[1:], word)
        return (max(own[word] - 0.75, 0) + 0.75 * len(own) * lower) / sum(own.values()) if own else lower

    want = {}
    for i, t in rows:
        w = [0] * (order - 1) + [*words(t), None]
        want.setdefault(i, []).append(sum(math.log10(p(tuple(w[at - order + 1 : at]), w[at])) for at in range(order - 1, len(w))))
    out = held_out_scores(docs(spark, rows), order=order).collect()
    assert len(out) == len(rows)
    for x in out:
        assert min(abs(x.score - y) for y in want[x.doc_id]) <= 0.03 * x.n_tokens


def test_scores_of_nothing(spark):
    assert held_out_scores(docs(spark, [])).collect() == []
    one = held_out_scores(docs(spark, [(next(i for i in range(50) if held_out(i)), "only held out")])).first()
    assert (one.train_tokens, one.n_known, one.n_tokens, one.score) == (0, 0, 4, 0.0)
