"""Each opN_ query over a driver's table, against a brute force of its contract."""

import hashlib
import math
import re
import zlib
from collections import Counter

import public_tokenizers
import pytest

import __spark_entry__
from sieveyard.llm.html_text import main_texts, trained
from sieveyard.llm.tokenizer import encoding
from sieveyard.llm.url_filter import RULES

from .test_text_operators import PATTERNS, plain_bootstrap, plain_passages, plain_spans

SF = "/root/testdata/sf0.001"
KINDS = ("email", "ip", "card", "phone")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def rows(spark):
    return [(r.doc_id, r.text or "", r.source) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


@pytest.fixture
def result(spark, request):
    return __spark_entry__.queries()[request.function.__name__.removeprefix("test_")](spark, SF).collect()


def digest(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def test_op1_substring_dedup(result, rows):
    got = Counter((x.doc_id, x.n_spans, x.repeated_chars, x.removed_chars, x.spans, x.removed, tuple(x.first_ids)) for x in result)
    assert got == plain_passages([r[:2] for r in rows]) and len(result) > 5


def test_op2_personal_data(result, rows):
    added = plain_bootstrap([t for _, t, _ in rows])
    want = Counter()
    for k, (i, text, _) in enumerate(rows):
        base = plain_spans(text)
        every = sorted([*base, *((a, b, kind) for (at, a, b), kind in added.items() if at == k)], key=lambda x: (x[0], x[2]))
        listed = lambda spans: ",".join(f"{KINDS[n]}:{a}:{b}" for a, b, n in spans)
        want[i, *(sum(n == kind for *_, n in base) for kind in range(len(PATTERNS))), digest(listed(base)), listed(every)] += 1
    assert Counter((x.doc_id, x.n_email, x.n_ip, x.n_card, x.n_phone, x.base_sha256, x.spans) for x in result) == want
    assert sum(x.n_email + x.n_ip + x.n_card + x.n_phone for x in result) > 3


def test_op3_url_templates(result, spark):
    got = {x.page_id: x for x in result}
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url").collect()
    assert len(result) == len(pages)
    for page in pages:
        after = page.url.partition("://")[2] if page.url and "://" in page.url else ""
        host = re.match("[^/?#]*", after)[0]
        path, host = re.match("[^?#]*", after[len(host) :])[0], "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        fits = [(len(rule), rule, what) for what, rule in RULES if f".{host}".endswith("." + rule.partition("/")[0]) and path.startswith("/" + rule.partition("/")[2])]
        x = got[page.page_id]
        assert (x.host, x.path, x.rule) == (host, path, max(fits)[1] if fits else None)
        assert x.verdict == (max(fits)[2] if fits else "block" if x.purity >= 0.8 else "allow")


def test_op5_lm_trie(result, rows):
    tokens = {i: [w.encode().lower() for w in WORD.findall(t)] + [None] for i, t, _ in rows}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i, *_ in rows}
    counts = Counter(w for i, ws in tokens.items() if not held[i] for w in ws)
    n, v = sum(counts.values()), len(counts)
    assert len(result) == len(rows)
    for x in result:
        own = tokens[x.doc_id]
        assert (x.held_out, x.n_tokens, x.n_known, x.train_tokens) == (held[x.doc_id], len(own), sum(counts[w] > 0 for w in own), n)
        assert x.base_score == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own), rel=1e-9) and math.isfinite(x.score) and x.score < 0
    model, base = (sum(getattr(x, c) for x in result if x.held_out) for c in ("score", "base_score"))
    assert model > base


def test_op6_simhash(result, rows):
    ordered = sorted(rows, key=lambda r: -r[0])
    got = {x.doc_id: x for x in result}
    by_text = {}
    assert len(result) == len(rows) == len(got)
    for k, (i, text, _) in enumerate(ordered):
        follower = ordered[(k + 1) % len(ordered)]
        m, x = len(text) // 2, got[i]
        assert (x.n_chars, x.edited_sha256) == (len(text), digest(text[: len(text) - m] + follower[1][:m]))
        apart = lambda a, b: bin(int(a, 16) ^ int(b, 16)).count("1")
        like = lambda bits: max(0.0, math.cos(math.pi * bits / 128))
        assert x.near_edited == pytest.approx(like(apart(x.fingerprint, x.edited_fingerprint))) and x.near_next == pytest.approx(like(apart(x.fingerprint, got[follower[0]].fingerprint)))
        assert by_text.setdefault(text, x.fingerprint) == x.fingerprint
    assert sum(x.near_edited > x.near_next for x in result) > 0.95 * len(result)


def test_op7_main_text(result, spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    assert len(result) == len(pages)
    for x in result:
        assert x.url == pages[x.page_id].url and x.n_chars == len(x.text) and x.text == main_texts([pages[x.page_id].html], trained())[0]
        assert x.text and not re.search(r"<[a-zA-Z/!]|&[a-z]+;|\s{2}", x.text)


def test_op8_quality_rules(result, rows):
    got = {x.doc_id: x for x in result}
    assert len(result) == len(rows)
    for i, text, _ in rows:
        words = WORD.findall(text)
        windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
        times = Counter(windows)
        repeat = {k + j for k, w in enumerate(windows) if times[w] > 1 for j in range(3)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        x = got[i]
        want = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeat))
        assert (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words) == want
        assert x.base_failed == (len(words) < 50 or 100 * len(repeat) > 50 * len(words)) and not (x.base_failed and x.kept)
    assert any(x.kept for x in result)


def test_op9_source_mix(result, rows):
    sizes, source_of = {i: len(WORD.findall(t)) for i, t, _ in rows}, {i: s for i, _, s in rows}
    names = sorted({s for *_, s in rows}, key=lambda s: (s is None, s or ""))
    own = {s: sum(sizes[i] for i in sizes if source_of[i] == s) for s in names}
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    full = set()
    while True:  # those above twice their size stop there; the rest share what is left
        left = 1.5 * sum(own.values()) - sum(2 * own[s] for s in full)
        target = {s: 2.0 * own[s] if s in full else left * weight[s] / sum(weight[x] for x in names if x not in full) for s in names}
        more = {s for s in names if target[s] > 2 * own[s]}
        if not more:
            break
        full |= more
    taken = Counter()
    assert sorted(x.doc_id for x in result) == sorted(sizes)
    for x in result:
        s = source_of[x.doc_id]
        assert (x.size, x.source_size) == (sizes[x.doc_id], own[s]) and x.target == pytest.approx(target[s]) and 0 <= x.taken <= 2 * x.size
        taken[s] += x.taken
    assert all(abs(taken[s] - target[s]) <= max(0.02 * target[s], 32) for s in names)


def test_op10_byte_bpe(result, rows):
    enc = encoding(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    want = Counter()
    for i, text, _ in rows:
        ids = enc.encode_ordinary(text)
        want[i, len(ids), digest(b"".join(t.to_bytes(4, "little") for t in ids)), digest(text)] += 1
    assert Counter((x.doc_id, x.n_tokens, x.ids_sha256, x.decoded_sha256) for x in result) == want
