"""Rows that every operator must take: nulls, empty and long texts, ties, repeats, other scripts, clashing names."""

import zlib

LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(40_000))
RUN = "a" * 100_000 + " " + "1" * 100_000 + " " * 5_000 + "@" * 1_000
BASE = " ".join(f"term{i}" for i in range(120))

TEXTS = [
    (1, BASE), (2, BASE), (3, BASE.replace("term7 ", "other ")), (4, None), (5, ""), (6, "  \n\t "), (7, "one two"), (8, LONG), (9, RUN), (10, "Été naïve 漢字 😀 " * 30),
    (11, BASE.upper()), (11, BASE.upper()), (12, "mail a.b@c.de and 1.2.3.4 or +1 (555) 555-0100 ok"), (None, BASE), (None, "no id here at all"), (13, "one two"),
]
SCHEMA = "doc_id long, text string"


def docs(spark, rows=None, extra=True):
    """A documents table; extra columns carry names that operators might use themselves."""
    rows = TEXTS if rows is None else rows
    df = spark.createDataFrame([(*r, "src", 1, "x", 2.0) for r in rows], f"{SCHEMA}, source string, node long, key string, n double")
    return df if extra else df.select("doc_id", "text")


def words(text):
    return (text or "").encode().lower().split()


def shingles(text, size=5):
    w = words(text)
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2
