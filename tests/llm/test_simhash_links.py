"""What the search for like texts moves: those that stand in a pair, and no others."""

import random

import pytest
from pyspark.sql import functions as F

from sieveyard.llm import simhash as S


def _texts() -> list[str]:
    rng = random.Random(3)
    out = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(rng.randrange(5, 400))) for _ in range(60)]
    for k in range(12):  # near copies, a longer one of each, and a passage that many hold
        words = out[k].split()
        out += [" ".join([*words, "end"]), " ".join(words + words[::-1])]
    return [t + " all of these share one passage" * (i % 3 == 0) for i, t in enumerate(out)]


def _links(texts: list[str]) -> set[frozenset[int]]:
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} or {tuple(w)} for w in map(str.split, texts)]
    comp = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                old, new = comp[a], comp[b]
                comp = [new if c == old else c for c in comp]
    return {s for c in set(comp) if len(s := frozenset(i for i, x in enumerate(comp) if x == c)) > 1}


@pytest.mark.parametrize("most", [S.MOST_SENT, -1])
def test_few_members_go_to_the_texts(spark, monkeypatch, most):
    monkeypatch.setattr(S, "MOST_SENT", most)
    plans, write = [], S.written

    def seen(df, name, keep=False):
        if name == "simhash-members":
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, name, keep)

    monkeypatch.setattr(S, "written", seen)
    texts = _texts()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if the tables were large
    try:
        with S.scratch(spark):
            rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", "t", F.xxhash64("t").alias("h"))
            ids = {r.h: r.i for r in rows.select("h", "i").collect()}
            got = S.like_texts(rows.select("t", "h")).groupBy("comp").agg(F.collect_list("h").alias("m")).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert {frozenset(ids[h] for h in r.m) for r in got} == _links(texts)
    assert plans and all(("BroadcastHashJoin" in p) == (most > 0) for p in plans)
