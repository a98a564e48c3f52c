"""Queries do the whole of their job: nothing seen is left out."""

import math
import random
import zlib
from collections import Counter

import pytest

from pyspark.sql import functions as F

from scriptorium.llm import katz, pii, queries


def test_katz_query_prices_bigrams_seen_once(spark, tmp_path, monkeypatch):
    rng = random.Random(16)
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(rng.choices(words, [1 / (i + 1) for i in range(60)], k=rng.randrange(40))) for _ in range(150)] + [None, "", "Never seen"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(katz, "MOST_HEAD", 12)
    monkeypatch.setattr(katz, "HEAD_WORDS", 8)
    got = {r["doc_id"]: r["score"] for r in queries.QUERIES["op4_katz"](spark, str(tmp_path)).collect()}

    tokens = {i: [*(t or "").lower().split(), "</s>"] for i, t in enumerate(texts)}
    c, pairs = Counter(), Counter()
    for i, w in tokens.items():
        if zlib.crc32(str(i).encode()) % 10:
            c.update(w)
            pairs.update(zip(["<s>", *w[:-1]], w, strict=True))
    assert 1 in pairs.values()
    n = sum(c.values())
    d1, d2 = katz.discounts(Counter(c.values())), katz.discounts(Counter(pairs.values()))
    p = {w: d1.get(k, 1) * k / (n + 1) for w, k in c.items()}
    unknown = 1 - sum(p.values())
    context = {**c, "<s>": c["</s>"]}

    def prob(a, w):
        if pairs[a, w]:
            return d2.get(pairs[a, w], 1) * pairs[a, w] / (context[a] + 0.5)
        own = {x: k for (b, x), k in pairs.items() if b == a and k}
        alpha = (1 - sum(d2.get(k, 1) * k for k in own.values()) / (context.get(a, 0) + 0.5)) / (1 - sum(p[x] for x in own))
        return alpha * p.get(w, unknown)

    for i, w in tokens.items():
        assert got[i] == pytest.approx(sum(math.log10(prob(a, x)) for a, x in zip(["<s>", *w[:-1]], w, strict=True)))
    assert sum(prob("w0", w) for w in c) + prob("w0", "nothing like it") == pytest.approx(1)


def test_cards_beside_other_numbers_are_found(spark):
    card, short = "4111 1111 1111 1111", "378282246310005"
    joined = card.replace(" ", "")
    texts = [f"{joined} 12", f"{card} 2024", f"2024 {card}", f"12 {joined} 99 {short} 7", f"7536784127813050 {joined}", f"{card} 2024-01-05", f"{card} 192.168.0.1", f"no {'7 ' * 200}{joined}", card, "1234 5678 1234 5678 12"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(2)
    out = pii.pseudonymise(rows, "k").cache()
    got = {r["doc_id"]: r for r in out.collect()}
    for i, t in enumerate(texts[:-1]):
        assert "card" in got[i]["pii"] and card not in got[i]["text"] and joined not in got[i]["text"] and short not in got[i]["text"]
        assert i == 6 or len(got[i]["text"]) == len(t)
    assert got[3]["pii"] == ["card", "card"] and got[5]["pii"] == ["card", "date"] and got[6]["pii"] == ["card", "ip"]
    many = spark.range(300).select(F.col("id").alias("doc_id"), F.format_string("2024 4111 1111 %04d 11", F.col("id")).alias("text"))
    for first in (rows, many):
        again = pii.pseudonymise(pii.pseudonymise(first, "k").drop("pii"), "k", back=True)
        assert {r["doc_id"]: r["text"] for r in again.collect()} == {r["doc_id"]: r["text"] for r in first.collect()}
