import hashlib
import random
import re
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from scriptorium.llm import bpe, chat, common, decontaminate, embeddings, katz, licenses, pii, secrets, simhash, toxicity

ODD = [None, "", "  \n\t ", "İx Σας 'S don't <|endoftext|>a", "a" * 5000, "token = abcdef123 " * 300, "é́  x\x1fy", "same", "same"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i if i != 3 else None, t, "id", "span", 0) for i, t in enumerate(ODD)]
    return spark.createDataFrame(rows, "doc_id long, text string, print string, spans string, key int").repartition(2)


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe.tokenizer_path())


def by_text(docs, frame):
    return {(r["doc_id"]): r for r in frame.collect()}


def test_bpe_equals_the_library(docs, library):
    got = by_text(docs, bpe.digest(docs))
    for row in docs.collect():
        ids = library.encode(row["text"] or "", add_special_tokens=False).ids
        r = got[row["doc_id"]]
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_bpe_words_split_as_the_library_splits_them(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_WORDS", 4)
    monkeypatch.setattr(bpe, "GROUP", 20)
    own = bpe.Codec(bpe.tokenizer_path())
    spaces = [chr(i) for i in range(0x3001) if chr(i).isspace()]
    texts = [f"Ab{c}cd{c}{c}don't{c}x<|endoftext|>y <|endoftext|>{c}1\u0301 e\u0301{c}<|ENDOFTEXT|>" for c in spaces]
    texts += ["", None, "   ", "\x1c", "a\x1fb\u2003c", "same words " * 50, "same words"]
    for text, (ids, decoded) in zip(texts, own.encode_all(texts), strict=True):
        want = library.encode(text or "", add_special_tokens=False).ids
        assert list(memoryview(ids).cast("I")) == want
        assert decoded == library.decode(want, skip_special_tokens=False)


def test_bpe_trees_equal_whole_words(library):
    rng = random.Random(3)
    own = bpe.Codec(bpe.tokenizer_path(), leaf=8)
    for letters in ("ab", "the", "aeiostrnl", "éüxñ", "-=!"):
        for _ in range(60):
            word = "".join(rng.choice(letters) for _ in range(rng.randrange(9, 200)))
            assert own.long_word(word) == library.encode(word, add_special_tokens=False).ids


def test_secret_scan_equals_plain_search(docs):
    rng = random.Random(4)
    texts = ["".join(rng.choice(["token", "api_key", "APIKEY", "passwd", "AKIA", "'", '"', " ", "=", ":", "abcdef0123", "X9", "\n", "é", "ſecret", "ghp_"]) for _ in range(rng.randrange(60))) for _ in range(400)]
    for text, got in zip(texts, secrets.scanner().find(texts), strict=True):
        want = [(m.start(), k, m.end()) for k, (_, p, g, least) in enumerate(secrets.RULES) for m in re.finditer(p, text, re.ASCII) if len(m[g]) >= least]
        assert [(s, secrets.scanner().order[k], e) for k, s, e in got] == sorted(want)
    assert secrets.trigram_query(secrets.RULES[2][1]) is True and secrets.trigram_query(secrets.RULES[0][1]) is not True
    assert secrets.digest(docs).count() == len(ODD)
    assert secrets.redact(docs).columns == docs.columns
    assert secrets.cover("a token=abcdef b", [("assign", 2, 14)]) == "a [ASSIGN] b"


def test_decontamination_equals_brute_force(spark):
    rng = random.Random(5)
    vocabulary = ["a", "B", "c1", "é"]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(n))) for i, n in enumerate([3, 10, 12, 15, 1])] + [(9, None), (10, "...")]
    texts = [", ".join(rng.choice([*vocabulary, "zz"]) for _ in range(rng.randrange(80))) for _ in range(60)] + [items[2][1].upper(), None, "", "x" * 9000]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    windows = {}
    for i, t in items:
        w = [x.decode() for x in decontaminate.words_of(t)]
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[k : k + n]), set()).add(str(i))
    got = {r["doc_id"]: r for r in decontaminate.digest(d, b).collect()}
    split = {r["doc_id"]: r for r in decontaminate.scan(d, b, most=30).collect()}
    for i, t in enumerate(texts):
        w = [x.decode() for x in decontaminate.words_of(t)]
        hit, found = set(), set()
        for n in {len(k) for k in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    found |= windows[tuple(w[k : k + n])]
                    hit.update(range(k, k + n))
        assert (got[i]["n_words"], got[i]["n_hit"], got[i]["n_items"]) == (len(w), len(hit), len(found))
        assert got[i]["items_sha256"] == hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        assert sum(s["end"] - s["start"] for s in split[i]["spans"]) == len(hit) and split[i]["items"] == sorted(found)
    assert {r["doc_id"] for r in decontaminate.clean(d, b).collect()} == {i for i in got if not got[i]["contaminated"]}
    assert decontaminate.scan(d, b.limit(0)).where(F.size("spans") > 0).isEmpty()
    assert decontaminate.digest(d.limit(0), b).count() == 0


def test_katz_equals_brute_force_also_off_the_head(spark, monkeypatch):
    import math
    from collections import Counter

    rng = random.Random(6)
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(rng.choices(words, [1 / (i + 1) for i in range(60)], k=rng.randrange(40))) for _ in range(150)] + [None, "", "Never seen"]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    monkeypatch.setattr(katz, "MOST_HEAD", 12)
    monkeypatch.setattr(katz, "HEAD_WORDS", 8)
    got = {r["doc_id"]: r for r in katz.digest(d).collect()}
    import zlib

    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in got}
    tokens = {i: [*(t or "").lower().split(), "</s>"] for i, t in enumerate(texts)}
    c, pairs = Counter(), Counter()
    for i, w in tokens.items():
        if not held[i]:
            c.update(w)
            pairs.update(zip(["<s>", *w[:-1]], w, strict=True))
    n, v = sum(c.values()), len(c)
    d1, d2 = katz.discounts(Counter(c.values())), katz.discounts(Counter(pairs.values()))
    p = {w: d1.get(k, 1) * k / (n + 1) for w, k in c.items()}
    unknown = 1 - sum(p.values())
    context = {**c, "<s>": c["</s>"]}

    def prob(a, w):
        if pairs[a, w] >= 2:
            return d2.get(pairs[a, w], 1) * pairs[a, w] / (context[a] + 0.5)
        own = {x: k for (b, x), k in pairs.items() if b == a and k >= 2}
        alpha = (1 - sum(d2.get(k, 1) * k for k in own.values()) / (context.get(a, 0) + 0.5)) / (1 - sum(p[x] for x in own))
        return alpha * p.get(w, unknown)

    for i, w in tokens.items():
        assert got[i]["n_tokens"] == len(w) and got[i]["train_tokens"] == n and got[i]["held_out"] == held[i]
        assert got[i]["n_known"] == sum(x in c for x in w)
        assert got[i]["base_score"] == pytest.approx(sum(math.log10((c.get(x, 0) + 0.1) / (n + 0.1 * (v + 1))) for x in w))
        assert got[i]["score"] == pytest.approx(sum(math.log10(prob(a, x)) for a, x in zip(["<s>", *w[:-1]], w, strict=True)))
    assert sum(prob("w0", w) for w in c) + prob("w0", "nothing like it") == pytest.approx(1)


def test_chat_reads_back(spark):
    rng = random.Random(7)
    rows = [(c, t, ["system", "user", "assistant"][min(t, 1 + t % 2)] if c % 2 == 0 else rng.choice(["user", "assistant", "a: #\\<"]), rng.choice(["\\### Assistant: </turn> ok", "x" * rng.randrange(3000), "", "a\nb </turn>\n", "\\h\\s\\l", None]))
            for c in range(8) for t in range(rng.randrange(1, 40))]
    rows += [(None, None, None, None), (99, 0, "assistant", "same"), (99, 0, "assistant", "same")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: r for r in chat.digest(df).collect()}
    for conv in {r[0] for r in rows}:
        own = sorted(((t if t is not None else -1), r or "", x or "") for c, t, r, x in rows if c == conv)
        loss = "".join(x for _, r, x in own if r == "assistant")
        r = got[conv]
        assert r["n_turns"] == len(own) and r["loss_chars"] == len(loss)
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for _, a, b in own).encode()).hexdigest()
        assert r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    small = {r["conv_id"]: r["n_windows"] for r in chat.digest(df.where("conv_id < 8")).collect()}
    assert max(small.values()) > 1
    blocked = chat.windows(df, block=3).orderBy("conv_id", "window").select("conv_id", "window", "formatted").collect()
    assert blocked == chat.windows(df).orderBy("conv_id", "window").select("conv_id", "window", "formatted").collect()


def test_toxic_segments_and_held_out_accuracy(spark):
    rng = np.random.default_rng(8)
    for _ in range(200):
        x = rng.normal(-0.3, 1, rng.integers(0, 12))
        best = max((x[i:j].sum() for i in range(len(x)) for j in range(i + 1, len(x) + 1)), default=0)
        found = toxicity.segments(x)
        assert max((s for *_, s in found), default=0) == pytest.approx(max(best, 0))
        assert all(a[1] <= b[0] for a, b in zip(found, found[1:], strict=False))
    sf = "/root/testdata/sf0.1"
    docs, labels = common.table(spark, sf, "documents"), common.table(spark, sf, "labels")
    out = toxicity.digest(docs, labels).join(labels, "doc_id").where("held_out").groupBy("toxic", "predicted").count().collect()
    n = {(r["toxic"], r["predicted"]): r["count"] for r in out}
    assert n[1, 1] / (n[1, 1] + n.get((1, 0), 0)) > 0.85 and n.get((0, 1), 0) / n[0, 0] < 0.01
    odd = spark.createDataFrame([(1, None), (None, ""), (2, "x " * 5000)], "doc_id long, text string")
    assert toxicity.score(odd, toxicity.fit(odd, labels.limit(0))).count() == 3


def test_simhash_equals_brute_force(spark):
    rng = random.Random(9)
    base = [[f"w{rng.randrange(500)}" for _ in range(80)] for _ in range(6)]
    texts = []
    for words in base:
        for _ in range(25):
            own = list(words)
            for _ in range(rng.randrange(3)):
                own[rng.randrange(len(own))] = f"w{rng.randrange(500)}"
            texts.append(" ".join(own))
    texts += [None, "", "One two", "ONE two"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    prints = np.array([simhash.fingerprint(t) for t in texts])
    label = list(range(len(texts)))
    for _ in range(len(texts)):
        new = [min(label[j] for j in np.flatnonzero(np.bitwise_count((prints ^ prints[i]).view(np.uint64)) <= 4)) for i in range(len(texts))]
        if new == label:
            break
        label = new
    got = {r["doc_id"]: r for r in simhash.digest(df).collect()}
    assert [got[i]["component_id"] for i in range(len(texts))] == label
    assert got[0]["fingerprint"] == f"{int(prints[0]) & (2**64 - 1):016x}"
    assert sorted(r["doc_id"] for r in simhash.dedup(df).collect()) == sorted(set(label))
    assert simhash.digest(df.limit(0)).count() == 0


def test_golay_keys_meet_within_four_bits():
    rng = np.random.default_rng(10)
    a = rng.integers(-(2**63), 2**63 - 1, 400)
    b = a.copy()
    for i in range(len(b)):
        for bit in rng.choice(64, rng.integers(0, 5), replace=False):
            b[i] ^= np.int64(np.uint64(1) << np.uint64(bit)) if bit < 63 else np.int64(-(2**63))
    rows_a, keys_a = simhash.keys(a)
    rows_b, keys_b = simhash.keys(b)
    assert all(set(keys_a[rows_a == i]) & set(keys_b[rows_b == i]) for i in range(len(a)))


def test_embedding_links_equal_brute_force(spark):
    rng = np.random.default_rng(11)
    base = rng.normal(size=(40, 32))
    rows = [(int(i), [float(x) for x in base[i % 40] + rng.normal(0, 0.06, 32)], int(i % 3 == 0)) for i in range(200)]
    rows += [(300 + k, rows[0][1], rows[0][2]) for k in range(30)]
    rows += [(900, None, 1), (901, [0.0] * 32, 1), (902, [float("nan")] * 32, 1), (903, rows[0][1], None), (904, [1.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: r for r in embeddings.near_copies(df, block=16).collect()}
    assert len(got) == len(rows)
    sound = rows[:230]
    x = embeddings.unit([r[1] for r in sound])
    same = np.array([r[2] for r in sound])[:, None] == np.array([r[2] for r in sound])[None, :]
    close = (x @ x.T >= 0.98) & same
    np.fill_diagonal(close, False)
    found, true = sum(got[r[0]]["n_links"] for r in sound), int(close.sum())
    assert 0.9 * true <= found <= true
    assert all(got[r[0]]["n_links"] <= n for r, n in zip(sound, close.sum(1), strict=True))
    assert all(got[i]["n_links"] == 0 and got[i]["kept"] for i in (900, 901, 902, 903, 904))
    assert embeddings.near_copies(df.limit(0)).count() == 0


def test_licences(spark):
    rows = [(1, "x\nReleased under the MIT License.\ny"), (2, "Licensed under CC BY-NC 4.0."), (3, "He lost his driver license."), (4, None), (5, ""), (None, "Licensed under the Apache License, Version 2.0.\nAll rights reserved. Copyright.")]
    got = {r["doc_id"]: r for r in licenses.digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i]["families"] for i in (1, 2, 3, 4, 5, None)] == ["MIT", "CC-BY-NC-4.0", "", "", "", "Apache-2.0"]
    assert got[3]["n_unknown"] == 1 and got[None]["n_paragraphs"] == 2


def test_pseudonyms_keep_format_and_turn_back(spark):
    texts = ["card 4111 1111 1111 1111 and 4952935900253052, on 2024-02-29 by ab.12@mail7.example.com from 144.137.247.239 tel +1 (017) 555-7713.", "again 144.137.247.239", "999.1.1.1 2023-02-30 1234567890123456", None, "", "none"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = pii.pseudonymise(df, "k")
    got = {r["doc_id"]: r for r in out.collect()}
    a = got[0]["text"]
    assert re.fullmatch(r"card \d{4} \d{4} \d{4} \d{4} and \d{16}, on \d{4}-\d\d-\d\d by [a-z]{2}\.\d\d@mail7\.example\.com from [\d.]+ tel \+\d \(\d{3}\) \d{3}-\d{4}\.", a)
    assert a != texts[0] and re.search(r"from ([\d.]+) tel", a)[1] == got[1]["text"].split()[1] != "144.137.247.239"
    card = re.search(r"\d{4} \d{4} \d{4} \d{4}", a)[0].replace(" ", "")
    assert sum(int(c) if k % 2 == 0 else sum(map(int, str(2 * int(c)))) for k, c in enumerate(reversed(card))) % 10 == 0
    assert [got[i]["text"] for i in (2, 3, 4, 5)] == texts[2:]
    back = {r["doc_id"]: r["text"] for r in pii.pseudonymise(out.drop("pii"), "k", back=True).collect()}
    assert [back[i] for i in range(6)] == texts


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 101), (101, 100), (5, 5)] + [(200, 200 + k) for k in range(1, 40)]
    got = {r["node"]: r["component"] for r in common.least_label(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(31)) and got[101] == 100 and all(got[200 + k] == 200 for k in range(40))


def test_pipeline_keeps_columns(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = common.table(spark, sf, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf).columns == docs.columns
    out = corpus_pipeline.run(spark, sf).toPandas().set_index("doc_id")
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    model = toxicity.fit(docs, common.table(spark, sf, "labels"), lambda i: ~toxicity.held_out(i))
    kept = {i for i, t in rows.items() if model.probability(t) < toxicity.THRESHOLD}
    left = docs.where(F.col("doc_id").isin([int(i) for i in kept]))
    kept = {r["doc_id"] for r in simhash.components(left).collect() if r["doc_id"] == r["component_id"]}
    items = tuple((str(r["item_id"]), r["text"]) for r in common.table(spark, sf, "benchmark").collect())
    kept = {i for i in kept if not decontaminate.Windows(items).hits(rows[i])[1]}
    assert set(out.index) == kept
    i = next(iter(kept))
    covered = secrets.cover(rows[i], next(iter(secrets.scanner().find([rows[i]]))))
    assert out.loc[i, "text"] == covered and bytes(out.loc[i, "token_ids"]) == bpe.codec("word_bpe_49k.json").encode(covered)[0]
