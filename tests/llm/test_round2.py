"""Cases that reviews found: spans over blocks, many trigrams, repeated ids, labels that aren't integers, mail names."""

import random

from pyspark.sql import functions as F

from scriptorium.llm import bpe, chat, decontaminate, embeddings, pii, secrets, simhash


def test_spans_are_removed_from_the_given_text_whatever_the_block(spark):
    rng = random.Random(21)
    words = list("abcdefg")
    items = [(i, " ".join(rng.choices(words, k=rng.randrange(1, 5)))) for i in range(6)] + [(7, "k l m n o"), (8, "n o p q")]
    texts = [", ".join(rng.choices([*words, "zz"], k=rng.randrange(30))) for _ in range(40)] + ["p q a b k l m n o p q x", None, "", "k l m n o p q"]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, __hit_ranges0 string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    own = decontaminate.Windows([(str(i), t) for i, t in items], window=3)
    want = {i: decontaminate.without_spans(t, own.hits(t)[1]) if t else t for i, t in enumerate(texts)}
    for most in (1, 20, 1 << 20):
        out = decontaminate.clean(docs, benchmark, remove="spans", window=3, most=most)
        assert out.columns == docs.columns and {r["doc_id"]: r["text"] for r in out.collect()} == want
        kept = decontaminate.clean(docs, benchmark, window=3, most=most)
        assert {r["doc_id"] for r in kept.collect()} == {i for i, t in enumerate(texts) if not own.hits(t)[1]}


def test_secret_rules_may_have_many_trigrams():
    rng = random.Random(22)
    names = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=8)) for _ in range(80)]
    rules = tuple((n, f"{n}[0-9]+", 0, 0) for n in names)
    found = list(secrets.Scanner(rules).find([f"x {names[70]}12 {names[3]}9", "none"]))
    assert found == [[(names[70], 2, 12), (names[3], 13, 22)], []]


def test_repeated_ids_are_one_node_and_labels_are_kept_apart(spark):
    rows = [(1, [1.0, 0.0], 0.2), (1, [1.0, 0.0], 0.2), (2, [1.0, 0.0], 0.7), (3, [1.0, 0.0], 0.2), (4, [0.999, 0.01], 0.2)]
    got = [(r["vec_id"], r["n_links"], r["component_id"]) for r in embeddings.near_copies(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label double")).collect()]
    assert sorted(got) == [(1, 2, 1), (1, 2, 1), (2, 0, 2), (3, 2, 1), (4, 2, 1)]


def test_mail_names_are_permuted_and_turn_back(spark):
    names = ["bob.roe", "ann.lee", "a", "Z9", "x_y+1", "o-" * 20 + "k"]
    texts = [f"to {n}@mail.example.com now" for n in names] + ["010.0.0.1 and 10.0.0.1"]
    out = pii.pseudonymise(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "k")
    got = {r["doc_id"]: r["text"] for r in out.collect()}
    new = [got[i].split()[1].split("@")[0] for i in range(len(names))]
    assert all(len(a) == len(b) and [c.isalnum() for c in a] == [c.isalnum() for c in b] for a, b in zip(names, new, strict=True))
    shifts = [[(ord(y) - ord(x)) % 26 for x, y in zip(a, b, strict=True) if x.isalpha()] for a, b in zip(names[:2], new, strict=False)]
    assert shifts[0] != shifts[1]
    assert got[6].startswith("010.0.0.1 and ") and got[6] != texts[6]
    back = {r["doc_id"]: r["text"] for r in pii.pseudonymise(out.drop("pii"), "k", back=True).collect()}
    assert [back[i] for i in range(len(texts))] == texts
    short = spark.range(26 * 26).select(F.col("id").alias("doc_id"), F.concat(F.char(F.floor(F.col("id") / 26) + 97), F.char(F.col("id") % 26 + 97), F.lit("@a.example")).alias("text"))
    assert pii.pseudonymise(short, "k").select("text").distinct().count() == 26 * 26


def test_windows_with_system_turn_and_history_keep_the_budget(spark):
    rng = random.Random(23)
    rows = [(c, t, "system" if t == 0 and c % 3 else rng.choice(["user", "assistant"]), "x" * rng.randrange(rng.choice([50, 900, 3000]))) for c in range(9) for t in range(rng.randrange(1, 50))]
    rows += [(20, t, "system" if t == 0 else "user", "y" * 4400 if t == 0 else "z" * 30) for t in range(5)]
    out = chat.windows(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    for r in out:
        pieces = r["formatted"].split(chat.END)[:-1]
        sizes = [-(-len(p.split(": ", 1)[1]) // 4) + 8 for p in pieces]
        assert sum(sizes) <= chat.BUDGET or len(pieces) - r["n_repeated"] == 1
    assert sum(r["n_repeated"] for r in out) > 0 and any(len(r["formatted"].split(chat.END)) - 1 - r["n_repeated"] > 2 for r in out)


def test_leaves_in_parallel_give_the_whole_word():
    rng = random.Random(24)
    own = bpe.Codec(bpe.tokenizer_path(), leaf=64)
    for n in (64, 65, 1000, 5000):
        for letters in ("abcdefgh", "a", "abe\u00e9\u4e2d7-"):
            word = "".join(rng.choices(letters, k=n))
            for last in (False, True):
                assert own.tree(word, last) == own._part(word, last)


def test_decoded_texts_are_those_of_the_ids(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(bpe.tokenizer_path())
    texts = ["One text, two.", None, "", "y" * 9000, "a\u00e9 b", "One text, two."]
    docs = spark.createDataFrame([(i, t, "old", "x") for i, t in enumerate(texts)], "doc_id long, text string, token_ids string, decoded string")
    out = bpe.with_ids(docs, decoded="decoded")
    assert out.columns == ["doc_id", "text", "token_ids", "decoded"]
    for r in out.collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert [int.from_bytes(r["token_ids"][i : i + 4], "little") for i in range(0, len(r["token_ids"]), 4)] == ids
        assert r["decoded"] == library.decode(ids, skip_special_tokens=False)
    assert bpe.with_ids(docs).columns == ["doc_id", "text", "decoded", "token_ids"]
    texts_replaced = {r["text"].hex() for r in bpe.with_ids(docs, out="text").collect()}
    assert len(texts_replaced) == 4


def test_components_are_the_same_whichever_travel(spark, monkeypatch):
    rng = random.Random(25)
    words = [f"w{i}" for i in range(300)]
    base = [rng.choices(words, k=400) for _ in range(4)]
    rows = [(100 - 3 * i + k, " ".join(["new"] * (i % 2) + base[k][i // 4 :])) for k in range(3) for i in range(20)] + [(500, None), (None, "alone here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = []
    for most in (1, 3, 1000):
        monkeypatch.setattr(simhash, "MOST_HOT", most)
        found.append(sorted(map(tuple, simhash.digest(docs).collect()), key=str))
    assert found[0] == found[1] == found[2] and len(found[0]) == len(rows)
    prints = [(r["doc_id"], int(f, 16)) for r, f in [(r, r["fingerprint"]) for r in simhash.digest(docs).collect()]]
    least = dict.fromkeys(range(len(prints)))
    for i in range(len(prints)):
        if least[i] is None:
            queue, seen = [i], {i}
            while queue:
                at = queue.pop()
                for j, (_, p) in enumerate(prints):
                    if j not in seen and (p ^ prints[at][1]).bit_count() <= 4:
                        seen.add(j)
                        queue.append(j)
            smallest = min((prints[j][0] for j in seen if prints[j][0] is not None), default=None)
            for j in seen:
                least[j] = (smallest,)
    want = sorted([(d, least[i][0]) for i, (d, _) in enumerate(prints)], key=str)
    assert sorted([(d, c) for d, _, c in found[0]], key=str) == want
