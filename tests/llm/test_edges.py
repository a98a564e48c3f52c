"""Nulls in any column, empty and very long texts, ties, repeated rows, empty tables and clashing column names."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from scriptorium.llm import bpe, chat, common, decontaminate, embeddings, katz, licenses, pii, secrets, simhash, toxicity

LONG = "Long words of one text, token=abcdef0123456789 again. " * 4000
ROWS = [(1, "One text."), (1, "One text."), (None, None), (None, "One text."), (4, None), (5, ""), (6, LONG), (7, "x" * 100_000), (8, "\n\n"), (9, "\U0001f600é́\x00\x1f")]
#: Names that the operators use inside.
CLASHING = ("id", "key", "print", "label", "node", "component", "spans", "copy", "first", "n", "code", "score", "__kept_id", "part", "word", "window", "token", "value")


def clash(df):
    return df.select("*", *[F.lit(None).cast("string").alias(c) for c in CLASHING if c not in df.columns])


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, None if i is None else "en", None if i == 4 else "s", None if t is None else len(t)) for i, t in ROWS]
    return clash(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")).repartition(3).cache()


@pytest.fixture(scope="module")
def tables(spark):
    labels = spark.createDataFrame([(1, 1, 1), (1, 1, 1), (None, None, 1), (6, None, None), (7, 0, 0), (8, 0, 0)], "doc_id long, quality int, toxic int")
    benchmark = spark.createDataFrame([(1, "a long words of one text"), (1, "a long words of one text"), (None, None), (2, ""), (None, "never seen")], "item_id long, text string")
    return {"labels": clash(labels.withColumnRenamed("label", "x")), "benchmark": clash(benchmark)}


OPERATORS = {
    "bpe": lambda d, t: bpe.digest(d), "secrets": lambda d, t: secrets.digest(d), "decontaminate": lambda d, t: decontaminate.digest(d, t["benchmark"]),
    "katz": lambda d, t: katz.digest(d), "toxicity": lambda d, t: toxicity.digest(d, t["labels"]), "simhash": lambda d, t: simhash.digest(d),
    "licenses": lambda d, t: licenses.digest(d), "pii": lambda d, t: pii.digest(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_each_row_gets_a_result(docs, tables, name):
    rows = OPERATORS[name](docs, tables).collect()
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(i) for i, _ in ROWS)
    ones = [tuple(r) for r in rows if r["doc_id"] == 1]
    assert len(ones) == 2 and ones[0] == ones[1]


@pytest.mark.parametrize("name", OPERATORS)
def test_an_empty_table_gives_no_rows(docs, tables, name):
    assert OPERATORS[name](docs.limit(0), tables).collect() == []
    assert OPERATORS[name](docs.limit(0), {k: v.limit(0) for k, v in tables.items()}).collect() == []


def test_chat_and_embeddings_take_odd_tables(spark):
    turns = clash(spark.createDataFrame([(1, 0, "user", LONG), (1, 0, "user", LONG), (1, None, None, None), (None, 1, "assistant", "a"), (2, 0, "assistant", "")], "conv_id long, turn long, role string, text string"))
    got = {r["conv_id"]: r for r in chat.digest(turns).collect()}
    assert {c: r["n_turns"] for c, r in got.items()} == {1: 3, None: 1, 2: 1} and got[2]["loss_chars"] == 0
    assert chat.digest(turns.limit(0)).collect() == []
    vectors = spark.createDataFrame([(1, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (2, [1.0, 0.0], 0), (None, [1.0, 0.0], 0), (3, [1.0, None], 0), (4, [], 0), (5, [float("inf"), 1.0], None)], "vec_id long, embedding array<double>, label int")
    rows = embeddings.near_copies(clash(vectors)).collect()
    assert len(rows) == 7 and {r["component_id"] for r in rows if r["vec_id"] in (1, 2)} == {1}
    assert all(r["n_links"] == 0 for r in rows if r["vec_id"] in (None, 3, 4, 5))
    assert embeddings.near_copies(clash(vectors).limit(0)).collect() == []


def test_stages_take_odd_and_empty_documents(spark, docs, tables, tmp_path):
    for name, df in tables.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
        assert stage(spark, docs.limit(0), str(tmp_path)).collect() == [], name
    last = corpus_pipeline.STAGES[-1][1]
    assert last(spark, docs, str(tmp_path)).count() == len(ROWS) and last(spark, docs.limit(0), str(tmp_path)).collect() == []
    assert common.least_label(spark.createDataFrame([], "a long, b long")).collect() == []
