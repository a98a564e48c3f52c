"""One small test for each finding of the round."""

import hashlib
import math
import random
import textwrap

import duckdb
import pytest
from pyspark.sql import functions as F

from scriptorium.functions import text as T
from scriptorium.llm import licenses
from scriptorium.operators import fulltext, metadata, search
from scriptorium.plans import catalog
from scriptorium.plans import reference_queries as R

BLOCKS = "doc_id long, page_pos int, block_pos int, block_id string, block_type string, html string, items array<string>"


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_layout_metadata_reads_blocks_once(spark):
    entry = "Smith, J. (1999). Journal of Things, 3: 4."
    parts = [(0, "SectionHeader", "Short", []), (0, "SectionHeader", "A rather <i>longer</i> title", []), (0, "Text", "Ann Smith and Bob Ray", []), (0, None, "ISSN 1234-5678", []),
             (0, "SectionHeader", "Abstract", []), (0, "Text", "Volume 9", []), (2, "SectionHeader", "References", []), (2, "Text", entry, []), (2, "ListGroup", "", ["one &amp; two", ""]),
             (3, "SectionHeader", "Appendix", []), (3, "Text", entry.replace("Smith", "Outside"), []), (3, "SectionHeader", "references", []), (4, "Text", entry.replace("Smith", "Late"), []), (4, "Text", "no entry", [])]
    rows = [(1, p, i, f"/page/{p}/b/{i}", t, h, items) for i, (p, t, h, items) in enumerate(parts)] + [(2, 5, 0, "/page/5/b/0", "Text", "far back", [])]
    found = metadata.extract(spark.createDataFrame(rows[::-1], BLOCKS))
    got = {r["doc_id"]: r for r in found.collect()}
    assert (got[1]["title"], got[1]["journal"], got[1]["issn"], got[1]["volume"]) == ("A rather longer title", "Short", "1234-5678", None)
    assert got[1]["authors"] == ["Ann Smith", "Bob Ray"]
    assert got[1]["references"] == [entry, "one & two", entry.replace("Smith", "Late")]
    assert got[2]["title"] is None and got[2]["authors"] == [] and got[2]["references"] == []
    text = plan(found)
    assert "Window" not in text and "Join" not in text and text.count("Aggregate [") == 1


def test_names_need_neighbours(spark, monkeypatch):
    """What the quick test leaves out has no names: without it the same are found."""
    rng = random.Random(5)
    parts = ["Ann", "Smith", "J.", "B", "and", "of", "&", "Smith*", "†Bob", "Ray,", ";", "O'Neil", "[2]", "12", "Oslo", "x.", "university", "É", "Ta-Lo", "/", ": Eve", "\u00a0Kim"]
    texts = ["Ann Smith, Bob Ray", "nothing here. At all"] + [" ".join(rng.choices(parts, k=rng.randrange(1, 12))) for _ in range(300)]
    table = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", metadata.author_names(F.col("t")).alias("n"))
    quick = dict(map(tuple, table.collect()))
    monkeypatch.setattr(metadata, "NEIGHBOURS", "")
    whole = dict(map(tuple, spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", metadata.author_names(F.col("t")).alias("n")).collect()))
    assert quick == whole and quick[0] == ["Ann Smith", "Bob Ray"] and sum(map(bool, quick.values())) > 20


def test_index_scores_equal_the_scan_to_the_last_bit(spark, tmp_path):
    """Sums in the order of rows gave texts with equal counts unlike scores, and so another order than the ids'."""
    rng = random.Random(8)
    words = [f"w{i}" for i in range(7)]
    rows = [(f"c{i:03}", " ".join(rng.sample(words * 3, 20))) for i in range(300)]
    chunks = spark.createDataFrame(rows, "chunk_id string, text string").repartition(7)
    query = " ".join(words)
    index = fulltext.FullTextIndex(spark, str(tmp_path / "index"), buckets=3).refresh(chunks)
    assert dict(map(tuple, index.bm25(query).collect())) == dict(map(tuple, search.bm25(chunks, query).collect()))
    assert index.topk(query, 50).collect() == search.fts_topk(chunks, query, 50).collect()


def test_scores_unlike_by_rounding_only_are_ties(spark):
    """The same counts of other terms add up to the same score; the id decides, not the order of addition."""
    words, rng = ["one", "two", "three", "four", "five", "six", "seven"], random.Random(2)
    counts = sorted({tuple(rng.sample((1, 2, 3, 4, 6, 9, 11), 7)) for _ in range(60)})
    rows = [(f"c{99 - i}", " ".join(w for w, n in zip(words, c) for _ in range(n))) for i, c in enumerate(counts)]
    chunks = spark.createDataFrame([*rows, *((f"x{i}", "other") for i in range(40))], "chunk_id string, text string").withColumn("embedding", F.array(F.lit(1.0), F.lit(0.0)))
    ids = sorted(r[0] for r in rows)
    assert len({r["fts_score"] for r in search.bm25(chunks, " ".join(words)).collect()}) > 1
    assert [r["chunk_id"] for r in search.fts_topk(chunks, " ".join(words), 60).collect()] == ids
    listed = search.hits(search.fts_topk(chunks, " ".join(words), 60), "fts", "fts").orderBy("rank")
    assert [r["chunk_id"] for r in listed.collect()] == ids
    assert [r["chunk_id"] for r in search.hybrid_topk(chunks, " ".join(words), [1.0, 0.0], 60).orderBy("rank").collect()] == ids


def test_pages_keep_entities_without_semicolon_as_their_sql_does(spark, tmp_path):
    page = "<p>one&amp</p>a&amp;lt; b&copy; &copy2 &#39; &notit; &&amp;"
    spark.createDataFrame([(1, page)], "page_id long, html string").write.parquet(str(tmp_path / "pages.parquet"))
    want = "one&amp\na&lt; b© &copy2 ' &notit; &&"
    assert catalog.QUERIES["html_to_text"](spark, str(tmp_path)).first()["text"] == want.replace("\n", " ")
    assert catalog.QUERIES["html_blocks"](spark, str(tmp_path)).first()["digest"] == hashlib.sha256(want.encode()).hexdigest()
    assert spark.range(1).select(T.html_to_text(F.lit("x&amp</b>y&copy2")).alias("t")).first()["t"] == "x& y©2"


def test_licences_wrapped_over_lines_are_confirmed(spark):
    def wrap(text, width, mark=""):
        return "\n".join(mark + line for line in textwrap.wrap(text, width))

    prose = "The river ran past the old mill and nobody had seen the miller for many years"
    gpl, mit, bsd = licenses.TEMPLATES["GPL-3.0"][1], licenses.TEMPLATES["MIT"][1], licenses.TEMPLATES["BSD-3-Clause"][1]
    apache = licenses.TEMPLATES["Apache-2.0"][2]
    texts = {1: wrap(gpl, 50), 2: f"{prose}\n{wrap(mit, 40, '# ')}\n{prose}", 3: wrap(apache, 60, " * "), 4: "\n".join(bsd.split()),
             5: "Licensed under the Apache License, Version 2.0.\nHis license was lost.", 6: wrap(gpl, 50).replace("\n", "\n\n"), 7: f"{prose}\nA license\nof no use", 8: wrap(gpl, 60) + "\n\n" + wrap(mit, 60)}
    got = {r["doc_id"]: r for r in licenses.digest(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    assert {i: r["families"] for i, r in got.items()} == {1: "GPL-3.0", 2: "MIT", 3: "Apache-2.0", 4: "BSD-3-Clause", 5: "Apache-2.0", 6: "", 7: "", 8: "GPL-3.0,MIT"}
    assert (got[5]["n_paragraphs"], got[5]["n_confirmed"]) == (2, 1)


@pytest.fixture(params=["true", "false"])
def ansi(spark, request):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield request.param
    spark.conf.set("spark.sql.ansi.enabled", before)


@pytest.mark.parametrize("odd", ["source", "vector", "text", "dotted"])
def test_expand_agrees_with_its_sql_on_nulls_and_dotted_letters(spark, tmp_path, ansi, odd):
    rng, terms = random.Random(3), R.QUESTION.split()
    docs, vectors = [], []
    for i in range(60):
        text = " ".join(rng.choices([f"w{j}" for j in range(30)], k=20 + i) + rng.choices(terms, k=1 + i % 6))
        if odd == "text" and i % 4 == 0:
            text = None
        elif odd == "dotted":
            text += [" LİCENSE", " aİb İİ", ""][i % 3]
        docs.append((i, text, "en", None if odd == "source" and i % 3 == 0 else f"src{i % 5}", 9))
        vectors.append((i, None if odd == "vector" and i % 9 == 4 else [rng.random() for _ in range(4)]))
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars int").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.execute("SET threads = 1")  # with more, its sums of doubles hang on the order of rows
    for name in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    want = sorted(con.execute(catalog.ORACLES["exclusions_expand"]).fetchall())
    assert sorted(map(tuple, catalog.QUERIES["exclusions_expand"](spark, str(tmp_path)).collect())) == want
    if odd == "source":
        assert None in {r["paper_id"] for r in catalog.QUERIES["exclusions_expand_all"](spark, str(tmp_path)).collect()}


def test_index_and_scan_agree_on_null_texts(spark, tmp_path, ansi):
    texts = ["license one", None, "public license two three", None, "İ LİCENSE"]
    chunks = spark.createDataFrame([(f"c{i}", t) for i, t in enumerate(texts)], "chunk_id string, text string")
    scan = dict(map(tuple, search.bm25(chunks, "LİCENSE public").collect()))
    assert scan == dict(map(tuple, fulltext.FullTextIndex(spark, str(tmp_path / "index"), buckets=2).refresh(chunks).bm25("license public").collect()))
    assert scan.keys() == {"c0", "c2", "c4"}
    # three texts of 2, 4 and 2 words, five chunks, the term in three of them
    assert abs(scan["c0"] - math.log(1 + 2.5 / 3.5) * 2.2 / (1 + 1.2 * (0.25 + 0.75 * 2 / (8 / 3)))) < 1e-12
