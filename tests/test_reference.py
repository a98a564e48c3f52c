import random

import pytest
from pyspark.sql import functions as F

from scriptorium.functions import text as T
from scriptorium.functions import vectors as V
from scriptorium.operators import blocks, chunking, filters, followup, fusion, labels, models, sessions
from scriptorium.plans import catalog
from scriptorium.sources import store

SF = "/root/testdata/sf0.001"


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()


def test_chunk_windows_cover_all_words():
    rng = random.Random(5)
    for n in [0, 1, 99, 199, 200, 201, 260, 399, 600, 1500]:
        for stop in (7, 40, 10**9):
            text = " ".join(f"w{i}" + ("." if rng.randrange(stop) == 0 else "") for i in range(n))
            got = chunking.windows(text)
            assert (got == []) == (n == 0)
            if got:
                starts = [s for s, _, _ in got]
                assert starts == sorted(starts) and starts[0] == 0 and got[-1][1] == len(text)
                assert all(b[0] <= a[1] for a, b in zip(got, got[1:], strict=False))
                assert all(len(text[s:e].split()) == k for s, e, k in got)


def test_sections_drop_the_preamble(spark):
    text = "preamble\n# A\n\nbody one\n## B  \ntext\n#\n\nC\n### not\n# D\n"
    rows = chunking.sections(spark.createDataFrame([("p", text)], "paper_id string, markdown string")).orderBy("section_pos").collect()
    assert [(r["title"], r["heading_level"]) for r in rows] == [("A", 1), ("B", 2), ("C", 1), ("D", 1)]
    assert rows[2]["content"] == "### not" and rows[0]["content"] == "body one"


def test_labels_inherit(spark):
    rows = [("p", 0, "Introduction", 1, 1), ("p", 1, "1 Own", 2, 1), ("p", 2, "B1", 1, 1), ("p", 3, "Other", 1, 1), ("p", 4, "Deeper", 2, 1), ("p", 5, "Results", 1, 0), ("p", 6, "C2", 1, 1)]
    out = labels.label_sections(spark.createDataFrame(rows, "paper_id string, section_pos int, title string, heading_level int, n_chunks int"))
    got = [(r["label"], r["confidence"]) for r in out.orderBy("section_pos").collect()]
    assert got == [("introduction", "high"), ("introduction", "medium"), ("introduction", "medium"), (None, None), ("introduction", "medium"), ("results", "high"), ("introduction", "medium")]


def test_blocks_are_cut_flagged_and_joined(spark):
    rows = [("d", 0, 0, "/page/0/a", "SectionHeader", "Journal"), ("d", 0, 1, "/page/0/b", "SectionHeader", "A longer title"), ("d", 0, 2, "/page/0/c", "SectionHeader", "Abstract"), ("d", 0, 3, "/page/0/d", "Text", "<p>It begins here</p>"),
            ("d", 0, 4, "/page/0/e", "Text", "and goes on."), ("d", 0, 5, "/page/0/f", "Table", "x"), ("d", 0, 6, "/page/0/g", "Odd", "x"), ("d", 1, 0, "/page/1/a", "SectionHeader", "Acknowledgment"), ("d", 1, 1, "/page/1/b", "Text", "Thanks"),
            ("d", 1, 2, "/page/1/c", "SectionHeader", "Next"), ("d", 1, 3, "/page/1/d", "Text", "© 2020 someone"), ("d", 2, 0, "/page/2/a", "SectionHeader", "References"), ("d", 3, 0, "/page/3/a", "Text", "Appendix")]
    df = spark.createDataFrame(rows, "doc_id string, page_pos int, block_pos int, block_id string, block_type string, html string").withColumn("items", F.array().cast("array<string>"))
    out = blocks.flagged(df)
    reasons = [r["reason"] for r in out.orderBy("page_pos", "block_pos").collect()]
    assert reasons == ["title_page_heading", None, None, None, None, "skipped_block_type", "unsupported_block_type", "excluded_section", "excluded_section", None, "boilerplate_text", "references_cutoff", "after_references"]
    assert blocks.markdown(out.where("reason IS NULL")).first()["markdown"] == "# A longer title\n\n# Abstract\n\nIt begins here and goes on.\n\n# Next"


def test_text_functions(spark):
    r = one(spark, a=T.chunk_id(F.lit("2025_Zhu"), F.lit("1 Introduction"), F.lit(0)), b=T.citation_label(F.array(F.lit("Ann Smith")), F.lit(2024), F.lit("x")),
            c=T.citation_label(F.array().cast("array<string>"), F.lit(None).cast("int"), F.lit("2023_Uchida-Mori")), d=T.claim_key(F.lit("Ça, va?  Oui!")), e=T.html_to_text(F.lit("<p>a &amp;lt; b</p>c")),
            f=T.parse_reply(F.lit("```{'a': True, 'b': [1,2,],}```"), "struct<a:boolean,b:array<int>>"), g=T.summary_section(F.lit("# x\n## Synthesized Summary\n\nbody\n## y\n")), h=T.page_of(F.lit("/page/12/x")), i=T.page_of(F.lit("x")))
    assert r["a"] == "fa2389fd0ec99e337d4873948bfa9c9898181632a55a188bae78f2964b2b8022"
    assert (r["b"], r["c"], r["d"]) == ("Smith, 2024", "Uchida Mori, 2023", "ça va oui")
    assert r["e"].split() == ["a", "&lt;", "b", "c"] and r["f"]["a"] is True and r["f"]["b"] == [1, 2] and r["g"] == "body" and (r["h"], r["i"]) == (12, None)


def test_fusion_vector(spark):
    hits = spark.createDataFrame([("c", k, k, r, None, None, None) for k, r in (("hyde", 1), ("fts", 3), ("hybrid", 1), ("rewrite1", 9), ("rewrite2", 4))],
                                 "chunk_id string, retrieval_key string, retrieval_kind string, rank int, relevance_score double, distance double, fts_score double")
    assert f"{fusion.fuse(hits, 5).first()['rrf_score']:.6f}" == "0.078778"
    with pytest.raises(ValueError):
        fusion.fuse(hits, 5, rrf_k=0)


def test_hash_embedding_agrees_with_its_twin(spark):
    text = "Über die the the cat"
    got = one(spark, v=V.hash_embedding(F.lit(text), 32))["v"]
    assert got == pytest.approx(models.HashEmbedder(32).embed([text])[0])


def test_plans_are_checked():
    ok = '{"intent":"i","answer_mode":"summary","reason":"r","tool_calls":[{"query":"q","filters":{"paper_id_in":"p","author":""},"top_k":0}]}'
    plan = followup.parse_plan(ok)
    assert plan.answer_mode == "direct_answer" and plan.tool_calls[0].top_k == 6 and plan.tool_calls[0].filters.paper_id_in == ["p"]
    for bad in (ok.replace('"i"', '""'), ok.replace("summary", "sing"), ok.replace(":0}", ":-1}"), "none"):
        with pytest.raises(ValueError):
            followup.parse_plan(bad)


def test_sessions(spark):
    claims = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.9, 0.5]), (3, [0.3, 1.0])], "seq long, vector array<double>").withColumn("session_id", F.lit(1))
    assert sorted(r["seq"] for r in sessions.semantic_dedupe(claims).collect()) == [1, 3]
    assert sessions.resolve_branch([], "new", None, None, "q" * 99)[0][0]["label"] == "q" * 60
    with pytest.raises(ValueError):
        sessions.resolve_branch([], "continue", None, None, "q")
    assert sessions.pool("deepen", 15, 10) == (60, True, False)
    decoded = sessions.decode_claims(spark.createDataFrame([("{'claims_added': [{'text': ' a '}, {'text': ''},]}",), ("bad",)], "reply string")).collect()
    assert [[c["text"] for c in r["claims"]] for r in decoded] == [["a"], []]


def test_chunk_table_upserts_by_paper(spark, tmp_path):
    base = {c.split()[0]: c.split()[1] for c in store.CHUNK_COLUMNS.replace("\n", " ").split(", ")}
    rows = spark.range(4).select(*[F.lit(None).cast(t).alias(c) for c, t in base.items() if c not in ("paper_id", "embedding", "text")], F.when(F.col("id") < 2, "a").otherwise("o'b").alias("paper_id"), F.lit("t").alias("text"), F.array(F.lit(1.0), F.lit(0.0)).alias("embedding"))
    table = store.ChunkTable(spark, str(tmp_path / "chunks"), 2)
    table.append(rows)
    table.upsert(rows.where("paper_id = 'a'").limit(1))
    assert {r["paper_id"]: r["count"] for r in table.read().groupBy("paper_id").count().collect()} == {"a": 1, "o'b": 2}
    assert table.delete_paper("o'b") == 1 and not table.has_paper("o'b") and table.delete_paper("none") == 0


def test_filters(spark):
    df = spark.createDataFrame([("p", 2020, "Title", "m", "S", ["Ann O'Brien"]), ("q", None, "Other", None, "S", [])], "paper_id string, year int, paper_title string, classification_label string, section_title string, authors array<string>")
    assert [r["paper_id"] for r in filters.apply(df, filters.QueryFilters(year_min=2000, author="o'brien", paper_title_contains="TIT")).collect()] == ["p"]
    assert filters.expanded_limit(10, filters.QueryFilters(author="x")) == 50


@pytest.mark.parametrize("name", ["hybrid_rrf_topk", "fts_bm25_topk", "boilerplate_flag", "label_carry_forward", "hash_embedding", "article_quintile", "claim_exact_dedupe"])
def test_queries_agree_with_sql(spark, name):
    import os

    import duckdb

    con = duckdb.connect()
    for t in os.listdir(SF):
        con.sql(f"CREATE VIEW {t[:-8]} AS SELECT * FROM '{SF}/{t}'")
    got, want = catalog.QUERIES[name](spark, SF).toPandas(), con.sql(catalog.ORACLES[name]).df()

    def rows(df):
        return sorted(tuple(round(float(x), 6) if isinstance(x, float) else str(x) for x in r) for r in df[sorted(df.columns)].itertuples(index=False))

    assert sorted(got.columns) == sorted(want.columns) and rows(got) == rows(want)
