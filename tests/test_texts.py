"""Entities, replies, plans and front matter, against Python's own rules and plain expectations."""

import html

import pytest
from pyspark.sql import functions as F

from scriptorium.functions import text as T
from scriptorium.operators import blocks, followup, metadata, sessions


def test_entities_as_html_has_them(spark):
    texts = ["&#8217; &eacute; &reg; &#x1F600;", "&amp;lt; &AMP &ampx &notit; &nosuch; &", "&#0; &#128; &#xD800; &#1114112; &#99999999999999999; &#12;x&#1;y", "a & b &copy2020 &ngE;", "no entity", "&&lt;&&", ""]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r["i"]: r["t"] for r in rows.select("i", T.unescape_entities(F.col("t")).alias("t")).collect()}
    assert [got[i] for i in range(len(texts))] == [html.unescape(t) for t in texts]


def test_replies_keep_words_inside_strings(spark):
    replies = ['{"t": "None of the True baselines, ]help"}', "x {'t': 'None, ]', 'n': None, 'b': [True, False,],} y", "```json\n{\"t\": \"it's\",}\n```", "nothing", None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(replies)], "i int, t string").select("i", T.parse_reply(F.col("t"), "struct<t:string,n:string,b:array<boolean>>").alias("r"))
    got = {r["i"]: r["r"] for r in rows.collect()}
    assert [got[i] and got[i]["t"] for i in range(5)] == ["None of the True baselines, ]help", "None, ]", "it's", None, None]
    assert got[1]["b"] == [True, False] and got[1]["n"] is None
    claims = sessions.decode_claims(spark.createDataFrame([('{"claims_added": [{"text":"a"}, "junk", 3, null, {"text": " "}]}',)], "reply string")).first()["claims"]
    assert [(c["text"], c["status"], c["confidence"]) for c in claims] == [("a", "supported", "medium")]


def test_plans_name_the_evidence_tool():
    reply = '{"intent": "i", "answer_mode": " Synthesis ", "reason": "r", "tool_calls": [{"tool": "retrieve_evidence", "query": "q", "filters": {"paper_id_in": ["", "p"]}, "top_k": 40}]}'
    plan = followup.parse_plan(reply)
    assert plan.answer_mode == "direct_answer" and plan.tool_calls[0].top_k == 12 and plan.tool_calls[0].filters.paper_id_in == ["p"]
    with pytest.raises(ValueError):
        followup.parse_plan(reply.replace("retrieve_evidence", "other"))


def layout(spark, *parts):
    rows = [("d", p, i, f"/page/{p}/{i}", k, h, items) for i, (p, k, h, items) in enumerate(parts)]
    return spark.createDataFrame(rows, "doc_id string, page_pos int, block_pos int, block_id string, block_type string, html string, items array<string>")


def test_metadata_of_mixed_blocks_lists_and_ids(spark):
    df = layout(spark, (0, "SectionHeader", "A title of it", []), (0, "Text", "Ann Smith Bob University of Oslo", []), (0, "Text", "ANN SMITH BOB", []), (0, "Text", "Eve B. Ray, Kim Lee*", []), (0, "SectionHeader", "Abstract", []),
                (1, "SectionHeader", "References", []), (1, "ListGroup", "", ["Any item", "any  ITEM", "Other"]), (1, "Text", "Not one", []), (1, "Text", "Ray, E. (2001). Journal of It.", []), (1, "SectionHeader", "Next", []), (1, "Text", "Ray, E. (2002). Journal of It.", []))
    r = metadata.extract(df.withColumn("source_path", F.lit("/x/2019-Ray.json"))).first()
    assert r["authors"] == ["Ann Smith Bob", "Eve B. Ray", "Kim Lee"] and r["references"] == ["Any item", "Other", "Ray, E. (2001). Journal of It."] and r["year"] == "2019"
    assert metadata.extract(df).first()["year"] is None
    assert spark.range(1).select(metadata.in_turn(F.lit("Ann Smith Bob Jones of Eve Lab")).alias("a")).first()["a"] == ["Ann Smith", "Bob Jones"]


def test_only_whole_names_and_titled_headings_go(spark):
    df = layout(spark, (0, "SectionHeader", "The Title", []), (0, "Text", "the title", []), (0, "Text", "Ann Smith wrote this sentence", []), (0, "SectionHeader", "Abstract", []), (0, "Text", "ann smith", []),
                (0, "Text", "", []), (0, "ListGroup", "", ["© license", "one"]), (0, "Text", "and goes on", []), (1, "SectionHeader", "References", []), (1, "SectionHeader", "References", []))
    known = spark.createDataFrame([("d", "the title", ["Ann Smith"])], "doc_id string, title string, authors array<string>")
    marked = blocks.flagged(df, known)
    assert [r["reason"] for r in marked.orderBy("block_pos").collect()] == ["metadata_title", None, None, None, "metadata_author", "empty_text", None, None, "references_cutoff", "after_references"]
    assert blocks.audit(marked).count() == 4
    assert blocks.markdown(marked.where("reason IS NULL")).first()["markdown"] == "the title\n\nAnn Smith wrote this sentence\n\n# Abstract\n\n- one\n\nand goes on"
