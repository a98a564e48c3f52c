"""Session turns, their snapshots and the JSON form."""

import json

import pytest

from scriptorium.functions import prompts
from scriptorium.operators import models, retrieval, turns
from scriptorium.sources import state, store

TEXTS = ["tables of figures and forms", "methods of measurement in fields", "measurement error and noise", "noise in long tables", "error bars on figures", "fields of noise and error"]
EMBED = models.HashEmbedder(16)


@pytest.fixture(scope="module")
def chunks(spark):
    empty = {c.split()[0]: None for c in store.CHUNK_COLUMNS.replace("\n", " ").split(", ")}
    rows = [empty | {"chunk_id": f"c{i}", "paper_id": f"p{i % 3}", "authors": ["A. B"], "year": 2000, "chunk_index": i, "text": t, "paper_title": "T", "section_title": f"S{i}",
                     "classification_label": "method" if i % 2 else None, "embedding": EMBED.embed([t])[0]} for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, store.CHUNK_COLUMNS).cache()


def ask(question, mode="continue", **more):
    return turns.TurnRequest(question, mode, query=retrieval.QueryRequest(question, mode="fts_hybrid", depth=2, final_top_k=2, batch_size=1), **more)


def test_turns_deepen_expand_and_branch(spark, chunks, tmp_path):
    disk = state.SessionStore(spark, str(tmp_path / "s"))
    assert not disk.exists()
    with pytest.raises(ValueError):
        disk.load()
    first = turns.run(chunks, state.initial(spark, "s", "measurement noise", "T0"), ask("measurement noise"), EMBED, now="T1")
    assert first.record["turn_id"] == "t1" and len(first.ranked) == 2 and [c["claim_id"] for c in first.claims] == ["c1", "c2"]
    assert first.view.claims == [] and first.request.query == "measurement noise" and "[none]" in first.view.text()
    assert disk.save(first.session) == 1
    deeper = turns.run(chunks, disk.load(), ask("noise in tables", "deepen"), EMBED, now="T2")
    assert not {r["chunk_id"] for r in deeper.ranked} & set(first.record["chunk_ids"]) and deeper.request.candidate_pool_k == 8
    assert deeper.record["contextualized_query"].startswith("Current research focus:\nmeasurement noise\n\nPrior findings:\n- ")
    assert deeper.record["contextualized_query"].endswith("\n\nNew request:\n\nnoise in tables")
    assert {c["claim_id"] for c in deeper.view.claims} == {"c1", "c2"} and deeper.view.evidence[0]["chunk_id"] == first.record["chunk_ids"][-1]
    assert deeper.claims[0]["claim_id"] == "c3"
    disk.save(deeper.session)
    wide = turns.run(chunks, disk.load(), ask("error", "expand"), EMBED, now="T3") if len({r["paper_id"] for r in first.ranked + deeper.ranked}) < 3 else None
    if wide:
        assert not {r["paper_id"] for r in wide.ranked} & {r["paper_id"] for r in first.ranked + deeper.ranked}
    again = turns.run(chunks, disk.load(), ask("measurement noise"), EMBED, now="T3")
    assert again.claims == []
    fresh = turns.run(chunks, disk.load(), ask("figures", "new"), EMBED, now="T3")
    assert fresh.record["branch_id"] == "b2" and fresh.view.claims == [] and fresh.session.session.first()["active_branch_id"] == "b2"
    text = turns.artifact(fresh, "there")
    assert "Branch: b2" in text and "turn_count: 3" in text and "## Synthesized Summary" in text
    with pytest.raises(ValueError):
        turns.run(chunks, disk.load(), ask("x", "new", branch_id="b1"), EMBED)
    with pytest.raises(ValueError):
        turns.run(chunks, disk.load(), ask("x", branch_id="b9"), EMBED)
    with pytest.raises(RuntimeError):
        turns.run(chunks.limit(0), disk.load(), ask("x y"), EMBED)


def test_snapshots_and_json_turn_back(spark, chunks, tmp_path):
    disk = state.SessionStore(spark, str(tmp_path / "s"))
    made = turns.run(chunks, state.initial(spark, "s", "noise", "T0"), ask("noise"), EMBED, now="T1").session
    assert [disk.save(made), disk.save(made)] == [1, 2] and disk.versions() == [1, 2]
    (tmp_path / "s" / "v000003").mkdir()
    assert disk.versions() == [1, 2]
    path = tmp_path / "s.json"
    path.write_text(state.to_json(disk.load()).first()["value"])
    back = state.from_json(spark, str(path))
    for name in ("session", "branches", "turns", "claims", "followups"):
        key = getattr(made, name).columns[0]
        columns = getattr(made, name).columns
        assert [r.asDict() for r in getattr(back, name).select(*columns).orderBy(key).collect()] == [r.asDict() for r in getattr(made, name).orderBy(key).collect()]


def test_old_sessions_get_their_branches(spark, tmp_path):
    path = tmp_path / "old.json"
    turn = {"turn_id": "t1", "user_question": "q", "timestamp": "T", "synthesized_summary": "s", "retrieved_chunk_ids": ["x", "y", "x"], "query_request": {"query": "q"}}
    path.write_text(json.dumps({"session_id": "s", "created_at": "T", "updated_at": "T", "root_query": "r", "turn_order": ["t1", "t9", "t2"], "turns": {"t1": turn, "t2": turn | {"branch_id": "b7"}},
                                "claims": {"c1": {"text": "a", "status": "supported", "confidence": "high", "created_in_turn": "t2"}}, "open_questions": {"q1": {"text": "b", "created_in_turn": "t5"}},
                                "evidence_index": {"x": {"paper_id": "p", "section_title": "S"}, "y": {"paper_id": "p", "section_title": "S"}}}))
    old = state.from_json(spark, str(path))
    assert [(r["branch_id"], r["label"]) for r in old.branches.orderBy("seq").collect()] == [("b1", "main"), ("b7", "b7")]
    assert old.claims.first()["branch_id"] == "b7" and old.followups.first()["branch_id"] == "b1"
    assert [r["paper_ids"] for r in old.turns.collect()] == [["p"], ["p"]]
    path.write_text(json.dumps({"session_id": "s"}))
    with pytest.raises(ValueError):
        state.from_json(spark, str(path))


def test_modes_and_prompts():
    keys = {m: [k for k, *_ in retrieval.variants(retrieval.QueryRequest("a word", mode=m))] for m in retrieval.SEARCHES}
    assert keys["fts_hybrid"] == ["original_hybrid", "original_fts"] and keys["hybrid_only"] == ["original_hybrid"] and keys["fts_only"] == ["original_fts"]
    assert keys["full"] == ["original_hybrid", "original_fts", "rewrite_1_vector", "rewrite_2_vector", "hyde_vector"]
    for text in (prompts.claims_prompt("q", 0, ["a", "b"], "s"), prompts.label_prompt("t", "x", "first 20%", ["method"]), prompts.plan_prompt("q", "s", ["compare"], ["search"], 3), prompts.grounded_prompt("q", "s", [])):
        assert text.count("\n\n") >= 1
    assert "[none]" in prompts.grounded_prompt("q", "s", []) and prompts.listing([]) == "- [none]"
