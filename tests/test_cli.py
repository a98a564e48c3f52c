"""The command lines over a small chunk table."""

import json

import pytest

from scriptorium import cli
from scriptorium.operators import models
from scriptorium.sources import store


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("table") / "chunks")
    embedder = models.HashEmbedder(16)
    rows = []
    for i, text in enumerate(["tables of figures", "methods of measurement", "measurement error and noise"]):
        row = {c.split()[0]: None for c in store.CHUNK_COLUMNS.replace("\n", " ").split(", ")}
        rows.append(row | {"chunk_id": f"c{i}", "paper_id": f"p{i % 2}", "authors": [f"A. Author{i}"], "year": 2000 + i, "chunk_index": i,
                           "text": text, "paper_title": f"Title {i}", "section_title": "S", "embedding": embedder.embed([text])[0]})
    store.ChunkTable(spark, path, 16).append(spark.createDataFrame(rows, store.CHUNK_COLUMNS))
    return path


def test_query_writes_ranked_chunks(spark, folder, tmp_path):
    out = tmp_path / "out.md"
    cli.main(["query", "measurement noise", "--db-path", folder, "--embedding-dimensions", "16", "--output-path", str(out)], spark)
    text = out.read_text()
    assert text.index("chunk_id: c2") < text.index("chunk_id: c1")
    cli.main(["query", "measurement noise", "--db-path", folder, "--embedding-dimensions", "16", "--year", "2001", "--retrieval-mode", "fts", "--output-path", str(out)], spark)
    assert "chunk_id: c1" in out.read_text() and "chunk_id: c2" not in out.read_text()


def test_followup_reads_a_plan(spark, folder, tmp_path):
    plan, out = tmp_path / "plan.json", tmp_path / "out.md"
    mode = next(iter(cli.followup.ANSWER_MODES))
    plan.write_text(json.dumps({"intent": "check", "answer_mode": mode, "reason": "r", "tool_calls": [{"query": "error"}, {"query": "methods", "filters": {"paper_id": "p1"}}]}))
    cli.main(["followup", "--db-path", folder, "--embedding-dimensions", "16", "--plan-path", str(plan), "--output-path", str(out)], spark)
    text = out.read_text()
    assert "intent: check" in text and text.count("chunk_id: c1") == 1 and "chunk_id: c2" in text


def test_inspect_and_wrong_flags(spark, folder, capsys):
    cli.main(["inspect", "--db-path", folder, "--embedding-dimensions", "16", "--paper-id", "p1"], spark)
    assert "c1" in capsys.readouterr().out
    with pytest.raises(SystemExit):
        cli.main(["query", "x", "--db-path", folder, "--retrieval-mode", "none"], spark)


def page(n, blocks):
    return {"id": f"/page/{n}/Page/0", "children": [{"id": f"/page/{n}/{t}/{i}", "block_type": t, "html": h} for i, (t, h) in enumerate(blocks)]}


def test_folder_to_table_to_session(spark, tmp_path, capsys):
    layout, db, session = tmp_path / "layout", str(tmp_path / "db"), str(tmp_path / "study")
    layout.mkdir()
    body = " ".join(f"Measured value {i} is noise." for i in range(60))
    good = [page(0, [("SectionHeader", "<h1>A Study of Noise</h1>"), ("SectionHeader", "<h2>Introduction</h2>"), ("Text", f"<p>{body}</p>"), ("SectionHeader", "<h2>Results</h2>"), ("Text", "<p>Errors were few here.</p>")])]
    bad = [page(0, [("SectionHeader", "<h1>Another Study of Other Noise</h1>"), ("SectionHeader", "<h2>Odd</h2>"), ("Text", "<p>Nothing settles where this goes.</p>")])]
    (layout / "good.json").write_text(json.dumps({"id": "g", "children": good}))
    (layout / "bad.json").write_text(json.dumps({"id": "b", "children": bad}))
    common = ["--db-path", db, "--embedding-dimensions", "16"]
    cli.main(["ingest-folder", str(layout), *common], spark)
    report = dict(x.split("=") for x in capsys.readouterr().out.split())
    table = store.ChunkTable(spark, db, 16)
    assert report["papers_kept_back"] == "1" and table.has_paper("good") and not table.has_paper("bad")
    cli.main(["ingest-folder", str(layout), *common, "--keep-unresolved", "--replace-existing"], spark)
    rows = table.read().orderBy("paper_id", "section_title").collect()
    assert {r["paper_id"] for r in rows} == {"good", "bad"} and len({r["chunk_id"] for r in rows}) == len(rows)
    assert {r["section_title"]: r["classification_label"] for r in rows if r["paper_id"] == "good"}["Introduction"] == "introduction"
    out = tmp_path / "turn.md"
    for n, mode in enumerate(("continue", "deepen"), 1):
        cli.main(["session", "measured noise", *common, "--session-path", session, "--run-mode", mode, "--final-top-k", "1", "--retrieval-depth", "1", "--output-path", str(out)], spark)
        assert f"Turn: t{n}" in out.read_text()
    assert "Excluded chunk_ids: [none]" not in out.read_text()


def test_classified_json_to_table_and_markdown_to_tsv(spark, tmp_path, capsys):
    path, db = tmp_path / "paper_classified_chunks.json", str(tmp_path / "db")
    chunk = {"chunk_index": 0, "text": "some words", "word_count": 2, "classification": {"label": "results", "source": "deterministic", "reason": "title", "confidence": "high"}}
    path.write_text(json.dumps({"source_markdown": "x/Of_Noise_filtered.md", "headings": [{"title": "Results", "heading_level": 1, "chunks": [chunk]}, {"title": "B", "heading_level": 1, "chunks": []}]}))
    for more in ([], ["--replace-existing"], ["--paper-id", "other"]):
        cli.main(["ingest", "--db-path", db, "--embedding-dimensions", "16", "--classified-json", str(path), *more], spark)
    assert capsys.readouterr().out == "chunks=1\n" * 3
    rows = store.ChunkTable(spark, db, 16).read().orderBy("paper_id").collect()
    assert [(r["paper_id"], r["paper_title"], r["classification_label"], r["reason"]) for r in rows] == [("other", "Of_Noise", "results", "title"), ("paper", "Of_Noise", "results", "title")]
    markdown = tmp_path / "m.md"
    markdown.write_text("# Methods\n\nWe measure.\n\n## Odd\n\nMore.\n\n# What\n\nElse.\n")
    cli.main(["classify", str(markdown)], spark)
    lines = capsys.readouterr().out.splitlines()
    assert lines[:2] == ["total_chunks=3", "llm_classified_chunks=1"]
    assert [x.split("\t")[3:5] for x in lines[2:]] == [["method", "deterministic"], ["method", "deterministic"], ["None", "llm"]]
