"""A research session's turn: select prior state, query with exclusions, extract claims and questions, merge.

The tables of a session (sources.state) hold everything; what a branch has seen is derived from its turns. The
driver handles only what a turn bounds: its ranked chunks, batches, new claims and the selected prior state.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scriptorium.functions import prompts
from scriptorium.functions.text import parse_reply
from scriptorium.operators import fusion, models, retrieval, sessions
from scriptorium.sources import state as S

RUN_MODES = ("continue", "new", "deepen", "expand")


@dataclass(frozen=True)
class TurnRequest:
    question: str
    run_mode: str = "continue"
    branch_id: str | None = None
    branch_label: str | None = None
    query: retrieval.QueryRequest | None = None
    similarity: float = sessions.SIMILARITY
    query_output_path: str | None = None


@dataclass(frozen=True)
class View:
    """The prior state that a turn starts from."""

    root_query: str
    branch_id: str
    claims: list[dict] = field(default_factory=list)
    followups: list[dict] = field(default_factory=list)
    evidence: list[dict] = field(default_factory=list)

    def text(self) -> str:
        return "\n".join([f"root_query: {self.root_query}", "prior_claims:", prompts.listing(map(claim_line, self.claims)), "followup_suggestions:",
                          prompts.listing(map(followup_line, self.followups)), "recent_evidence:", prompts.listing(map(evidence_line, self.evidence))])


@dataclass(frozen=True)
class Turn:
    """What a turn did, and the session after it."""

    session: S.Session
    view: View
    request: retrieval.QueryRequest
    record: dict
    excluded_chunks: list[str]
    excluded_papers: list[str]
    ranked: list[dict]
    summaries: list[dict]
    claims: list[dict]
    followups: list[dict]


def claim_line(c: dict) -> str:
    return f"{c['claim_id']} | status={c['status']} | confidence={c['confidence']} | {c['text']}"


def followup_line(f: dict) -> str:
    return f"{f['question_id']} | {f['text']}"


def evidence_line(e: dict) -> str:
    return f"{e['chunk_id']} | paper_id={e['paper_id']} | section_label={e['section_label'] or prompts.NONE} | section_title={e['section_title']}"


def now_utc() -> str:
    return datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")


def embedded(rows: DataFrame, embedder: models.Embedder, *columns: str) -> DataFrame:
    """A session's claims (columns, text) with their vectors."""
    spark, found = rows.sparkSession, rows.select(*columns, "text").collect()
    vectors = embedder.embed([r["text"] for r in found]) if found else []
    schema = rows.select(*columns, "text").schema.add("vector", T.ArrayType(T.DoubleType()))
    return spark.createDataFrame([(*r, [float(x) for x in v]) for r, v in zip(found, vectors, strict=True)], schema)


def select(session: S.Session, branch_id: str, question: str, embedder: models.Embedder | None) -> View:
    """The branch's best claims, newest questions and recent evidence; without embedder claims go by priority."""
    own = session.claims.where(F.col("branch_id") == branch_id)
    columns = ["claim_id", "seq", "turn_seq", "branch_id", "status", "confidence"]
    if embedder is not None:
        ranked = sessions.rank_claims(embedded(own, embedder, *columns), embedder.embed([question])[0])
    else:
        ranked = sessions.rank_claims(own.select(*columns, "text"))
    later = sessions.order_followups(session.followups.where(F.col("branch_id") == branch_id))
    recent = sessions.recent_evidence(session.turns.where(F.col("branch_id") == branch_id).select("branch_id", "turn_seq", "chunk_ids"), session.evidence.drop("turn_seq")).orderBy("place")
    rows = lambda df: [r.asDict() for r in df.collect()]  # noqa: E731  capped lists
    return View(session.session.first()["root_query"], branch_id, rows(ranked.select("claim_id", "text", "status", "confidence")),
                rows(later.select("question_id", "text")), rows(recent.select("chunk_id", "paper_id", "section_label", "section_title")))


def new_claims(session: S.Session, replies: list[tuple[int, str, list[str]]], embedder: models.Embedder | None, similarity: float) -> list[dict]:
    """Claims of the batches' replies (batch, reply, chunk_ids) that no claim of the session says already."""
    spark = session.claims.sparkSession
    decoded = sessions.decode_claims(spark.createDataFrame(replies, "batch int, reply string, chunk_ids array<string>"))
    rows = decoded.select("batch", "chunk_ids", F.posexplode("claims").alias("pos", "c")).select((F.col("batch") * 1000 + F.col("pos")).cast("long").alias("seq"), "c.*", "chunk_ids")
    fresh = sessions.exact_dedupe(rows, session.claims)
    if embedder is not None:
        old = embedded(session.claims, embedder, "seq").select((F.col("seq") - (1 << 40)).alias("seq"), "vector", F.lit(True).alias("accepted"))
        both = old.unionByName(embedded(fresh, embedder, "seq").select("seq", "vector", F.lit(False).alias("accepted")))
        fresh = fresh.join(sessions.semantic_dedupe(both.withColumn("session_id", F.lit(0)), similarity).select("seq"), "seq", "left_semi")
    return [r.asDict() for r in fresh.orderBy("seq").collect()]


def decode_followups(session: S.Session, reply: str) -> list[dict]:
    kind = "struct<followups_added:array<struct<text:string>>>"
    found = session.claims.sparkSession.createDataFrame([(reply,)], "reply string").select(parse_reply(F.col("reply"), kind).alias("r")).first()["r"]
    return [{"text": f["text"].strip()} for f in (found and found["followups_added"] or []) if f and (f["text"] or "").strip()]


def run(chunks: DataFrame, session: S.Session, request: TurnRequest, embedder: models.Embedder, model: models.ResearchModel | None = None, now: str | None = None) -> Turn:
    """One turn; the session it returns is to be saved by the caller.

    Deepen leaves out the chunks that the branch has seen, expand its papers. Without any synthesis the turn
    fails (RuntimeError); an unknown or an existing branch is a ValueError.
    """
    if request.run_mode not in RUN_MODES:
        raise ValueError(f"unknown run mode: {request.run_mode}")
    model, now, spark = model or models.ExtractiveResearch(), now or now_utc(), chunks.sparkSession
    head = session.session.first()
    known = [r.asDict() for r in session.branches.orderBy("seq").collect()]
    branches, branch = sessions.resolve_branch(known, request.run_mode, request.branch_id or (head["active_branch_id"] if request.run_mode != "new" else None), request.branch_label, request.question.strip())
    branches = [{"created_at": now, **b} for b in branches]
    view = select(session, branch, request.question, embedder)
    base = request.query or retrieval.QueryRequest(request.question)
    pool, no_chunks, no_papers = sessions.pool(request.run_mode, base.final_top_k, base.depth, base.candidate_pool_k)
    text = sessions.contextualize(request.question, request.run_mode, view.root_query, [c["text"] for c in view.claims])
    asked = replace(base, query=text, candidate_pool_k=pool)
    past = session.turns.where(F.col("branch_id") == branch)
    seen_chunks = past.select(F.explode("chunk_ids").alias("chunk_id")).distinct() if no_chunks else None
    seen_papers = past.select(F.explode("paper_ids").alias("paper_id")).distinct() if no_papers else None
    columns = ["chunk_id", "paper_id", "paper_title", "authors", "year", "section_title", "classification_label", "chunk_index", "text", "rrf_score", "retrieval_keys", "position", "batch_index"]
    found = retrieval.run(chunks, asked, embedder, seen_chunks=seen_chunks, seen_papers=seen_papers).select(*columns).orderBy("position")
    schema = found.schema
    ranked = [r.asDict() for r in found.collect()]
    batched = spark.createDataFrame([tuple(r[c] for c in columns) for r in ranked], schema)
    summaries = [{"batch_index": r["batch_index"], "chunk_ids": r["chunk_ids"], "text": model.summarize(text, r["prompt"])} for r in fusion.batch_prompts(batched).orderBy("batch_index").collect()]
    synthesis = model.synthesize(text, [s["text"] for s in summaries]).strip() if summaries else ""
    if not synthesis:
        raise RuntimeError("the turn has no synthesis")
    replies = [(s["batch_index"], model.claims(prompts.claims_prompt(request.question, s["batch_index"], s["chunk_ids"], s["text"]), s["text"]), s["chunk_ids"]) for s in summaries]
    claims = new_claims(session, replies, embedder, request.similarity)
    later = decode_followups(session, model.followups(prompts.followups_prompt(request.question, synthesis), synthesis))
    n = session.turns.agg(F.count("*").alias("n"), F.max("turn_seq").alias("m")).first()
    seq = max(n["n"], n["m"] or 0) + 1
    n_claims, n_later = session.claims.count(), session.followups.count()
    record = {"turn_id": f"t{seq}", "turn_seq": seq, "branch_id": branch, "run_mode": request.run_mode, "user_question": request.question, "contextualized_query": text, "timestamp": now,
              "synthesized_summary": synthesis, "query_output_path": request.query_output_path, "chunk_ids": [r["chunk_id"] for r in ranked], "paper_ids": list(dict.fromkeys(r["paper_id"] for r in ranked))}
    made_by = {"turn_seq": seq, "branch_id": branch, "created_in_turn": record["turn_id"]}
    claims = [{"claim_id": f"c{n_claims + i}", "text": c["text"], "status": c["status"], "confidence": c["confidence"], "evidence_chunk_ids": c["chunk_ids"], **made_by, "seq": n_claims + i} for i, c in enumerate(claims, 1)]
    later = [{"question_id": f"q{n_later + i}", "text": f["text"], **made_by, "seq": n_later + i} for i, f in enumerate(later, 1)]
    evidence = [{"chunk_id": r["chunk_id"], "turn_seq": seq, "paper_id": r["paper_id"], "section_label": r["classification_label"], "section_title": r["section_title"]} for r in ranked]

    def rows(name: str, new: list[dict]) -> DataFrame:
        return spark.createDataFrame(new, S.TABLES[name])

    merged = S.Session(
        session.session.select("session_id", "created_at", F.lit(now).alias("updated_at"), "root_query", F.lit(branch).alias("active_branch_id")), rows("branches", branches),
        session.turns.unionByName(rows("turns", [record])), session.claims.unionByName(rows("claims", claims)), session.followups.unionByName(rows("followups", later)),
        sessions.upsert_evidence(session.evidence.unionByName(rows("evidence", evidence))))
    listed = lambda df: sorted(r[0] for r in df.collect()) if df is not None else []  # noqa: E731  ids that the branch's turns returned
    return Turn(merged, view, asked, record, listed(seen_chunks), listed(seen_papers), ranked, summaries, claims, later)


def artifact(turn: Turn, session_path: str) -> str:
    """The turn as Markdown: prior state, query, synthesis, what was added, the session's counts."""
    r, v, head, counts = turn.record, turn.view, turn.session.session.first(), turn.session.counts()
    snapshot = {"session_id": head["session_id"], "root_query": head["root_query"], "active_branch_id": head["active_branch_id"], "branch_count": counts["branches"],
                "turn_count": counts["turns"], "claim_count": counts["claims"], "followup_count": counts["followups"]}

    def listed(rows, line) -> str:
        return "\n".join(f"- {line(x)}" for x in rows) or prompts.NONE

    def added(c: dict) -> str:
        return f"status={c['status']} | confidence={c['confidence']} | chunk_ids={', '.join(c['evidence_chunk_ids'])} | {c['text']}"

    sections = {
        "# Research Session Turn": f"Session path: {session_path}\nTurn: {r['turn_id']}\nBranch: {r['branch_id']}\nRun mode: {r['run_mode']}\nUser question: {r['user_question']}",
        "## Selected Prior State": f"Root query: {v.root_query}\nSelected branch: {v.branch_id or prompts.NONE}",
        "### Prior Claims": listed(v.claims, claim_line), "### Follow-up Suggestions": listed(v.followups, followup_line), "### Recent Evidence": listed(v.evidence, evidence_line),
        "## Query Context": f"Text sent to the query:\n```text\n{r['contextualized_query']}\n```\n\nExcluded chunk_ids: {', '.join(turn.excluded_chunks) or prompts.NONE}\n"
                            f"Excluded paper_ids: {', '.join(turn.excluded_papers) or prompts.NONE}\nCandidate pool k: {turn.request.candidate_pool_k or '[default]'}",
        "## Query Artifact": f"Query artifact path: {r['query_output_path'] or '[not written]'}", "## Synthesized Summary": r["synthesized_summary"],
        "## State Update": "", "### Claims Added": listed(turn.claims, added), "### Follow-up Suggestions Added": listed(turn.followups, lambda f: f["text"]),
        "## Session Snapshot": "\n".join(f"{k}: {x}" for k, x in snapshot.items()),
    }
    return "\n\n".join(part for title, body in sections.items() for part in (title, body) if part).rstrip() + "\n"
