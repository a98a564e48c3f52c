"""Research sessions as tables: claims, follow-ups, evidence, branches and turns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from scriptorium.functions import vectors as V
from scriptorium.functions.text import claim_key

MOST_CLAIMS, MOST_FOLLOWUPS, MOST_EVIDENCE, RECENT_TURNS, CONTEXT_CLAIMS, SIMILARITY = 8, 6, 8, 2, 3, 0.85
CLAIM = "array<struct<text:string,status:string,confidence:string>>"


def decode_claims(replies: DataFrame, column: str = "reply") -> DataFrame:
    """Claims of model replies: objects with text, other items skipped; status and confidence default; unreadable replies give none."""
    from scriptorium.functions.text import parse_reply

    items = parse_reply(F.col(column), "struct<claims_added:array<string>>")["claims_added"]
    kind = "struct<text:string,status:string,confidence:string>"
    loose = {"allowSingleQuotes": "true", "allowBackslashEscapingAnyCharacter": "true"}
    objects = F.transform(F.filter(F.coalesce(items, F.array().cast("array<string>")), lambda i: i.startswith("{")), lambda i: F.from_json(i, kind, loose))
    return replies.withColumn("claims", F.transform(F.filter(objects, lambda c: F.trim(F.coalesce(c["text"], F.lit(""))) != ""), lambda c: F.struct(
        F.trim(c["text"]).alias("text"), F.coalesce(c["status"], F.lit("supported")).alias("status"), F.coalesce(c["confidence"], F.lit("medium")).alias("confidence"))))


def exact_dedupe(new: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """New claims (seq, text) whose normalized text no earlier claim has."""
    keyed = new.withColumn("key", claim_key(F.col("text"))).where("key <> ''")
    if existing is not None:
        keyed = keyed.join(existing.select(claim_key(F.col("text")).alias("key")).distinct(), "key", "left_anti")
    return keyed.withColumn("n", F.row_number().over(W.partitionBy("key").orderBy("seq"))).where("n = 1").drop("n", "key")


def semantic_dedupe(claims: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """Claims (session_id, seq, vector) that are kept in order: none is as near as `threshold` to one kept before.

    Rows with a true column accepted, if there is one, are kept in any case.
    Greedy and dependent on order, so a fold over each session's claims, which the reference's sessions bound.
    """
    accepted = F.coalesce(F.col("accepted"), F.lit(False)) if "accepted" in claims.columns else F.lit(False)
    rows = F.array_sort(F.collect_list(F.struct("seq", "vector", accepted.alias("accepted"))))
    fold = F.aggregate("rows", F.array().cast("array<struct<seq:bigint,vector:array<double>>>"), lambda kept, x: F.when(
        ~x["accepted"] & F.exists(kept, lambda k: V.cosine(k["vector"], x["vector"]) >= threshold), kept).otherwise(
        F.concat(kept, F.array(F.struct(x["seq"].cast("long").alias("seq"), x["vector"].cast("array<double>").alias("vector"))))))
    return claims.groupBy("session_id").agg(rows.alias("rows")).select("session_id", F.explode(fold).alias("k")).select("session_id", "k.seq")


def priority(status, confidence):
    return F.when(status == "supported", 10).otherwise(0) + F.when(confidence == "high", 2).when(confidence == "medium", 1).otherwise(0)


def rank_claims(claims: DataFrame, question: list[float] | None = None, most: int = MOST_CLAIMS, branch: str | None = None) -> DataFrame:
    """The claims of most use: nearest to the question, then by priority, later turn, order."""
    rows = claims.where(F.col("branch_id") == branch) if branch else claims
    near = V.cosine(F.col("vector"), V.literal(question)) if question else F.lit(0.0)
    return rows.withColumn("relevance", near).withColumn("priority", priority(F.col("status"), F.col("confidence"))).orderBy(F.desc("relevance"), F.desc("priority"), F.desc("turn_seq"), "seq").limit(most)


def order_followups(followups: DataFrame, most: int = MOST_FOLLOWUPS) -> DataFrame:
    return followups.orderBy(F.desc("turn_seq"), "seq").limit(most)


def recent_evidence(turns: DataFrame, evidence: DataFrame, most: int = MOST_EVIDENCE) -> DataFrame:
    """Evidence of the last two turns of each branch: newest turn first, within a turn last first.

    turns: (branch_id, turn_seq, chunk_ids); evidence: (chunk_id, ...). Unknown chunks are skipped.
    """
    newest = turns.withColumn("back", F.row_number().over(W.partitionBy("branch_id").orderBy(F.desc("turn_seq")))).where(F.col("back") <= RECENT_TURNS)
    ids = newest.select("branch_id", "back", F.posexplode("chunk_ids").alias("pos", "chunk_id"))
    first = ids.withColumn("n", F.row_number().over(W.partitionBy("branch_id", "chunk_id").orderBy("back", F.desc("pos")))).where("n = 1")
    joined = first.join(evidence, "chunk_id")
    placed = joined.withColumn("place", F.row_number().over(W.partitionBy("branch_id").orderBy("back", F.desc("pos"))))
    return placed.where(F.col("place") <= most).drop("n", "back", "pos")


def upsert_evidence(evidence: DataFrame) -> DataFrame:
    """The last write of each chunk: rows (chunk_id, turn_seq, ...)."""
    rest = [c for c in evidence.columns if c not in ("chunk_id",)]
    return evidence.groupBy("chunk_id").agg(F.max_by(F.struct(*rest), "turn_seq").alias("e")).select("chunk_id", "e.*")


def seen_sets(turns: DataFrame) -> DataFrame:
    """Per branch the chunks seen, in the order first seen, from turns (branch_id, turn_seq, chunk_ids)."""
    ids = turns.select("branch_id", "turn_seq", F.posexplode("chunk_ids").alias("pos", "chunk_id"))
    first = ids.groupBy("branch_id", "chunk_id").agg(F.min(F.struct("turn_seq", "pos")).alias("at"))
    return first.groupBy("branch_id").agg(F.array_sort(F.collect_list(F.struct("at", "chunk_id"))).alias("s")).select("branch_id", F.transform("s", lambda x: x["chunk_id"]).alias("seen_chunk_ids"))


def allocate_ids(new: DataFrame, prefix: str, existing: int, *order) -> DataFrame:
    """Ids prefix{n+1}... in order, for the bounded rows of one turn."""
    return new.withColumn("id", F.concat(F.lit(prefix), (F.row_number().over(W.orderBy(*order)) + existing).cast("string")))


def backfill_branches(rows: DataFrame, turns: DataFrame, active_branch: str) -> DataFrame:
    """Claims or follow-ups without branch take their turn's, else the active one."""
    t = turns.select(F.col("turn_id").alias("created_in_turn"), F.col("branch_id").alias("turn_branch"))
    return rows.join(t, "created_in_turn", "left").withColumn("branch_id", F.coalesce(F.nullif("branch_id", F.lit("")), "turn_branch", F.lit(active_branch))).drop("turn_branch")


def snapshot(**tables: DataFrame) -> dict[str, int]:
    """Row counts of a session's tables."""
    return {name: df.count() for name, df in tables.items()}


def contextualize(question: str, mode: str, focus: str | None, claims: list[str]) -> str:
    """The request with focus and findings in the modes deepen and expand; unchanged in others, or without both."""
    question = question.strip()
    parts = ["Current research focus:\n" + focus.strip()] if focus and focus.strip() else []
    found = [f"- {c}" for c in claims[:CONTEXT_CLAIMS] if c.strip()]
    if found:
        parts.append("\n".join(["Prior findings:", *found]))
    if mode not in ("deepen", "expand") or not parts:
        return question
    return "\n\n".join([*parts, "New request:", question])


def pool(mode: str, final_top_k: int, depth: int, given: int | None = None) -> tuple[int | None, bool, bool]:
    """Candidate pool, and whether seen chunks and seen papers are excluded."""
    if mode in ("deepen", "expand"):
        return given or max(4 * final_top_k, depth), mode == "deepen", mode == "expand"
    return given, False, False


def resolve_branch(branches: list[dict], mode: str, branch_id: str | None, label: str | None, question: str) -> tuple[list[dict], str]:
    """The branches and the active one; mode new makes one, others need one that exists."""
    known = [b["branch_id"] for b in branches]
    if mode == "new":
        made = branch_id or f"b{len(branches) + 1}"
        if made in known:
            raise ValueError(f"branch exists: {made}")
        return [*branches, {"branch_id": made, "seq": len(branches), "label": label or question[:60]}], made
    chosen = branch_id or (known[-1] if known else "")
    if chosen not in known:
        raise ValueError(f"unknown branch: {chosen}")
    return branches, chosen
