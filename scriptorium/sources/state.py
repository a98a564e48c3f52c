"""A research session's state: six tables, kept as numbered Parquet snapshots, and its JSON form.

A snapshot counts only once its marker is written, last, so that a save that breaks off leaves the one before in
force. The JSON form is read with defaults for fields that older files lack.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = {
    "session": "session_id string, created_at string, updated_at string, root_query string, active_branch_id string",
    "branches": "branch_id string, seq int, label string, created_at string",
    "turns": """turn_id string, turn_seq int, branch_id string, run_mode string, user_question string, contextualized_query string, timestamp string,
synthesized_summary string, query_output_path string, chunk_ids array<string>, paper_ids array<string>""",
    "claims": "claim_id string, seq int, turn_seq int, branch_id string, created_in_turn string, text string, status string, confidence string, evidence_chunk_ids array<string>",
    "followups": "question_id string, seq int, turn_seq int, branch_id string, created_in_turn string, text string",
    "evidence": "chunk_id string, turn_seq int, paper_id string, section_label string, section_title string",
}
#: The fields of the JSON form that are read; questions have two names.
JSON = """session_id string, created_at string, updated_at string, root_query string, active_branch_id string, branch_order array<string>,
branches map<string,struct<label:string,created_at:string>>, turn_order array<string>,
turns map<string,struct<branch_id:string,run_mode:string,user_question:string,timestamp:string,contextualized_query:string,query_output_path:string,synthesized_summary:string,retrieved_chunk_ids:array<string>>>,
claims map<string,struct<text:string,status:string,confidence:string,evidence_chunk_ids:array<string>,created_in_turn:string,branch_id:string>>,
followup_suggestions map<string,struct<text:string,created_in_turn:string,branch_id:string>>,
open_questions map<string,struct<text:string,created_in_turn:string,branch_id:string>>,
evidence_index map<string,struct<paper_id:string,section_label:string,section_title:string>>"""


@dataclass(frozen=True)
class Session:
    session: DataFrame
    branches: DataFrame
    turns: DataFrame
    claims: DataFrame
    followups: DataFrame
    evidence: DataFrame

    def counts(self) -> dict[str, int]:
        return {name: getattr(self, name).count() for name in ("branches", "turns", "claims", "followups")}


def initial(spark: SparkSession, session_id: str, root_query: str, now: str) -> Session:
    """A session with the branch b1 and nothing else."""
    rows = {"session": [(session_id, now, now, root_query, "b1")], "branches": [("b1", 0, "main", now)]}
    return Session(**{name: spark.createDataFrame(rows.get(name, []), schema) for name, schema in TABLES.items()})


class SessionStore:
    """Snapshots v000001, v000002, ... below a folder that driver and executors share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def versions(self) -> list[int]:
        """The whole snapshots, oldest first."""
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        done = jvm.org.apache.hadoop.fs.Path(f"{self.path}/v*/complete/_SUCCESS")
        found = done.getFileSystem(conf).globStatus(done)
        return sorted(int(s.getPath().getParent().getParent().getName()[1:]) for s in found or [])

    def exists(self) -> bool:
        return bool(self.versions())

    def load(self, version: int | None = None) -> Session:
        """The newest snapshot or a given one; ValueError if there is none."""
        known = self.versions()
        if not known or version is not None and version not in known:
            raise ValueError("no such session snapshot")
        folder = f"{self.path}/v{version or known[-1]:06d}"
        return Session(**{name: self.spark.read.schema(schema).parquet(f"{folder}/{name}") for name, schema in TABLES.items()})

    def save(self, session: Session) -> int:
        """Write the next snapshot; its number."""
        number = (self.versions() or [0])[-1] + 1
        folder = f"{self.path}/v{number:06d}"
        for name, schema in TABLES.items():
            columns = [c.name for c in T._parse_datatype_string(schema).fields]
            getattr(session, name).select(*columns).coalesce(1).write.mode("overwrite").parquet(f"{folder}/{name}")
        self.spark.range(1).coalesce(1).write.mode("overwrite").parquet(f"{folder}/complete")
        return number


def from_json(spark: SparkSession, path: str) -> Session:
    """The session in a JSON file: claims and questions without branch take their turn's, else the active one.

    A file without sessions, turns, claims or evidence objects is an error, as is one that isn't an object.
    """
    raw = spark.read.schema(JSON).option("multiLine", True).json(path)
    bad = F.col("session_id").isNull() | F.col("turns").isNull() | F.col("claims").isNull() | F.col("evidence_index").isNull()
    if not raw.where(bad).isEmpty() or raw.isEmpty():
        raise ValueError("not a session")
    raw = raw.withColumn("questions", F.coalesce("followup_suggestions", "open_questions"))
    order = F.coalesce("branch_order", F.array(F.lit("b1")))
    turns = raw.select(F.posexplode("turn_order").alias("pos", "turn_id"), "turns", "evidence_index").select(
        "turn_id", (F.col("pos") + 1).alias("turn_seq"), F.try_element_at("turns", "turn_id").alias("t"), "evidence_index").where("t IS NOT NULL")
    papers = F.array_distinct(F.filter(F.transform("t.retrieved_chunk_ids", lambda c: F.try_element_at(F.col("evidence_index"), c)["paper_id"]), lambda p: p.isNotNull()))
    turns = turns.select("turn_id", "turn_seq", F.coalesce("t.branch_id", F.lit("b1")).alias("branch_id"), F.coalesce("t.run_mode", F.lit("continue")).alias("run_mode"), "t.user_question",
                         F.coalesce("t.contextualized_query", F.lit("")).alias("contextualized_query"), "t.timestamp", "t.synthesized_summary", "t.query_output_path",
                         F.coalesce("t.retrieved_chunk_ids", F.array().cast("array<string>")).alias("chunk_ids"), F.coalesce(papers, F.array().cast("array<string>")).alias("paper_ids"))
    listed = raw.select(F.posexplode(order).alias("seq", "branch_id"), "branches", "created_at").select(
        "branch_id", "seq", F.coalesce(F.try_element_at("branches", "branch_id")["label"], F.when(F.col("branch_id") == "b1", "main").otherwise(F.col("branch_id"))).alias("label"),
        F.coalesce(F.try_element_at("branches", "branch_id")["created_at"], "created_at").alias("created_at"))
    unlisted = turns.join(listed, "branch_id", "left_anti").groupBy("branch_id").agg((F.min("turn_seq") + 1_000_000).cast("int").alias("seq"), F.min("timestamp").alias("created_at"))
    branches = listed.unionByName(unlisted.withColumn("label", F.col("branch_id")))
    active = F.when(F.array_contains(order, F.coalesce("active_branch_id", F.lit("b1"))), F.coalesce("active_branch_id", F.lit("b1"))).otherwise(F.element_at(order, 1))
    head = raw.select("session_id", "created_at", "updated_at", "root_query", active.alias("active_branch_id"))
    at = turns.select(F.col("turn_id").alias("created_in_turn"), "turn_seq", F.col("branch_id").alias("turn_branch"))

    def entries(column: str, name: str, fields: list[str]) -> DataFrame:
        rows = raw.select(F.explode(column).alias(name, "e"), active.alias("active"))
        rows = rows.withColumn("seq", F.coalesce(F.regexp_extract(name, r"(\d+)$", 1).try_cast("int"), F.lit(0))).withColumn("created_in_turn", F.col("e.created_in_turn"))
        joined = rows.join(at, "created_in_turn", "left")
        branch = F.coalesce(F.nullif("e.branch_id", F.lit("")), "turn_branch", "active")
        return joined.select(name, "seq", F.coalesce("turn_seq", F.lit(0)).alias("turn_seq"), branch.alias("branch_id"), F.coalesce("created_in_turn", F.lit("")).alias("created_in_turn"), *[f"e.{c}" for c in fields])

    evidence = raw.select(F.explode("evidence_index").alias("chunk_id", "e")).select("chunk_id", F.lit(0).alias("turn_seq"), "e.paper_id", "e.section_label", "e.section_title")
    return Session(head, branches, turns, entries("claims", "claim_id", ["text", "status", "confidence", "evidence_chunk_ids"]), entries("questions", "question_id", ["text"]), evidence)


def to_json(session: Session) -> DataFrame:
    """One row: the session as JSON, in the form that from_json reads."""
    def packed(rows: DataFrame, key: str, *fields: str) -> DataFrame:
        return rows.agg(F.map_from_entries(F.collect_list(F.struct(F.col(key), F.struct(*fields)))).alias("m"))

    turns = session.turns.withColumn("retrieved_chunk_ids", F.col("chunk_ids"))
    parts = {
        "branches": packed(session.branches, "branch_id", "branch_id", "label", "created_at"),
        "turns": packed(turns, "turn_id", "turn_id", "branch_id", "run_mode", "user_question", "timestamp", "contextualized_query", "query_output_path", "synthesized_summary", "retrieved_chunk_ids"),
        "claims": packed(session.claims, "claim_id", "claim_id", "text", "status", "confidence", "evidence_chunk_ids", "created_in_turn", "branch_id"),
        "followup_suggestions": packed(session.followups, "question_id", "question_id", "text", "created_in_turn", "branch_id"),
        "evidence_index": packed(session.evidence, "chunk_id", "chunk_id", "paper_id", "section_label", "section_title"),
        "branch_order": session.branches.agg(F.array_sort(F.collect_list(F.struct("seq", "branch_id"))).alias("m")).select(F.transform("m", lambda x: x["branch_id"]).alias("m")),
        "turn_order": session.turns.agg(F.array_sort(F.collect_list(F.struct("turn_seq", "turn_id"))).alias("m")).select(F.transform("m", lambda x: x["turn_id"]).alias("m")),
    }
    out = session.session
    for name, one in parts.items():
        out = out.crossJoin(F.broadcast(one.withColumnRenamed("m", name)))  # one row each
    return out.select(F.to_json(F.struct(*out.columns)).alias("value"))
