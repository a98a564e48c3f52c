"""Planned follow-up retrieval: parse and check an evidence plan, retrieve per call, pool the evidence."""

from __future__ import annotations

import json
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptorium.functions.constants import ANSWER_ALIASES, ANSWER_MODES
from scriptorium.operators import filters, fusion, search

TOP_K, MOST_TOP_K, MOST_CALLS, TOOLS = 6, 12, 3, ("retrieve_evidence",)


@dataclass(frozen=True)
class ToolCall:
    query: str
    tool: str = TOOLS[0]
    filters: filters.QueryFilters = field(default_factory=filters.QueryFilters)
    top_k: int = TOP_K


@dataclass(frozen=True)
class Plan:
    intent: str
    answer_mode: str
    reason: str
    tool_calls: tuple[ToolCall, ...]


def parse_plan(reply: str) -> Plan:
    """A plan from a model's JSON; scalars where lists are due become lists, empty strings null."""
    start, end = reply.find("{"), reply.rfind("}")
    if start < 0 or end < start:
        raise ValueError("the plan has no JSON object")
    raw = json.loads(reply[start : end + 1])
    calls = raw.get("tool_calls")
    if not isinstance(calls, list):
        raise ValueError("tool_calls must be a list")

    def cleaned(f: dict) -> filters.QueryFilters:
        out = {}
        for k, v in (f or {}).items():
            if k in filters.QueryFilters.__dataclass_fields__ and v not in ("", None):
                out[k] = [v] if k.endswith(("_in", "_any")) and not isinstance(v, list) else v
        return filters.QueryFilters(**out)

    return check_plan(Plan(str(raw.get("intent") or ""), str(raw.get("answer_mode") or ""), str(raw.get("reason") or ""), tuple(
        ToolCall(str(c.get("query") or ""), str(c.get("tool") or TOOLS[0]), cleaned(c.get("filters")), int(TOP_K if c.get("top_k") is None else c["top_k"])) for c in calls)))


def check_plan(plan: Plan) -> Plan:
    """The plan with alias modes resolved, empty names left out of lists and top_k in bounds, or ValueError."""
    mode = plan.answer_mode.strip().lower()
    mode = ANSWER_ALIASES.get(mode, mode)
    if not plan.intent or not plan.reason or mode not in ANSWER_MODES or not 1 <= len(plan.tool_calls) <= MOST_CALLS:
        raise ValueError("the plan lacks intent, reason, a known answer mode or one to three calls")
    calls = []
    for c in plan.tool_calls:
        top_k = TOP_K if c.top_k == 0 else c.top_k
        f = c.filters
        if not c.query or c.tool not in TOOLS or top_k < 0 or (f.year_min is not None and f.year_max is not None and f.year_min > f.year_max):
            raise ValueError("a call lacks a query or a known tool, or its limits are contrary")
        f = replace(f, **{k: [x for x in getattr(f, k) if x] for k in ("paper_id_in", "authors_any", "classification_label_in")})
        calls.append(ToolCall(c.query, c.tool, f, min(top_k, MOST_TOP_K)))
    return Plan(plan.intent, mode, plan.reason, tuple(calls))


def retrieve(chunks: DataFrame, plan: Plan, embed) -> DataFrame:
    """Rows of fused evidence by call_index; each call searches hybrid and full text."""
    parts = []
    for i, call in enumerate(plan.tool_calls):
        own = filters.apply(chunks, call.filters)
        both = search.hits(search.hybrid_topk(own, call.query, embed(call.query), call.top_k), "followup_hybrid", "hybrid").unionByName(
            search.hits(search.fts_topk(own, call.query, call.top_k), "followup_fts", "fts"))
        parts.append(fusion.fuse(both, call.top_k).withColumn("call_index", F.lit(i)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def pooled(evidence: DataFrame) -> DataFrame:
    """Distinct chunks over all calls, in the order of their first use."""
    first = evidence.groupBy("chunk_id").agg(F.min(F.struct("call_index", (-F.col("rrf_score")).alias("s"))).alias("at"))
    return first.orderBy("at", "chunk_id").select("chunk_id")


def insufficient(evidence: DataFrame) -> bool:
    """No call found anything."""
    return evidence.isEmpty()
