"""Texts for language models and for people, put together on the driver from bounded lists."""

from __future__ import annotations

from collections.abc import Iterable

NONE = "[none]"


def claims_prompt(question: str, batch_index: int, chunk_ids: list[str], summary: str) -> str:
    """Asks for the claims of one batch's summary as JSON."""
    return "\n\n".join([
        f"Question: {question.strip()}", f"Summary {batch_index} of the chunks {', '.join(chunk_ids)}:\n{summary.strip()}",
        'Name the claims that this summary supports, two at most. Reply with JSON only: {"claims_added": [{"text": "", "status": "supported", "confidence": "medium"}]}',
    ])


def followups_prompt(question: str, synthesis: str) -> str:
    """Asks for two to four further questions as JSON."""
    return "\n\n".join([f"Question: {question.strip()}", f"Answer so far:\n{synthesis.strip()}", 'Name two to four questions that remain. Reply with JSON only: {"followups_added": [{"text": ""}]}'])


def label_prompt(title: str, text: str, quintile: str, labels: Iterable[str], previous_label: str | None = None, context: str = "") -> str:
    """Asks for the label of a section that its title doesn't settle."""
    parts = [f"Section title: {title}", f"Place in the article: {quintile}", f"Label of the section before: {previous_label or NONE}", f"Text:\n{text.strip()}"]
    if context:
        parts.append(f"Text around it:\n{context.strip()}")
    return "\n\n".join([*parts, f'Reply with JSON only: {{"action": "label", "label": one of {", ".join(labels)}, "confidence": "high", "medium" or "low", "reason": ""}}, or with the action "context" to see the text around it.'])


def plan_prompt(question: str, summary: str, modes: Iterable[str], tools: Iterable[str], most_calls: int) -> str:
    """Asks for an evidence plan as JSON."""
    return "\n\n".join([f"Prior summary:\n{summary.strip()}", f"Follow-up question: {question.strip()}", f"Plan at most {most_calls} retrievals. Answer modes: {', '.join(modes)}. Tools: {', '.join(tools)}.",
                        'Reply with JSON only: {"intent": "", "answer_mode": "", "reason": "", "tool_calls": [{"tool": "", "query": "", "filters": {}, "top_k": 6}]}'])


def grounded_prompt(question: str, summary: str, evidence: list[tuple[str, str]]) -> str:
    """Asks for an answer from (chunk_id, text) pairs alone."""
    shown = "\n\n".join(f"[{i}]\n{t}" for i, t in evidence) or NONE
    return "\n\n".join([f"Prior summary:\n{summary.strip()}", f"Evidence:\n{shown}", f"Answer from this evidence alone, or say that it does not suffice.\nQuestion: {question.strip()}"])


def listing(rows: Iterable[str], dash: bool = True) -> str:
    """Lines of a list, or the mark for an empty one."""
    return "\n".join(f"- {r}" if dash else r for r in rows) or (f"- {NONE}" if dash else NONE)
