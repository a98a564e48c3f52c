"""Models as interfaces with deterministic stand-ins: embedders and text generators."""

from __future__ import annotations

import hashlib
import json
import math
import re
from typing import Protocol

from scriptorium.operators.search import query_terms


class Embedder(Protocol):
    dimension: int

    def embed(self, texts: list[str]) -> list[list[float]]: ...


class HashEmbedder:
    """The driver's twin of functions.vectors.hash_embedding."""

    def __init__(self, dimension: int = 256):
        if dimension <= 0:
            raise ValueError("the dimension must be positive")
        self.dimension = dimension

    def embed(self, texts: list[str]) -> list[list[float]]:
        out = []
        for text in texts:
            v = [0.0] * self.dimension
            for token in text.lower().split():
                d = hashlib.sha256(token.encode()).digest()
                v[int.from_bytes(d[:8], "big") % self.dimension] += 1.0 if d[8] % 2 == 0 else -1.0
            norm = math.sqrt(sum(x * x for x in v))
            out.append([x / norm for x in v] if norm else v)
        return out


class TextGenerator(Protocol):
    def generate(self, prompt: str, max_tokens: int = 512) -> str: ...


class Extractive:
    """First sentences in place of a language model."""

    def generate(self, prompt: str, max_tokens: int = 512) -> str:
        words = (re.split(r"(?<=[.!?])\s", prompt.strip())[0] if prompt.strip() else "").split()
        return " ".join(words[:max_tokens])


class ResearchModel(Protocol):
    """What a session turn asks of a language model; claims and followups reply in JSON."""

    def summarize(self, question: str, prompt: str) -> str: ...

    def synthesize(self, question: str, summaries: list[str]) -> str: ...

    def claims(self, prompt: str, summary: str) -> str: ...

    def followups(self, prompt: str, synthesis: str) -> str: ...


class ExtractiveResearch:
    """Sentences of the passages in place of a language model."""

    def summarize(self, question: str, prompt: str) -> str:
        return Extractive().generate(prompt.split("Chunk text:\n", 1)[-1])

    def synthesize(self, question: str, summaries: list[str]) -> str:
        return " ".join(summaries)

    def claims(self, prompt: str, summary: str) -> str:
        return json.dumps({"claims_added": [{"text": summary, "status": "supported", "confidence": "medium"}]})

    def followups(self, prompt: str, synthesis: str) -> str:
        terms = query_terms(synthesis)[:2]
        return json.dumps({"followups_added": [{"text": f"What else is known of {t}?"} for t in terms]})


def rewrites(query: str, n: int = 2) -> list[str]:
    """n rewordings: the query's terms, then rotations of them; an error if there are no terms."""
    terms = query_terms(query)
    if n and not terms:
        raise RuntimeError("no terms to rewrite")
    return [" ".join(terms[i % len(terms) :] + terms[: i % len(terms)]) for i in range(n)]


def hypothetical_answer(query: str) -> str:
    return f"This passage answers: {query}"
