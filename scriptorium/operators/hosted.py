"""Embedders behind an HTTP address; nothing uses them unless a caller makes one.

Requests follow the common form of such services: a JSON object with the model's name and a list of inputs, the
reply a list of vectors under "data". Texts of a table go through `embed_column`, in batches in each task.
"""

from __future__ import annotations

import json
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Vector widths of hosted models.
WIDTHS = {"text-embedding-3-small": 1536, "text-embedding-3-large": 3072}


def post(url: str, body: dict, headers: dict[str, str], seconds: float) -> dict:
    """The JSON reply to a JSON request; any failure is a RuntimeError that tells the status or the reason."""
    sent = urllib.request.Request(url, json.dumps(body).encode(), {"Content-Type": "application/json", **headers})
    try:
        with urllib.request.urlopen(sent, timeout=seconds) as reply:
            return json.loads(reply.read())
    except urllib.error.HTTPError as refused:
        raise RuntimeError(f"the embedder replied with HTTP {refused.code}: {refused.read().decode('utf-8', 'replace')}") from refused
    except (urllib.error.URLError, TimeoutError) as failed:
        raise RuntimeError(f"the embedder can't be reached: {getattr(failed, 'reason', failed)}") from failed
    except ValueError as garbled:
        raise RuntimeError("the embedder's reply is no JSON") from garbled


class HttpEmbedder:
    """Vectors from a service. Without a width, the first reply sets it, and another width later is an error."""

    def __init__(self, url: str, model: str, key: str | None = None, dimension: int | None = None, seconds: float = 60.0, send: Callable = post):
        self.url, self.model, self.key, self.seconds, self.send = url, model, key, seconds, send
        self.asked, self.known = dimension, dimension

    @property
    def dimension(self) -> int:
        if self.known is None:
            raise RuntimeError("the width isn't known before the first reply")
        return self.known

    def embed(self, texts: list[str]) -> list[list[float]]:
        if not texts:
            return []
        body = {"model": self.model, "input": list(texts)} | ({"dimensions": self.asked} if self.asked else {})
        reply = self.send(self.url, body, {"Authorization": f"Bearer {self.key}"} if self.key else {}, self.seconds)
        rows = reply.get("data") if isinstance(reply, dict) else None
        if not isinstance(rows, list) or not all(isinstance(r, dict) and isinstance(r.get("embedding"), list) for r in rows):
            raise RuntimeError("the embedder's reply holds no list of vectors")
        if len(rows) != len(texts):
            raise RuntimeError(f"{len(texts)} texts gave {len(rows)} vectors")
        vectors = [[float(x) for x in r["embedding"]] for r in rows]
        for v in vectors:
            self.known = self.known or len(v)
            if len(v) != self.known:
                raise RuntimeError(f"a vector has {len(v)} components where {self.known} are due")
        return vectors


def hosted(model: str, key: str | None, url: str, dimension: int | None = None, **more) -> HttpEmbedder:
    """An embedder that needs a key, of a width known beforehand."""
    if not key:
        raise RuntimeError("a hosted embedder needs a key")
    width = dimension or WIDTHS.get(model)
    if width is None:
        raise RuntimeError(f"give the width of {model}")
    return HttpEmbedder(url, model, key, width, **more)


def embed_column(rows: DataFrame, embedder, text_col: str = "text", out: str = "embedding", at_once: int = 64) -> DataFrame:
    """All rows and columns, and the embedder's vectors in `out`; null texts count as empty; a column `out` is replaced.

    Tasks repeat their requests when an executor is lost; vectors don't depend on how rows are shared out.
    """
    kept = [f for f in rows.schema.fields if f.name != out]
    rows = rows.select(*[rows[f"`{f.name}`"] for f in kept])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(batch.schema.get_field_index(text_col)).to_pylist()]
            vectors = [v for i in range(0, len(texts), at_once) for v in embedder.embed(texts[i : i + at_once])]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(vectors, pa.list_(pa.float32()))], names=[*batch.schema.names, out])

    return rows.mapInArrow(run, T.StructType([*kept, T.StructField(out, T.ArrayType(T.FloatType()))]))
