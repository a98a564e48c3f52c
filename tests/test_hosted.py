"""Embedders over HTTP, against a server of this test."""

import json
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest

from scriptorium.operators import hosted, models


class Replies(BaseHTTPRequestHandler):
    asked: list = []

    def do_POST(self):
        body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
        Replies.asked.append((body, self.headers.get("Authorization")))
        status, reply = 200, {"data": [{"embedding": [len(t), 1]} for t in body["input"]]}
        if body["model"] == "refuses":
            status, reply = 429, {"error": "slow down"}
        if body["model"] == "short":
            reply["data"] = reply["data"][1:]
        if body["model"] == "grows":
            reply["data"] = [{"embedding": [0.0] * len(t)} for t in body["input"]]
        if body["model"] == "odd":
            reply = {"data": [{"vector": []}]}
        self.send_response(status)
        self.end_headers()
        self.wfile.write(json.dumps(reply).encode())

    def log_message(self, *_):
        pass


@pytest.fixture(scope="module")
def url():
    server = HTTPServer(("127.0.0.1", 0), Replies)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}/embeddings"
    server.shutdown()


def test_vectors_come_in_order_and_widths_hold(url):
    own = hosted.HttpEmbedder(url, "m", "k")
    with pytest.raises(RuntimeError):
        own.dimension
    assert own.embed([]) == [] and own.embed(["a", "bcd"]) == [[1.0, 1.0], [3.0, 1.0]] and own.dimension == 2
    assert Replies.asked[-1] == ({"model": "m", "input": ["a", "bcd"]}, "Bearer k")
    grows = hosted.HttpEmbedder(url, "grows")
    grows.embed(["ab"])
    for model, text in (("refuses", "429"), ("short", "1 vectors"), ("odd", "no list")):
        with pytest.raises(RuntimeError, match=text):
            hosted.HttpEmbedder(url, model).embed(["a", "b"])
    with pytest.raises(RuntimeError, match="3 components"):
        grows.embed(["abc"])
    with pytest.raises(RuntimeError, match="reached"):
        hosted.HttpEmbedder("http://127.0.0.1:9/none", "m", seconds=2).embed(["a"])


def test_hosted_models_need_a_key_and_a_width(url):
    with pytest.raises(RuntimeError):
        hosted.hosted("text-embedding-3-small", None, url)
    with pytest.raises(RuntimeError):
        hosted.hosted("other", "k", url)
    assert hosted.hosted("text-embedding-3-large", "k", url).dimension == 3072
    two = hosted.hosted("other", "k", url, 2)
    assert two.embed(["abc"]) == [[3.0, 1.0]] and Replies.asked[-1][0]["dimensions"] == 2


def test_a_table_is_embedded_in_batches(spark, url):
    rows = [(i, "x" * i if i else None, "old") for i in range(150)]
    df = spark.createDataFrame(rows, "chunk_id long, text string, embedding string").repartition(3)
    out = hosted.embed_column(df, hosted.HttpEmbedder(url, "m"), at_once=7)
    assert out.columns == ["chunk_id", "text", "embedding"]
    assert {r["chunk_id"]: r["embedding"] for r in out.collect()} == {i: [float(i), 1.0] for i in range(150)}
    assert hosted.embed_column(df.limit(0), models.HashEmbedder(4)).collect() == []
