"""The training-data operators as named queries."""

from __future__ import annotations

import corpus_pipeline
from scriptorium.llm import bpe, chat, decontaminate, embeddings, katz, licenses, pii, secrets, simhash, toxicity
from scriptorium.llm.common import table

QUERIES = {
    "op1_bpe": lambda spark, d: bpe.digest(table(spark, d, "documents")),
    "op2_secrets": lambda spark, d: secrets.digest(table(spark, d, "documents")),
    "op3_decontamination": lambda spark, d: decontaminate.digest(table(spark, d, "documents"), table(spark, d, "benchmark")),
    "op4_katz": lambda spark, d: katz.digest(table(spark, d, "documents"), seen=1),
    "op5_chat": lambda spark, d: chat.digest(chat.with_test_conversation(spark, table(spark, d, "conversations"))),
    "op6_toxicity": lambda spark, d: toxicity.digest(table(spark, d, "documents"), table(spark, d, "labels")),
    "op7_simhash": lambda spark, d: simhash.digest(table(spark, d, "documents")),
    "op8_embeddings": lambda spark, d: embeddings.near_copies(table(spark, d, "embeddings")),
    "op9_licenses": lambda spark, d: licenses.digest(table(spark, d, "documents")),
    "op10_pii": lambda spark, d: pii.digest(table(spark, d, "documents")),
    "pipeline": corpus_pipeline.run,
}
WORDS_SQL = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
ORACLES: dict[str, str] = {
    "op3_decontamination": f"""WITH d AS (SELECT doc_id, {WORDS_SQL} AS w FROM documents),
b AS (SELECT item_id::VARCHAR AS item, w, least(10, len(w)) AS n FROM (SELECT item_id, {WORDS_SQL} AS w FROM benchmark) WHERE len(w) > 0),
windows AS (SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM (SELECT item, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM b)),
places AS (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n),
hits AS (SELECT doc_id, i, places.n, item FROM places JOIN windows ON places.n = windows.n AND array_to_string(w[i:i + places.n - 1], ' ') = g),
covered AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS x FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS listed FROM hits GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(listed, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)""",
}
