"""Toxic passages as maximum-scoring segments of token log-odds.

Learning: tokens are words and their beginnings of three to seven characters, which catch inflected and compound
forms. Of labelled documents, distinct texts only, each token's document counts in either class give a log-odds
ratio with an informative Dirichlet prior (the token's overall share) and its z value. Tokens that are
significantly toxic, and at least exp(LEAST_ODDS) times as likely in toxic documents, keep their log-odds: weaker
ones tell languages and topics apart rather than toxicity. A word scores as its best token; all words pay a
small drift, so that a random text's expected score is negative. Scoring: one linear scan finds all maximal
segments of a text (Ruzzo and Tompa). The best one's score is calibrated by the extreme-value law of such
segments: the expected number of segments as good in a random text of that length is E = K n exp(-lambda S), with
lambda from the token distribution of the other class and K from its texts. A logistic curve, fitted on the
learning rows, turns log E and the number of significant segments into a probability.

No token is left out for its number: one whose z could not reach LEAST_Z even if no other document held it is
dropped before the others are counted, which changes nothing, and only those that pass both tests are collected.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptorium.llm.common import keep_rows, map_rows, only
from scriptorium.llm.decontaminate import words_of

#: At most so many labelled rows are learnt from (those of least hash).
MOST_ROWS = 200_000
BEGINNINGS = range(3, 8)
CACHED_WORDS = 400_000
#: Minus the logarithm of log 2: the median of the standard extreme-value law.
GUMBEL_MEDIAN = 0.3665
PRIOR, LEAST_Z, LEAST_ODDS, DRIFT, SIGNIFICANT = 2000.0, 3.0, 2.0, 0.05, 0.01
THRESHOLD = 0.7


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score), in linear time."""
    places = np.flatnonzero(scores > 0)
    if not len(places):
        return []
    total = np.concatenate([[0.0], np.cumsum(scores)])
    found: list[list] = []  # start, end, cumulative before, cumulative after, nearest earlier one that begins lower
    for i in places.tolist():
        start, end, before, after = i, i + 1, total[i], total[i + 1]
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= before:
                j = found[j][4]
            if j < 0 or found[j][3] >= after:
                found.append([start, end, before, after, j])
                break
            start, before = found[j][0], found[j][2]
            del found[j:]
    return [(s, e, float(a - b)) for s, e, b, a, _ in found]


def tokens_of(words: list[bytes]) -> set[str]:
    """The distinct tokens of a text's words: the words, and their beginnings with a tilde."""
    own = {w.decode("utf-8", "replace") for w in set(words)}
    return own | {w[:n] + "~" for w in own for n in BEGINNINGS if len(w) > n}


class Scores(dict):
    """Word to score, worked out once; of bounded size."""

    def __init__(self, tokens: dict[str, float], drift: float):
        super().__init__()
        self.tokens, self.drift = tokens, drift

    def __missing__(self, word: bytes) -> float:
        if len(self) > CACHED_WORDS:
            self.clear()
        found = max((self.tokens.get(t, 0.0) for t in tokens_of([word])), default=0.0) - self.drift
        self[word] = found
        return found


@dataclass
class Model:
    """What is learnt: token scores, the extreme-value law, the logistic curve."""

    tokens: dict[str, float] = field(default_factory=dict)
    rate: float = 1.0
    log_k: float = 0.0
    curve: tuple[float, ...] = (-4.0, 0.0, 0.0)
    drift: float = DRIFT

    def __post_init__(self):
        self.scores = Scores(self.tokens, self.drift)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "scores"}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.__post_init__()

    def passages(self, text: str | None) -> tuple[int, list[tuple[int, int, float]]]:
        """Number of words, and maximal segments of words with their scores."""
        words = words_of(text)
        return len(words), segments(np.fromiter(map(self.scores.__getitem__, words), np.float64, len(words)))

    def expected(self, n: int, score: float) -> float:
        """log10 of the expected number of segments this good in a random text of n words."""
        return (self.log_k + math.log(max(n, 1)) - self.rate * score) / math.log(10)

    def features(self, n: int, found: list[tuple[int, int, float]]) -> tuple[float, float]:
        """How far below one the expected number of the best segment is, in powers of ten; log of the number of significant ones."""
        if not found:
            return 0.0, 0.0
        logs = [self.expected(n, s) for *_, s in found]
        return min(30.0, max(-5.0, -min(logs))), math.log1p(sum(x < math.log10(SIGNIFICANT) for x in logs))

    def judged(self, n: int, found: list[tuple[int, int, float]]) -> float:
        a, b = self.features(n, found)
        x = self.curve[0] + self.curve[1] * a + self.curve[2] * b
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, x))))

    def probability(self, text: str | None) -> float:
        return self.judged(*self.passages(text))


def known_labels(docs: DataFrame, labels: DataFrame, allowed, id_col: str, text_col: str, most: int) -> dict:
    """id to label of learning rows: one for each distinct text, at most `most` of them, of least hash."""
    rows = labels.select(F.col("doc_id").alias("id"), F.col("toxic").alias("label")).where("id IS NOT NULL AND label IS NOT NULL")
    rows = rows.where(allowed(F.col("id"))).groupBy("id").agg(F.max("label").alias("label"))
    texts = only(docs, id=id_col, text=text_col).select("id", F.xxhash64("text").alias("key"))
    one = texts.join(rows, "id").groupBy("key").agg(F.min_by(F.struct("id", "label"), "id").alias("r")).select("r.*")
    return {r["id"]: int(r["label"] > 0) for r in one.orderBy(F.xxhash64("id"), "id").limit(most).toLocalIterator()}


def weighed(c1, c0, n1: int, n0: int):
    """Log-odds ratio and z of tokens in c1 of n1 toxic and c0 of n0 other documents; z falls as c0 grows."""
    prior = PRIOR * (c1 + c0) / F.lit(n1 + n0) / 10
    a1, a0, mass = c1 + prior + 0.01, c0 + prior + 0.01, PRIOR / 10 + 0.01
    odds = F.log(a1 / (n1 + mass - a1 + 1)) - F.log(a0 / (n0 + mass - a0 + 1))
    return odds, odds / F.sqrt(1 / a1 + 1 / a0)


def fit(docs: DataFrame, labels: DataFrame, allowed=lambda doc_id: F.lit(True), id_col: str = "doc_id", text_col: str = "text",
        most_rows: int = MOST_ROWS) -> Model:
    """Learn from the labelled rows whose id satisfies `allowed` (a column condition).

    Null ids, labels and texts teach nothing; of repeated ids the higher label holds; with one class only, or
    no labels, every text gets the same low score.
    """
    spark = docs.sparkSession
    classes = known_labels(docs, labels, allowed, id_col, text_col, most_rows)
    sent = spark.sparkContext.broadcast(classes)
    given = only(docs, id=id_col, text=text_col).where("id IS NOT NULL")
    n1 = sum(classes.values())
    n0 = len(classes) - n1
    if not n1 or not n0:
        return Model()

    def toxic(rows):
        seen: Counter = Counter()
        for row in rows:
            if sent.value.get(row["id"]):
                seen.update(tokens_of(words_of(row["text"])))
        for token, n in seen.items():
            yield {"token": token, "c": n}

    counted = map_rows(given, "token string, c bigint", toxic).groupBy("token").agg(F.sum("c").alias("c1"))
    odds, z = weighed(F.col("c1"), F.lit(0), n1, n0)
    promising = {r["token"]: r["c1"] for r in counted.where((odds >= LEAST_ODDS) & (z >= LEAST_Z)).toLocalIterator()}
    watched = spark.sparkContext.broadcast(frozenset(promising))

    def clean(rows):
        seen: Counter = Counter()
        words = 0
        for row in rows:
            if sent.value.get(row["id"]) == 0:
                own = words_of(row["text"])
                words += len(own)
                seen.update(tokens_of(own) & watched.value)
        for token, n in seen.items():
            yield {"token": token, "c": n}
        yield {"token": None, "c": words}

    others = {r["token"]: r["c"] for r in map_rows(given, "token string, c bigint", clean).groupBy("token").agg(F.sum("c").alias("c")).toLocalIterator()}
    words = max(1, others.pop(None, 0))
    counts = spark.createDataFrame([(t, c, others.get(t, 0)) for t, c in promising.items()], "token string, c1 bigint, c0 bigint") if promising else None
    odds, z = weighed(F.col("c1"), F.col("c0"), n1, n0)
    kept = counts.select("token", "c0", odds.alias("odds"), z.alias("z")).where((F.col("odds") >= LEAST_ODDS) & (F.col("z") >= LEAST_Z)).collect() if promising else []
    model = Model({r["token"]: float(r["odds"]) for r in sorted(kept, key=lambda r: r["token"])})
    share = [(r["odds"] - DRIFT, r["c0"] / words) for r in kept if r["c0"]]
    model.rate = _rate(share, 1 - sum(p for _, p in share))

    def best(rows):
        for row in rows:
            if sent.value.get(row["id"]) == 0:
                n, found = model.passages(row["text"])
                if found:
                    yield {"level": model.rate * max(s for *_, s in found) - math.log(max(n, 1))}

    level = map_rows(given, "level double", best).agg(F.median("level")).first()[0]
    if level is not None:
        model.log_k = float(level) - GUMBEL_MEDIAN

    def measure(rows):
        for row in rows:
            if (label := sent.value.get(row["id"])) is not None:
                a, b = model.features(*model.passages(row["text"]))
                yield {"label": label, "a": a, "b": b}

    # Equal rows of features weigh as one with their number, so that few reach the driver.
    seen = map_rows(given, "label int, a double, b double", measure).groupBy("label", F.round("a", 2).alias("a"), F.col("b")).count().toPandas()
    x = np.column_stack([np.ones(len(seen)), seen.a, seen.b])
    model.curve = _logistic(x, seen.label.to_numpy(float), seen["count"].to_numpy(float))
    return model


def _rate(scores: list[tuple[float, float]], rest: float) -> float:
    """The positive root of sum p exp(lambda s) = 1."""
    def over(x):
        return sum(p * math.exp(min(x * s, 300)) for s, p in scores) + rest * math.exp(-x * DRIFT) - 1

    low, high = 1e-3, 5.0
    if not scores or over(low) >= 0:
        return 0.5
    while over(high) < 0 and high < 100:
        high *= 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if over(mid) < 0 else (low, mid)
    return max(0.2, min(2.0, high))


def _logistic(x: np.ndarray, y: np.ndarray, times: np.ndarray, ridge: float = 1e-3) -> tuple[float, ...]:
    """Weights of rows x with labels y, each of which counts so many times."""
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (times * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (times * (y - p)) - ridge * w)
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(map(float, w))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, score, passages array<struct<start, end, score>> of significant word ranges).

    One row for each input row; null and empty texts have no passage and the score of such texts; null and
    repeated ids keep their rows; an empty table gives no rows; other columns are ignored.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def work(rows) -> Iterator[dict]:
        own = sent.value
        limit = math.log10(SIGNIFICANT)
        for row in rows:
            n, found = own.passages(row["text"])
            kept = [{"start": s, "end": e, "score": x} for s, e, x in found if own.expected(n, x) < limit]
            yield {"doc_id": row["doc_id"], "score": own.judged(n, found), "passages": kept}

    return map_rows(only(docs, doc_id=id_col, text=text_col), f"doc_id {kind}, score double, passages array<struct<start bigint, end bigint, score double>>", work)


def keep_clean(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """docs, all columns, without the rows that score the threshold or more.

    A null or empty text scores as one without passages and stays; repeated rows are judged alike, null ids are
    rows like others; an empty table gives no rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return keep_rows(docs, text_col, lambda texts: (texts, [sent.value.probability(t) < threshold for t in texts]))


def held_out(doc_id):
    """Rows that are never learnt from, by id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The contract's columns, from the operator's scores."""
    model = fit(docs, labels, lambda i: ~held_out(i))
    return score(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                                     (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), F.size("passages").alias("n_passages"))
