"""Quality of a text by a small convolutional network over its bytes, trained and run in numpy.

A text is cut into overlapping chunks that cover it. Bytes are embedded, learned filters slide over each chunk, the strongest response of
each filter in the chunk goes through a hidden layer to a chunk score, and the chunk scores are averaged into one probability.

Null and empty texts are one chunk of padding, so they too have a score. Ties do not arise; repeated rows get equal scores. One row per
input row; other columns are left out (``score``) or kept as they are (``filter_quality``).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tether.llm.texts import held_out, judged, map_texts

CHUNK, STEP = 512, 448
KERNEL, STRIDE, EMBEDDING, FILTERS, HIDDEN = 8, 4, 8, 48, 24
PAD = 0
# Training sample: for each label one document of each of so many shares of the ids, and so many of its first bytes' chunks.
SHARES, SAMPLE_CHARS, SAMPLE_CHUNKS = 1500, 3000, 6
STEPS, BATCH, RATE = 1000, 32, 0.004
THRESHOLD = 0.7
CHUNKS_AT_ONCE = 256

Weights = dict[str, np.ndarray]


def chunks(texts: list[bytes], step: int = STEP) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``CHUNK`` bytes covering all texts in turn, and the first row of each text."""
    counts = [1 + max(0, -(-(len(t) - CHUNK) // step)) for t in texts]
    first = np.cumsum([0, *counts[:-1]]) if counts else np.zeros(0, dtype=np.int64)
    rows = np.full((sum(counts), CHUNK), PAD, dtype=np.uint8)
    for text, at, n in zip(texts, first, counts):
        data = np.frombuffer(text, dtype=np.uint8)
        for i in range(n):
            part = data[i * step : i * step + CHUNK]
            rows[at + i, : len(part)] = part
    return rows, first


def initial(seed: int = 7) -> Weights:
    draw = np.random.default_rng(seed)

    def normal(*shape: int, scale: float) -> np.ndarray:
        return draw.normal(0, scale, shape).astype(np.float32)

    return {
        "embed": normal(256, EMBEDDING, scale=0.5),
        "filters": normal(KERNEL * EMBEDDING, FILTERS, scale=(2 / (KERNEL * EMBEDDING)) ** 0.5),
        "filter_bias": np.zeros(FILTERS, dtype=np.float32),
        "hidden": normal(FILTERS, HIDDEN, scale=(2 / FILTERS) ** 0.5),
        "hidden_bias": np.zeros(HIDDEN, dtype=np.float32),
        "out": normal(HIDDEN, scale=(1 / HIDDEN) ** 0.5),
        "out_bias": np.zeros(1, dtype=np.float32),
    }


def windows(rows: np.ndarray) -> np.ndarray:
    """``(chunks, places, KERNEL)`` view of the bytes under the filters."""
    return np.lib.stride_tricks.sliding_window_view(rows, KERNEL, axis=1)[:, ::STRIDE]


def responses(rows: np.ndarray, w: Weights) -> np.ndarray:
    """``(chunks, places, FILTERS)``."""
    embedded = w["embed"][rows].reshape(len(rows), -1)
    seen = np.lib.stride_tricks.sliding_window_view(embedded, KERNEL * EMBEDDING, axis=1)[:, :: STRIDE * EMBEDDING]
    return seen @ w["filters"]


def chunk_scores(rows: np.ndarray, w: Weights) -> np.ndarray:
    out = []
    for i in range(0, len(rows), CHUNKS_AT_ONCE):
        pooled = np.maximum(responses(rows[i : i + CHUNKS_AT_ONCE], w).max(axis=1) + w["filter_bias"], 0)
        out.append(np.maximum(pooled @ w["hidden"] + w["hidden_bias"], 0) @ w["out"] + w["out_bias"])
    return np.concatenate(out)


def probability(texts: list[bytes], w: Weights) -> np.ndarray:
    """One probability per text; texts are taken whole."""
    if not texts:
        return np.zeros(0)
    rows, first = chunks(texts)
    scores = chunk_scores(rows, w).astype(np.float64)
    mean = np.add.reduceat(scores, first) / np.diff(np.append(first, len(rows)))
    return 1 / (1 + np.exp(-np.clip(mean, -30, 30)))


def train(texts: list[bytes], labels: list[int], seed: int = 7) -> Weights:
    """Weights after a fixed number of steps, each on as many texts of either label."""
    w, draw = initial(seed), np.random.default_rng(seed)
    target = np.array(labels, dtype=np.float32)
    groups = [np.flatnonzero(target == v) for v in (0, 1)]
    if not len(groups[0]) or not len(groups[1]):
        # Nothing to tell apart: all texts get the one label there is (or one half).
        w["out"][:] = 0
        w["out_bias"][:] = 0 if not len(target) else 4 * (1 if target[0] else -1)
        return w
    momentum = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in w.items()}
    for step in range(1, STEPS + 1):
        chosen = np.concatenate([draw.choice(g, BATCH // 2) for g in groups])
        rows, first = chunks([_shortened(texts[i], draw) for i in chosen])
        counts = np.diff(np.append(first, len(rows)))
        # A few chunks of each text, in turn from a random one.
        picked = [f + (draw.integers(c) + np.arange(min(c, SAMPLE_CHUNKS))) % c for f, c in zip(first, counts)]
        owner = np.repeat(np.arange(len(chosen)), [len(p) for p in picked])
        gradients = _gradients(rows[np.concatenate(picked)], owner, target[chosen], w)
        rate = RATE * (1 - step / (STEPS + 1))
        for k, g in gradients.items():
            m, v = momentum[k]
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w[k] -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return w


def _shortened(text: bytes, draw: np.random.Generator) -> bytes:
    """Every third text as a short passage of itself, so that short texts are learned too."""
    if draw.integers(3) or len(text) < 16:
        return text
    size = int(draw.integers(8, 400))
    start = int(draw.integers(max(1, len(text) - size)))
    return text[start : start + size]


def _gradients(rows: np.ndarray, owner: np.ndarray, target: np.ndarray, w: Weights) -> Weights:
    """Gradient of the mean logistic loss of texts, whose score is the mean of their chunks'."""
    found = responses(rows, w)
    strongest = found.argmax(axis=1)
    best = np.take_along_axis(found, strongest[:, None, :], axis=1)[:, 0] + w["filter_bias"]
    pooled = np.maximum(best, 0)
    before = pooled @ w["hidden"] + w["hidden_bias"]
    hidden = np.maximum(before, 0)
    scores = hidden @ w["out"] + w["out_bias"]
    counts = np.bincount(owner, minlength=len(target))
    logits = np.bincount(owner, scores, minlength=len(target)) / counts
    d_scores = (((1 / (1 + np.exp(-logits)) - target) / len(target) / counts)[owner]).astype(np.float32)
    d_before = np.outer(d_scores, w["out"]) * (before > 0)
    d_best = (d_before @ w["hidden"].T) * (best > 0)
    # The bytes under each filter's strongest place: (chunks, filters, KERNEL).
    under = windows(rows)[np.arange(len(rows))[:, None], strongest]
    seen = w["embed"][under].reshape(len(rows), FILTERS, -1)
    d_seen = (d_best[:, :, None] * w["filters"].T[None]).reshape(-1, EMBEDDING)
    d_embed = np.stack([np.bincount(under.ravel(), d_seen[:, e], minlength=256) for e in range(EMBEDDING)], axis=1)
    return {
        "embed": d_embed.astype(np.float32),
        "filters": np.einsum("cf,cfk->kf", d_best, seen),
        "filter_bias": d_best.sum(axis=0),
        "hidden": pooled.T @ d_before,
        "hidden_bias": d_before.sum(axis=0),
        "out": hidden.T @ d_scores,
        "out_bias": d_scores.sum(keepdims=True),
    }


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> Weights:
    """Weights from labelled documents that are not held out. Runs a job.

    The sample has at most ``SHARES`` documents of each label and ``SAMPLE_CHARS`` characters of each, and the number of training steps is
    fixed, so neither grows with the corpus. Rows without label are left out.
    """
    known = labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label")).where("label in (0, 1)").where(~held_out("key")).distinct()
    turn = F.xxhash64("key")
    drawn = known.groupBy("label", F.pmod(turn, F.lit(SHARES)).alias("share")).agg(F.min(F.struct(turn.alias("turn"), "key"))["key"].alias("key"))
    rows = docs.select(F.col(key).alias("key"), F.substring(F.coalesce(F.col(text), F.lit("")), 1, SAMPLE_CHARS).alias("text"))
    # At most two rows for each share: few enough to be sent to every task.
    sample = sorted(rows.join(F.broadcast(drawn), "key").select("key", "label", "text").collect(), key=lambda r: (r.key, r.label, r.text))
    return train([r.text.encode() for r in sample], [r.label for r in sample])


def _work(w: Weights):
    return lambda texts: {"score": probability(texts, w).tolist()}


def score(docs: DataFrame, weights: Weights, threshold: float = THRESHOLD, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, held_out, score, predicted)``."""
    found = map_texts(docs, key, text, _work(weights), "score double", binary=True)
    return found.select(key, held_out(key).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def filter_quality(docs: DataFrame, weights: Weights, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """``docs`` without the rows whose score is below ``threshold``; all columns as they were."""
    return judged(docs, text, _work(weights), "score double", lambda found: found["score"] >= threshold, binary=True)
