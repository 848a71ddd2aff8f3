"""Quality: supervised subword embeddings.

A document is the average of learned vectors of its words and of their character n-grams, all hashed; a softmax over the
average gives the class. Vectors and softmax are trained together by stochastic gradient descent in numpy. A word that
repeats the word before it also counts as the token "repeated", so that loops are seen whatever word they loop on.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from learnlake.llm import textbytes
from learnlake.llm.frames import annotate, hash_sample

BITS = 17
DIM = 8
GRAMS = (3, 4)  # bytes; with the blank before a word, so that beginnings differ from middles
TRAIN = 2500  # rows of each class learned from, at most
EPOCHS = 4
RATE = 0.5
REPEATED, EMPTY = 0, 1  # two slots of the table that stand for no string


@dataclass
class Model:
    vectors: np.ndarray  # slot x DIM
    softmax: np.ndarray  # DIM x 2
    bias: np.ndarray


def tokens(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each piece of the batch: slots of all tokens, and the text each belongs to."""
    for piece in textbytes.pieces(texts):
        data = textbytes.lower(piece.data)
        data[textbytes.SPACE[data]] = 0x20
        starts, ends = textbytes.runs(data != 0x20, piece.starts)
        row = textbytes.row_of(starts, piece)
        h = textbytes.Prefix(data).hash(starts, ends)
        slots, rows = [_slot((h >> np.uint64(64 - BITS)).astype(np.int64))], [row]
        again = np.flatnonzero((h[1:] == h[:-1]) & (row[1:] == row[:-1])) + 1
        slots.append(np.full(len(again), REPEATED)), rows.append(row[again])
        at = np.repeat(np.arange(len(piece.starts)), piece.ends - piece.starts)
        for n in GRAMS:
            g = textbytes.grams(data, n, BITS)
            ok = (at[: len(g)] == at[n - 1:]) if len(g) else np.zeros(0, bool)
            # a string may begin with a blank but holds no other
            blank = data == 0x20
            for k in range(1, n):
                ok = ok & ~blank[k: len(g) + k]
            slots.append(_slot(g[ok].astype(np.int64))), rows.append(at[: len(g)][ok])
        yield np.concatenate(slots), piece.rows[np.concatenate(rows)]


def _slot(h: np.ndarray) -> np.ndarray:
    return 2 + h % ((1 << BITS) - 2)


def counts(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each text its slots, each once, and how often each occurs."""
    parts: dict[int, list[np.ndarray]] = {}
    for slot, row in tokens(texts):
        order = np.argsort(row, kind="stable")
        slot, row = slot[order], row[order]
        first = np.flatnonzero(np.diff(row, prepend=-1))
        for a, b in zip(first, [*first[1:], len(row)]):
            parts.setdefault(int(row[a]), []).append(slot[a:b])
    for i in range(len(texts)):
        yield np.unique(np.concatenate(parts.pop(i, [np.array([EMPTY])])), return_counts=True)


def train(samples: list[tuple[np.ndarray, np.ndarray, int]]) -> Model:
    """``samples``: slots, counts and class of each text. Classes weigh alike; the rate falls to zero."""
    rng = np.random.default_rng(3)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (1 << BITS, DIM)).astype(np.float32)
    softmax, bias = rng.normal(0, 0.1, (DIM, 2)).astype(np.float32), np.zeros(2, np.float32)
    share = np.mean([y for *_, y in samples]) if samples else 0.5
    weight = (0.5 / max(1e-6, 1 - share), 0.5 / max(1e-6, share))
    steps, step = EPOCHS * len(samples), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(samples)):
            slot, n, y = samples[i]
            part = (n / n.sum()).astype(np.float32)
            mean = part @ vectors[slot]
            p = _softmax(mean @ softmax + bias)
            p[y] -= 1
            p *= weight[y]
            rate = RATE * (1 - step / steps)
            back = softmax @ p
            softmax -= rate * np.outer(mean, p)
            bias -= rate * p
            # a token's own gradient is its share of the text; scaled so that a rare one still learns
            vectors[slot] -= (rate * np.sqrt(part))[:, None] * back
            step += 1
    return Model(vectors, softmax, bias)


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=-1, keepdims=True))
    return z / z.sum(axis=-1, keepdims=True)


def rate(model: Model, texts: pa.Array) -> np.ndarray:
    """Probability of class 1. The average passes through the softmax layer, so slots are scored first and averaged then."""
    scored = model.vectors @ model.softmax
    edge = (scored[:, 1] - scored[:, 0]).astype(np.float64)
    total, number = np.zeros(len(texts)), np.zeros(len(texts))
    for slot, row in tokens(texts):
        total += np.bincount(row, weights=edge[slot], minlength=len(texts))
        number += np.bincount(row, minlength=len(texts))
    z = np.where(number > 0, total / np.maximum(1, number), edge[EMPTY]) + float(model.bias[1] - model.bias[0])
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(docs: DataFrame, labels: DataFrame, usable: Column) -> Model:
    """Learn from at most ``TRAIN`` rows of each class, those of smallest hash among the labelled rows that are ``usable``."""
    known = labels.where(F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.max("quality").alias("quality")).where(usable)
    chosen = [hash_sample(known.where(F.col("quality") == c), TRAIN, "doc_id") for c in (0, 1)]
    chosen = F.broadcast(chosen[0].unionByName(chosen[1]))  # 2 * TRAIN rows at most
    rows = docs.select("doc_id", "text").join(chosen, "doc_id")

    def build(_) -> Callable[[pa.Array], dict]:
        def run(texts: pa.Array) -> dict:
            found = list(counts(texts))
            return {"slots": [s.astype("<i4").tobytes() for s, _ in found], "times": [n.astype("<i4").tobytes() for _, n in found]}

        return run

    sample = annotate(rows, ["doc_id", "quality"], "slots binary, times binary", build)
    taken = sorted(sample.dropDuplicates(["doc_id"]).collect(), key=lambda r: r["doc_id"])
    return train([(np.frombuffer(r["slots"], "<i4"), np.frombuffer(r["times"], "<i4"), int(r["quality"])) for r in taken])


def predict(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """``keep`` columns and ``score`` (probability of class 1) of each row.

    A NULL or empty text is scored by a slot of its own; repeated rows are scored alike; an empty table gives no rows;
    without labelled rows the untrained vectors score all texts.
    """
    return annotate(docs, keep, "score double", lambda shared: lambda texts: {"score": rate(shared, texts)}, model)
