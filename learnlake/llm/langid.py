"""Language identification with string kernels.

Two texts are as alike as the share of byte n-grams (all lengths from 1 to ``ORDER``, the blended spectrum) that both
contain; how often does not count. Landmark texts give a Nyström map of this kernel, on which one ridge regression per
language is fitted to all labelled rows: each task sums its rows' part of the normal equations. The score of a text is its kernel row against the landmarks times the regression weights; since the
kernel is linear in the presence vectors, batches compute it as presence matrix times (landmarks times weights).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from learnlake.llm import textbytes
from learnlake.llm.frames import annotate, keep_where, returning

ORDER = 4
BITS = 17  # n-grams are hashed to so many bits
LANDMARKS = 192
HEATS = (0.5, 1, 2, 4, 8, 16)
UNKNOWN = "und"
_FLUSH = 1 << 18


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # landmarks times regression weights: n-gram x language
    bias: np.ndarray
    heat: float  # of the softmax


def presence(texts: pa.Array) -> Iterator[np.ndarray]:
    """For each text the hashes of its n-grams, each once, in order. Letters are lower-cased, other ASCII is a blank."""
    row, found = 0, np.zeros(0, np.intp)
    for piece in textbytes.pieces(texts):
        data = textbytes.lower(piece.data)
        data[~textbytes.LETTER[data]] = 0x20
        hashed = [textbytes.grams(data, n, BITS) for n in range(1, ORDER + 1)]
        for i, s, e in zip(piece.rows, piece.starts, piece.ends):
            if i != row:
                yield found
                row, found = i, found[:0]
            own = _distinct(np.concatenate([h[s: max(s, e - n)] for n, h in enumerate(hashed)]))
            found = _distinct(np.concatenate([found, own])) if len(found) else own  # a long text comes in several pieces
    if len(texts):
        yield found


def _distinct(hashes: np.ndarray) -> np.ndarray:
    """Sorting the few hashes of a text costs less than looking through flags of all there can be."""
    hashes.sort()
    first = np.ones(len(hashes), bool)
    first[1:] = hashes[1:] != hashes[:-1]
    return hashes[first].astype(np.intp)


def rate(model: Model, texts: pa.Array) -> np.ndarray:
    """Scores of a batch: text x language."""
    out = np.zeros((len(texts), len(model.languages)), np.float32)
    rows: list[np.ndarray] = []
    first = waiting = 0

    def flush(last: int) -> None:
        sizes = np.array([len(r) for r in rows])
        some = np.flatnonzero(sizes)
        if len(some):
            at = np.cumsum(sizes[some]) - sizes[some]
            sums = np.add.reduceat(model.weights[np.concatenate(rows)], at, axis=0)
            out[first + some] = sums / np.sqrt(sizes[some])[:, None]
        rows.clear()

    for i, found in enumerate(presence(texts)):
        rows.append(found)
        waiting += len(found)
        if waiting > _FLUSH:
            flush(i + 1)
            first, waiting = i + 1, 0
    if rows:
        flush(len(texts))
    return out + model.bias


def fit(docs: DataFrame, usable: Column, scores: bool = True) -> Model:
    """Learn from all rows that are ``usable`` and have text and lang; a repeated row counts as often as it comes.

    Without ``scores`` the scores are not calibrated, which spares a pass over the rows; the languages said are the same.
    """
    rows = docs.where(usable & F.col("text").isNotNull() & F.col("lang").isNotNull()).select("doc_id", "lang", "text")
    number = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # a row a language
    languages = sorted(number)
    if not languages:
        return Model([UNKNOWN], np.zeros((1 << BITS, 1), np.float32), np.zeros(1, np.float32), 1.0)
    space = _space(_landmarks(rows))
    model = _solved(languages, space, _equations(rows, languages, number, space))
    if scores:
        losses = _losses(rows, model)
        model.heat = float(min(HEATS, key=lambda h: losses[HEATS.index(h)]))
    return model


def train(langs: list[str], found: list[np.ndarray]) -> Model:
    """The same fit of a few rows that lie in memory, given by the hashes of their n-grams."""
    languages = sorted(set(langs))
    y = np.array([languages.index(x) for x in langs])
    rank = np.zeros(len(y), int)
    for c in range(len(languages)):
        rank[y == c] = np.arange((y == c).sum())
    chosen = [i for i in np.lexsort((y, rank)) if len(found[i])][:LANDMARKS]
    space = _space(_marked([found[i] for i in chosen]))
    count = np.bincount(y, minlength=len(languages))
    model = _solved(languages, space, _sums(space, found, y, count))
    z = np.stack([model.weights[f].sum(axis=0) / max(1.0, np.sqrt(len(f))) + model.bias for f in found]).astype(float)
    model.heat = float(min(HEATS, key=lambda h: _loss(z * h, y)))
    return model


@dataclass
class _Space:
    marks: np.ndarray  # n-gram x landmark
    size: np.ndarray  # of the landmarks
    whiten: np.ndarray  # Nyström map: kernel row -> features


def _marked(found: list[np.ndarray]) -> np.ndarray:
    marks = np.zeros((1 << BITS, max(1, len(found))), np.uint8)
    for j, grams in enumerate(found):
        marks[grams, j] = 1
    return marks


def _space(marks: np.ndarray) -> _Space:
    size = np.sqrt(np.maximum(1, marks.sum(axis=0, dtype=np.int64)))
    inner = _kernel(marks, map(np.flatnonzero, marks.T), marks.shape[1]) / size
    value, vector = np.linalg.eigh((inner + inner.T) / 2)
    good = value > 1e-8 * max(1e-8, value.max())
    return _Space(marks, size, vector[:, good] / np.sqrt(value[good]))


def _kernel(marks: np.ndarray, found: Iterable[np.ndarray], rows: int) -> np.ndarray:
    """How many n-grams each row shares with each landmark, by the root of its own number."""
    out = np.zeros((rows, marks.shape[1]))
    wide = np.pad(marks, ((0, 0), (0, -marks.shape[1] % 8))).view(np.uint64)  # eight counters in a word, up to 255 each
    for i, grams in enumerate(found):
        if len(grams):
            counted = np.add.reduceat(wide[grams], np.arange(0, len(grams), 255), axis=0).view(np.uint8)
            out[i] = counted.sum(axis=0, dtype=np.int64)[: marks.shape[1]] / np.sqrt(len(grams))
    return out


def _sums(space: _Space, found: Iterable[np.ndarray], y: np.ndarray, count: np.ndarray) -> np.ndarray:
    """These rows' part of the normal equations, both sides beside each other; every language counts alike."""
    phi = np.concatenate([_kernel(space.marks, found, len(y)) / space.size @ space.whiten, np.ones((len(y), 1))], axis=1)
    signs = np.where(y[:, None] == np.arange(len(count)), 1.0, -1.0)
    return (phi / count[y][:, None]).T @ np.concatenate([phi, signs], axis=1)


def _solved(languages: list[str], space: _Space, sums: np.ndarray) -> Model:
    left, right = sums[:, : len(sums)], sums[:, len(sums):]
    ridge = 1e-3 * np.eye(len(left))
    ridge[-1, -1] = 0
    beta = np.linalg.lstsq(left + ridge, right, rcond=None)[0]
    project = ((space.whiten @ beta[:-1]) / space.size[:, None]).astype(np.float32)
    weights = np.concatenate([space.marks[i: i + 4096].astype(np.float32) @ project for i in range(0, 1 << BITS, 4096)])
    return Model(languages, weights, beta[-1].astype(np.float32), 1.0)


def _landmarks(rows: DataFrame) -> np.ndarray:
    """The n-grams (n-gram x landmark) of ``LANDMARKS`` texts with something in them, as many of each language as possible in the
    order of a hash of their ids."""
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    ids = rows.where(F.length("text") > 0).select("doc_id", "lang").distinct()
    first = ids.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= LANDMARKS).orderBy("rank", "lang").limit(LANDMARKS)
    places = {(r["doc_id"], r["lang"]): k for k, r in enumerate(first.collect())}
    chosen = rows.where((F.length("text") > 0) & F.col("doc_id").isin(sorted({i for i, _ in places})))
    found = chosen.groupBy("doc_id", "lang").agg(F.min("text").alias("text")).collect()
    texts = [t for _, t in sorted((places[i, lang], t) for i, lang, t in found if (i, lang) in places)]
    return _marked(list(presence(pa.array(texts, pa.string()))))


def _equations(rows: DataFrame, languages: list[str], number: dict[str, int], space: _Space) -> np.ndarray:
    """The normal equations of all rows."""
    lists = [np.flatnonzero(m).astype(np.int32) for m in space.marks.T]
    count = np.array([number[x] for x in languages])
    shared = rows.sparkSession.sparkContext.broadcast((languages, count, lists, space.size, space.whiten))
    m = space.whiten.shape[1] + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, count, lists, size, whiten = shared.value
        space = _Space(_marked(lists), size, whiten)
        at, total = {x: c for c, x in enumerate(names)}, np.zeros((m, m + len(names)))
        for batch in returning(batches):
            y = np.array([at[x] for x in batch.column(0).to_pylist()], int)
            total += _sums(space, presence(batch.column(1)), y, count)
        part = TaskContext.get().partitionId()
        lines = [pa.array(np.arange(m)), pa.array(np.full(m, part)), pa.array([r.tobytes() for r in total], pa.binary())]
        yield pa.RecordBatch.from_arrays(lines, names=["i", "part", "line"])

    found = rows.select("lang", "text").mapInArrow(run, "i long, part long, line binary").groupBy("i").applyInArrow(_total, "i long, line binary")
    lines = {r["i"]: np.frombuffer(r["line"]) for r in found.collect()}  # a row a landmark
    return np.stack([lines[i] for i in range(m)])


def _total(group: pa.Table) -> pa.Table:
    group = group.sort_by("part")  # reruns agree
    line = np.sum([np.frombuffer(v.as_buffer()) for v in group.column("line")], axis=0)
    return pa.table({"i": group.column("i").slice(0, 1), "line": pa.array([line.tobytes()], pa.binary())})


def _losses(rows: DataFrame, model: Model) -> np.ndarray:
    """The summed loss of all rows for each of ``HEATS``."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, total = shared.value, np.zeros(len(HEATS))
        at = {x: c for c, x in enumerate(known.languages)}
        for batch in returning(batches):
            y = np.array([at[x] for x in batch.column(0).to_pylist()], int)
            z = rate(known, batch.column(1)).astype(float)
            total += [_loss(z * h, y) for h in HEATS]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(HEATS))), pa.array(total)], names=["i", "loss"])

    found = rows.select("lang", "text").mapInArrow(run, "i long, loss double").groupBy("i").agg(F.sum("loss").alias("loss"))
    return np.array([r["loss"] for r in sorted(found.collect())])


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def _loss(z: np.ndarray, y: np.ndarray) -> float:
    return float(-np.log(_softmax(z)[np.arange(len(y)), y] + 1e-9).sum())


def has_letters(texts: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_numpy(zero_copy_only=False)


def classify(model: Model, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Language and score of each text; ``und`` with score 0 where there is no letter."""
    p = _softmax(rate(model, texts).astype(float) * model.heat)
    best, letters = p.argmax(axis=1), has_letters(texts)
    names = np.array([*model.languages, UNKNOWN], object)
    return names[np.where(letters, best, len(model.languages))], np.where(letters, p[np.arange(len(p)), best], 0.0)


def predict(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """``keep`` columns, ``lang_pred`` and ``score`` (0 to 1) of each row.

    A NULL, empty or letterless text is ``und`` with score 0; with no usable training row every text is ``und``. Repeated
    rows and ties are scored alike (the first language by name wins); an empty table gives no rows.
    """

    def build(shared: Model) -> Callable[[pa.Array], dict]:
        def run(texts: pa.Array) -> dict:
            names, score = classify(shared, texts)
            return {"lang_pred": pa.array(names, pa.string()), "score": score}

        return run

    return annotate(docs, keep, "lang_pred string, score double", build, model)


def accept(docs: DataFrame, model: Model) -> DataFrame:
    """The rows in a language that the model knows: those not ``und``; all columns stay."""

    def build(shared: Model) -> Callable[[pa.Array], np.ndarray]:
        return lambda texts: classify(shared, texts)[0] != UNKNOWN

    return keep_where(docs, build, model)
