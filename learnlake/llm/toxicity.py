"""Toxicity: a convolutional text classifier trained in numpy.

A word's vector is the sum of three hashed embeddings (the word, its first four and its first five bytes). Filters over
one, two and three words in a row are maximised over the whole text; a logistic layer gives the score. The threshold is
calibrated for each language, as language identification sees it in the text, on scores out of fold: each row is scored by
a network that has not learned from its fold. The score is shifted so that 0.5 is that threshold.

All labelled rows are learned from. Up to ``ALONE`` of them train one network. More are dealt into shards of ``SHARD`` rows:
a task trains a network on each, all from the same start (counted over all rows), and their parameters are averaged.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from learnlake.llm import langid, textbytes
from learnlake.llm.frames import annotate, keep_where, returning
from learnlake.llm.slots import Slots
from learnlake.session import written

BITS = 18  # of the hashed embeddings
DIM = 12
WIDTHS = (1, 2, 3)
FILTERS = 10  # of each width
ALONE = 4000  # labelled rows that train one network; more are dealt into shards
SHARD = 4000  # rows of a shard, at most on average
FOLDS = 4  # networks that score the rows they have not seen, for the thresholds
STEPS = 1024  # of one unit of the raw score, where the thresholds of sharded rows are looked for
EPOCHS = 3
RATE = 0.05
LEAST = 2  # texts in which a feature must occur to be learned
AFFIXES = (1 << 20, 4, 5)  # leading bytes of a word that make its three features


@dataclass
class Network:
    embed: np.ndarray
    filters: list[np.ndarray]  # width x DIM x FILTERS
    shift: list[np.ndarray]
    out: np.ndarray
    bias: float
    limits: dict[str, float] = field(default_factory=dict)  # threshold of the raw score by language
    limit: float = 0.0

    def __getstate__(self) -> dict:
        """Most features are never met: only embeddings that are not zero are sent to the tasks."""
        at = np.flatnonzero(self.embed.any(axis=1))
        return self.__dict__ | {"embed": (at, self.embed[at])}

    def __setstate__(self, state: dict) -> None:
        at, values = state["embed"]
        self.__dict__.update(state)
        self.embed = np.zeros((1 << BITS, DIM), np.float32)
        self.embed[at] = values


def features(piece: textbytes.Piece) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of the piece's words (word x 3), and the text (index into ``piece.rows``) of each word."""
    data = textbytes.lower(piece.data)
    starts, ends = textbytes.runs(textbytes.WORD[data], piece.starts)
    prefix = textbytes.Prefix(data)
    ids = [prefix.hash(starts, np.minimum(ends, starts + n)) + np.uint64(i) for i, n in enumerate(AFFIXES)]
    mixed = [(h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS) for h in ids]
    return np.stack(mixed, axis=1).astype(np.uint32), textbytes.row_of(starts, piece)


def word_features(texts: pa.Array) -> Iterator[np.ndarray]:
    """The features of each text's words."""
    parts: dict[int, list[np.ndarray]] = {}
    for piece in textbytes.pieces(texts):
        ids, row = features(piece)
        cuts = np.searchsorted(row, np.arange(len(piece.rows) + 1))
        for k, i in enumerate(piece.rows):
            parts.setdefault(int(i), []).append(ids[cuts[k]: cuts[k + 1]])
    for i in range(len(texts)):
        yield np.concatenate(parts.pop(i))


def _occurrences(samples: list[tuple[np.ndarray, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Texts of each class with each feature, and all texts of each class."""
    with_, texts = np.zeros((2, 1 << BITS)), np.zeros(2)
    for ids, y in samples:
        with_[y, np.unique(ids)] += 1
        texts[y] += 1
    return with_, texts


def _new(with_: np.ndarray, texts: np.ndarray) -> Network:
    """Small random weights, but for the first component of an embedding: the log odds of its texts' classes.

    It spares epochs: training alone also learns, but the maxima of long texts begin on common words. The odds of a
    feature seen in few texts are shrunk, and one seen in fewer than ``LEAST`` has no embedding at all, nor has a new one:
    else every word of a small class's texts would tell.
    """
    rng = np.random.default_rng(5)
    embed = rng.normal(0, 0.02, (1 << BITS, DIM)).astype(np.float32)
    with_, texts = np.asarray(with_, float), np.asarray(texts, float)
    number = with_.sum(axis=0)
    odds = np.log((with_[1] + 0.5) / (texts[1] + 1)) - np.log((with_[0] + 0.5) / (texts[0] + 1))
    embed[:, 0] += odds * number / (number + LEAST) / 6
    embed[number < LEAST] = 0
    filters = [rng.normal(0, 0.1, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
    for w, f in zip(WIDTHS, filters):
        f[:, 0] += 1 / w
    return Network(
        embed,
        filters,
        [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
        rng.uniform(0, 0.3, len(WIDTHS) * FILTERS).astype(np.float32),
        0.0,
    )


def train(
    samples: list[tuple[np.ndarray, int]], occurrences: tuple[np.ndarray, np.ndarray] | None = None
) -> Network:
    """Stochastic gradient descent with Adagrad, one text at a time; only the maxima pass a gradient back.

    A shard is given the ``occurrences`` of all rows, for its start and the weights of the classes.
    """
    with_, texts = occurrences or _occurrences(samples)
    net, rng = _new(with_, texts), np.random.default_rng(7)
    learned = net.embed.any(axis=1)
    # all filters and shifts in one array each, of which the network keeps views; a filter lies there word by word
    width, offset = (np.array(x) for x in zip(*[(j, k) for j, w in enumerate(WIDTHS) for k in range(w)]))
    kernel, shift = np.concatenate(net.filters), np.stack(net.shift)
    net.filters, net.shift = np.split(kernel, np.cumsum(WIDTHS)[:-1]), list(shift)
    seen = {"embed": np.full((1 << BITS, 1), 1e-2, np.float32), "out": np.full_like(net.out, 1e-2), "bias": 1e-2}
    seen_f, seen_s = np.full_like(kernel, 1e-2), np.full_like(shift, 1e-2)
    share = max(1e-6, texts[1] / texts.sum()) if texts.any() else 0.5
    weight = {1: 0.5 / share, 0: 0.5 / max(1e-6, 1 - share)}
    for _ in range(EPOCHS):
        for i in rng.permutation(len(samples)):
            ids, y = samples[i]
            if not len(ids):
                continue
            n = len(ids)
            x = np.zeros((n + max(WIDTHS) - 1, DIM), np.float32)
            x[:n] = net.embed[ids[:, 0]] + net.embed[ids[:, 1]] + net.embed[ids[:, 2]]
            made, pre = kernel.transpose(0, 2, 1).reshape(-1, DIM) @ x.T, np.zeros((len(WIDTHS), FILTERS, n), np.float32)
            for c, (j, k) in enumerate(zip(width, offset)):
                pre[j] += made[c * FILTERS: (c + 1) * FILTERS, k: k + n]
            at = pre.argmax(axis=2)
            raw = np.take_along_axis(pre, at[..., None], axis=2)[..., 0] + shift
            z = np.tanh(raw).ravel()  # unlike a rectifier it never dies under the maxima of long clean texts
            p = 1 / (1 + np.exp(-np.clip(z @ net.out + net.bias, -30, 30)))
            g = np.float32((p - y) * weight[y])
            back = (g * net.out * (1 - z**2)).reshape(len(WIDTHS), FILTERS)
            seen["out"] += (g * z) ** 2
            net.out -= RATE * g * z / np.sqrt(seen["out"])
            seen["bias"] += float(g) ** 2
            net.bias -= RATE * float(g) / seen["bias"] ** 0.5
            place, own = at[width] + offset[:, None], back[width][:, None]
            inside = place < n
            rows = ids[place[inside]].T.ravel()
            grads = np.tile((kernel * own).transpose(0, 2, 1)[inside], (len(AFFIXES), 1))
            grad = x[place].transpose(0, 2, 1) * own  # word of a filter x DIM x FILTERS
            seen_f += grad**2
            kernel -= RATE * grad / np.sqrt(seen_f)
            seen_s += back**2
            shift -= RATE * back / np.sqrt(seen_s)
            order = rows.argsort(kind="stable")
            order = order[learned[rows[order]]]
            if not len(order):
                continue
            rows = rows[order]
            first = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
            to, total = rows[first], np.add.reduceat(grads[order], first, axis=0)
            seen["embed"][to] += (total**2).mean(axis=1, keepdims=True)
            net.embed[to] -= RATE * total / np.sqrt(seen["embed"][to])
    return net


def raw_scores(net: Network, texts: pa.Array) -> np.ndarray:
    """The network's output before the logistic function; a text without words has what zero features give."""
    pooled = np.full((len(texts), len(WIDTHS) * FILTERS), -np.inf, np.float32)
    kernel = np.concatenate([f[k] for f in net.filters for k in range(len(f))], axis=1)
    for piece in textbytes.pieces(texts):
        ids, row = features(piece)
        for a in range(0, len(ids), 1 << 15):  # a few words more, so that no window is cut
            b = min(len(ids), a + (1 << 15) + max(WIDTHS) - 1)
            x = net.embed[ids[a:b, 0]] + net.embed[ids[a:b, 1]] + net.embed[ids[a:b, 2]]
            y, r, column = x @ kernel, row[a:b], 0
            made = np.empty((len(y), len(WIDTHS) * FILTERS), np.float32)
            for i, w in enumerate(WIDTHS):
                pre = made[:, i * FILTERS: (i + 1) * FILTERS]
                pre[:] = y[:, column: column + FILTERS]
                for k in range(1, w):
                    last = np.flatnonzero(r[k:] != r[:-k])  # a text's last words have no k-th one after them
                    alone = pre[last]
                    pre[: max(0, len(pre) - k)] += y[k:, column + k * FILTERS: column + (k + 1) * FILTERS]
                    pre[last] = alone
                column += w * FILTERS
            first = np.flatnonzero(np.diff(r, prepend=-1))
            top = np.maximum.reduceat(made, first, axis=0)
            to = piece.rows[r[first]]
            np.maximum.at(pooled, to, top)
    pooled = np.where(np.isfinite(pooled), pooled + np.concatenate(net.shift), 0)
    return np.tanh(pooled) @ net.out + net.bias


def _limit(z: np.ndarray, hits: np.ndarray, rows: np.ndarray) -> float:
    """Middle of the gap that separates the classes with the best F1; of ``rows`` rows with a score ``hits`` are positive."""
    order = np.argsort(z)
    z, hits, rows = z[order], hits[order], rows[order]
    hit = np.concatenate([np.cumsum(hits[::-1])[::-1], [0]])  # positives at or above each place
    called = np.concatenate([np.cumsum(rows[::-1])[::-1], [0]])
    f1 = 2 * hit / np.maximum(1, called + hits.sum())
    k = int(np.flatnonzero(f1 == f1.max()).mean())
    low, high = z[max(0, k - 1)], z[min(len(z) - 1, k)]
    return float((low + high) / 2)


def calibrate(
    net: Network, z: np.ndarray, hits: np.ndarray, langs: np.ndarray, least: int = 15, rows: np.ndarray | None = None
) -> Network:
    """Thresholds by language; one with under ``least`` rows of either class shares the threshold of all rows."""
    rows = np.ones_like(hits) if rows is None else rows
    if 0 < hits.sum() < rows.sum():
        net.limit = _limit(z, hits, rows)
    for name in sorted(set(langs.tolist())):
        own = langs == name
        if min(hits[own].sum(), (rows - hits)[own].sum()) >= least:
            net.limits[name] = _limit(z[own], hits[own], rows[own])
    return net


@dataclass
class Model:
    network: Network
    language: langid.Model


def fit(docs: DataFrame, labels: DataFrame, usable: Column, language: langid.Model) -> Model:
    """Learn from all labelled rows that are ``usable``; an id with several texts or labels counts once, by the smallest text
    and the largest label."""
    known = labels.where(F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where(usable)
    known = written(known, "labels")  # narrow; its size tells the planner whether the texts have to be shuffled
    # few texts of other ids are shuffled
    texts = Slots(known, ["doc_id"], [F.lit(True)]).mark(docs.select("doc_id", "text")).where("_kinds > 0").drop("_kinds")
    found = texts.join(known, "doc_id")
    rows = written(found.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")), "labelled")
    number = rows.count()
    if number > ALONE:
        return Model(_sharded(rows, -(-number // (FOLDS * SHARD)) * FOLDS, language), language)

    def build(shared: langid.Model) -> Callable[[pa.Array], dict]:
        def run(texts: pa.Array) -> dict:
            return {"words": [w.tobytes() for w in word_features(texts)], "said": pa.array(langid.classify(shared, texts)[0], pa.string())}

        return run

    read = annotate(rows, ["doc_id", "toxic"], "words binary, said string", build, language)
    taken = sorted(read.collect(), key=lambda r: r["doc_id"])  # ALONE rows at most
    data = [(np.frombuffer(r["words"], np.uint32).reshape(-1, len(AFFIXES)), int(r["toxic"])) for r in taken]
    net = train(data)
    if data:
        z = out_of_fold(docs.sparkSession, data)
        calibrate(net, z, np.array([y for _, y in data]), np.array([r["said"] for r in taken]))
    return Model(net, language)


def _sharded(rows: DataFrame, shards: int, language: langid.Model) -> Network:
    """The mean of networks trained on each shard of ``(doc_id, toxic, text)``; its thresholds come from all rows.

    A row's fold is its shard's. What is left of the mean without the shards of a fold, from a start without its rows,
    scores the rows of the fold.
    """
    spark = rows.sparkSession
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int"))
    with_, texts = _counted(dealt)
    every = with_.sum(axis=0), texts.sum(axis=0)
    start = _flat(_new(*every))
    moved = _moved(dealt, shards, every)
    total = moved.sum(axis=0)
    net = _shaped(start + total / shards)
    others = []
    for k in range(FOLDS):
        rest = _new(every[0] - with_[k], every[1] - texts[k])
        other = _shaped(_flat(rest) + (total - moved[k]) / (shards - shards // FOLDS))
        other.embed[~rest.embed.any(axis=1)] = 0
        others.append(other)
    shared = spark.sparkContext.broadcast((others, language))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nets, model = shared.value
        for batch in returning(batches):
            shard, toxic, text = batch.columns
            fold, z = shard.to_numpy() % FOLDS, np.zeros(len(batch))
            for k in np.unique(fold):
                own = np.flatnonzero(fold == k)
                z[own] = raw_scores(nets[k], text.take(pa.array(own)))
            said = pa.array(langid.classify(model, text)[0], pa.string())
            yield pa.RecordBatch.from_arrays([said, toxic, pa.array(np.round(z * STEPS).astype(np.int64))], names=["said", "toxic", "step"])

    scored = dealt.select("shard", F.col("toxic").cast("int").alias("toxic"), "text").mapInArrow(score, "said string, toxic int, step long")
    # a row a language and step: scores are bounded by the output weights
    steps = sorted(scored.groupBy("said", "step").agg(F.count("*").alias("n"), F.sum("toxic").alias("hits")).collect())
    z, n, hits = (np.array([r[c] for r in steps], float) for c in ("step", "n", "hits"))
    return calibrate(net, z / STEPS, hits, np.array([r["said"] for r in steps]), rows=n)


def _counted(dealt: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The occurrences of each fold: fold x class x feature, and fold x class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with_ = np.zeros((FOLDS, 2, (1 << BITS) + 1), np.int64)  # the last one counts the texts
        for batch in returning(batches):
            shard, toxic, text = batch.columns
            for k, y, ids in zip(shard.to_numpy() % FOLDS, toxic.to_numpy(), word_features(text)):
                with_[k, y, np.unique(ids)] += 1
                with_[k, y, -1] += 1
        at = np.nonzero(with_)
        for a in range(0, len(at[0]), 1 << 16):
            cells = [x[a: a + (1 << 16)] for x in at]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (*cells, with_[tuple(cells)])], names=["fold", "y", "feature", "n"])

    read = dealt.select("shard", F.col("toxic").cast("int").alias("toxic"), "text")
    cells = read.mapInArrow(run, "fold long, y long, feature long, n long").groupBy("fold", "y", "feature").agg(F.sum("n").alias("n"))
    found = cells.toArrow()  # FOLDS * 2 * 2 ** BITS rows at most
    out = np.zeros((FOLDS, 2, (1 << BITS) + 1), np.uint32)
    out[tuple(found.column(c).to_numpy() for c in ("fold", "y", "feature"))] = found.column("n").to_numpy()
    return out[..., :-1], out[..., -1]


def _moved(dealt: DataFrame, shards: int, every: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """How far training moves the parameters from their start, summed over the shards of each fold: fold x parameter."""
    shared = dealt.sparkSession.sparkContext.broadcast(every)
    parts = max(16, shards)  # of the parameters, so that what is summed in one group does not grow

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_shard: dict[int, list] = {}
        for batch in returning(batches):
            shard, ids, toxic, text = batch.columns
            for k, i, y, words in zip(shard.to_pylist(), ids.to_pylist(), toxic.to_pylist(), word_features(text)):
                by_shard.setdefault(k, []).append((i, words, y))
        for k, own in by_shard.items():
            own.sort(key=lambda r: r[0])
            moved = _flat(train([(words, y) for _, words, y in own], shared.value)) - _flat(_new(*shared.value))
            for part, values in enumerate(np.array_split(moved, parts)):
                made = [pa.array([k % FOLDS]), pa.array([part]), pa.array([k]), pa.array([values.tobytes()], pa.binary())]
                yield pa.RecordBatch.from_arrays(made, names=["fold", "part", "shard", "moved"])

    def total(group: pa.Table) -> pa.Table:
        group = group.sort_by("shard")  # reruns agree
        summed = np.sum([np.frombuffer(v.as_buffer(), np.float32) for v in group.column("moved")], axis=0, dtype=np.float64)
        packed = zlib.compress(summed.astype(np.float32).tobytes(), 1)  # most parameters have not moved
        return group.slice(0, 1).set_column(3, "moved", pa.array([packed], pa.binary()))

    shape = "fold long, part long, shard long, moved binary"
    read = dealt.select("shard", "doc_id", F.col("toxic").cast("int").alias("toxic"), "text").repartitionById(shards, "shard")
    sums = read.mapInArrow(learn, shape).groupBy("fold", "part").applyInArrow(total, shape)
    found = {(r["fold"], r["part"]): np.frombuffer(zlib.decompress(r["moved"]), np.float32) for r in sums.collect()}  # FOLDS networks
    empty = np.array_split(np.zeros_like(_flat(_new(*every))), parts)
    return np.stack([np.concatenate([found.get((k, p), empty[p]) for p in range(parts)]) for k in range(FOLDS)])


def _flat(net: Network) -> np.ndarray:
    """All parameters in one row."""
    return np.concatenate([a.ravel() for a in (net.embed, *net.filters, *net.shift, net.out, np.float32([net.bias]))])


def _shaped(flat: np.ndarray) -> Network:
    """The network of ``_flat`` parameters."""
    shapes = [(1 << BITS, DIM), *[(w, DIM, FILTERS) for w in WIDTHS], *[(FILTERS,) for _ in WIDTHS], (len(WIDTHS) * FILTERS,)]
    cuts = np.cumsum([int(np.prod(s)) for s in shapes])
    made = [a.reshape(s).astype(np.float32) for a, s in zip(np.split(flat, cuts), shapes)]
    n = len(WIDTHS)
    return Network(made[0], made[1: 1 + n], made[1 + n: 1 + 2 * n], made[-1], float(flat[-1]))


def out_of_fold(spark: SparkSession, data: list[tuple[np.ndarray, int]], folds: int = FOLDS) -> np.ndarray:
    """What each row gets from a network that was trained, by the same recipe, on the other folds; a task trains one fold."""
    number, fold = {0: 0, 1: 0}, []
    for _, y in data:  # every fold has its share of each class
        fold.append(number[y] % folds)
        number[y] += 1
    shared = spark.sparkContext.broadcast((data, fold))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, of = shared.value
        for batch in returning(batches):
            for k in batch.column(0).to_pylist():
                net = train([d for d, f in zip(rows, of) if f != k])
                own = [i for i, f in enumerate(of) if f == k]
                z = [_raw(net, rows[i][0]) for i in own]
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array(z, pa.float64())], names=["i", "z"])

    scored = spark.range(0, folds, 1, folds).mapInArrow(run, "i long, z double").collect()
    out = np.zeros(len(data))
    for r in scored:
        out[r["i"]] = r["z"]
    return out


def _raw(net: Network, ids: np.ndarray) -> float:
    if not len(ids):
        return net.bias
    x = np.concatenate([net.embed[ids].sum(axis=1), np.zeros((max(WIDTHS) - 1, DIM), np.float32)])
    pooled = [
        (s + sum(x[k: k + len(ids)] @ f[k] for k in range(w))).max(axis=0) for w, f, s in zip(WIDTHS, net.filters, net.shift)
    ]
    return float(np.tanh(np.concatenate(pooled)) @ net.out + net.bias)


def rate(model: Model, texts: pa.Array) -> np.ndarray:
    """Scores from 0 to 1; 0.5 is the threshold of the text's language."""
    net = model.network
    z = raw_scores(net, texts)
    said = langid.classify(model.language, texts)[0]
    limit = np.array([net.limits.get(s, net.limit) for s in said])
    return 1 / (1 + np.exp(-np.clip(z - limit, -30, 30)))


def predict(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """``keep`` columns and ``score`` of each row.

    A NULL or empty text has the score of a text without words; repeated rows are scored alike; an empty table gives no
    rows; without labelled rows the untrained network scores all texts.
    """
    return annotate(docs, keep, "score double", lambda shared: lambda texts: {"score": rate(shared, texts)}, model)


def accept(docs: DataFrame, model: Model) -> DataFrame:
    """The rows under the threshold; all columns stay."""
    return keep_where(docs, lambda shared: lambda texts: rate(shared, texts) < 0.5, model)
