"""Packing token sequences: vector bin packing by the dot-product heuristic.

Every example is a vector (tokens, one segment, loss-bearing tokens). A sequence takes, one after another, the example
that fits all limits and has the largest dot product with the room left; when none fits whole, one is cut to fill it.
Each task packs the rows it reads from a window of open examples, so nothing is shuffled and memory is bounded.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from learnlake.llm import wordids
from learnlake.llm.frames import returning

WINDOW = 1024  # open examples of a task
OUT = "start long, length long, ids binary, loss long, doc_tokens long, sequence_id long, offset long"


@dataclass(frozen=True)
class Limits:
    tokens: int = 2048
    segments: int = 256
    loss: int = 2048


class Packer:
    """Takes examples, gives finished pieces ``(key, start, ids, loss, doc_tokens, sequence, offset)``."""

    def __init__(self, limits: Limits, first_sequence: int = 0, window: int = WINDOW):
        if min(limits.tokens, limits.segments, limits.loss) < 1:
            raise ValueError("limits must be positive")
        self.limits, self.next, self.window = limits, first_sequence, window
        self.cap = np.array([limits.tokens, limits.segments, limits.loss], float)
        self.size = np.zeros((2 * window, 3))  # demand of each open example
        self.open: list = [None] * (2 * window)
        self.n = 0
        self.done: list[tuple] = []

    def add(self, key, ids: np.ndarray, unlearned: int = 0) -> None:
        """``unlearned``: how many leading ids (a prompt) bear no loss."""
        start, total, whole = 0, len(ids), min(self.limits.tokens, self.limits.loss)
        while total - start >= whole:  # fills a sequence alone; an all-prompt part may leave loss room, which is right
            take = self._fits(start, total, unlearned, self.cap)
            self._emit([(key, start, ids[start: start + take], self._loss(start, take, unlearned), total)])
            start += take
        if start < total:
            self._put((key, start, ids[start:], unlearned, total))
        if self.n >= self.window:
            self._pack(self.window // 2)

    def finish(self) -> None:
        self._pack(0)

    @staticmethod
    def _loss(start: int, length: int, unlearned: int) -> int:
        return max(0, start + length - max(start, unlearned))

    def _fits(self, start: int, total: int, unlearned: int, room: np.ndarray) -> int:
        """The most ids from ``start`` on that the room holds."""
        free = max(0, unlearned - start)
        return int(min(total - start, room[0], free + room[2]))

    def _put(self, item: tuple) -> None:
        key, start, ids, unlearned, total = item
        if self.n == len(self.open):
            self.open += [None] * self.n
            self.size = np.concatenate([self.size, np.zeros_like(self.size)])
        self.open[self.n] = item
        self.size[self.n] = len(ids), 1, self._loss(start, len(ids), unlearned)
        self.n += 1

    def _take(self, i: int) -> tuple:
        item, self.n = self.open[i], self.n - 1
        self.open[i], self.open[self.n] = self.open[self.n], None
        self.size[i] = self.size[self.n]
        return item

    def _pack(self, leave: int) -> None:
        while self.n > leave:
            room, made = self.cap.copy(), []
            while self.n and (room >= 1).all():
                size = self.size[: self.n]
                fit = (size <= room).all(axis=1)
                value = np.where(fit, (size / self.cap) @ (room / self.cap), -1.0)
                best = int(value.argmax())
                if value[best] >= 0:
                    key, start, ids, unlearned, total = self._take(best)
                else:  # cut the one that would overhang most
                    key, start, ids, unlearned, total = self._take(int(size[:, 0].argmax()))
                    take = self._fits(start, total, unlearned, room)
                    if take < len(ids):
                        self._put((key, start + take, ids[take:], unlearned, total))
                    ids = ids[:take]
                loss = self._loss(start, len(ids), unlearned)
                made.append((key, start, ids, loss, total))
                room -= len(ids), 1, loss
            self._emit(made)

    def _emit(self, parts: list[tuple]) -> None:
        """A sequence that isn't full is laid out as several whose lengths are powers of two, which need no padding."""
        left = sum(len(p[2]) for p in parts)
        size = min(self.limits.tokens, left)
        room, offset = size if size == self.limits.tokens else 1 << size.bit_length() - 1, 0
        for key, start, ids, loss, total in parts:
            free = len(ids) - loss  # of a piece only the leading ids can be without loss
            at = 0
            while at < len(ids):
                take = min(len(ids) - at, room)
                own = max(0, at + take - max(at, free))
                self.done.append((key, start + at, ids[at: at + take], own, total, self.next, offset))
                at, room, offset, left = at + take, room - take, offset + take, left - take
                if not room and left:
                    room, offset, self.next = 1 << left.bit_length() - 1, 0, self.next + 1
        self.next += 1


def pack(
    docs: DataFrame, tokenizer: str, limits: Limits = Limits(), end_id: int = 1, keep: str = "doc_id", unlearned: str | None = None
) -> DataFrame:
    """One row for each piece of a text: ``keep``, start, length, ids (unsigned 32-bit, little-endian), loss, doc_tokens,
    sequence_id and offset in that sequence.

    A text's ids are those of ``tokenizer`` and then ``end_id``. A NULL or empty text is just ``end_id``. ``unlearned``
    names a column with the number of leading ids that bear no loss (NULL: 0). Repeated rows are packed as often as they
    occur; an empty table gives no rows; columns other than ``keep``, ``unlearned`` and text are not read.
    """
    marks = F.coalesce(F.col(unlearned).cast("long"), F.lit(0)) if unlearned else F.lit(0).cast("long")
    source = docs.select(keep, F.col("text").alias("_text"), marks.alias("_unlearned"))
    schema = T.StructType([source.schema[keep], *T.StructType.fromDDL(OUT).fields])
    arrow = pa.schema([(f.name, _arrow(f.dataType)) for f in schema.fields[1:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = wordids.load(tokenizer)
        packer = Packer(limits, TaskContext.get().partitionId() << 33)
        kind = None

        def finished() -> pa.RecordBatch:
            key, start, ids, loss, total, seq, offset = zip(*packer.done)
            packer.done.clear()
            values = [start, [len(i) for i in ids], [i.astype("<u4").tobytes() for i in ids], loss, total, seq, offset]
            return pa.RecordBatch.from_arrays(
                [pa.array(key, kind), *(pa.array(v, t) for v, t in zip(values, arrow.types))], names=schema.names
            )

        for batch in returning(batches):
            kind = batch.column(0).type
            for key, mark, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), words.batch(batch.column(1))):
                packer.add(key, np.append(ids, np.uint16(end_id)), mark)
                if len(packer.done) >= 2048:
                    yield finished()
        packer.finish()
        if packer.done:
            yield finished()

    return source.mapInArrow(run, schema)


def _arrow(kind: T.DataType) -> pa.DataType:
    return pa.binary() if isinstance(kind, T.BinaryType) else pa.int64()
