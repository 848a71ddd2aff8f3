"""Phrase collocation mining by top-order marginalisation.

Each word position opens one window: the word and the three that follow it in its piece as lead columns, padded with empty
text where the piece ends. Only these longest windows are counted; Spark's ROLLUP over the four columns then adds them up
over ever shorter beginnings, which gives the counts of all phrases of 1 to 4 words, and the number of words, without
counting n-grams of each length on their own.

Most long windows occur once or twice, and a phrase can only be frequent if each of its pairs and triples of words is. So a
window ends before the first pair or triple that certainly is rare: pairs, then the triples of possible pairs, are counted
by 64-bit hash first, and the frequent hashes are set in a bit table of fixed size that every task holds. What the table
lets through by mistake is counted like the rest, so counts of frequent phrases are exact whatever the size of the corpus; a
fuller table only prunes less.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from learnlake.llm.textbytes import runs
from learnlake.session import written

LONGEST, SUPPORT, COVER, TOP, SCORE = 4, 30, 80, 2000, 2_000_000
TABLE_BITS = 26  # logarithm of the bits in the table of frequent pairs and triples: 8 MB
PRUNED = (2, 3)  # sizes that are counted by hash first
SLICE = 1 << 20  # bytes of text handled at a time; a longer text is handled alone
WORDS = [f"w{i}" for i in range(1, LONGEST + 1)]
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_GAP, _BREAK = np.zeros(256, bool), np.zeros(256, bool)
_GAP[[0x20, 0x09]] = True
_BREAK[[ord(c) for c in ".,;:!?\n\v\f\r"]] = True
_ODD = np.uint64(0x9E3779B97F4A7C15)


class Words(NamedTuple):
    """The words of some texts in order."""

    ids: np.ndarray  # number of (language, word)
    joined: np.ndarray  # whether the next word follows in the same piece
    langs: pa.Array  # language and word by number
    words: pa.Array
    hashes: np.ndarray


def words(texts: pa.Array, langs: pa.Array) -> Words | None:
    """Words of whole texts, lower-cased for A-Z, numbered within this call."""
    texts = texts.cast(pa.large_binary())
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset: texts.offset + n + 1]
    raw = texts.buffers()[2]
    if raw is None or offsets[-1] == offsets[0]:
        return None
    data = _LOWER[np.frombuffer(raw, np.uint8)[offsets[0]: offsets[-1]]]
    first = offsets[:-1] - offsets[0]
    breaks = _BREAK[data]
    inside = ~(breaks | _GAP[data])
    start, end = runs(inside, first)
    if not len(start):
        return None
    row = np.searchsorted(first, start, "right") - 1
    piece = np.cumsum(breaks, dtype=np.int32 if len(data) < 1 << 31 else np.int64)[start]
    joined = np.append((row[1:] == row[:-1]) & (piece[1:] == piece[:-1]), False)
    ends = np.concatenate([[0], np.cumsum(end - start)])
    found = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(start), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data[inside])]
    ).dictionary_encode()
    names = langs.dictionary_encode()
    code = names.indices.to_numpy()[row].astype(np.int64)
    count = len(found.dictionary)
    ids, keys = pd.factorize(code * count + found.indices.to_numpy())
    word, lang = pa.array(keys % count), pa.array(keys // count)
    seeds = np.array([xxhash.xxh64_intdigest(x) for x in names.dictionary.to_pylist()], np.uint64)
    hashes = np.array([xxhash.xxh64_intdigest(w) for w in found.dictionary.to_pylist()], np.uint64)
    with np.errstate(over="ignore"):
        mixed = _mixed(hashes[word.to_numpy()] ^ (seeds[lang.to_numpy()] * _ODD))
    return Words(ids, joined, names.dictionary.take(lang), found.dictionary.cast(pa.large_string()).take(word), mixed)


def _mixed(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(32))) * _ODD
        return h ^ (h >> np.uint64(29))


class Grams(NamedTuple):
    """The n-grams at some word positions."""

    at: np.ndarray
    kind: np.ndarray
    hashes: np.ndarray  # by kind


def _grams(w: Words, size: int, table: np.ndarray) -> tuple[Grams, list[np.ndarray]]:
    """The n-grams of ``size`` words whose shorter parts may all be frequent, and for each shorter size, from 2, the places
    where such a part begins."""
    n, count = len(w.words), len(w.ids)
    open_, places = w.joined, []
    kind, hashes = w.ids, w.hashes
    for m in range(2, size + 1):
        at = np.flatnonzero(open_)
        own, keys = pd.factorize(kind[at] * n + w.ids[at + m - 1])
        with np.errstate(over="ignore"):
            hashes = _mixed(hashes[keys // n] * _ODD + w.hashes[keys % n])
        if m == size:
            return Grams(at, own, hashes), places
        passed = _listed(table, hashes)[own]
        kind, here = np.zeros(count, np.int64), np.zeros(count, bool)
        kind[at], here[at] = own, passed
        places.append(here)
        open_ = here & np.append(here[1:], False)
    raise ValueError("a phrase has two words at least")


def _places(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64((1 << TABLE_BITS) - 1)
    return (h & mask).astype(np.int64), ((h >> np.uint64(32)) & mask).astype(np.int64)


def _listed(table: np.ndarray, h: np.ndarray) -> np.ndarray:
    out = np.ones(len(h), bool)
    for at in _places(h):
        out &= ((table[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)
    return out


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[Words]:
    """Runs of whole texts (columns text, lang) of at most ``SLICE`` bytes, or one longer text."""
    for batch in batches:
        texts, langs = batch.column(0), batch.column(1)
        size = np.cumsum(pa.compute.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
        a = 0
        while a < len(texts):
            b = max(a + 1, int(np.searchsorted(size, (size[a - 1] if a else 0) + SLICE, "right")))
            if found := words(texts.slice(a, b - a), langs.slice(a, b - a)):
                yield found
            a = b


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("text", F.lit("")).alias("text"), F.coalesce("lang", F.lit("und")).alias("lang")).where("text <> ''")


def frequent(texts: DataFrame, support: int) -> np.ndarray:
    """The bit table of all pairs and triples that occur ``support`` times or more, and of a few others."""
    table = np.zeros(1 << (TABLE_BITS - 6), np.uint64)
    for size in PRUNED:
        table |= _frequent(texts, support, size, table)
    return table


def _frequent(texts: DataFrame, support: int, size: int, table: np.ndarray) -> np.ndarray:
    shared = texts.sparkSession.sparkContext.broadcast(table.copy())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for w in _slices(batches):
            grams, _ = _grams(w, size, shared.value)
            n = np.bincount(grams.kind, minlength=len(grams.hashes)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(grams.hashes.view(np.int64)), pa.array(n)], names=["h", "n"])

    counted = texts.mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= support)
    mask = (1 << TABLE_BITS) - 1
    bits = F.explode(F.array(F.col("h").bitwiseAND(mask), F.shiftrightunsigned("h", 32).bitwiseAND(mask)))
    longs = counted.select(bits.alias("b")).groupBy(F.shiftright("b", 6).alias("i")).agg(
        F.expr("bit_or(shiftleft(1L, cast(b & 63 as int)))").alias("v")
    )
    found = longs.toArrow()  # at most 2 ** (TABLE_BITS - 6) rows
    bits_set = np.zeros(len(table), np.int64)
    bits_set[found["i"].to_numpy()] = found["v"].to_numpy()
    return bits_set.view(np.uint64)


def windows(texts: DataFrame, table: np.ndarray) -> DataFrame:
    """``lang``, the lead columns, ``n``: the windows of every word position, added up within some texts."""
    shared = texts.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for w in _slices(batches):
            grams, places = _grams(w, LONGEST, shared.value)
            last = np.zeros(len(w.ids), bool)
            last[grams.at] = True  # both triples of the window may be frequent
            ids = np.append(w.ids + 1, np.zeros(LONGEST, np.int64))  # 0 pads
            columns = [w.ids + 1]
            columns += [np.where(here, ids[k: k + len(here)], 0) for k, here in enumerate([*places, last], 1)]
            base = len(w.words) + 1
            left, left_keys = pd.factorize(columns[0] * base + columns[1])
            right, right_keys = pd.factorize(columns[2] * base + columns[3])
            both, keys = pd.factorize(left * len(right_keys) + right)
            a, b = left_keys[keys // len(right_keys)], right_keys[keys % len(right_keys)]
            padded = pa.concat_arrays([pa.array([""], pa.large_string()), w.words])
            made = [padded.take(pa.array(x)).cast(pa.string()) for x in (a // base, a % base, b // base, b % base)]
            lang = w.langs.take(pa.array(a // base - 1)).cast(pa.string())
            n = pa.array(np.bincount(both).astype(np.int64))
            yield pa.RecordBatch.from_arrays([lang, *made, n], names=["lang", *WORDS, "n"])

    schema = "lang string, " + ", ".join(f"{w} string" for w in WORDS) + ", n long"
    return texts.mapInArrow(run, schema).groupBy("lang", *WORDS).agg(F.sum("n").alias("n"))


def counts(docs: DataFrame, support: int = SUPPORT) -> DataFrame:
    """``lang``, ``size``, ``phrase``, ``a``: every phrase of up to four words that occurs ``support`` times; the number of all
    words of a language as size 0."""
    texts = _texts(docs)
    rolled = windows(texts, frequent(texts, support)).rollup("lang", *WORDS).agg(
        F.sum("n").alias("a"), F.grouping_id().alias("g")
    )
    size = F.lit(LONGEST) - F.bit_count("g")  # the words that are not summed over
    last = F.element_at(F.array(F.lit("-"), *WORDS), F.col("size") + 1)
    rows = rolled.where(F.col("g") < (1 << LONGEST)).withColumn("size", size)
    rows = rows.where((F.col("size") == 0) | ((F.col("a") >= support) & (last != "")))
    return rows.select("lang", "size", F.concat_ws(" ", *WORDS).alias("phrase"), "a")


def _part(words_: Column, first: Column, many: Column) -> Column:
    return F.array_join(F.slice(words_, first, many), " ")


def scored(found: DataFrame) -> DataFrame:
    """The phrases of two words and more with the counts ``l`` and ``r`` of their weakest cut and its ``score``."""
    phrases = found.where("size > 0").select("lang", "phrase", "a")
    cut = found.where("size > 1").select("lang", "phrase", "size", "a", F.split("phrase", " ").alias("_w"))
    cut = cut.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cut = cut.select(
        "lang", "phrase", "size", "a", "k", _part(F.col("_w"), F.lit(1), F.col("k")).alias("_l"),
        _part(F.col("_w"), F.col("k") + 1, F.col("size") - F.col("k")).alias("_r"),
    )
    for side in ("l", "r"):
        named = phrases.select("lang", F.col("phrase").alias(f"_{side}"), F.col("a").alias(side))
        cut = cut.join(named, ["lang", f"_{side}"])
    score = F.expr(f"(cast(a as decimal(20,0)) * {SCORE}) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    weakest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("m")
    return cut.groupBy("lang", "phrase", "a").agg(weakest).select("lang", "phrase", "a", "m.l", "m.r", "m.score")


def covering(found: DataFrame) -> DataFrame:
    """For each phrase inside a longer one the greatest count of these longer ones, as ``longer``."""
    long_ = found.where("size > 2").select("lang", "size", "a", F.split("phrase", " ").alias("_w"))
    many = long_.withColumn("m", F.explode(F.sequence(F.lit(2), F.col("size") - 1)))
    inner = many.withColumn("i", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("m") + 1)))
    parts = inner.select("lang", _part(F.col("_w"), F.col("i"), F.col("m")).alias("phrase"), "a")
    return parts.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))


def mine(docs: DataFrame, support: int = SUPPORT, top: int = TOP) -> DataFrame:
    """``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``: the first ``top`` phrases of each language.

    A NULL language is ``und``. NULL, empty and blank texts have no words; a text of any length is read whole; repeated
    rows count as often as they occur; ties go to the more frequent, then the smaller phrase. Columns other than ``text``
    and ``lang`` are not read. An empty table gives no rows.
    """
    found = written(counts(docs, support), "collocations")
    all_ = scored(found).join(covering(found), ["lang", "phrase"], "left")
    a, longer = F.col("a").cast("decimal(20,0)"), F.col("longer").cast("decimal(20,0)")
    kept = all_.where(F.col("longer").isNull() | (longer * 100 < a * COVER))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    total = found.where("size = 0").select("lang", F.col("a").alias("n"))
    return ranked.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
