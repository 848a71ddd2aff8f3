"""Token ids of whole batches for a word-level BPE tokenizer: each distinct word of a batch is tokenized once.

The ids are those of ``tokenizers``: such a tokenizer never joins characters across white space, so a text's ids are
its words' ids in order. Words of plain letters, digits and marks go through the tokenizer's own steps (lower case,
split, merge) piece by piece, with a bounded memory of pieces; every other word is handed to ``encode`` as it is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from tokenizers import Tokenizer

# fixed values: the split pattern of the public vocabulary file, and the characters that NFC leaves alone
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PLAIN = r"^[\x21-\x7e\x{a1}-\x{ff}]*$"
MEMORY = 400_000  # pieces remembered by one Python worker
ROWS = 2048  # texts split into words at a time
STEP = 1 << 18  # words laid out at a time


def _byte_letters() -> dict[int, str]:
    """Byte-level BPE writes bytes as printable characters: printable Latin-1 as itself, the rest from U+0100 on."""
    keep = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(keep)]
    return {b: chr(b) for b in keep} | {b: chr(0x100 + i) for i, b in enumerate(rest)}


class WordIds:
    """``batch(texts)`` yields, text by text, the ids as uint16."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids must fit in 16 bits")
        self.special = sorted(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        self.model = self.tokenizer.model
        self.split = regex.compile(SPLIT + "| ")
        letters = _byte_letters()
        self.letters = {c: "".join(letters[b] for b in chr(c).encode()) for c in range(0x80, 0x100)}
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {" ": 0}  # piece -> its place in ends
        self.flat = np.zeros(0, np.uint16)
        self.ends = np.zeros(1, np.int64)

    def _learn(self, new: set[str]) -> None:
        """The ids of pieces not met before."""
        tokenize, letters, flat, ends = self.model.tokenize, self.letters, [], []
        for piece in new:
            flat += [t.id for t in tokenize(piece if piece.isascii() else piece.translate(letters))]
            ends.append(len(flat))
        first = len(self.ends)
        self.known.update(zip(new, range(first, first + len(ends))))
        self.ends = np.concatenate([self.ends, len(self.flat) + np.array(ends, np.int64)])
        self.flat = np.concatenate([self.flat, np.array(flat, np.uint16)])

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All words' ids in one array, with each word's start and length there."""
        plain = pc.match_substring_regex(words, PLAIN)
        for s in self.special:
            plain = pc.and_not(plain, pc.match_substring(words, s))
        fast = plain.to_numpy(zero_copy_only=False)
        found = self.split.findall(" ".join(pc.filter(words, plain).to_pylist()).lower())
        if len(self.known) > MEMORY:
            self._forget()
        if new := set(found).difference(self.known):
            self._learn(new)
        codes = np.fromiter(map(self.known.__getitem__, found), np.int64, len(found))
        begin, size = self.ends[codes - 1], self.ends[codes]
        begin[codes == 0] = 0
        size = size - begin  # the blank between words has none
        ids = _lay(self.flat, begin, size)
        word = np.cumsum(codes == 0)
        n_fast = int(fast.sum())
        length = np.zeros(len(words), np.int64)
        length[fast] = np.bincount(word, weights=size, minlength=n_fast).astype(np.int64)[:n_fast] if n_fast else 0
        slow = np.flatnonzero(~fast)
        own = [np.array(self.tokenizer.encode(words[int(i)].as_py(), add_special_tokens=False).ids, np.uint16) for i in slow]
        length[slow] = [len(a) for a in own]
        start = np.zeros(len(words), np.int64)
        start[fast] = np.cumsum(length[fast]) - length[fast]
        start[slow] = len(ids) + np.cumsum(length[slow]) - length[slow]
        return np.concatenate([ids, *own]), start, length

    def batch(self, texts: pa.Array) -> Iterator[np.ndarray]:
        for i in range(0, len(texts), ROWS):
            yield from self._batch(texts.slice(i, ROWS))

    def _batch(self, texts: pa.Array) -> Iterator[np.ndarray]:
        split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        coded = split.flatten().dictionary_encode()
        ids, start, length = self._words(coded.dictionary)
        codes = coded.indices.to_numpy()
        bounds = split.offsets.to_numpy() - split.offsets[0].as_py()
        first = 0
        while first < len(texts):
            last = max(int(np.searchsorted(bounds, bounds[first] + STEP, "right")) - 1, first + 1)
            if last == first + 1:  # a long text, laid out part by part
                parts = [codes[a: min(a + STEP, bounds[last])] for a in range(bounds[first], bounds[last], STEP)]
                yield np.concatenate([np.zeros(0, np.uint16), *(_lay(ids, start[c], length[c]) for c in parts)])
            else:
                some = codes[bounds[first]: bounds[last]]
                laid = _lay(ids, start[some], length[some])
                ends = np.concatenate([[0], np.cumsum(length[some])])[bounds[first: last + 1] - bounds[first]]
                yield from (laid[a:b] for a, b in zip(ends[:-1], ends[1:]))
            first = last


def _lay(flat: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The given ranges of ``flat`` one after another."""
    total = int(length.sum())
    before = np.cumsum(length) - length
    return flat[np.repeat(start - before, length) + np.arange(total)]


_LOADED: dict[str, WordIds] = {}


def load(path: str) -> WordIds:
    """One tokenizer for each file and Python worker."""
    if path not in _LOADED:
        _LOADED[path] = WordIds(path)
    return _LOADED[path]
