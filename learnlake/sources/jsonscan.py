"""Whether the lines of a file are one JSON document, and of how many items, from summaries that can be put together.

A piece of JSON text becomes a word of symbols: ``s`` a string, ``v`` any other value, ``l<n>;`` a list of n items,
brackets, commas and colons. What is complete in itself is replaced by one symbol, and of complete neighbours only the number
stays (``a<n>;`` items of a list, ``m`` members of an object), so a word is as long as the nesting is deep. The word of two
pieces is that of their words side by side: pieces can be read by different tasks. A JSON string has no line break, so
no line begins inside one. ``x`` is a piece that no JSON document has.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa

_TOKEN = re.compile(
    r'[ \t\r\n]++|(?P<s>"[^"\\\x00-\x1f]*+(?:\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4})[^"\\\x00-\x1f]*+)*+")'
    r"|(?P<v>(?:-?(?:0|[1-9][0-9]*+)(?:\.[0-9]++)?(?:[eE][+-]?[0-9]++)?|true|false|null)(?![0-9A-Za-z.+-]))|(?P<p>[\[\]{},:])|(?P<x>.)",
    re.S,
)
_ITEM, _VALUE = r"(?:[sv]|[la][0-9]+;)", r"(?:[sv]|l[0-9]+;)"
_MEMBER = rf"(?:m|s:{_VALUE})"
_LIST = re.compile(rf"\[(?:{_ITEM}(?:,{_ITEM})*+)?\]")
_OBJECT = re.compile(rf"\{{(?:{_MEMBER}(?:,{_MEMBER})*+)?\}}")
_ITEMS = re.compile(rf"(?<=,){_ITEM}(?:,{_ITEM})+(?=,)")  # between commas: surely items, members have a colon
_MEMBERS = re.compile(rf"(?<=,){_MEMBER}(?:,{_MEMBER})+(?=,)")
_WRONG = re.compile(
    "|".join([
        "x", r"[sv;\]}m][sv\[{lm]", r"[,:{\[][,:]", r"[,:][\]}]", r"\{[vla\[\]{]", r"\[[}m]", r"[v;\]}m]:", ":s:", r"\[s:", r"\{s[,}\]]",
        r"[\[{][^\[\]{}]*[\]}]",  # a pair of brackets that did not become a value
        rf"(?<=,){_ITEM},(?:m|s:)", rf"(?:m|s:{_VALUE}),{_ITEM},",  # items beside members
    ])
)
_LENGTH = 4096  # symbols that are gathered before they are reduced


def symbols(text: str) -> str:
    """The word of a piece of text, as it stands."""
    return "".join(m[0] if m.lastgroup == "p" else m.lastgroup for m in _TOKEN.finditer(text) if m.lastgroup)


def _number(items: str) -> int:
    """Items in a list's text."""
    return sum(int(i[1:-1]) if i[0] == "a" else 1 for i in items.split(",")) if items else 0


def reduced(word: str) -> str:
    """The shortest form of a word."""
    while True:
        before = word
        word = _LIST.sub(lambda m: f"l{_number(m[0][1:-1])};", word)
        word = _OBJECT.sub("v", word)
        if word == before:
            break
    word = _MEMBERS.sub("m", _ITEMS.sub(lambda m: f"a{_number(m[0])};", word))
    return "x" if _WRONG.search(word) else word


def items(word: str) -> int | None:
    """Items of the document that a whole file's word stands for: a list's length, 1 for any other, None if it is none."""
    if word in ("s", "v"):
        return 1
    return int(word[1:-1]) if re.fullmatch("l[0-9]+;", word) else None


def _refuse(name: str) -> None:
    raise ValueError(name)  # NaN and the like are not JSON


_DECODER = json.JSONDecoder(parse_int=str, parse_float=str, parse_constant=_refuse)


def whole(line: str) -> str | None:
    """The word of a line that is a whole document, None of any other. (Spark's own parsers pass over what follows a document.)"""
    try:
        doc = _DECODER.decode(line)
    except ValueError:
        return None
    except RecursionError:  # nested deeper than that decoder reads
        word = reduced(symbols(line))
        return None if items(word) is None else word
    return f"l{len(doc)};" if isinstance(doc, list) else "s" if line.lstrip(" \t\r\n").startswith('"') else "v"


SUMMARY = "path string, block long, valid_lines long, word string"


def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines ``(path, block, value)`` in file order -> one row a block."""
    at: tuple[str, int] | None = None
    valid, word, begun, length = 0, "", [], 0
    out: list[tuple] = []

    def table() -> pa.RecordBatch:
        columns = list(zip(*out)) or [[]] * 4
        out.clear()
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["path", "block", "valid_lines", "word"])

    for batch in batches:
        for path, block, value in zip(*(c.to_pylist() for c in batch.columns)):
            if (path, block) != at:
                if at is not None:
                    out.append((*at, valid, reduced(word + "".join(begun))))
                at, valid, word, begun, length = (path, block), 0, "", [], 0
            known = whole(value)
            valid += known is not None
            if word == "x":
                continue
            begun.append(symbols(value) if known is None else known)
            length += len(begun[-1])
            if length > _LENGTH or not word and len(begun) == 2:  # a second document ends it early
                word, begun, length = reduced(word + "".join(begun)), [], 0
        yield table()
    if at is not None:
        out.append((*at, valid, reduced(word + "".join(begun))))
    yield table()


def totals(keys: tuple, blocks: pa.Table) -> pa.Table:
    """The records of one file from its blocks: items of its document, else its lines that are documents."""
    word = ""
    for piece in blocks.sort_by("block")["word"].to_pylist():
        word = reduced(word + piece)
    found = items(word)
    records = sum(blocks["valid_lines"].to_pylist()) if found is None else found
    return pa.table({"path": [keys[0].as_py()], "records": pa.array([records], pa.int64())})
