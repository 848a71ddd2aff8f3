"""Small HTML reader: block trees of any depth with their runs of text, folded so that equal neighbours are one node."""

from __future__ import annotations

import html
import json
import re
from collections import Counter, deque
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

import numpy as np

# fixed values: elements of HTML
INLINE = set(
    """a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small
    span strike strong sub sup time tt u var wbr picture source
    math mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded mphantom msub msup msubsup munder mover
    munderover mmultiscripts mtable mtr mtd maction semantics""".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template iframe textarea select svg annotation annotation-xml title canvas audio video".split())
CLOSED_BY = {  # an open element that a new one ends, and where the search for it stops
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead", "tfoot"}), "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}), "body": ({"head"}, {"html"}),
}
_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""",
    re.S,
)
_NAMES = re.compile(r"""(?<![\w-])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
FAR = 300  # labels of a path; beyond it, only those that it does not have yet
CELLS = 4_000_000  # of the table by which two lists of children are aligned


@dataclass
class Run:
    """Text between two block borders."""

    parts: list[str] = field(default_factory=list)
    links: int = 0  # characters inside links
    order: int = 0

    def text(self) -> str:
        return " ".join(html.unescape("".join(self.parts)).split())


@dataclass
class Block:
    tag: str
    label: str
    kids: list = field(default_factory=list)


def _words(name: str) -> set[str]:
    return set(re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", name).lower()))


def words_of(attributes: str, of_id: Callable[[set[str]], set[str]] = set) -> list[str]:
    """Lower-case words of class and role, without numbers, and what ``of_id`` makes of those of the id."""
    found: set[str] = set()
    for kind, *values in _NAMES.findall(attributes):
        words = _words("".join(values))
        found |= of_id(words) if kind.lower() == "id" else words
    return sorted(found)


def read(page: str | None, of_id: Callable[[set[str]], set[str]] = set) -> Block:
    """The page's tree of blocks; broken markup is read as far as it goes."""
    root = Block("html", "html")
    stack, run, links, order, at = [root], None, 0, 0, 0
    opened: Counter[str] = Counter()  # tags on the stack

    def leave(i: int) -> None:
        opened.subtract(b.tag for b in stack[i:])
        del stack[i:]

    page = page or ""
    while at < len(page):
        start = page.find("<", at)
        if start < 0:
            start = len(page)
        token = _TOKEN.match(page, start) if start < len(page) else None
        end = token.end() if token else min(start + 1, len(page))
        text = page[at:start] if token or start == len(page) else page[at:end]
        at = end
        if text:
            if run is None:
                run = Run(order=order)
                order += 1
                stack[-1].kids.append(run)
            run.parts.append(text)
            if links:
                run.links += len(text) - text.count(" ")
        if not token:
            continue
        close, tag, rest = token[1] or token[4], (token[2] or token[5] or "").lower(), token[3] or token[6] or ""
        if not tag:
            continue
        if tag in RAW and not close:
            if not rest.endswith("/"):
                ending = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I).search(page, at)
                at = ending.end() if ending else len(page)
            continue
        if tag in INLINE:
            if tag == "a":
                links = max(0, links + (-1 if close else 1))
            elif tag == "br" and run is not None:
                run.parts.append(" ")
            continue
        run = None
        if close:
            if opened[tag] > 0:
                leave(next(i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag))
                links = 0
            continue
        if tag == "html":
            continue
        if stack[-1].tag == "p":
            leave(len(stack) - 1)
        ends, stops = CLOSED_BY.get(tag, ((), ()))
        i = len(stack) - 1
        while i > 0 and stack[i].tag not in stops and any(opened[e] > 0 for e in ends):
            if stack[i].tag in ends:
                leave(i)
            i -= 1
        block = Block(tag, ".".join([tag, *words_of(rest, of_id)]) if rest else tag)
        stack[-1].kids.append(block)
        if tag not in VOID and not rest.endswith("/"):
            stack.append(block)
            opened[tag] += 1
    return root


# ---- trees and simple tree matching


class Forest:
    """Trees in which equal parts are one node, so that equal parts are aligned once. A node is a number; 0 is a run of text.

    Nothing here recurses over the depth of a tree.
    """

    def __init__(self):
        self.labels: list[str] = ["#"]
        self.kids: list[tuple[int, ...]] = [()]
        self.sizes, self.slots = [1], [1]  # nodes and runs of the whole tree below
        self._known: dict[tuple[str, tuple[int, ...]], int] = {("#", ()): 0}
        self._scores: dict[tuple[int, int], int] = {}
        self._pairs: dict[tuple[int, int], list[tuple[int, int]]] = {}
        self._merged: dict[tuple[int, int], int] = {}

    def node(self, label: str, kids: Sequence[int] = ()) -> int:
        key = label, tuple(kids)
        if key not in self._known:
            self._known[key] = len(self.labels)
            self.labels.append(label)
            self.kids.append(key[1])
            self.sizes.append(1 + sum(self.sizes[k] for k in kids))
            self.slots.append(sum(self.slots[k] for k in kids))
        return self._known[key]

    def fold(self, block: Block) -> tuple[int, list[list[Run]]] | None:
        """The tree of a block and the runs of each of its slots, in order; None without text.

        Neighbours that are equal are one node of the tree, and their runs share its slots.
        """
        made: tuple[int, deque[list[Run]]] | None = None
        open_blocks: list[tuple[Block, list, list]] = [(block, block.kids[::-1], [])]
        while open_blocks:
            at, left, out = open_blocks[-1]
            if left and isinstance(left[-1], Block):
                kid = left.pop()
                open_blocks.append((kid, kid.kids[::-1], []))
                continue
            if left:
                run = left.pop()
                made = (0, deque([[run]])) if run.text() else None
            else:
                open_blocks.pop()
                made = (self.node(at.label, [o[0] for o in out]), _chained([o[1] for o in out])) if out else None
                if not open_blocks:
                    break
                out = open_blocks[-1][2]
            if made and out and out[-1][0] == made[0]:
                for own, more in zip(out[-1][1], made[1]):
                    own += more
            elif made:
                out.append(made)
        return (made[0], list(made[1])) if made else None

    def dump(self, root: int) -> str:
        """The tree as JSON: its different nodes, children first."""
        order: list[list] = []
        at: dict[int, int] = {}
        stack = [root]
        while stack:
            node = stack[-1]
            missing = [] if node in at else [k for k in dict.fromkeys(self.kids[node]) if k not in at]
            if missing:
                stack.extend(reversed(missing))
                continue
            stack.pop()
            if node not in at:
                at[node] = len(order)
                order.append([self.labels[node], [at[k] for k in self.kids[node]]])
        return json.dumps(order, separators=(",", ":"))

    def load(self, text: str) -> int:
        nodes: list[int] = []
        for label, kids in json.loads(text):
            nodes.append(self.node(label, [nodes[k] for k in kids]))
        return nodes[-1]

    def paths(self, root: int) -> list[tuple[str, ...]]:
        """The labels above each text slot, in the tree's order."""
        out: list[tuple[str, ...]] = []
        stack: list[tuple[int, tuple[str, ...]]] = [(root, ())]
        while stack:
            node, path = stack.pop()
            if node == 0:
                out.append(path)
                continue
            if len(path) < FAR or self.labels[node] not in path:
                path = (*path, self.labels[node])
            stack.extend((kid, path) for kid in reversed(self.kids[node]))
        return out

    def _middle(self, a: int, b: int) -> tuple[int, int]:
        """How many children at the beginning and at the end of two nodes are equal; pairing those is always best."""
        x, y = self.kids[a], self.kids[b]
        most, last = min(len(x), len(y)), 0
        while last < most and x[-1 - last] == y[-1 - last]:
            last += 1
        first = 0
        while first < most - last and x[first] == y[first]:
            first += 1
        return first, last

    def _gains(self, xs: Sequence[int], ys: Sequence[int]) -> _Gains:
        (kx, ix), (ky, iy) = np.unique(xs, return_inverse=True), np.unique(ys, return_inverse=True)
        table = np.zeros((len(kx), len(ky)), np.int32)
        by_label: dict[str, list[int]] = {}
        for j, y in enumerate(ky.tolist()):
            by_label.setdefault(self.labels[y], []).append(j)
        for i, x in enumerate(kx.tolist()):
            for j in by_label.get(self.labels[x], ()):
                y = int(ky[j])
                table[i, j] = self.sizes[x] if x == y else self._scores[x, y]
        return _Gains(table, ix, iy)

    def score(self, a: int, b: int) -> int:
        """The most nodes that two trees can pair in order; none if their labels differ."""
        stack = [(a, b)]
        while stack:
            pair = x, y = stack[-1]
            if pair in self._scores:
                stack.pop()
            elif x == y or self.labels[x] != self.labels[y]:
                self._scores[pair] = self.sizes[x] if x == y else 0
            else:
                first, last = self._middle(x, y)
                xs, ys = (self.kids[n][first: len(self.kids[n]) - last] for n in pair)
                alike: dict[str, set[int]] = {}
                for q in ys:
                    alike.setdefault(self.labels[q], set()).add(q)
                open_pairs = {(p, q) for p in set(xs) for q in alike.get(self.labels[p], ()) if p != q} - self._scores.keys()
                if open_pairs:
                    stack.extend(sorted(open_pairs))
                    continue
                equal = self.kids[x][:first] + self.kids[x][len(self.kids[x]) - last:]
                best = int(self._gains(xs, ys).last_row()[-1]) if xs and ys else 0
                self._scores[pair] = 1 + sum(self.sizes[k] for k in equal) + best
        return self._scores[a, b]

    def pairs(self, a: int, b: int) -> list[tuple[int, int]]:
        """Which children of two nodes with equal labels are paired."""
        if (a, b) not in self._pairs:
            m, n = len(self.kids[a]), len(self.kids[b])
            if self.labels[a] != self.labels[b]:
                found = []
            elif a == b:
                found = [(i, i) for i in range(m)]
            else:
                self.score(a, b)
                first, last = self._middle(a, b)
                xs, ys = self.kids[a][first: m - last], self.kids[b][first: n - last]
                between = self._gains(xs, ys).pairs() if xs and ys else []
                found = [(i, i) for i in range(first)]
                found += [(first + i, first + j) for i, j in between]
                found += [(m - k, n - k) for k in range(last, 0, -1)]
            self._pairs[a, b] = found
        return self._pairs[a, b]

    def merged(self, a: int, b: int) -> int:
        """A tree with the nodes of both: paired nodes are one, the others stand beside their neighbours."""
        stack = [(a, b)]
        while stack:
            pair = x, y = stack[-1]
            if pair in self._merged or x == y:
                self._merged[pair] = self._merged.get(pair, x)
                stack.pop()
                continue
            kx, ky = self.kids[x], self.kids[y]
            of = {j: i for i, j in self.pairs(x, y)}
            unmade = [(kx[i], ky[j]) for j, i in of.items() if (kx[i], ky[j]) not in self._merged]
            if unmade:
                stack.extend(unmade)
                continue
            kids, taken = [], 0
            for j, k in enumerate(ky):
                if j in of:
                    kids += kx[taken: of[j]]
                    kids.append(self._merged[kx[of[j]], k])
                    taken = of[j] + 1
                else:
                    kids.append(k)
            self._merged[pair] = self.node(self.labels[x], [*kids, *kx[taken:]])
        return self._merged[a, b]

    def places(self, page: int, template: int) -> list[int]:
        """For each text slot of the page its slot in the template, -1 if it has no partner."""
        out: list[int] = []
        stack = [(page, template if self.labels[page] == self.labels[template] else -1, 0)]
        while stack:
            a, b, first = stack.pop()
            if a == 0 or b < 0:
                out += [first] if a == 0 and b >= 0 else [-1] * self.slots[a]
                continue
            starts = np.cumsum([first, *(self.slots[k] for k in self.kids[b])]).tolist()
            of = dict(self.pairs(a, b))
            kids = [(k, self.kids[b][of[i]], starts[of[i]]) if i in of else (k, -1, 0) for i, k in enumerate(self.kids[a])]
            stack.extend(reversed(kids))
        return out


def _chained(parts: list[deque]) -> deque:
    """The parts in order, in the longest of them."""
    at = max(range(len(parts)), key=lambda i: len(parts[i]))
    whole = parts[at]
    for part in reversed(parts[:at]):
        whole.extendleft(reversed(part))
    for part in parts[at + 1:]:
        whole.extend(part)
    return whole


@dataclass
class _Gains:
    """What pairing each of two lists' entries brings: a table for the different entries, and which of them each entry is."""

    table: np.ndarray
    rows: np.ndarray
    columns: np.ndarray

    def _steps(self):
        """The best sums of the first rows with the first columns, row by row."""
        best = np.zeros(len(self.columns) + 1, np.int32)
        for i in self.rows:
            step = np.maximum(best[1:], best[:-1] + self.table[i][self.columns])
            best = np.concatenate(([0], np.maximum.accumulate(step))).astype(np.int32)
            yield best

    def last_row(self) -> np.ndarray:
        best = np.zeros(len(self.columns) + 1, np.int32)
        for best in self._steps():
            pass
        return best

    def pairs(self) -> list[tuple[int, int]]:
        """Row and column numbers of a best pairing in order. Long lists are halved, so that no large table is kept."""
        m, n = len(self.rows), len(self.columns)
        if m > 1 and m * n > CELLS:
            half = m // 2
            ahead = _Gains(self.table, self.rows[:half], self.columns).last_row()
            behind = _Gains(self.table, self.rows[half:][::-1], self.columns[::-1]).last_row()[::-1]
            cut = int(np.argmax(ahead + behind))
            above = _Gains(self.table, self.rows[:half], self.columns[:cut]).pairs()
            below = _Gains(self.table, self.rows[half:], self.columns[cut:]).pairs()
            return above + [(half + i, cut + j) for i, j in below]
        best = [np.zeros(n + 1, np.int32), *self._steps()]
        found, i, j = [], m, n
        while i and j:
            gain = self.table[self.rows[i - 1], self.columns[j - 1]]
            if gain and best[i][j] == best[i - 1][j - 1] + gain:
                found.append((i - 1, j - 1))
                i, j = i - 1, j - 1
            elif best[i][j] == best[i - 1][j]:
                i -= 1
            else:
                j -= 1
        return found[::-1]
