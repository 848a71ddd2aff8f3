"""HTML extraction by wrapper induction.

Pages are read into trees of blocks. The trees of a host are aligned by simple tree matching and merged into one
template; every text slot of the template gathers the texts that all pages have there. A slot whose text hardly changes
is template, a slot whose text varies is content, unless it stands in a menu, footer, form or the like. A page's text is
what it has in the content slots.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from learnlake.llm import dom
from learnlake.llm.frames import annotate
from learnlake.llm.urlfilter import split_url
from learnlake.session import written

MERGE = 64  # trees merged by one task
LEAST = 4  # different pages of a host from which on an unchanging slot is template
CONSTANT = 0.9
# fixed values: elements, and words of class, id and role, that mark what is not the article
ASIDE_TAGS = set("nav header footer aside form button dialog menu fieldset input head address".split())
ASIDE_WORDS = set(
    """ad ads adv advert advertisement advertising adsense banner sponsor sponsored promo promotion cookie cookies consent
    gdpr notice alert popup modal overlay nav navbar navigation menu breadcrumb breadcrumbs sidebar widget related
    recommended recommendations share sharing social comment comments commentary discussion disqus reply replies respond
    footer masthead login signup signin subscribe subscription newsletter pagination pager toolbar search skip copyright
    disclaimer complementary contentinfo""".split()
)
# those words of whole blocks that are never part of an article; with them and PARTS alone, an element is such a block
BLOCK_WORDS = ASIDE_WORDS - set("related social discussion replies notice alert widget search skip disclaimer".split())
PARTS = set("list area wrap wrapper block box container inner section item items body div post posts entry title".split())
MAIN = {"article", "main"}
HEADING = {"h1", "h2", "h3", "h4", "h5", "h6"}


def _of_id(words: set[str]) -> set[str]:
    """What an id adds to a label: the words that mark what is not the article, and whether it has others beside them.

    Other ids, such as those of a page's own headings, add nothing; labels made of them would differ from page to page.
    """
    told = words & ASIDE_WORDS
    return told | (words & {"section"}) | ({"~"} if words - ASIDE_WORDS - PARTS else set()) if told else set()


def beside(path: tuple[str, ...], place: tuple[str, ...] = (), named: bool = False, words: set[str] = ASIDE_WORDS) -> bool:
    """Whether a slot under these labels belongs to a menu, footer, advert, form, comment or the like.

    The words of an element that contains the article or ``place`` (the labels above the content) only count if they are
    all that it is called, and nothing around a main counts. Articles, and headings and sections in the content, must be
    called a block such as an advert or comments. ``named``: elements beside the content must be called nothing else either.
    """
    tags = [label.split(".")[0] for label in path]
    first = tags.index("article") if "article" in tags else -1
    main = False
    for k, label in enumerate(path):
        tag, *own = label.split(".")
        if tag in ("html", "body") or tag == "header" and main and tags[-1] in HEADING:
            continue  # the headline of the article
        if tag in ASIDE_TAGS:
            return True
        told, only = words.intersection(own), not set(own) - ASIDE_WORDS - PARTS
        holds = k < first or bool(place) and path[: k + 1] == place[: k + 1]
        part = tag in HEADING or tag == "section" or tag == "div" and "section" in own
        within_place = path[: len(place)] == place or tag in HEADING and path[:k] == place[:k]
        if tag == "article" or part and not holds and (main or within_place):
            told &= BLOCK_WORDS
        if told and "main" not in tags[k:] and (only or not (named or holds or k == first or part and main)):
            return True
        main = main or tag in MAIN
    return False


def within(path: tuple[str, ...]) -> bool:
    return any(label.split(".")[0] in MAIN for label in path)


def _deepest(slots: list[tuple[int, tuple[str, ...], int]]) -> tuple[str, ...]:
    """The deepest place that still holds most of the text of these slots (number, path, characters)."""
    mass, depth, chosen, place = sum(s[2] for s in slots), 1, slots, ()
    while True:
        heads: dict[tuple[str, ...], int] = {}
        for _, path, size in chosen:
            if len(path) > depth:
                heads[path[:depth]] = heads.get(path[:depth], 0) + size
        top = max(heads, key=heads.get, default=None)
        if top is None or heads[top] < 0.75 * mass:
            return place
        chosen, place, depth = [v for v in chosen if v[1][:depth] == top], top, depth + 1


def content(paths: list[tuple[str, ...]], pages: int, stats: dict[int, tuple[int, ...]]) -> tuple[list[int], ...]:
    """The content slots of a template with these paths, in the order in which a page takes them: those inside article or main, also those
    there that may stand beside the article, those of the region of pages without such an element, and all that vary. In the
    place that holds most of an article's text, slots stay also if their text never changes; without such an element, headings do.

    ``stats``: pages with the slot, pages with its commonest text, characters, link characters, and the last two again of
    the pages without article or main.
    """
    varying, fixed = [], []
    for i, path in enumerate(paths):
        n, most, size, links, *other = stats.get(i, (0, 0, 0, 0, 0, 0))
        if not (pages >= LEAST and 2 * n >= pages and most >= CONSTANT * n):
            varying.append((i, path, size, links, *other))
        elif links < 0.6 * max(1, size):
            fixed.append((i, path))
    # first the place of the content, then what is beside it; an element's words do not decide on what contains it
    main = [v for v in varying if within(v[1]) and not beside(v[1], named=True)]
    place = _deepest([v[:3] for v in main])
    among = lambda place: [(i, p) for i, p in fixed if place and p[: len(place)] == place and not beside(p, place)]
    kept = {i for i, p in among(place) if within(p)}
    inside = sorted({v[0] for v in main if not beside(v[1], place)} | kept)
    varying = [v for v in varying if not within(v[1]) and v[3] < 0.6 * max(1, v[2]) and not beside(v[1], named=True, words=BLOCK_WORDS)]
    plain = [(i, path, size) for i, path, _, _, size, links in varying if size and links < 0.6 * size]
    place = _deepest([v for v in plain if not beside(v[1], named=True)] or plain)
    plain = [v for v in plain if not beside(v[1], place)]
    place = _deepest(plain)
    # and the headings that stand right above it
    region = [i for i, p, _ in plain if p[: len(place)] == place or p[-1].split(".")[0] in HEADING and p[:-1] == place[: len(p) - 1]]
    kept_there = {i for i, p in among(place) if p[-1].split(".")[0] in HEADING and not within(p)}
    return inside, sorted({v[0] for v in main} | kept), sorted({*region, *kept_there}), sorted({v[0] for v in varying} | kept_there)


# ---- jobs


def _read(page: str | None, forest: dom.Forest) -> tuple[int, list[list[dom.Run]]]:
    return forest.fold(dom.read(page, _of_id)) or (forest.node("html"), [])


def shapes(pages: DataFrame) -> DataFrame:
    """``host``, ``shape`` (the page's tree), and for each text slot ``hashes``, ``sizes``, ``links``."""

    def build(_) -> Callable[[pa.Array], dict]:
        def run(texts: pa.Array) -> dict:
            out: dict[str, list] = {"shape": [], "hashes": [], "sizes": [], "links": []}
            forest = dom.Forest()
            for page in texts.to_pylist():
                tree, found = _read(page, forest)
                said = ["\n".join(r.text() for r in slot) for slot in found]
                out["shape"].append(forest.dump(tree))
                out["hashes"].append([xxhash.xxh64_intdigest(s.encode("utf-8", "replace")) - (1 << 63) for s in said])
                out["sizes"].append([len(s) for s in said])
                out["links"].append([sum(r.links for r in slot) for slot in found])
            return {k: pa.array(v, pa.string() if k == "shape" else pa.list_(pa.int64())) for k, v in out.items()}

        return run

    named = pages.select(split_url(F.col("url"))[0].alias("host"), F.col("html").alias("text"))
    return annotate(named, ["host"], "shape string, hashes array<long>, sizes array<long>, links array<long>", build)


def templates(parsed: DataFrame) -> DataFrame:
    """``host``, ``template``: the trees of each host merged, ``MERGE`` at a time, until one is left."""
    trees = written(parsed.select("host", "shape").distinct(), "wrapper-shapes")

    def merge(keys: tuple, table: pa.Table) -> pa.Table:
        order = sorted(table["shape"].to_pylist(), key=lambda s: (-len(s), s))
        forest = dom.Forest()
        whole = forest.load(order[0])
        for other in order[1:]:
            whole = forest.merged(whole, forest.load(other))
        return pa.table({"host": [keys[0].as_py()], "shape": [forest.dump(whole)]})

    while True:
        sizes = trees.groupBy("host").agg(F.count("*").alias("n"))
        if (sizes.agg(F.max("n")).first()[0] or 0) <= 1:
            return trees.withColumnRenamed("shape", "template")
        dealt = trees.join(sizes, "host").select(
            "host", F.pmod(F.xxhash64("shape"), F.ceil(F.col("n") / MERGE)).alias("_part"), "shape"
        )
        trees = written(dealt.groupBy("host", "_part").applyInArrow(merge, "host string, shape string"), "wrapper-shapes")


class _Aligned:
    """Slot places of a page's tree in a template; equal pairs of trees are matched once in a task."""

    def __init__(self):
        self._new()

    def _new(self) -> None:
        self.forest = dom.Forest()
        self.trees: dict[str, int] = {}
        self.found: dict[tuple[int, int], list[int]] = {}
        self.mains: dict[int, bool] = {}

    def tidy(self) -> None:
        """Between pages: what is known of earlier ones does not grow for ever."""
        if len(self.forest.labels) > 200_000 or len(self.found) > 20_000:
            self._new()

    def tree(self, shape: str) -> int:
        if shape not in self.trees:
            self.trees[shape] = self.forest.load(shape)
        return self.trees[shape]

    def main(self, tree: int) -> bool:
        """Whether the page has an article or main element with text."""
        if tree not in self.mains:
            self.mains[tree] = any(within(p) and not beside(p, named=True) for p in self.forest.paths(tree))
        return self.mains[tree]

    def __call__(self, tree: int, template: int) -> list[int]:
        if (tree, template) not in self.found:
            self.found[tree, template] = self.forest.places(tree, template)
        return self.found[tree, template]


def induce(pages: DataFrame) -> DataFrame:
    """``host``, ``template`` and ``content`` (its content slots, see there) from all pages. Equal pages of a host count once."""
    parsed = written(shapes(pages).distinct(), "wrapper-pages")
    found = templates(parsed)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligned = _Aligned()
        for batch in batches:
            cols: list[list] = [[] for _ in names]
            for row in batch.to_pylist():
                aligned.tidy()
                tree = aligned.tree(row["shape"])
                to = aligned(tree, aligned.tree(row["template"]))
                plain = not aligned.main(tree)
                for i, h, s, k in zip(to, row["hashes"], row["sizes"], row["links"]):
                    if i >= 0:
                        for c, v in zip(cols, (row["host"], i, h, s, k, s * plain, k * plain)):
                            c.append(v)
            kinds = [pa.string()] + [pa.int64()] * (len(names) - 1)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=names)

    sums = ["size", "links", "other_size", "other_links"]  # the last two of pages without article or main
    names = ["host", "slot", "hash", *sums]
    rows = parsed.join(found, "host").mapInArrow(spread, "host string, " + ", ".join(f"{c} long" for c in names[1:]))
    texts = rows.groupBy("host", "slot", "hash").agg(F.count("*").alias("n"), *[F.sum(c).alias(c) for c in sums])
    one = texts.groupBy("host", "slot").agg(F.sum("n").alias("n"), F.max("n").alias("most"), *[F.sum(c).alias(c) for c in sums])
    # as many entries as the template has slots
    of = one.groupBy("host").agg(F.collect_list(F.struct("slot", "n", "most", *sums)).alias("stats"))
    number = parsed.groupBy("host").agg(F.count("*").alias("pages"))

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            forest = dom.Forest()
            kept = [
                content(forest.paths(forest.load(r["template"])), r["pages"], {s["slot"]: tuple(s[c] for c in ("n", "most", *sums)) for s in r["stats"] or []})
                for r in rows
            ]
            arrays = [pa.array([r["host"] for r in rows], pa.string()), pa.array([r["template"] for r in rows], pa.string()), pa.array([list(k) for k in kept], pa.list_(pa.list_(pa.int64())))]
            yield pa.RecordBatch.from_arrays(arrays, names=["host", "template", "content"])

    joined = found.join(number, "host").join(of, "host", "left").select("host", "template", "pages", "stats")
    return written(joined.mapInArrow(decide, "host string, template string, content array<array<long>>"), "wrapper-templates")


def page_text(page: str | None, template: str, kept: list[set[int]], aligned: _Aligned) -> str:
    """What the page has in the first of its host's lists of content slots in which it has any text."""
    aligned.tidy()
    tree, found = _read(page, aligned.forest)
    to = aligned(tree, aligned.tree(template))
    inside, *others = kept
    paths = aligned.forest.paths(tree)
    chosen = [s for i, p, s in zip(to, paths, found) if i in inside or i < 0 and within(p) and not beside(p)]
    for other in others:
        chosen = chosen or [s for i, s in zip(to, found) if i in other]
    return "\n".join(r.text() for r in sorted((r for s in chosen for r in s), key=lambda r: r.order))


def extract(pages: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns, ``text`` and ``n_chars`` of every page.

    A NULL or empty page has an empty text. Pages without a host (NULL url, no ``://``) share one template. Repeated rows
    get the same text; an empty table gives no rows; other columns are not read.
    """
    rules = induce(pages)
    named = pages.select(*keep, split_url(F.col("url"))[0].alias("_host"), F.col("html").alias("_html"))
    joined = named.join(rules, named["_host"] == rules["host"]).select(*keep, "_html", "template", "content")
    schema = joined.select(*keep, F.lit("").alias("text"), F.lit(0).cast("long").alias("n_chars")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligned = _Aligned()
        for batch in batches:
            k = len(keep)
            rows = zip(batch.column(k).to_pylist(), batch.column(k + 1).to_pylist(), batch.column(k + 2).to_pylist())
            texts = [page_text(page, template, [set(k) for k in kept], aligned) for page, template, kept in rows]
            made = [pa.array(texts, pa.string()), pa.array(np.array([len(t) for t in texts], np.int64))]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(k)), *made], names=schema.names)

    return joined.mapInArrow(run, schema)
