"""Personal data, collocations and vector codes against brute force and on hard rows."""

import collections
import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from learnlake.llm import collocation, pii, pivots

# ---- personal data

EXPRESSIONS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def check_digit(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(v - 9 * (v > 9) for v in doubled) % 10 == 0


def base_spans(text):
    for kind, expression in EXPRESSIONS.items():
        for m in re.finditer(expression, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if {
                "email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in m[0].split(".")),
                "card": 16 <= len(digits) <= 19 and check_digit(digits), "phone": 8 <= len(digits) <= 15,
            }[kind]:
                yield f"{kind}:{m.start()}:{m.end()}"


def test_base_spans_equal_the_plain_expressions(spark, documents):
    rng = random.Random(5)
    bits = ["a", "b.c", "@", "@", ".", "-", "+", " ", "é", "😀", "1", "25", "255", "256", "0007", "(", ")", "\n", "4111111111111111",
            "4111 1111 1111 1111", "+1 (743) 555-3824", "x@y.zz", "1.2.3.4", "%", "_", "@h-1.org"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(1, 40))) for _ in range(600)]
    texts += [None, "", " ", "a" * 5_000, "1" * 5_000, "a@" + "b." * 50_000 + "c", "+1" * 50_000, "1 " * 100_000, "a@b.cc " * 20_000, "😀1.2.3.4"]
    docs = documents(*[(i, t) for i, t in enumerate(texts)], (0, texts[0]), (None, "q@r.st")).withColumn("row", F.lit("x"))
    got = collections.Counter((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in pii.digest(pii.find(docs)).collect())
    want = collections.Counter()
    for i, text in [*enumerate(texts), (0, texts[0]), (None, "q@r.st")]:
        found = list(base_spans(text))
        n = collections.Counter(s.split(":")[0] for s in found)
        want[(i, *[n[k] for k in EXPRESSIONS], hashlib.sha256(",".join(found).encode()).hexdigest())] += 1
    assert got == want
    assert pii.digest(pii.find(docs.limit(0))).count() == 0


def test_long_runs_take_linear_time(spark, documents):
    texts = ["a" * 3_000_000, "1" * 3_000_000, "1" + " " * 500_000 + "2 3 4 5 6 7 8 " * 1_000]
    rows = pii.digest(pii.find(documents(*enumerate(texts)))).collect()
    assert len(rows) == 3 and {r.spans for r in rows} == {""}


def brute_patterns(edges, rounds):
    """Mean scores of patterns by plain dictionaries; ``edges`` maps (pattern, instance) to the kinds it is a seed of."""
    kinds = pii.KINDS
    seeds = collections.defaultdict(set)
    for (_, i), own in edges.items():
        seeds[i] |= own
    value = {(i, k): pii.ONE * (k in seeds[i]) for _, i in edges for k in kinds}
    by_pattern, by_instance = collections.defaultdict(list), collections.defaultdict(list)
    for p, i in edges:
        by_pattern[p].append(i), by_instance[i].append(p)
    for _ in range(rounds):
        score = {(p, k): sum(value[i, k] for i in own) // len(own) for p, own in by_pattern.items() for k in kinds}
        for i, own in by_instance.items():
            if not seeds[i]:
                for k in kinds:
                    value[i, k] = sum(score[p, k] for p in own) // len(own)
    return score


def test_pattern_scores_equal_plain_rounds(spark):
    rng = random.Random(3)
    edges = {(f"p{rng.randint(0, 9)}", f"i{rng.randint(0, 40)}"): set() for _ in range(150)}
    seeded = {f"i{n}": {rng.choice(pii.KINDS)} for n in range(0, 40, 2)}
    edges = {e: seeded.get(e[1], set()) for e in edges}
    frame = spark.createDataFrame([(p, i, *[k in own for k in pii.KINDS]) for (p, i), own in edges.items()],
                                  "pattern string, instance string, " + ", ".join(f"{k} boolean" for k in pii.KINDS))
    got = {(r.pattern, k): r[f"s_{k}"] for r in pii.score_patterns(frame).collect() for k in pii.KINDS}
    assert got == brute_patterns(edges, pii.ROUNDS)


def test_patterns_discover_identifiers_of_another_form(spark, documents):
    known = [(n, f"Please call me at +1 (743) 555-38{n:02d} today. My login is person{n}@mail.example.com ok") for n in range(10, 20)]
    unseen = [
        (30, "Please call me at (743) 555 9911, thanks"), (31, "my login is root@intranet now"), (32, "we sold 7435559911 pieces"),
        (33, "call me at noon"), (34, "Line call me\nat 743 555 9912 now"),
    ]
    rows = {r.doc_id: r for r in pii.digest(pii.find(documents(*known, *unseen))).collect()}
    text = dict(unseen)
    said = {i: [(s.split(":")[0], text[i][int(s.split(":")[1]): int(s.split(":")[2])]) for s in rows[i].spans.split(",") if s] for i in text}
    assert said[30] == [("phone", "(743) 555 9911")] and said[31] == [("email", "root@intranet")]
    assert said[32] == said[33] == []
    assert rows[30].n_phone == 0 and rows[10].spans.count(":") == 4
    # too few seeds: nothing is added, the base spans stay
    few = {r.doc_id: r for r in pii.digest(pii.find(documents(*known[:3], *unseen))).collect()}
    assert few[30].spans == "" and few[10].n_email == 1


# ---- collocations


def brute_collocations(rows, support, top):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    f, n = collections.Counter(), collections.Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(low)):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for m in range(1, 5):
                for i in range(len(words) - m + 1):
                    f[lang, tuple(words[i: i + m])] += 1
    phrases = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= support}
    covered = collections.Counter()
    for (lang, w), a in phrases.items():
        for m in range(2, len(w)):
            for i in range(len(w) - m + 1):
                covered[lang, w[i: i + m]] = max(covered[lang, w[i: i + m]], a)
    out = collections.defaultdict(list)
    for (lang, w), a in phrases.items():
        if 100 * covered[lang, w] >= 80 * a:
            continue
        score, k = min((2_000_000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k) for k in range(1, len(w)))
        out[lang].append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    return {
        (lang, rank, p.decode(), -a, l, r, n[lang], -s)
        for lang, found in out.items() for rank, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1)
    }


@pytest.mark.parametrize("top", [5, 2000])
def test_collocations_equal_counting_all_phrases(spark, documents, top):
    rng = random.Random(9)
    words = ["The", "the", "of", "naïve", "É", "x", "y", "zz", "new york", "a"]
    ends = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", " ! "]
    texts = ["".join(rng.choice(words) + rng.choice(ends) for _ in range(rng.randint(0, 60))) for _ in range(300)]
    rows = [(i, t, rng.choice(["en", "de", None])) for i, t in enumerate(texts)]
    rows += [(900, None, "en"), (901, "", "en"), (902, " \t", "fr"), (903, "one", "fr"), (None, "big apple pie " * 40, "en"), (1, texts[1], "en")]
    rows += [(904, "long text here " * 400_000, "xx"), (905, "w" * 3_000_000 + " tail", "xx")]
    docs = documents(*rows).withColumn("w1", F.lit("x")).withColumn("n", F.lit(1))
    got = {tuple(r) for r in collocation.mine(docs, 30, top).collect()}
    assert got == brute_collocations([(t, lang) for _, t, lang in rows], 30, top)
    assert collocation.mine(docs.limit(0)).count() == 0


def test_counts_are_exact_with_a_full_table(spark, documents):
    """A table that lets every pair through only prunes less."""
    texts = documents(*[(i, "a b c d. e f", "en") for i in range(40)]).select("text", "lang")
    full = np.full(1 << (collocation.TABLE_BITS - 6), 2**64 - 1, np.uint64)
    some = collocation.frequent(texts, 30)
    assert sorted(map(tuple, collocation.windows(texts, full).collect())) == sorted(map(tuple, collocation.windows(texts, some).collect()))


# ---- vector codes


def brute_codes(rows, rounds=6, entries=16):
    """``rows`` of (id, label, vector): codes, errors and digests, with integers of any size."""
    from fractions import Fraction
    from math import floor

    good = [r for r in rows if r[2] is not None and all(x is not None and np.isfinite(x) for x in r[2])]
    out = []
    for dim in {len(r[2]) for r in good}:
        own = sorted((r for r in good if len(r[2]) == dim), key=lambda r: (r[0] is None, r[0], r[2]))
        cut = [0, *itertools.accumulate(len(p) for p in np.array_split(range(dim), 8))]
        parts = [[[floor(Fraction(x) * 4096) for x in r[2][a:b]] for r in own] for a, b in zip(cut, cut[1:])]
        books = [[list(x) for x in p[:entries]] for p in parts]
        nearest = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(book))
        for _ in range(rounds):
            for p, book in zip(parts, books):
                found = [nearest(x, book)[1] for x in p]
                for e in set(found):
                    mine = [x for x, i in zip(p, found) if i == e]
                    book[e] = [sum(c) // len(mine) for c in zip(*mine)]
        sha = hashlib.sha256(",".join(str(v) for b in books for e in b for v in e).encode()).hexdigest()
        for k, r in enumerate(own):
            best = [nearest(p[k], b) for p, b in zip(parts, books)]
            out.append((r[0], r[1], "".join(f"{i:02x}" for _, i in best), sum(d for d, _ in best), sha))
    errors = collections.Counter()
    for r in out:
        errors[r[1]] += r[3]
    fits = lambda v: v if v < 2**63 else None
    wide = {r[1] for r in out if r[3] >= 2**63}
    return collections.Counter((i, c, fits(e), None if lab in wide else fits(errors[lab]), s) for i, lab, c, e, s in out)


def vectors_frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").withColumn("dim", F.lit("x"))


def test_codes_equal_trying_all_entries(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(30, 24))
    rows = [(i, int(i % 3) or None, (centres[i % 30] + 0.1 * rng.normal(size=24)).tolist()) for i in range(400)]
    rows += [(5, 1, rows[9][2]), (5, 1, rows[9][2]), (None, 2, rows[11][2]), (700, 1, None), (701, 1, [float("nan")] * 24)]
    rows += [(702, 1, [None] * 24), (703, 1, [float("inf")] * 24), (704, 4, []), (705, 4, [0.0] * 24), (706, 5, [1.0] * 11), (707, 5, [-1.0] * 11)]
    got = collections.Counter(map(tuple, pivots.compress(vectors_frame(spark, rows)).collect()))
    assert got == brute_codes(rows)
    assert pivots.compress(vectors_frame(spark, rows[:5])).count() == 5
    assert pivots.compress(vectors_frame(spark, []).limit(0)).count() == 0


def test_codes_of_very_large_components(spark):
    rng = np.random.default_rng(8)
    rows = [(i, 1, (rng.normal(size=16) * 10.0 ** rng.integers(-3, 300)).tolist()) for i in range(60)]
    rows += [(100 + i, 2, (rng.normal(size=16) * 1e11).tolist()) for i in range(40)]
    got = collections.Counter(map(tuple, pivots.compress(vectors_frame(spark, rows)).collect()))
    assert got == brute_codes(rows)


def test_bounds_leave_out_most_entries():
    rng = np.random.default_rng(2)
    book = (rng.normal(size=(16, 8)) * 4096).astype(np.int64)
    x = book[rng.integers(0, 16, 2000)] + rng.integers(-200, 200, (2000, 8))
    chosen = pivots.choose(book)
    at, best, tried = pivots.assign(x, pivots.distances(x, chosen), book, chosen)
    every = ((x[:, None] - book[None]) ** 2).sum(axis=2)
    assert (at == every.argmin(axis=1)).all() and (best == every.min(axis=1)).all()
    assert tried < 0.2 * every.size


# ---- mixing with probabilities next to 0 and 1


def test_mix_of_probabilities_that_are_nearly_whole(spark, documents):
    """Weights 0.1 and 0.2 over sources of 100 and 200 documents of a word: the share wanted is one but for a rounding error."""
    from learnlake.llm import mixing

    docs = documents(*[(i, "word", None, "a" if i < 100 else "b") for i in range(300)])
    rows = mixing.mix(docs, lambda names: {s: {"a": 0.1, "b": 0.2}[s] for s in names}).collect()
    assert len(rows) == 300 and {r.taken for r in rows} == {1}


# ---- the cover tree of the largest products


def test_tree_nests_covers_and_separates():
    from learnlake.llm import covertree

    rng = np.random.default_rng(6)  # clusters of clusters, so that there are levels of many sizes
    x = sum(rng.normal(size=(n, 6))[rng.integers(0, n, 5000)] * size for n, size in ((6, 3000), (20, 200), (5000, 5)))
    x = np.concatenate([x, x[:50]])
    root = covertree.build(x)
    assert sorted(root.at.tolist()) == list(range(len(x)))
    by_level, nodes, deepest = collections.defaultdict(set), [root], 0
    while nodes:
        n = nodes.pop()
        assert np.sqrt(((x[n.at] - x[n.point]) ** 2).sum(axis=1)).max() <= n.radius * (1 + 1e-12)
        if n.children:
            deepest += 1
            assert n.children[0].point == n.point
            assert all(np.linalg.norm(x[c.point] - x[n.point]) <= 2.0**n.level for c in n.children)
            by_level[n.level - 1] |= {c.point for c in n.children}
        nodes += n.children
    points, levels, _ = covertree.net(x)
    assert deepest > 5 and len(by_level) > 2
    for level in by_level:
        own = x[points[levels >= level]]
        gaps = np.sqrt(((own[:, None] - own[None]) ** 2).sum(axis=2)) + np.diag(np.full(len(own), np.inf))
        assert gaps.min() > 2.0**level


def test_largest_products_of_any_finite_size(spark):
    from fractions import Fraction
    from math import floor

    from learnlake.llm import covertree

    rng = np.random.default_rng(12)
    for power in (0, 9, 160, 307):
        x = rng.normal(size=(40, 3)) * 10.0**power / 4
        rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(10, x[3].tolist())]
        got = covertree.largest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 10, 5).collect()
        ints = [(i, [floor(Fraction(c) * 256) for c in v]) for i, v in rows]
        ends = lambda s: min(max(s, -(2**63)), 2**63 - 1)
        for q in (0, 10, 20, 30):
            mine = min((v for i, v in rows if i == q))
            asked = [floor(Fraction(c) * 256) for c in mine]
            best = sorted((-sum(a * b for a, b in zip(asked, v)), i) for i, v in ints if i != q)[:5]
            found = sorted((r.rank, r.score) for r in got if r.query_id == q)
            assert [s for _, s in found] == [ends(-s) for s, _ in best]


# ---- batch scores of the classifiers against plain forms


def test_language_scores_are_those_of_the_landmark_form():
    """The collapsed weights give kernel values to the landmarks times one weight for each landmark and language."""
    import duckdb
    import pyarrow as pa

    from learnlake.llm import langid

    rows = [r for r in duckdb.sql("SELECT text, lang FROM '/root/testdata/sf0.01/documents.parquet' LIMIT 400").fetchall() if r[0] and r[1]]
    grams = lambda some: [set(f.tolist()) for f in langid.presence(pa.array([t for t, _ in some]))]
    known, others = rows[:40], rows[40:200]
    model = langid.train([lang for _, lang in known], list(langid.presence(pa.array([t for t, _ in known]))))
    marks = grams(known)
    kernel = np.array([[len(g & m) / max(1, len(g) * len(m)) ** 0.5 for m in marks] for g in grams(others)])
    got = langid.rate(model, pa.array([t for t, _ in others])) - model.bias
    half = len(others) // 2
    weights = np.linalg.lstsq(kernel[:half], got[:half], rcond=None)[0]
    assert np.abs(kernel[half:] @ weights - got[half:]).max() < 1e-3 * np.abs(got).max()


def test_quality_scores_are_softmax_of_averaged_vectors():
    import duckdb
    import pyarrow as pa

    from learnlake.llm import quality

    texts = [r[0] for r in duckdb.sql("SELECT text FROM '/root/testdata/sf0.001/documents.parquet' LIMIT 80").fetchall()] + ["", None, " ", "x x x"]
    found = list(quality.counts(pa.array(texts)))
    model = quality.train([(s, n, i % 2) for i, (s, n) in enumerate(found)])
    for got, (slot, n) in zip(quality.rate(model, pa.array(texts)), found):
        mean = np.average(model.vectors[slot].astype(float), axis=0, weights=n)
        z = np.exp(mean @ model.softmax + model.bias)
        assert abs(got - z[1] / z.sum()) < 1e-4


# ---- nearest neighbours of any size


def test_nearest_of_components_of_any_size(spark):
    from learnlake.llm import onebit

    rng = np.random.default_rng(21)
    tables = {
        "two far clusters": np.concatenate([rng.normal(1e9, 1, (300, 1)), rng.normal(-1e9, 1, (300, 1))]),
        "near the end of floats": rng.normal(size=(300, 8)) * 5e37, "doubles": rng.normal(size=(300, 8)) * 1e160,
        "the end of doubles": rng.uniform(-1, 1, size=(200, 4)) * 1.7e308, "small": rng.normal(size=(300, 8)) * 1e-200,
    }
    for name, x in tables.items():
        frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
        rows = onebit.nearest(frame, 20, 10).collect()
        unit, hits = np.abs(x).max(), 0
        for q in range(0, len(x), 20):
            far = np.sqrt(((x / unit - x[q] / unit) ** 2).sum(axis=1))
            far[q] = np.inf
            best = set(np.argsort(far, kind="stable")[:10].tolist())
            found = [r.vec_id for r in sorted(rows, key=lambda r: r.rank) if r.query_id == q]
            assert len(found) == 10
            hits += len(best & set(found))
        assert hits >= 0.9 * 10 * len(range(0, len(x), 20)), name


def test_a_long_host_has_no_more_keys_than_rules_have_shapes():
    from learnlake.llm import urlfilter

    host, shapes = "a." * 50_000 + "example.com", [(3, 1), (11, 4), (15, 4)]
    assert list(urlfilter.asked(host, "/en/x", shapes)) == ["a.a.example.com/en/", "example.com/en/", "com/"]
    assert list(urlfilter.asked("xexample.com", "/en/x", shapes)) == ["com/"]
    assert list(urlfilter.asked("com", "", shapes)) == [] == list(urlfilter.asked("", "/en/", shapes))


@pytest.mark.parametrize("pages", [3, 4, 40])
def test_headings_that_all_pages_share_stay_in_the_article(spark, pages):
    from learnlake.llm import wrapper

    html = """<html><body><nav><a href=/>Home</a></nav><div class="menu"><h3>Topics</h3><ul><li><a href=/x>Menu</a></li></ul></div>
        {open}<h1>Dish {n}</h1><h2>Ingredients</h2><p>Take {n} spoons of salt and {m} of something else, as said.</p>
        <h2>Method</h2><p>Stir it {n} times and wait for {m} hours, then serve it warm.</p>{close}<footer>Fixed words</footer></body></html>"""
    for open_, close in (("<article>", "</article>"), ('<div class="text">', "</div>")):
        rows = [(i, f"http://h{pages}.org/{i}", html.format(open=open_, close=close, n=i * 7, m=i * 31)) for i in range(pages)]
        got = wrapper.extract(spark.createDataFrame(rows, "page_id long, url string, html string"), ["page_id", "url"]).collect()
        for r in got:
            n, m = r.page_id * 7, r.page_id * 31
            want = [f"Dish {n}", "Ingredients", f"Take {n} spoons of salt and {m} of something else, as said.", "Method",
                    f"Stir it {n} times and wait for {m} hours, then serve it warm."]
            assert r.text.split("\n") == want
