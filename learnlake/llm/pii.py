"""Personal data by bootstrapped contextual extraction, with DataFrame functions only.

Four regular expressions give the seeds: e-mail and IP addresses, card and phone numbers. The words before a seed are a
lexical pattern ("call me at"). Spans that only look like an identifier are candidates; they share patterns with seeds.
Patterns and the identifiers found after them form a graph, which is scored in rounds: a pattern is as good as the mean of
its identifiers, an identifier that is no seed as good as the mean of its patterns, for each kind on its own. Patterns
that stay above ``ACCEPT`` and follow enough different seeds turn the candidates after them into finds.

Scores are whole millionths, so that reruns agree. All of it runs in joins and aggregates that combine before they
shuffle; texts are read once, and only what was found in them is kept.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from learnlake.session import written

KINDS = ["email", "ip", "card", "phone"]
ROUNDS, ONE, ACCEPT, SEEDS = 3, 1_000_000, 800_000, 5
BEFORE = 80  # code points before a span in which the words of its pattern are looked for

# What the contract asks for, written so that no run of characters is tried again from its middle and no repeated group
# nests: a match can only begin where a run begins or where the last match ended.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Spans that may be an identifier of a kind without having its usual form.
LOOSE = {
    "address": r"(?:(?<![^\s<>\"'(),;])|\G)[^\s<>\"'(),;@]++@[^\s<>\"'(),;]++",
    "colons": r"(?<![0-9A-Za-z:])(?=[0-9A-Fa-f]{0,4}:)[0-9A-Fa-f:]{8,}+(?![0-9A-Za-z])",
    "digits": r"(?<![0-9A-Za-z@._+-])\(?[0-9][\x20().0-9/-]*+",
}
OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the check digit of a number is right: every second digit from the right counts twice."""
    places = F.sequence(F.lit(1), F.length(digits))
    value = F.transform(places, lambda i: F.substring(F.reverse(digits), i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1))
    return F.aggregate(value, F.lit(0), lambda total, v: total + v - F.when(v > 9, 9).otherwise(0)) % 10 == 0


def valid(source: Column, match: Column) -> Column:
    """Whether a match of a base expression is a span of its kind."""
    size = F.length(_digits(match))
    return (
        F.when(source == "email", True)
        .when(source == "ip", match.rlike(f"^{OCTET}(?:[.]{OCTET}){{3}}$"))
        .when(source == "card", F.when(size.between(16, 19), luhn(_digits(match))).otherwise(False))
        .when(source == "phone", size.between(8, 15))
        .otherwise(False)
    )


def possible(source: Column, match: Column, kind: str) -> Column:
    """Whether a loose match can be an identifier of a kind."""
    size = F.length(_digits(match))
    if kind == "email":
        return source == "address"
    if kind == "ip":
        return (source == "colons") & (F.length(F.regexp_replace(match, "[^:]", "")).between(2, 7))
    return (source == "digits") & (size.between(12, 19) if kind == "card" else size.between(7, 15))


def _matches(text: Column, pattern: str, needs: str | None) -> Column:
    """For each match the length of the text since the last one, the match, and the end of that text."""
    zipped = F.zip_with(
        F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda gap, hit: F.struct(F.length(gap).alias("gap"), hit.alias("hit"), F.right(gap, F.lit(BEFORE)).alias("before")),
    )
    found = F.filter(zipped, lambda m: m["hit"].isNotNull())
    return found if needs is None else F.when(F.contains(text, F.lit(needs)), found)


def scan(docs: DataFrame) -> DataFrame:
    """``row`` (a number of its own for each document), ``doc_id`` and the matches of every expression."""
    text = F.coalesce("text", F.lit(""))
    needs = {"email": "@", "address": "@", "phone": "+", "colons": ":"}
    return docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id",
        *[_matches(text, pattern, needs.get(name)).alias(name) for name, pattern in (BASE | LOOSE).items()],
    )


def spans(scanned: DataFrame) -> DataFrame:
    """``row``, ``source``, ``start``, ``end``, ``hit``, ``before`` of every match, in code points of the whole text."""
    parts = [
        scanned.select("row", F.lit(name).alias("source"), F.posexplode(name).alias("i", "m")).select("row", "source", "i", "m.*")
        for name in BASE | LOOSE
    ]
    matches = reduce(DataFrame.unionAll, parts)
    upto = Window.partitionBy("row", "source").orderBy("i")
    placed = matches.withColumn("end", F.sum(F.col("gap") + F.length("hit")).over(upto))
    placed = placed.withColumn("start", F.col("end") - F.length("hit"))
    # a loose run of digits may end in blanks and the like, a loose address in a full stop
    short = F.rtrim("hit", F.lit(" ().:/-"))
    loose = F.col("source").isin(*LOOSE)
    placed = placed.withColumn("hit", F.when(loose, short).otherwise(F.col("hit")))
    return placed.select("row", "source", "start", (F.col("start") + F.length("hit")).alias("end"), "hit", "before")


def instance(source: Column, hit: Column) -> Column:
    """The identifier itself: the digits of numbers, lower case of the rest."""
    return F.when(source.isin("card", "phone", "digits"), _digits(hit)).otherwise(F.lower(hit))


def patterns(before: Column) -> Column:
    """The last one and the last two words before a span, on its line and with few other characters between."""
    word, between = r"(\p{L}{1,30})", r"[^\p{L}\p{N}\n]{1,5}"
    one = F.regexp_extract(before, rf"(?:^|[^\p{{L}}]){word}{between}$", 1)
    two = F.regexp_extract(before, rf"(?:^|[^\p{{L}}]){word}{between}\p{{L}}{{1,30}}{between}$", 1)
    both = F.array(F.when(one != "", F.lower(one)), F.when((one != "") & (two != ""), F.lower(F.concat_ws(" ", two, one))))
    return F.array_compact(both)


def candidates(found: DataFrame) -> DataFrame:
    """The loose spans (``seed`` false) that do not overlap a seed, and the seeds."""
    by_place = Window.partitionBy("row").orderBy("start")
    seed = F.col("seed")
    marked = found.withColumns({
        "_end": F.max(F.when(seed, F.col("end"))).over(by_place.rangeBetween(Window.unboundedPreceding, Window.currentRow)),
        "_next": F.min(F.when(seed, F.col("start"))).over(by_place.rangeBetween(Window.currentRow, Window.unboundedFollowing)),
    })
    free = ~F.coalesce(F.col("_end") > F.col("start"), F.lit(False)) & ~F.coalesce(F.col("_next") < F.col("end"), F.lit(False))
    return marked.where(seed | (free & (F.col("end") > F.col("start")))).drop("_end", "_next")


def score_patterns(edges: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``pattern`` with a score in millionths and the number of different seeds for each kind.

    ``edges`` has ``pattern``, ``instance`` and, for each kind, whether the instance is a seed of it; one row for each pattern
    and instance. Every round joins scores to edges by instance and by pattern and is written to the shared folder.
    """
    known = reduce(lambda a, b: a | b, [F.col(k) for k in KINDS])
    nodes = edges.groupBy("instance").agg(*[F.max(F.when(F.col(k), ONE).otherwise(0)).alias(f"v_{k}") for k in KINDS])
    mean = lambda column: F.expr(f"sum({column}) div count(1)")
    for _ in range(rounds):
        nodes = written(nodes, "pii-instances")
        scored = written(
            edges.join(nodes, "instance").groupBy("pattern").agg(
                *[mean(f"v_{k}").alias(f"s_{k}") for k in KINDS], *[F.count_if(F.col(k)).alias(f"n_{k}") for k in KINDS]
            ),
            "pii-patterns",
        )
        again = edges.join(scored, "pattern").groupBy("instance").agg(
            F.bool_or(known).alias("_known"), *[F.max(F.when(F.col(k), ONE).otherwise(0)).alias(f"o_{k}") for k in KINDS],
            *[mean(f"s_{k}").alias(f"m_{k}") for k in KINDS],
        )
        own = [F.when(F.col("_known"), F.col(f"o_{k}")).otherwise(F.col(f"m_{k}")).cast("int").alias(f"v_{k}") for k in KINDS]
        nodes = again.select("instance", *own)
    return scored


def _listed(kind: Column) -> Column:
    return F.array_position(F.array(*[F.lit(k) for k in KINDS]), kind)


def _text(column: str) -> Column:
    parts = F.transform(F.array_sort(column), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(F.coalesce(parts, F.array().cast("array<string>")), ",")


def find(docs: DataFrame, rounds: int = ROUNDS, accept: int = ACCEPT, seeds: int = SEEDS) -> DataFrame:
    """``doc_id``, ``base`` and ``added``: arrays of (place of the kind, start, end, kind), one row for each row of ``docs``.

    ``base`` holds the spans of the four expressions, ``added`` the further ones that accepted patterns find. A NULL or
    empty text has neither; texts are read whole; repeated rows and rows with a NULL id each get their spans. Columns other
    than ``doc_id`` and ``text`` are not read. Where two kinds claim a candidate, the better pattern decides, then the kind
    listed first. An empty table gives no rows.
    """
    scanned = written(scan(docs), "pii-matches")
    source, hit = F.col("source"), F.col("hit")
    seed = source.isin(*BASE)
    chosen = spans(scanned).withColumn("seed", seed).where(~seed | valid(source, hit))
    for_kind = {k: F.when(F.col("seed"), source == k).otherwise(possible(source, hit, k)) for k in KINDS}
    any_kind = reduce(lambda a, b: a | b, for_kind.values())
    found = written(
        candidates(chosen.where(any_kind)).select(
            "row", "seed", "start", "end", instance(source, hit).alias("instance"), patterns(F.col("before")).alias("patterns"),
            *[c.alias(k) for k, c in for_kind.items()],
        ),
        "pii-spans",
    )
    flat = found.select("*", F.explode("patterns").alias("pattern"))
    edges = written(
        flat.groupBy("pattern", "instance").agg(*[F.bool_or(F.col("seed") & F.col(k)).alias(k) for k in KINDS]), "pii-edges"
    )
    good = score_patterns(edges, rounds)
    best = F.greatest(*[F.when((F.col(f"s_{k}") >= accept) & (F.col(f"n_{k}") >= seeds), 1).otherwise(0) for k in KINDS])
    good = good.where(best == 1)
    open_ = flat.where(~F.col("seed")).select("row", "start", "end", "pattern", *KINDS).join(good, "pattern")
    claims = open_.select(
        "row", "start", "end",
        F.explode(F.array(*[
            F.struct(
                F.when(F.col(k) & (F.col(f"s_{k}") >= accept) & (F.col(f"n_{k}") >= seeds), -F.col(f"s_{k}")).alias("s"),
                F.lit(i + 1).alias("place"), F.lit(k).alias("kind"),
            )
            for i, k in enumerate(KINDS)
        ])).alias("c"),
    ).where(F.col("c.s").isNotNull())
    added = claims.groupBy("row", "start", "end").agg(F.min("c").alias("c")).select(
        "row", F.lit(False).alias("seed"), F.col("c.place").cast("long").alias("place"), "start", "end", F.col("c.kind").alias("kind")
    )
    kind = F.coalesce(*[F.when(F.col(k), F.lit(k)) for k in KINDS])
    base = found.where("seed").select("row", "seed", _listed(kind).alias("place"), "start", "end", kind.alias("kind"))
    span = F.struct("place", "start", "end", "kind")
    by_row = base.unionByName(added).groupBy("row").agg(
        F.collect_list(F.when(F.col("seed"), span)).alias("base"), F.collect_list(F.when(~F.col("seed"), span)).alias("added")
    )
    return scanned.select("row", "doc_id").join(by_row, "row", "left").drop("row")


def digest(found: DataFrame) -> DataFrame:
    """One row a document: how many base spans of each kind it has, their digest, and all spans as text.

    The counts, like the digest, are those of the base spans; ``spans`` lists the added ones too.
    """
    size = lambda k: F.coalesce(F.size(F.filter("base", lambda s: s["kind"] == k)), F.lit(0))
    everything = found.withColumn("all", F.concat("base", "added"))
    return everything.select(
        "doc_id", *[size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(_text("base"), 256).alias("base_sha256"), _text("all").alias("spans"),
    )
