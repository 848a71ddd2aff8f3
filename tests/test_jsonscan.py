"""JSON files cut into blocks anywhere against reading them whole."""

import json
import random

import pytest

from learnlake.sources import files, jsonscan


def whole(text):
    """Records of a file's text: items of its document, else its lines that are documents."""

    def refuse(_):
        raise ValueError

    def parsed(t):
        try:
            return [json.loads(t, parse_constant=refuse)]
        except ValueError:
            return []

    doc = parsed(text)
    if doc:
        return len(doc[0]) if isinstance(doc[0], list) else 1
    return sum(len(parsed(line)) for line in text.split("\n"))


def value(rng, depth):
    kind = rng.randrange(8 if depth else 4)
    if kind < 4:
        return [rng.choice(["a,b", 'q"[', "k: {", "\\", "é\u0001"]), rng.choice([0, -1.5, 1e30]), True, None][kind]
    if kind < 6:
        return [value(rng, depth - 1) for _ in range(rng.randrange(6))]
    return {f"k{i}": value(rng, depth - 1) for i in range(rng.randrange(6))}


def texts(seed, n):
    rng = random.Random(seed)
    for _ in range(n):
        text = json.dumps(value(rng, 4), indent=rng.choice([None, 0, 1]))
        if rng.random() < 0.3:
            text = "\n".join(json.dumps(value(rng, 2)) for _ in range(rng.randrange(1, 5)))
        for _ in range(rng.choice([0, 0, 0, 1, 2])):  # broken here and there
            at = rng.randrange(len(text))
            text = text[:at] + rng.choice(["", ",", "]", "}", "{", "[", ":", '"', "0", "1,", "x", "\n", '"s"']) + text[at + rng.randrange(2):]
        yield rng, text


@pytest.mark.parametrize("seed", range(4))
def test_words_of_pieces(seed):
    for rng, text in texts(seed, 1500):
        lines = text.split("\n")
        cuts = sorted(rng.randrange(len(lines) + 1) for _ in range(3))
        pieces = ["\n".join(lines[a:b]) for a, b in zip([0, *cuts], [*cuts, len(lines)])]
        word = ""
        for piece in pieces:
            word = jsonscan.reduced(word + jsonscan.reduced(jsonscan.symbols(piece)))
        found = jsonscan.items(word)
        doc = jsonscan.items(jsonscan.reduced(jsonscan.symbols(text)))
        assert found == doc
        try:
            assert found == (len(d) if isinstance(d := json.loads(text), list) else 1), text
        except ValueError:
            assert found is None, text


def test_words_stay_short():
    members = ",".join(f'"k{i}": [1, 2, {{}}]' for i in range(3000))
    for text in (members, "1," * 9000, '{"a": [' + "{}," * 9000, '1, "a": 2,' * 3000, "[1, {" * 3 + "x " * 9000, '["a": 1, 2], ' * 3000):
        assert len(jsonscan.reduced(jsonscan.symbols(text))) < 40


@pytest.mark.parametrize("size", [64, 1000])
def test_files_in_blocks(spark, tmp_path, size):
    want = {}
    for i, (_, text) in enumerate(texts(size, 60)):
        if text.strip():
            want[f"f{i}.json"] = whole(text)
            (tmp_path / f"f{i}.json").write_text(text, encoding="utf-8")
    big = {"Records": [{"n": i, "text": "}," * 5} for i in range(400)]}
    broken = "{oops\n" + "\n".join('{"n": 1}' for _ in range(300))
    for name, text, n in (
        ("big.json", json.dumps(big, indent=1), 1), ("list.json", json.dumps(big["Records"], indent=1), 400), ("broken.json", broken, 300),
        ("one.json", '"a"', 1), ("split.json", '{\n"a"\n:\n1\n}', 1), ("empty list.json", "[\n]", 0),
    ):
        want[name] = n
        (tmp_path / name).write_text(text)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    try:
        got = {r.path.rsplit("/", 1)[1].replace("%20", " "): r.records for r in files.profile_json(spark, str(tmp_path)).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == want
