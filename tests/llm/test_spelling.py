"""Spelling variants against every pair of words, and the query against its definition."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from quirelens.llm import spelling

DOCS = "doc_id long, text string, word string, n int, form string, best string"


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(counts, times=5):
    rows, form = {}, {}
    for w, n in counts.items():
        close = [v for v in counts if one_edit(w, v)]
        best = min(close, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= times * n else None
        rows[w] = len(close)
    out = []
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, rows[w], counts[form[w]] if form[w] else None))
    return sorted(out)


def vocabulary(rng, size, alphabet, low=6, high=10):
    words = {"".join(rng.choice(alphabet) for _ in range(rng.randrange(low, high))) for _ in range(size)}
    for w in list(words):
        i = rng.randrange(len(w))
        words.add(w[:i] + rng.choice(alphabet) + w[i + 1:])
        words.add(w[:i] + w[i + 1:])
        words.add(w[:i] + rng.choice(alphabet) + w[i:])
    return sorted(w for w in words if len(w) >= low)


@pytest.mark.parametrize("alphabet", ["ab", "abcdeé", "aé漢𝒳\0"])
def test_neighbours_are_those_of_brute_force(spark, monkeypatch, alphabet):
    rng = random.Random(len(alphabet))
    counts = {w: rng.choice([5, 5, 6, 30, 200, 1500, 40_000]) for w in vocabulary(rng, 60, alphabet)}
    words = spark.createDataFrame(sorted(counts.items()), "word string, n long")
    assert sorted(map(tuple, spelling.variants(words).collect())) == brute(counts)
    monkeypatch.setattr(spelling, "GROUP_PART", 7)  # every half is cut into parts
    assert sorted(map(tuple, spelling.variants(words).collect())) == brute(counts)


def test_words_that_end_or_begin_with_a_zero_code_point(spark):
    """What fills up short words in a comparison is told apart from the zero a word may hold."""
    counts = {"abcdef": 5, "abcdef\0": 30, "abcdef\0\0": 200, "\0abcdef": 40, "ghijkl\0": 7, "ghijkl": 900}
    words = spark.createDataFrame(sorted(counts.items()), "word string, n long")
    assert sorted(map(tuple, spelling.variants(words).collect())) == brute(counts)


@pytest.mark.parametrize("tile", [5, 64, 256])
def test_tiles(monkeypatch, tile):
    monkeypatch.setattr(spelling, "TILE", tile)
    rng = random.Random(tile)
    words = [w for w in vocabulary(rng, 90, "abc", 6, 9) if len(w) in (7, 8)]
    block = spelling.Block(words, [rng.randrange(5, 50) for _ in words], 8)
    for part in (None, np.array([i % 2 for i in range(len(words))])):
        seen = Counter()
        for side in (0, 1):
            seen.update({words[i]: n for i, n, _ in spelling.compare(block, side, part)})
        want = Counter({
            w: sum(one_edit(w, v) and 8 in (len(w), len(v)) and (part is None or part[i] != part[j]) for j, v in enumerate(words))
            for i, w in enumerate(words)
        })
        assert +want == seen


def test_long_chain(spark):
    counts = {"a" * (6 + k): 5 ** (k + 1) for k in range(14)}
    words = spark.createDataFrame(sorted(counts.items()), "word string, n long")
    got = sorted(map(tuple, spelling.variants(words).collect()))
    assert got == brute(counts)
    assert {r[2] for r in got} == {"a" * 19}


def expected(rows):
    seen = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c < "\x80" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            seen[run] += 1
    return brute({w: n for w, n in seen.items() if len(w) >= 6 and n >= 5})


def test_query_rows(spark, tmp_path):
    rng = random.Random(9)
    stems = ["Remember", "garden", "ÉTRANGER", "élevage", "straße", "naïveté", "Ångström", "window", "windows", "x×y÷zabc"]
    rows = [(i, " ".join(rng.choice(stems) + rng.choice(["", " ", ",", "1", "s", "S", "\xa0"]) for _ in range(rng.randrange(300)))) for i in range(150)]
    rows += [(900, None), (901, ""), (902, "a" * 200_000 + " " + "window " * 20_000), (None, "garden window " * 40), (None, None), rows[3], rows[3]]
    spark.createDataFrame([(*r, "window", 1, "f", "b") for r in rows], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, spelling.spelling_variants(spark, str(tmp_path)).collect()))
    want = expected(rows)
    assert got == want
    assert any(r[1] for r in want)


def test_counts_are_handed_on_in_parts(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"wordab{chr(97 + i % 26)} common" * 3) for i in range(200)], "doc_id long, text string")
    whole = sorted(map(tuple, spelling.word_counts(docs).collect()))
    monkeypatch.setattr(spelling, "MOST_COUNTED", 3)
    assert sorted(map(tuple, spelling.word_counts(docs).collect())) == whole


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    assert spelling.spelling_variants(spark, str(tmp_path)).collect() == []
