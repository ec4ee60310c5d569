"""Periodic runs against a search of every start and period, and the query's planting against its definition."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import pytest

from quirelens.llm import periodic

DOCS = "doc_id long, text string, lang string, runs int, collapsed int, h long, w int, n int, p int"


def brute(words, least=24):
    """Runs by their definition: every stretch, its smallest period, no neighbour that extends it."""
    n, found = len(words), set()
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(least, 3 * q) and not any(
                all(words[x] == words[x + r] for x in range(i, i + length - r)) for r in range(1, q)
            ):
                found.add((i, length, q))
            i = j + 1
    return sorted(found)


def samples():
    rng = random.Random(3)
    yield from ([], ["a"], ["a"] * 23, ["a"] * 24, ["a"] * 200, ["a", "b"] * 12, ["a", "b"] * 12 + ["c"], "a b c d e f g h".split() * 3)
    for k in range(250):
        alphabet = [f"w{i}" for i in range(rng.choice([1, 2, 3, 5, 30]))]
        words = [rng.choice(alphabet) for _ in range(rng.randrange(60))]
        for _ in range(rng.randrange(4)):
            group = [rng.choice(alphabet + ["x", "y"]) for _ in range(rng.randrange(1, 14))]
            words += (group * 9)[: rng.randrange(len(group), 8 * len(group) + 1)]
            words += [rng.choice(alphabet) for _ in range(rng.randrange(30))]
        yield words
    nested = (["a"] * 30 + ["b"]) * 4
    yield nested
    yield nested * 3 + ["a"] * 40


def test_runs_are_those_of_brute_force():
    for words in samples():
        coded = [w.encode() for w in words]
        assert periodic.runs_of(coded) == brute(words), words


def test_long_texts_end_soon():
    rng = random.Random(5)
    assert periodic.runs_of([b"a"] * 300_000) == [(0, 300_000, 1)]
    few = [rng.choice([b"a", b"b", b"c", b"d"]) for _ in range(20_000)]
    assert all(n >= max(24, 3 * q) for _, n, q in periodic.runs_of(few))
    group = [b"%d" % i for i in range(9_000)]
    assert periodic.runs_of(group * 4) == [(0, 36_000, 9_000)]


def expected(doc_id, text):
    words = re.findall(r"[^ \t-\r]+", text or "")
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (
        doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
        sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)),
        sha(" ".join(w for i, w in enumerate(words) if i not in dropped)),
    )


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    drawn = [i for i in range(4000) if zlib.crc32(str(i).encode()) % 10 == 0]
    texts = [" ".join(w) for w in samples()][:120]
    made = [(drawn[k], t) for k, t in enumerate(texts)] + [(5000 + k, t) for k, t in enumerate(texts)]
    prose = [(drawn[200 + k], " ".join(f"w{rng.randrange(3000)}" for _ in range(rng.randrange(400)))) for k in range(40)]
    odd = [(7000, None), (7001, ""), (7002, " \t\r\n\x0b\x0c"), (7003, "é\xa0x " * 30), (None, "z " * 30), (None, None), (-7, "b " * 99)]
    return made + prose + odd + [odd[3], made[5], made[5]]


def test_query_rows(spark, rows, tmp_path):
    # columns whose names the operator uses inside, too
    spark.createDataFrame([(*r, "en", 1, 2, 3, 4, 5, 6) for r in rows], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in periodic.periodic_runs(spark, str(tmp_path)).collect()]
    key = lambda r: str(r)
    assert sorted(got, key=key) == sorted((expected(*r) for r in rows), key=key)


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    assert periodic.periodic_runs(spark, str(tmp_path)).collect() == []
