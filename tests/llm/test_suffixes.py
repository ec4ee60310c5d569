"""Repeated byte strings against a table of every string, whatever the batches, parts and pieces."""

import hashlib
import random

import numpy as np
import pytest

from quirelens.llm import suffixes

DOCS = "doc_id long, text string, doc int, found int, start int, k0 long"


def brute(rows, match=100):
    """Removed flags of each row's bytes; rows of one id share them."""
    first = {}
    for doc_id, text in rows:
        data = (text or "").encode()
        key = -(1 << 63) if doc_id is None else doc_id
        for i in range(len(data) - match + 1):
            s = data[i:i + match]
            first[s] = min(first.get(s, (key, i)), (key, i))
    gone = {}
    for doc_id, text in rows:
        data = (text or "").encode()
        key = -(1 << 63) if doc_id is None else doc_id
        flags = gone.setdefault(key, set())
        for i in range(len(data) - match + 1):
            if first[data[i:i + match]] < (key, i):
                flags.update(range(i, i + match))
    out = []
    for doc_id, text in rows:
        data = (text or "").encode()
        flags = gone[-(1 << 63) if doc_id is None else doc_id]
        cut = [i in flags for i in range(len(data))]
        spans = sum(1 for i, c in enumerate(cut) if c and (i == 0 or not cut[i - 1]))
        kept = bytes(b for b, c in zip(data, cut) if not c)
        out.append((doc_id, len(data), sum(cut), spans, hashlib.sha256(kept).hexdigest()))
    return out


def texts(rng):
    words = [f"w{i}" for i in range(400)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    line = prose(40)
    base = [prose(rng.randrange(20, 200)) for _ in range(30)]
    out = base + base[:6]
    for text in base[:20]:  # near copies
        parts = text.split()
        for _ in range(rng.randrange(1, 4)):
            parts[rng.randrange(len(parts))] = "changed"
        out.append(" ".join(parts))
    out += [f"{prose(rng.randrange(30))} {line} {prose(rng.randrange(30))}" for _ in range(60)]  # a common passage
    out += [f"{t[:rng.randrange(80, 130)]}{prose(5)}" for t in base]  # matches about the least length
    out += ["x" * 99, "x" * 100, "x" * 101, "y" * 3000, "xy" * 700, "é漢\U0001f600" * 150, "ñ" * 80 + line, line[:99], line[:100], line + line, "", None]
    out += [prose(3000), prose(10) + " " + " ".join(base[:4])]
    rng.shuffle(out)
    return out


def table(spark, rows, path):
    spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], DOCS).repartition(5).write.parquet(f"{path}/documents.parquet")


def results(spark, path):
    return sorted((tuple(r) for r in suffixes.repeated_bytes(spark, str(path)).collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_rows_are_those_of_brute_force(spark, tmp_path, seed):
    rng = random.Random(seed)
    rows = [(i * 3 - 40, t) for i, t in enumerate(texts(rng))]
    rows += [rows[4], rows[4], (rows[9][0], rows[10][1]), (None, rows[11][1]), (None, None), (10_000, rows[12][1] * 3)]
    table(spark, rows, tmp_path)
    want = sorted(brute(rows), key=str)
    assert results(spark, tmp_path) == want
    assert sum(r[2] for r in want)


def test_small_parts_and_many_batches(spark, tmp_path):
    rows = list(enumerate(texts(random.Random(3))))
    table(spark, rows, tmp_path)
    want = sorted(brute(rows), key=str)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for batches, array_bytes, together in ((1, 1 << 12, 0), (7, 1 << 24, 2000), (4, 1 << 13, 6)):
        out = suffixes.remove_repeats(docs, batches, array_bytes, together).collect()
        got = [(r.doc_id, r.n_bytes, sum(s.stop - s.start for s in r.spans), len(r.spans), hashlib.sha256(r.kept).hexdigest()) for r in out]
        assert sorted(got, key=str) == want


def test_long_texts_are_cut_without_loss(monkeypatch):
    monkeypatch.setattr(suffixes, "PIECE", 1 << 10)
    rng = random.Random(5)
    text = bytes(rng.choice(b"abc") for _ in range(5000))
    e = suffixes.entries([7], [text])
    covered = np.zeros(len(text), dtype=int)
    for at, n in zip(e["at"].tolist(), e["n"].tolist()):
        covered[at:at + n] += 1
    assert (covered[:len(text) - 99] == 1).all() and not covered[len(text) - 99:].any()


def test_equal_strings_keep_equal_suffixes():
    rng = random.Random(6)
    shared = bytes(rng.choice(b"abcdef ") for _ in range(400))
    e = [suffixes.entries([d], [bytes(rng.choice(b"xyz ") for _ in range(150)) + shared + b"end" * 50]) for d in (1, 2)]
    kinds = [set(zip(*(x[c].tolist() for c in ("k0", "k1", "k2", "kind")))) for x in e]
    assert len(kinds[0] & kinds[1]) >= 5


def test_whole_groups():
    import pyarrow as pa

    rng = random.Random(8)
    keys = sorted(rng.randrange(6) for _ in range(50))
    for size in (1, 2, 7, 50):
        batches = [pa.RecordBatch.from_arrays([pa.array(keys[i:i + size])], ["k"]) for i in range(0, 50, size)]
        seen = [t.column("k").to_pylist() for t in suffixes.whole_groups(iter(batches), ["k"])]
        assert [k for t in seen for k in t] == keys
        assert all(a[-1] != b[0] for a, b in zip(seen, seen[1:]))


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    assert suffixes.repeated_bytes(spark, str(tmp_path)).collect() == []
