import random
import re

import numpy as np
import pytest

from specloom.llm import decontaminate as D


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def brute(text, items, width):
    w, hit, found = words(text), set(), set()
    for item, t in items:
        v = words(t)
        for i in range(max(1, len(v) - width + 1)) if v else ():
            window = v[i : i + width]
            for j in range(len(w) - len(window) + 1):
                if w[j : j + len(window)] == window:
                    hit |= set(range(j, j + len(window)))
                    found.add(str(item))
    return len(w), len(hit), sorted(found)


def texts(seed):
    rng = random.Random(seed)
    return [" ".join(rng.choice(["Ab", "b-b", "é", "c", "d9", "x", "y!", "z"]) for _ in range(rng.choice([0, 1, 3, 8, 40, 90]))) for _ in range(60)]


@pytest.mark.parametrize("block", [1 << 20, 40])
def test_same_as_brute_force(spark, docs, block):
    rows = list(enumerate(texts(1))) + [(100, None), (101, ""), (102, "a b é " * 3000), (3, "Ab b b é"), (3, "Ab b b é")]
    rng = random.Random(2)
    items = [(i, " ".join(t.split()[: rng.choice([2, 5, 7])])) for i, t in enumerate(texts(1)[:20])] + [(50, None), (51, "..."), (0, "é c")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = D.decontaminate(docs(rows).withColumnRenamed("lang", "items"), bench, width=4, block_bytes=block).collect()
    assert len(out) == len(rows)
    given = {}
    for i, t in rows:
        given.setdefault(i, []).append(t)
    for r in out:
        n, hit, found = brute(r["text"], [x for x in items if x[1]], 4)
        assert (r["n_words"], r["n_hit"], r["items"]) == (n, hit, found)
        s = r["spans"]
        assert sum(e - b for b, e in zip(s[::2], s[1::2], strict=True)) == hit


def test_empty_tables(spark, docs):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert [r["n_hit"] for r in D.decontaminate(docs([(1, "a b")]), bench).collect()] == [0]
    assert D.decontaminate(docs([]), bench).count() == 0


def test_suffix_array_and_index():
    rng = np.random.default_rng(3)
    parts = [rng.integers(1, 3, n) for n in (30, 1, 64, 64, 5)]
    parts[3] = parts[2]
    symbols = np.concatenate([np.r_[p, 0] for p in parts]).astype(np.int32)
    ends = np.flatnonzero(symbols == 0)
    keyed = symbols.astype(int) + len(ends)
    keyed[ends] = np.arange(len(ends))
    assert D.suffix_array(symbols).tolist() == sorted(range(len(keyed)), key=lambda i: keyed[i:].tolist())
    index = D.FMIndex(symbols, np.r_[0, ends[:-1] + 1])
    low, high = index.search(np.array([[1, 2, 1, 1]]), np.array([4]))
    at = sorted(index.locate(np.arange(low[0], high[0])).tolist())
    assert at == [i for i in range(len(symbols) - 3) if symbols[i : i + 4].tolist() == [1, 2, 1, 1]]
    low, high = index.search(np.array([[-1, -1, 9, 1], [-1, 1, 2, 9]]), np.array([2, 3]))
    assert (low >= high).all()
