"""Trained operators and embeddings: exact digests, held-out quality, brute force."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np

from specloom.llm import binary_codes, ngram_model, secret_scan, toxicity


def test_language_model(spark, docs):
    rng = random.Random(1)
    vocabulary = [f"W{i}" for i in range(50)] + ["é", "."]
    rows = [(i, " ".join(rng.choices(vocabulary, [1 / (k + 1) for k in range(52)], k=rng.choice([0, 1, 2, 30])))) for i in range(80)]
    rows += [(500, None), (501, "\t \n"), (502, "unseen " * 3000), (3, rows[3][1]), (None, "W1 é")]
    tokens = [[w.lower() for w in re.split("[\x20\x09-\x0d]+", t or "") if w] + [None] for _, t in rows]
    held = [i is not None and zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows]
    count = Counter(w for t, h in zip(tokens, held, strict=True) if not h for w in t)
    n, v = sum(count.values()), len(count)
    out = ngram_model.score(docs(rows).withColumnRenamed("lang", "score"), rarest=3e-3).collect()
    want = sorted((str(i), h, len(t), sum(count[w] > 0 for w in t), n, round(sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t), 5))
                  for (i, _), t, h in zip(rows, tokens, held, strict=True))
    assert sorted((str(r[0]), r[1], r[2], r[3], r[4], round(r["base_score"], 5)) for r in out) == want
    assert all(r["score"] < 0 for r in out)
    assert ngram_model.score(docs([])).count() == 0


def test_language_model_counts_rare_runs_too(spark, docs):
    """Absolute discounting by hand over all runs; with no run in the trie it must come out exactly."""
    rng = random.Random(7)
    rows = [(i, " ".join(rng.choices("abcdefgh", [8, 7, 6, 5, 1, 1, 1, 1], k=rng.choice([0, 1, 2, 3, 40])))) for i in range(60)]
    rows += [(100, "only here twice over"), (101, "only here twice over"), (102, None), (103, "never"), (103, "never"), (None, "a b")]
    tokens = [[*(t or "").split(), None] for _, t in rows]
    training = [t for t, (i, _) in zip(tokens, rows, strict=True) if i is None or zlib.crc32(str(i).encode()) % 10]
    count = [Counter(tuple(t[i : i + k]) for t in training for i in range(len(t) - k + 1)) for k in (1, 2, 3)]
    n, v, d = sum(count[0].values()), len(count[0]), 0.6

    def p(run):
        if len(run) == 1:
            return (count[0][run] + 0.1) / (n + 0.1 * (v + 1))
        after = [c for r, c in count[len(run) - 1].items() if r[:-1] == run[:-1]]
        if not after:
            return p(run[1:])
        return max(count[len(run) - 1][run] - d, 0) / sum(after) + d * len(after) / sum(after) * p(run[1:])

    want = sorted((str(i), sum(math.log10(p(tuple(t[max(k - 2, 0) : k + 1]))) for k in range(len(t)))) for (i, _), t in zip(rows, tokens, strict=True))
    for rarest, off in ((1, 1e-9), (0.05, 0.01), (0.01, 0.01), (0, 0.01)):  # what is in the trie is quantised
        got = sorted((str(r["doc_id"]), r["score"]) for r in ngram_model.score(docs(rows), rarest=rarest).collect())
        assert [i for i, _ in got] == [i for i, _ in want]
        assert all(abs(a - b) <= off * max(1, -b) for (_, a), (_, b) in zip(got, want, strict=True)), rarest


def test_runs_meet_however_their_keys_fall():
    rng = np.random.default_rng(5)
    above, word = rng.integers(0, 12, 4000).astype(np.uint64), rng.integers(0, 9, 4000).astype(np.uint64)
    for bits, key in ((0, word % np.uint64(2)), (0, above), (3, (above % np.uint64(3)) << np.uint64(3) | word % np.uint64(8)), (3, above << np.uint64(3) | word % np.uint64(8))):
        by = ngram_model._order(key, above, word, bits)
        runs = np.stack([above[by], word[by]], 1)
        assert sorted(by.tolist()) == list(range(4000))
        assert 1 + (runs[1:] != runs[:-1]).any(1).sum() == 12 * 9
        again = rng.permutation(4000)
        assert (np.stack([above[again], word[again]], 1)[ngram_model._order(key[again], above[again], word[again], bits)] == runs).all()
        assert bits == 0 or 1 + (runs[1:, 0] != runs[:-1, 0]).sum() == 12
    hashes = np.sort(rng.integers(0, 2**63, 3000).astype(np.uint64) * np.uint64(2))
    asked = np.r_[hashes, hashes + np.uint64(1), np.uint64(0), np.uint64(2**64 - 1)]
    assert ngram_model.Slots(hashes).find(asked).tolist() == [*range(3000), *[-1] * 3002]
    assert ngram_model.Slots(hashes[:0]).find(asked[:5]).tolist() == [-1] * 5


def test_elias_fano_finds_places():
    rng = np.random.default_rng(3)
    for values, universe in ((np.sort(rng.choice(10_000, 500, replace=False)), 10_001), (np.arange(300), 300), (np.r_[np.arange(5000, 5400), 10**12], 10**12 + 1), (np.zeros(0, np.int64), 9)):
        place = {x: i for i, x in enumerate(values.tolist())}
        asked = np.r_[values, np.arange(0, min(universe, 10_000)), universe - 1].astype(np.int64)
        assert ngram_model.EliasFano(values, universe).find(asked).tolist() == [place.get(x, -1) for x in asked.tolist()]


def test_trie_sums_to_one_and_finds_all():
    rng = np.random.default_rng(2)
    text = rng.zipf(1.4, 20_000) % 40
    words = np.sort(rng.integers(0, 2**63, 40).astype(np.uint64))
    n1 = np.bincount(text, minlength=40)
    base = np.log10((n1 + 0.1) / (n1.sum() + 0.1 * 41))
    pairs, n2 = np.unique(np.stack([text[:-1], text[1:]], 1), axis=0, return_counts=True)
    pairs, n2 = pairs[n2 > 4], n2[n2 > 4]
    triples, n3 = np.unique(np.stack([text[:-2], text[1:-1], text[2:]], 1), axis=0, return_counts=True)
    have = {tuple(p) for p in pairs.tolist()}
    keep = np.array([n > 4 and (a, b) in have and (b, c) in have for (a, b, c), n in zip(triples.tolist(), n3, strict=True)])
    trie = ngram_model.Trie.load(*ngram_model.Trie(words, base, n1, pairs, n2, triples[keep], n3[keep]).dump())
    everything = np.arange(40)
    for before, last in [(-1, -1), (-1, 3), (0, 0), (1, 0), (5, 39)]:
        total = (10 ** trie.log10(np.full(40, before), np.full(40, last), everything)).sum()
        unseen = 0.1 / (n1.sum() + 0.1 * 41)
        assert abs(total + unseen - 1) < 0.05, (before, last, total)
    values = np.sort(rng.integers(0, 10_000, 500))
    fano = ngram_model.EliasFano(values, 10_001)
    assert fano[np.arange(500)].tolist() == values.tolist()


def test_toxicity_learns_planted_words(spark, docs):
    rng = random.Random(4)
    clean = [f"word{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(900):
        bad = i % 4 == 0
        text = [rng.choice(clean) for _ in range(rng.choice([5, 40]))] + ([rng.choice(["badbad", "vilely", "vilest"]) for _ in range(3)] if bad else [])
        rng.shuffle(text)
        rows.append((i, " ".join(text)))
        labels.append((i, 1, int(bad)))
    rows += [(2000, None), (2001, ""), (2002, "word1 " * 20000), (2002, "word1 " * 20000)]
    known = spark.createDataFrame([*labels, (None, 1, 1), (5000, None, None)], "doc_id long, quality int, toxic int")
    out = toxicity.toxicity(docs(rows).withColumnRenamed("lang", "score"), known).collect()
    assert len(out) == len(rows) and all(0 <= r["score"] <= 1 for r in out)
    by = {r["doc_id"]: r["predicted"] for r in out}
    hidden = [i for i, _, _ in labels if zlib.crc32(str(i).encode()) % 3 == 1]
    assert np.mean([by[i] == labels[i][2] for i in hidden]) > 0.97
    assert by[2000] == by[2001] == by[2002] == 0
    assert toxicity.toxicity(docs([]), known).count() == 0
    none = toxicity.toxicity(docs([(1, "a")]), known.where("toxic = 0")).collect()
    assert none[0]["score"] == 0


def test_toxicity_sends_the_driver_only_features_that_tell(spark, docs, monkeypatch):
    rows = [(i, " ".join(f"u{i}x{k}" for k in range(2000)) + (" vile" if i % 2 else " kind")) for i in range(60)]
    labels = spark.createDataFrame([(i, 1, i % 2) for i, _ in rows], "doc_id long, quality int, toxic int")
    frame, sent = docs(rows), []
    kind = type(frame)
    whole = kind.toArrow

    def watched(self):
        out = whole(self)
        sent.append(sum(len(c) for c in out["buckets"].combine_chunks()) if "buckets" in out.column_names else 0)
        return out

    monkeypatch.setattr(kind, "toArrow", watched)
    model = toxicity.train(frame, labels)
    assert 0 < sum(sent) < 1000 and np.count_nonzero(model.weights)


def test_label_model_weighs_voters():
    rng = np.random.default_rng(3)
    y = rng.random(4000) < 0.3
    good = np.where(rng.random(4000) < 0.9, y, ~y)
    twin = good.copy()
    noise = rng.random(4000) < 0.5
    other = np.where(rng.random(4000) < 0.8, y, ~y)
    votes = np.stack([good, twin, noise, other], 1).astype(float)
    post, toxic, clean, share = toxicity.label_model(votes, 0.3, np.full(4, 0.7), np.full(4, 0.3))
    assert share[0] < 0.6 and share[3] > share[0]
    assert toxic[0] - clean[0] > toxic[2] - clean[2] + 0.3
    assert ((post > 0.5) == y).mean() > 0.85


def secret_rows(seed, n):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        text = " ".join("".join(rng.choice("aeioulnrst") for _ in range(rng.choice([2, 5, 9]))) for _ in range(rng.choice([3, 60])))
        if i % 3 == 0:
            key = "".join(rng.choice("0123456789abcdef") for _ in range(32))
            text += rng.choice([f' Token = "{key}" ', f" password={key[:12]} ", f" AKIA{key.upper()[:16].replace('-', 'A')} ", f"\n{key}\n"]) + "ende é"
        rows.append((i, text))
    return rows


def test_secret_spans(spark, docs):
    assign = re.compile("(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII)
    rows = [*secret_rows(1, 120), (200, None), (201, ""), (202, "é token:abcdef secret = x password=token:xyzabc AKIA1 " + "f" * 24 + "g"), (203, "ab " * 30_000), (203, "ab " * 30_000)]
    out = secret_scan.secrets(docs(rows).withColumnRenamed("lang", "spans")).collect()
    assert len(out) == len(rows)
    texts = dict(rows)
    for r in out:
        t = texts[r["doc_id"]] or ""
        want = [(m.start(), 0, f"assign:{m.start()}:{m.end()}") for m in assign.finditer(t) if len(m[2]) >= 6]
        want += [(m.start(), 1, f"access:{m.start()}:{m.end()}") for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
        want += [(m.start(), 2, f"hex:{m.start()}:{m.end()}") for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
        assert r["base_spans"] == [x for _, _, x in sorted(want)]
        assert r["n_assign"] + r["n_access"] + r["n_hex"] == len(want) and set(r["base_spans"]) <= set(r["spans"])
    assert secret_scan.secrets(docs([])).count() == 0


def test_field_finds_secrets_in_unseen_settings(spark, docs):
    model = secret_scan.learn(docs(secret_rows(2, 400)))
    text = "aei loun rst credential = 9f8e7d6c5b4a39281706f5e4d3c2b1a0X nol aer"
    spans = secret_scan.scan(docs([(1, text)]), model).collect()[0]["spans"]
    assert any(s.startswith("crf:") for s in spans) or any(s.startswith("hex:") for s in spans)
    assert secret_scan.scan(docs([(2, "aei loun rst ende")]), model).collect()[0]["spans"] == []


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(1)
    from itertools import product

    scores, moves = rng.normal(size=(9, 3)), rng.normal(size=(3, 3))
    moves[0, 2] = -1e9
    new = np.zeros(9, bool)
    new[[0, 4, 5]] = True
    got = secret_scan.viterbi(scores, moves, new)
    for a, b in ((0, 4), (4, 5), (5, 9)):
        def value(tags):
            return sum(scores[a + i, t] for i, t in enumerate(tags)) + sum(moves[s, t] for s, t in zip(tags, tags[1:])) - (1e9 if tags[0] == 2 else 0)
        assert tuple(got[a:b]) == max(product(range(3), repeat=b - a), key=value)


def test_near_vectors(spark):
    rng = np.random.default_rng(6)
    base = rng.normal(size=(150, 16))
    rows = [(i, v.tolist(), i % 3) for i, v in enumerate(base)]
    rows += [(200 + i, (v + rng.normal(size=16) * s).tolist(), i % 3) for i, (v, s) in enumerate(zip(base[:90], rng.uniform(0.05, 0.5, 90), strict=True))]
    rows += [(400 + i, base[0].tolist(), 0) for i in range(5)] + [(410, (2 * base[0]).tolist(), 0), (411, base[0].tolist(), None)]
    rows += [(500, None, 1), (501, [], 1), (502, [0.0] * 16, 1), (503, [float("nan")] + [1.0] * 15, 1), (504, [None] + [1.0] * 15, 1), (505, [1.0] * 8, 1), (505, [1.0] * 8, 1), (506, [1.0] * 8, 1)]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, label int, m int")
    good = [(i, np.array(v, np.float32).astype(float), y) for i, v, y in dict.fromkeys((i, tuple(v) if v else None, y) for i, v, y in rows)
            if v and y is not None and None not in v and np.isfinite(np.array(v, float)).all() and any(v)]
    links = {(a, b) for a, x, p in good for b, y, q in good if a != b and p == q and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.93}
    for block in (1024, 8):
        out = binary_codes.near_duplicates(frame, block=block).collect()
        assert len(out) == len(rows)
        got = {r["vec_id"]: r for r in out}
        total = sum(r["n_links"] for r in got.values())
        assert 0.95 * len(links) <= total <= len(links)
        assert all(got[i]["n_links"] == 0 and got[i]["kept"] for i in (500, 501, 502, 503, 504, 411))
        assert got[400]["component_id"] == got[410]["component_id"] == 0 and got[506]["component_id"] == 505
    assert binary_codes.near_duplicates(frame.limit(0)).count() == 0


def test_estimates_are_unbiased():
    rng = np.random.default_rng(8)
    x = rng.normal(size=16)
    x /= np.linalg.norm(x)
    y = x + 0.3 * rng.normal(size=16)
    y /= np.linalg.norm(y)
    found = []
    for seed in range(300):
        turn = binary_codes.rotation(16, 64, 1000 + seed)
        t = turn @ x
        factor = np.abs(t).sum() / 8
        found.append(np.sign(t) @ (turn @ y) / 8 / factor)
        assert abs(found[-1] - x @ y) < 2 * binary_codes.bound(np.array(factor), 64)
    assert abs(np.mean(found) - x @ y) < 0.02
