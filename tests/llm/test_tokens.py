"""Token counts and alignments against the libraries and plain Python."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from specloom.llm import alignment as A
from specloom.llm import keyed_sums, token_counts

sentencepiece = pytest.importorskip("sentencepiece")
tokenizers = pytest.importorskip("tokenizers")

ODD = [None, "", " ", "  ", "\n", "\n\n a", "▁", "a▁b", "a \x00 b", "<s> </s> <unk>", "<|endoftext|>", "x<|endoftext|> y", "日本語 テスト", "\U0001f600\U0001f601", "é",
       "ﬁne", "a" * 3000, "wort " * 40_000, " lead", "trail ", "tab\there", "1234567890", "don't we'll", "�", "​", "nbsp x", "<0x41>", "same", "same"]


def texts(seed=3, n=150):
    rng = random.Random(seed)
    parts = ["the", "Hello", "ingen", "über", "日本", "\U0001f600", "x1", "12,5", "e.g.", "\n", "  ", "'s", "--", "Straße", "aaaa", "<s>", "\t", "ñandú"]
    return ["".join(rng.choice(parts) + rng.choice(["", " ", " "]) for _ in range(rng.choice([1, 5, 60, 400]))) for _ in range(n)]


@pytest.fixture(scope="module")
def rows():
    return list(enumerate([*ODD, *texts()]))


def library():
    return sentencepiece.SentencePieceProcessor(model_file=token_counts.PIECES)


@pytest.mark.parametrize("head", [1, 300, 1 << 19])
def test_counts_are_the_librarys(spark, docs, rows, monkeypatch, head):
    monkeypatch.setattr(keyed_sums, "HEAD", head)  # all, some and no keys through the buckets
    given = docs([*rows, (7, "doc seven once more"), (None, "no id")]).withColumnRenamed("lang", "n_tokens")
    got = token_counts.token_counts(given).collect()
    want = Counter((i, len((t or "").encode()), len(library().encode(t or ""))) for i, t in [*rows, (7, "doc seven once more"), (None, "no id")])
    assert Counter(tuple(r) for r in got) == want


def test_vocabulary_counts_every_occurrence_once(spark, docs, monkeypatch):
    monkeypatch.setattr(token_counts, "BLOCK", 5)  # tasks send and forget many times
    given = docs(list(enumerate(texts(5, 60))))
    found = token_counts.vocabulary(given).collect()
    assert len({r["key"] for r in found}) == len(found)
    total = sum(r["n"] * r["pieces"] for r in found)
    assert total == sum(len(library().encode(t)) for t in texts(5, 60))


def test_no_rows(spark, docs):
    assert token_counts.token_counts(docs([])).count() == 0
    assert A.alignment_summary(docs([])).count() == 0
    assert A.align(docs([])).count() == 0
    nothing = docs([(1, None), (2, "")])
    assert [tuple(r) for r in token_counts.token_counts(nothing).orderBy("doc_id").collect()] == [(1, 0, 0), (2, 0, 0)]
    assert [tuple(r) for r in A.alignment_summary(nothing).orderBy("doc_id").collect()] == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_common_ends_by_sets():
    rng = np.random.default_rng(4)
    for case in range(300):
        a, b, fa, fb, at = [], [], [], [], 0
        for _ in range(rng.integers(1, 6)):
            n = int(rng.integers(1, 400))
            cut = lambda keep, n=n: sorted({*np.flatnonzero(rng.random(n) < keep).tolist(), n})
            x = [v for v in cut(rng.choice([0.1, 0.5, 0.98])) if v]
            y = [v for v in (x if case % 3 == 0 and rng.random() < 0.5 else cut(rng.choice([0.1, 0.5, 0.98]))) if v]
            fa.append(len(a)), fb.append(len(b))
            a += [at + v for v in x]
            b += [at + v for v in y]
            at += n
        in_a, in_b = A.common_ends(np.array(a), np.array(b), np.array(fa), np.array(fb), stride=int(rng.choice([2, 16, 64])))
        both = set(a) & set(b)
        assert in_a.tolist() == [v in both for v in a] and in_b.tolist() == [v in both for v in b]


def by_hand(rows):
    """Alignments of (id, text) rows in plain Python: per row ids, groups and links."""
    a_lib = tokenizers.Tokenizer.from_file(A.BYTE_BPE)
    a_lib.encode_special_tokens = True
    decode = {c: b for c, b in A.byte_alphabet().items()}
    b_lib = library()
    out = []
    for i, t in rows:
        groups, links = [], []
        if t:
            enc = a_lib.encode(" " + t, add_special_tokens=False)
            a, a_bytes = enc.ids, [bytes(decode[c] for c in p) for p in enc.tokens]
            b = b_lib.encode(t)
            b_bytes = [bytes([int(p[3:5], 16)]) if b_lib.is_byte(k) else p.replace("▁", " ").encode() for k, p in zip(b, b_lib.id_to_piece(b), strict=True)]
            if b"".join(a_bytes) == b"".join(b_bytes) == (" " + t).encode():
                ends = [np.cumsum([len(x) for x in side]).tolist() for side in (a_bytes, b_bytes)]
                x = y = 0
                for end in sorted(set(ends[0]) & set(ends[1])):
                    p, q = ends[0].index(end, x) + 1, ends[1].index(end, y) + 1
                    groups.append((a[x:p], b[y:q]))
                    links.append((a[p - 1], b[q - 1]))
                    x, y = p, q
        out.append((i, groups, links))
    return out


@pytest.mark.parametrize("head", [1, 200])
def test_alignment_by_hand(spark, docs, rows, monkeypatch, head):
    monkeypatch.setattr(keyed_sums, "HEAD", head)
    rows = [(i, t) for i, t in rows if len(t or "") < 20_000] + [(3, "id three once more")]
    hand = by_hand(rows)
    count = Counter(link for _, _, links in hand for link in links)
    most = {}
    for (_, b), n in count.items():
        most[b] = max(most.get(b, 0), n)
    want = Counter()
    for i, groups, links in hand:
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        want[(i, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(links), sum(count[k] == most[k[1]] for k in links),
              sum(count[k] for k in links), hashlib.sha256(text.encode()).hexdigest() if groups else "")] += 1
    given = docs(rows).withColumnRenamed("lang", "n_a").withColumnRenamed("source", "pairs").repartition(5)
    assert Counter(tuple(r) for r in A.alignment_summary(given).collect()) == want
    pairs = {(r["a_id"], r["b_id"]): (r["n"], r["best"]) for r in A.pair_counts(given).collect()}
    assert pairs == {k: (n, n == most[k[1]]) for k, n in count.items()}


def test_groups_as_lists(spark, docs, rows):
    rows = [(i, t) for i, t in rows if len(t or "") < 20_000]
    got = {r["doc_id"]: r for r in A.align(docs(rows)).collect()}
    for i, groups, _ in by_hand(rows):
        assert got[i]["a_ids"] == [t for a, _ in groups for t in a] and got[i]["b_ids"] == [t for _, b in groups for t in b]
        assert got[i]["a_sizes"] == [len(a) for a, _ in groups] and got[i]["b_sizes"] == [len(b) for _, b in groups]


def test_long_text_of_many_slices(spark, docs):
    """A text of several slices beside short ones: counts add up and tokens give the bytes back."""
    text = " ".join(texts(9, 150)) * 20
    assert len(text.encode()) > 3 * A.SLICE
    given = docs([(1, text), (2, "short")])
    assert {r["doc_id"]: r["n_tokens"] for r in token_counts.token_counts(given).collect()} == {1: len(library().encode(text)), 2: len(library().encode("short"))}
    row = A.align(given).where(F.col("doc_id") == 1).first()
    assert row["b_ids"] == library().encode(text)
    assert sum(row["a_sizes"]) == len(row["a_ids"]) and sum(row["b_sizes"]) == len(row["b_ids"])
