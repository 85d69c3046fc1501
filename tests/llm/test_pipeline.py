"""The pipeline's stages, each judged by brute force on its own input."""

import re
import subprocess
import sys
import zlib
from collections import Counter

import corpus_pipeline as C
from specloom.llm import pieces
from specloom.llm.queries import QUERIES
from specloom.session import store

ROOT = "/root/testdata/sf0.001"
LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def rows(df):
    return {r["doc_id"]: r for r in df.collect()}


def shingle_set(text):
    w = [x for x in re.split("[\x20\x09-\x0d]+", (text or "").translate(LOW)) if x]
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def test_each_stage_on_its_own_input(spark):
    docs = spark.read.parquet(f"{ROOT}/documents.parquet")
    extra = docs.limit(3).selectExpr("-doc_id - 1 AS doc_id", "CASE WHEN doc_id = 0 THEN '' END AS text", "lang", "source", "n_chars")
    docs = store(docs.unionByName(extra))
    stages = dict(C.STAGES)
    assert list(stages)[0] == "toxicity" and len(stages) == 5
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{ROOT}/labels.parquet").collect()}
    before = rows(docs)

    clean = store(stages["toxicity"](spark, docs, ROOT))
    assert clean.columns == docs.columns
    left = rows(clean)
    hidden = [i for i in before if i in labels and zlib.crc32(str(i).encode()) % 3 == 1]
    assert sum((i not in left) == (labels[i] == 1) for i in hidden) >= 0.9 * len(hidden)

    cut = store(stages["line dedup"](spark, clean, ROOT))
    assert cut.columns == docs.columns
    after = rows(cut)
    norm = lambda line: line.strip(" \t\r\x0b\x0c").lower()
    kept = Counter(norm(x) for r in after.values() for x in (r["text"] or "").split("\n"))
    assert all(n == 1 for x, n in kept.items() if x)  # exact repeats are gone everywhere
    for i, r in left.items():
        if i not in after:
            assert (r["text"] or "").strip()  # only documents that had something are emptied
        elif r["text"] is not None:
            assert set(after[i]["text"].split("\n")) <= set(r["text"].split("\n"))
            assert after[i]["n_chars"] == (r["n_chars"] if after[i]["text"] == r["text"] else len(after[i]["text"]))

    single = store(stages["n-gram Jaccard join"](spark, cut, ROOT))
    sets = {i: shingle_set(r["text"]) for i, r in after.items()}
    link = {i: {j for j in sets if j != i and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])} for i in sets}
    want = set()
    for i in sorted(sets):
        reach, open_ = {i}, [i]
        while open_:
            for j in link[open_.pop()] - reach:
                reach.add(j)
                open_.append(j)
        want.add(min(reach))
    assert set(rows(single)) == want

    free = store(stages["benchmark decontamination"](spark, single, ROOT))
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOW))
    windows = set()
    for r in spark.read.parquet(f"{ROOT}/benchmark.parquet").collect():
        w = words(r["text"])
        windows |= {tuple(w[k : k + 13]) for k in range(max(1, len(w) - 12))} if w else set()
    ok = set()
    for i, r in rows(single).items():
        w, hit = words(r["text"]), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit |= set(range(k, k + n))
        if not (hit and 20 * len(hit) >= len(w)):
            ok.add(i)
    assert set(rows(free)) == ok

    vocabulary = pieces.load()
    final = rows(stages["SentencePiece encoding and decoding"](spark, free, ROOT))
    texts = rows(free)
    assert set(final) == set(texts)
    for i, r in final.items():
        assert r["round_trip"] and (r["ids"] is None) == (texts[i]["text"] is None)
        if r["ids"]:
            assert pieces.decode_ids(r["ids"], vocabulary) == texts[i]["text"]


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{ROOT}/documents.parquet").limit(0)
    for _, stage in C.STAGES:
        docs = store(stage(spark, docs, ROOT))
    assert docs.count() == 0


def test_registered_once_for_each_operator():
    names = sorted(QUERIES)
    assert [n for n in range(1, 11) if not any(x.startswith(f"op{n}_") for x in names)] == [] and "pipeline" in names


def test_the_rest_does_not_need_this_folder(tmp_path):
    """With neither the folder nor the pipeline, the entry module still lists the other queries."""
    code = """
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name.startswith("specloom.llm") or name == "corpus_pipeline":
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as e
assert "brand_summary" in e.queries() and not any(k.startswith("op") and k[2].isdigit() for k in e.queries())
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
