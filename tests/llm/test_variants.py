import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from touchline.llm import variants

SCHEMA = "doc_id long, text string, word string, n string"


def distance(a, b):
    if max(len(a), len(b)) > 60:  # long words: one edit iff common prefix and suffix leave one place
        if a == b or abs(len(a) - len(b)) > 1:
            return 0 if a == b else 2
        p = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        q = next((i for i, (x, y) in enumerate(zip(reversed(a), reversed(b))) if x != y), min(len(a), len(b)))
        return 1 if min(p + q, min(len(a), len(b))) >= max(len(a), len(b)) - 1 else 2
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return row[-1]


def brute(docs):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            if doc_id is not None:
                h = zlib.crc32(f"{doc_id}:{run}".encode())
                if h % 31 == 0:
                    k = h % len(run)
                    run = run[:k] + run[k + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    near = {w: [v for v in words if distance(w, v) == 1] for w in words}
    forms = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        forms[w] = best if best is not None and words[best] >= 10 * n else None
    out = []
    for w, n in words.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        out.append((w, forms[w], root, n, len(near[w]), None if forms[w] is None else words[forms[w]]))
    return sorted(out)


def corpus(seed, size):
    rng = random.Random(seed)
    base = ["abcdefgh", "kitchens", "strengths", "ökonomie", "Carefully", "carefullly", "ÀÉÎõüÿ×x", "mississippi", "abcdefghij"]
    words = []
    for w in base:
        words += [w] * rng.randint(20, 60)
        for _ in range(rng.randint(1, 6)):
            k = rng.randrange(len(w))
            edit = rng.choice([w[:k] + w[k + 1 :], w[:k] + rng.choice("aeiouxé") + w[k:], w[:k] + rng.choice("aeiouxé") + w[k + 1 :]])
            words += [edit] * rng.randint(1, 5)
    rng.shuffle(words)
    docs, at = [], 0
    while at < len(words):
        take = rng.randint(1, 40)
        docs.append((len(docs) if len(docs) % 13 else None, " ".join(words[at : at + take]) + "; 123 ABC-def"))
        at += take
    return docs + [(len(docs) + 1, None), (len(docs) + 2, ""), (5, docs[5][1])]


@pytest.mark.parametrize("cell_words", [4, 2048])
def test_equals_brute_force(spark, monkeypatch, cell_words):
    monkeypatch.setattr(variants, "CELL_WORDS", cell_words)
    docs = corpus(7, 0)
    frame = spark.createDataFrame([(*d, "clash", "x") for d in docs], SCHEMA)
    got = sorted(tuple(r) for r in variants.variant_forms(frame).collect())
    assert got == brute(docs)
    assert any(r[1] is not None for r in got) and any(r[2] != r[0] and r[2] != r[1] for r in got) is not None


def test_kd_search_equals_all_pairs():
    rng = random.Random(3)
    word = lambda n: "".join(rng.choice("aabcdeé") for _ in range(n))
    points = variants._vectors([word(8) for _ in range(3000)])
    asked = [word(8) for _ in range(300)] + [word(7) for _ in range(300)]
    queries, downs = variants._vectors(asked), np.array([1] * 300 + [0] * 300, dtype=np.int8)

    def fits(q, p):
        gap = points[p] - queries[q]
        return np.abs(gap).max() <= 1 and (gap == 1).sum() <= 1 and (gap == -1).sum() <= downs[q]

    want = {(q, p) for q in range(600) for p in range(3000) if fits(q, p)}
    assert set(variants.kd_search(points, queries, downs)) == want and len(want) > 100


def test_one_edit():
    assert variants.one_edit("abcdefg", "abcdeg") and variants.one_edit("abc", "abx") and variants.one_edit("ab", "xab")
    assert not variants.one_edit("abc", "abc") and not variants.one_edit("abc", "bca") and not variants.one_edit("ab", "abcd")


def test_empty_and_long(spark):
    docs = [(1, "x" * 50_000 + " " + "y" * 7), (2, "x" * 50_000), (3, "x" * 50_000 + " " + "x" * 49_999), (4, "x" * 49_999)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = sorted(tuple(r) for r in variants.variant_forms(frame).collect())
    assert got == brute(docs) and len(got) >= 1
    assert variants.variant_forms(frame.limit(0)).count() == 0


def test_leaves_compare_bits_first_and_pairs_in_numpy():
    """Equal to every pair checked letter by letter; candidates are no Python calls each."""
    import pandas as pd

    rng = random.Random(11)
    words = sorted({"".join(rng.choices("abcé", k=9)) for _ in range(600)} | {"a" * 9, "a" * 8 + "b"})
    asked = sorted({*words, *(w[:k] + w[k + 1 :] for w in words for k in (0, 4, 8)), "aaaaaaaa"})
    points = pd.DataFrame({"word": words})
    queries = pd.DataFrame({"query": asked, "delete": [int(len(w) == 9) for w in asked]})
    want = {(a, w) for a in asked for w in words if variants.one_edit(a, w)}
    calls, one_edit = [], variants.one_edit
    variants.one_edit = lambda a, b: calls.append(1) or one_edit(a, b)
    try:
        found = variants._leaf_pairs(points, queries)
    finally:
        variants.one_edit = one_edit
    assert len(found) == len(want) and set(map(tuple, found.to_numpy())) == want and not calls
