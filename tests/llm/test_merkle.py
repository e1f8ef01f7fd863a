import hashlib
import zlib

import pytest

from touchline.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, leaf string, root int"


def H(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row, text):
    return H("".join(field(v) for v in (row[0], row[1], row[2], row[3], text)))


def levels_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([H("".join(last[i : i + 3])) for i in range(0, len(last), 3)])
    return levels


def siblings(levels, i):
    out = []
    for level in levels[:-1]:
        run = i // 3 * 3
        out.append(("".join(level[run:i]), "".join(level[i + 1 : run + 3])))
        i //= 3
    return out


def brute(rows):
    """The whole rule in plain Python: rows of (doc_id, source, lang, n_chars, text)."""
    by_source = {}
    for row in rows:
        by_source.setdefault(row[1], []).append((row, leaf(row, row[4])))
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    low = {}
    for name in names:
        items = sorted(by_source[name], key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        low[name] = (items, levels_of([d for _, d in items]))
    top = levels_of([low[n][1][-1][0] for n in names])
    root = top[-1][0]
    out = []
    for s_i, name in enumerate(names):
        items, levels = low[name]
        for i, (row, digest) in enumerate(items):
            proof = siblings(levels, i) + siblings(top, s_i)
            tampered = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0
            start = leaf(row, row[4].replace("\n", "") if tampered and row[4] is not None else row[4])
            for left, right in proof:
                start = H(left + start + right)
            out.append((row[0], digest, levels[-1][0], root, H("".join(a + b for a, b in proof)), start, start == root))
    return sorted(out, key=repr)


def rows_of(n, sources):
    texts = ["a\nb", "no break", None, "", "x\n" * 50, "é\n€"]
    return [(i if i % 17 else None, sources[i % len(sources)], "en" if i % 5 else None, i * 3 if i % 7 else None, texts[i % len(texts)]) for i in range(n)]


@pytest.mark.parametrize("block_height", [1, 2, 6])
def test_equals_brute_force(spark, block_height):
    rows = rows_of(130, ["web", "books", None, "wiki", "ü"]) + rows_of(4, ["web"])  # repeated rows too
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA)
    got = sorted((tuple(r) for r in merkle.manifest(docs, block_height).collect()), key=repr)
    assert got == brute(rows)


def test_hot_source_many_rounds(spark):
    rows = rows_of(400, ["hot"]) + rows_of(5, ["cold"])
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    got = sorted((tuple(r) for r in merkle.manifest(docs, 1).collect()), key=repr)
    assert got == brute(rows)
    assert sum(not r[-1] for r in got) > 0 and sum(r[-1] for r in got) > 0


def test_lone_leaf_empty_table_and_long_text(spark):
    rows = [(7, None, None, None, "long\n" * 40000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    (got,) = merkle.manifest(docs).collect()
    assert got.leaf == got.subroot == got.root and got.proof_sha256 == H("")
    assert tuple(got) == brute(rows)[0]
    assert merkle.manifest(docs.limit(0)).count() == 0
