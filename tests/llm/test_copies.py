"""Fingerprints, near duplicates and repeated passages against brute force."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import check_oracle
from touchline.llm import catalog, fingerprints, near_dup, unit_dedup
from touchline.llm.components import components

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, node long, set_hash string"


def documents(spark, texts):
    return spark.createDataFrame([(i, t, 1, "x") for i, t in texts], SCHEMA)


def texts_of(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


# fingerprints


def shingle_hashes(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text.lower()) if w]
    runs = [words[i : i + 5] for i in range(len(words) - 4)] or ([[" ".join(words)]] if words else [])
    out = set()
    for run in runs:
        seed = 42
        for word in run:
            seed = xxhash.xxh64_intdigest(word.encode(), seed)
        out.add(seed - 2**64 if seed >= 2**63 else seed)
    return out


def test_op2_equals_sketches_of_the_texts(spark):
    texts = texts_of(spark)
    rows = {r["doc_id"]: r for r in catalog.QUERIES["op2_bottom_k_fingerprint"](spark, SF).collect()}
    assert sorted(rows) == sorted(texts)
    order = sorted(texts, reverse=True)
    for key, after in zip(order, order[1:] + order[:1], strict=True):
        text, other, row = texts[key], texts[after], rows[key]
        half = len(text) // 2
        edited = text[: len(text) - half] + other[:half]
        import hashlib

        assert (row["n_chars"], row["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        sketch = sorted(shingle_hashes(text))[:256]
        assert row["fingerprint"] == ".".join(f"{h % 2**64:X}" for h in sketch)
        assert row["edited_fingerprint"] == ".".join(f"{h % 2**64:X}" for h in sorted(shingle_hashes(edited))[:256])
        for name, b in (("near_edited", edited), ("near_next", other)):
            one, two = shingle_hashes(text), shingle_hashes(b)
            exact = len(one & two) / len(one | two) if one | two else 1.0
            assert row[name] == pytest.approx(exact, abs=1e-9 if len(one | two) <= 256 else 0.15)


def test_fingerprints_of_odd_rows_and_merging(spark, odd_docs):
    rows = fingerprints.edit_likeness(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert {r["fingerprint"] for r in rows if r["doc_id"] in (0, 1, 2, 3)} == {""}
    assert all(0 <= r[c] <= 1 for r in rows for c in ("near_edited", "near_next", "kept_in_edited"))
    assert fingerprints.edit_likeness(odd_docs.limit(0)).count() == 0
    words = [f"w{i}" for i in range(2000)]
    parts = [(1, " ".join(words[i : i + 104])) for i in range(0, 2000, 100)] + [(2, "")]
    sketched = spark.createDataFrame(parts, "k int, text string").select("k", fingerprints.sketch(F.col("text")).alias("sketch"))
    merged = {r["k"]: list(r["sketch"]) for r in fingerprints.merge_parts(sketched, "k").collect()}
    assert merged == {1: sorted(shingle_hashes(" ".join(words)))[:256], 2: []}
    one = spark.createDataFrame([(" ".join(words), " ".join(words[:1000]))], "a string, b string")
    a, b = fingerprints.sketch(F.col("a")), fingerprints.sketch(F.col("b"))
    row = one.select(
        fingerprints.distinct_shingles(a).alias("n"), fingerprints.containment(b, a).alias("c"), fingerprints.from_text(fingerprints.to_text(a)) == a
    ).first()
    assert row[0] == pytest.approx(1996, rel=0.2)
    assert row[1] == pytest.approx(1.0, abs=0.15)
    assert row[2]


# near duplicates


def brute_components(texts, words, percent):
    sets = {}
    for key, text in texts:
        found = (text or "").encode().lower().split()
        runs = {tuple(found[i : i + words]) for i in range(len(found) - words + 1)} or ({tuple(found)} if found else set())
        sets[key] = runs
    label = {k: k for k in sets}
    keys = sorted(sets)

    def root(k):
        while label[k] != k:
            k = label[k]
        return k

    for i, a in enumerate(keys):
        for b in keys[:i]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                x, y = root(a), root(b)
                label[max(x, y)] = min(x, y)
    return {k: (len(sets[k]), root(k)) for k in keys}


def edited(draw, words, n):
    words = list(words)
    for _ in range(n):
        words[draw.randrange(len(words))] = f"e{draw.randrange(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize(("words", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates_equal_brute_force(spark, words, percent, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK", 16)
    draw = random.Random(words)
    base = [[f"w{draw.randrange(400)}" for _ in range(n)] for n in (200, 120, 60, 12)]
    texts = [edited(draw, b, draw.choice([0, 1, 2, 3, 5, 8])) for b in base for _ in range(70)]
    texts += [" ".join(base[0]).upper()] * 30 + [None, "", " \t", "one", "One", "one two", "é É", "x " * 3000]
    draw.shuffle(texts)
    rows = list(enumerate(texts, 5))
    want = brute_components(rows, words, percent)
    got = near_dup.near_duplicates(documents(spark, rows), near_dup.Rule(words, percent)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_near_duplicates_of_odd_rows(spark, odd_docs):
    got = near_dup.near_duplicates(odd_docs).collect()
    assert len(got) == odd_docs.count()
    by_key = {}
    for row in got:
        by_key.setdefault(row["doc_id"], []).append(row)
    assert by_key[None][0]["component_id"] is None and by_key[None][0]["kept"]
    assert [r["component_id"] for r in by_key[4]] == [4, 4]
    assert [r["component_id"] for r in by_key[13]] == [4]  # the same two words
    assert [r["component_id"] for r in by_key[14]] == [11]
    assert near_dup.near_duplicates(odd_docs.limit(0)).count() == 0


def test_op5_equals_its_sql(spark):
    assert check_oracle.compare(spark, check_oracle.connect(SF), "op5_minhash_near_dup", SF)[0] == "ok"


def test_pairs_under_the_distance_share_a_bucket():
    draw, rule = np.random.default_rng(1), near_dup.Rule(3, 85)
    for _ in range(300):
        places = draw.permutation(near_dup.WIDTH)[: rule.distance]
        wrong = np.zeros(near_dup.WIDTH, bool)
        wrong[places] = True
        assert min(wrong[c].sum() for c in rule.chunks) <= 1


def test_groups_take_the_place_of_many_shared_buckets(spark):
    rows = [(100 + k, 60, k, node, node % 7) for k in range(40) for node in range(60)]  # one group in 40 buckets
    rows += [(200, 2, 3, 70, 70), (200, 2, 3, 71, 71)]  # a pair in one bucket
    rows += [(300 + k, 2, 5, 80 + k, 80 + k) for k in range(30)] + [(300 + k, 2, 5, 81 + k, 81 + k) for k in range(30)]  # a chain
    parts = spark.createDataFrame(rows, "bucket long, n long, slot short, node long, component long")
    got = near_dup._whole_groups(parts).collect()
    assert sum(r.node < 60 for r in got) == 60  # 2,400 rows before

    def meeting(rows):
        buckets = {}
        for bucket, _n, _slot, node, _component in rows:
            buckets.setdefault(bucket, set()).add(node)
        return {(a, b) for nodes in buckets.values() for a in nodes for b in nodes if a < b}

    assert meeting(rows) <= meeting(got)
    assert {(r.node, r.component) for r in got} == {(node, component) for *_, node, component in rows}
    assert all(r.n == sum(x.bucket == r.bucket for x in got) for r in got)
    assert len(got) <= len(rows)


def test_components_of_chains_hubs_and_loops(spark):
    links = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(101, 400)] + [(500, 500), (601, 600), (600, 601)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(51)}, **{i: 100 for i in range(100, 400)}, 600: 600, 601: 600}


# repeated passages


def test_passages_go_wherever_they_stand(spark):
    draw = random.Random(4)
    vocabulary = [f"w{i}" for i in range(5000)]
    sentence = lambda n: " ".join(draw.choices(vocabulary, k=n)).capitalize() + "."
    passage = " ".join(sentence(n) for n in (3, 12, 6, 3, 3, 12, 6, 9, 3))
    assert len(passage.split()) > 50
    clean = ["\n".join(" ".join(sentence(8) for _ in range(4)) for _ in range(3)) for _ in range(8)]
    texts = {}
    for i, text in enumerate(clean):
        words = text.split(" ")
        at = draw.randrange(len(words))
        texts[i] = " ".join([*words[:at], *(passage.split(" ") if i % 2 else []), *words[at:]])
    got = {r["doc_id"]: r for r in unit_dedup.remove_repeats(documents(spark, texts.items())).collect()}
    for i, text in texts.items():
        row = got[i]
        spans = [(s["start"], s["end"]) for s in row["removed"]]
        assert row["text"] == rebuild(text, spans)
        if i in (3, 5, 7):
            assert "".join(text[a:b] for a, b in spans).split() == passage.split()
            assert row["text"].split() == clean[i].split()
        else:
            assert spans == []


def rebuild(text, spans):
    out, at = [], 0
    for a, b in spans:
        out.append(text[at:a])
        at = b
    return "".join([*out, text[at:]])


def brute_repeats(texts, least, line_least, window):
    """Word ranges that repeat, from all runs of units and all windows of ``window`` words of all texts, with plain loops."""
    word = re.compile(r"[^\x20\x09-\x0D]+")
    runs = {}
    for key, text in sorted(texts.items()):
        words = [m.span() for m in word.finditer(text)]
        body = [text[a:b] for a, b in words]
        line = [i == 0 or "\n" in text[words[i - 1][1] : words[i][0]] for i in range(len(words))]
        unit = [line[i] or body[i][0].isupper() or re.search(r"[.!?…][\"'”’)\]]*\Z", body[i - 1]) is not None for i in range(len(words))]
        starts = [i for i in range(len(words)) if unit[i]] + [len(words)]
        lines = [i for i in range(len(words)) if line[i]] + [len(words)]
        spans = {(a, b) for a, b in zip(lines, lines[1:]) if b - a >= line_least}
        spans |= {(a, a + window) for a in range(len(words) - window + 1)}
        for n in range(len(starts) - 1):
            left = next((starts[m] for m in range(n, -1, -1) if starts[n + 1] - starts[m] >= least), None)
            right = next((starts[m] for m in range(n + 1, len(starts)) if starts[m] - starts[n] >= least), None)
            spans |= ({(left, starts[n + 1])} if left is not None else set()) | ({(starts[n], right)} if right is not None else set())
        for a, b in spans:
            runs.setdefault(tuple(x.lower() for x in body[a:b]), []).append((key, a, b))
    gone = {}
    for places in runs.values():
        key, a, b = min(places)
        for k, c, d in places:
            if k > key or c >= b:
                gone.setdefault(k, set()).update(range(c, d))
    return gone


def test_op3_equals_brute_force(spark):
    texts = texts_of(spark)
    gone = brute_repeats(texts, unit_dedup.MIN_WORDS, unit_dedup.LINE_WORDS, unit_dedup.WINDOW)
    rows = catalog.QUERIES["op3_unit_dedup"](spark, SF).collect()
    assert len(rows) == len(texts)
    for row in rows:
        text = texts[row["doc_id"]]
        spans = [(s["start"], s["end"]) for s in row["removed"]]
        assert row["text"] == rebuild(text, spans)
        words = [m.span() for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
        removed = {i for i, (a, b) in enumerate(words) if any(s <= a and b <= e for s, e in spans)}
        assert removed == gone.get(row["doc_id"], set())


def test_repeats_of_odd_rows(spark, odd_docs):
    got = unit_dedup.remove_repeats(odd_docs)
    assert got.columns == [*odd_docs.columns, "removed"]
    rows = got.collect()
    assert len(rows) == odd_docs.count()
    kept = {r["doc_id"]: r["text"] for r in rows}
    assert kept[0] is None and kept[1] == "" and kept[None] == "null key"
    assert kept[14] == "" and kept[11].startswith("Lorem ipsum")
    assert unit_dedup.remove_repeats(odd_docs.limit(0)).count() == 0


def test_runs_of_units():
    text = "One two. Three four five six seven eight nine ten eleven.\nshort line"
    doc, start, end, one, _two = unit_dedup.runs_of(pa.array([None, text, ""]), 8, 5)
    assert sorted(zip(doc.tolist(), start.tolist(), end.tolist(), strict=True)) == [(1, 0, 11), (1, 2, 11), (1, 2, 13)]
    assert len(set(one.tolist())) == 3


def test_repeats_without_whole_units(spark):
    """Passages of 50 words and more without capitals, marks or lines of their own go as a whole, and nothing else does."""
    draw = random.Random(11)
    flow = lambda n: [f"w{draw.randrange(10**6)}" for _ in range(n)]
    texts, expected = {}, {}
    for i, n in enumerate((50, 51, 60, 75, 120, 400)):
        passage = flow(n)
        for j, (before, after) in enumerate(((30, 40), (7, 3), (0, 90), (200, 0))):
            key = 10 * i + j
            texts[key] = " ".join([*flow(before), *passage, *flow(after)])
            expected[key] = set(range(before, before + n)) if j else set()
    short, long = flow(49), flow(130)
    texts |= {100: " ".join(flow(9) + short + flow(9)), 101: " ".join(flow(4) + short + flow(9))}
    # A part of a passage, the passage twice in a text, and a passage inside long sentences.
    texts |= {102: " ".join(flow(5) + long + flow(5)), 103: " ".join(flow(8) + long[33:99] + flow(2) + long + flow(3))}
    texts[104] = "It says " + " ".join(flow(20) + long[10:90] + flow(20)) + ". Then it ends."
    expected |= {103: set(range(8, 74)) | set(range(76, 206)), 104: set(range(22, 102))}
    got = unit_dedup.remove_repeats(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    assert len(got) == len(texts)
    for row in got:
        words = [m.span() for m in re.finditer(r"\S+", texts[row["doc_id"]])]
        removed = {i for i, (a, b) in enumerate(words) if any(s["start"] <= a and b <= s["end"] for s in row["removed"])}
        assert removed == expected.get(row["doc_id"], set()), row["doc_id"]
