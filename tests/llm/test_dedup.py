"""Substring, suffix and shingle deduplication against brute force."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from factloom.llm import minhash, substring, suffix, winnow
from factloom.llm.common import work_dir

from .conftest import WORD

LAST = (1 << 63) - 1
key = lambda r: tuple((x is not None, x) for x in r)


def test_words_follow_the_pattern():
    texts = ["", " a  b\tc", "x\x1cy z\x0b", None, "é\n日本 ", "a"]
    t = winnow.texts(pa.array(texts))
    w = winnow.words(t)
    raw = t.data.tobytes()
    for i, x in enumerate(texts):
        found = [raw[a:b].decode() for a, b in zip(w.start[w.first[i] : w.first[i + 1]], w.end[w.first[i] : w.first[i + 1]])]
        assert found == WORD.findall(x or "")


@given(st.lists(st.integers(0, 2**63), max_size=60), st.integers(1, 9))
@settings(deadline=None, max_examples=60)
def test_sliding_min(values, width):
    v = np.array(values, np.uint64)
    expected = [min(values[i : i + width]) for i in range(len(values) - width + 1)]
    assert winnow.sliding_min(v, width).tolist() == expected


def test_equal_windows_lie_in_segments_of_one_anchor(monkeypatch):
    rng = np.random.default_rng(1)
    for step in (1 << 20, 64):
        monkeypatch.setattr(winnow, "_STEP", step)
        values = rng.integers(0, 3, 400).astype(np.uint64)
        s = winnow.segments(lambda a, b: winnow.sliding(values[a : b + 4], 5), 400, np.zeros(400, np.int64), np.array([0, 400]), 20, 5)
        assert s.count.sum() == 381
        anchor = np.repeat(s.anchor, s.count)
        seen = {}
        for i in range(381):
            assert seen.setdefault(values[i : i + 20].tobytes(), anchor[i]) == anchor[i]


def thue_morse(n):
    """A word that polynomial hashes modulo a power of two can't tell from its complement."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


@given(st.lists(st.integers(0, 3), max_size=80), st.integers(1, 20))
@settings(deadline=None, max_examples=60)
def test_hashes_stand_for_content(values, width):
    v = np.array(values, np.uint64)
    h = winnow.sliding(v, width)
    assert len(h) == max(0, len(v) - width + 1)
    same = {}
    for i in range(len(h)):
        assert same.setdefault(v[i : i + width].tobytes(), h[i]) == h[i]
    assert len(set(same.values())) == len(same)


def test_words_of_any_length_are_told_apart():
    found = []
    for n in (7, 8, 9, 64, 512, 513, 1024, 2048, 4096):
        found += thue_morse(n)
    t = winnow.texts(pa.array([" ".join(found + found)]))
    h = winnow.word_hashes(t, winnow.words(t)).tolist()
    assert h[: len(found)] == h[len(found) :] and len(set(h)) == len(found)


def brute_substring(rows):
    firsts = {}
    parsed = [(LAST if r[0] is None else r[0], r[0], WORD.findall(r[1] or "")) for r in rows]
    for doc, _, words in parsed:
        for k in range(len(words) - 49):
            w = tuple(words[k : k + 50])
            firsts[w] = min(firsts.get(w, LAST), doc)
    expected = []
    for doc, shown, words in parsed:
        gone = set()
        for k in range(len(words) - 49):
            if firsts[tuple(words[k : k + 50])] < doc:
                gone.update(range(k, k + 50))
        expected.append((shown, len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone)))
    return expected


@pytest.mark.parametrize("batches", [1, 4])
def test_substring(docs, rows, batches):
    expected = brute_substring(rows)
    got = substring.dedup(docs, batches=batches).collect()
    assert sorted(map(tuple, got), key=key) == sorted(expected, key=key)
    assert any(r[2] for r in expected)


def test_index_is_reopened_compacted_and_leaves_no_tables(spark, docs, rows):
    path = f"{work_dir(spark)}/index"
    out = []
    merges = []
    for lo, hi in ((-1, 30), (30, 70), (70, 85), (85, (1 << 63) - 1)):
        some = substring.batch(docs).where(F.col("_doc").between(lo + 1, hi))
        # Each batch opens the folder anew, as a later job would.
        index = substring.FingerprintIndex(spark, path)
        before = len(index.state["runs"])
        out += [tuple(r) for r in index.append(some).collect()]
        merges.append(before + 1 - len(index.state["runs"]))
    assert sorted(out, key=key) == sorted(brute_substring(rows), key=key)
    assert max(merges) > 0
    assert not [t for t in spark.catalog.listTables() if not t.isTemporary]
    with pytest.raises(ValueError):
        substring.FingerprintIndex(spark, path, window=40)


def test_different_long_words_are_no_copies(spark):
    rows = []
    for n in (1024, 2048, 4096):
        for x in thue_morse(n):
            rows.append((len(rows), " ".join([x] + [f"w{k}" for k in range(49)])))
    rows += [(len(rows) + i, x) for i, x in enumerate(thue_morse(1024))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert [r.n_removed for r in substring.dedup(df, batches=1).collect()] == [0] * 8
    got = sorted(map(tuple, minhash.near_duplicates(df, shingle=2).drop("_tag").collect()))
    assert got == sorted(brute_components(rows, 2))


@pytest.mark.parametrize("most", [1, 4096])
def test_suffix(docs, rows, most):
    counts = Counter()
    raw = [(r[0], (r[1] or "").encode()) for r in rows]
    for _, b in raw:
        counts.update(b[k : k + 200] for k in range(len(b) - 199))
    expected = []
    for i, b in raw:
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - 199):
            if counts[b[k : k + 200]] > 1:
                gone[k : k + 200] = True
        spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(b) else 0
        expected.append((i, len(b), int(gone.sum()), spans, bytes(np.frombuffer(b, np.uint8)[~gone])))
    got = [(r[0], r[1], r[2], r[3], bytes(r[4])) for r in suffix.dedup(docs, bucket_most=most).collect()]
    assert sorted(got, key=key) == sorted(expected, key=key)
    assert any(r[2] for r in expected)


def test_refine_tells_windows_apart():
    rng = np.random.default_rng(5)
    texts = [bytes(rng.integers(97, 99, int(n)).astype(np.uint8)) for n in (230, 201, 200, 150, 260)]
    texts.append(texts[0][10:225])
    row, start, hit = suffix.refine(pa.array(texts, pa.binary()), 200)
    windows = [texts[r][s : s + 200] for r, s in zip(row, start)]
    count = Counter(windows)
    assert len(windows) == sum(max(0, len(x) - 199) for x in texts)
    assert hit.tolist() == [count[w] > 1 for w in windows]


def brute_components(rows, size):
    fold = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    sets = []
    for r in rows:
        words = WORD.findall((r[1] or "").translate(fold))
        sets.append(frozenset(zip(*[words[k:] for k in range(size)])) if len(words) >= size else frozenset([tuple(words)] if words else []))
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[root(i)] = min(least.get(root(i), r[0]), r[0])
    return [(r[0], len(s), least.get(root(i)), r[0] == least.get(root(i))) for i, (r, s) in enumerate(zip(rows, sets))]


@pytest.mark.parametrize("size,most,block", [(2, 128, 2048), (5, 128, 2048), (2, 4, 3)])
def test_minhash(docs, rows, size, most, block, monkeypatch):
    monkeypatch.setattr(minhash, "LIST_MOST", most)
    monkeypatch.setattr(minhash, "BLOCK", most)
    monkeypatch.setattr(minhash, "FAMILY_BLOCK", block)
    got = minhash.near_duplicates(docs, shingle=size).drop("_tag").collect()
    assert sorted(map(tuple, got), key=key) == sorted(brute_components(rows, size), key=key)


def test_short_texts_and_one_word_more(spark):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(40)]
    rows = []
    for _ in range(60):
        base = [rng.choice(words) for _ in range(rng.randint(1, 24))]
        for _ in range(3):
            some = list(base)
            for _ in range(rng.randint(0, 2)):
                at = rng.randrange(len(some) + 1)
                some = some[:at] + ([rng.choice(words)] if rng.random() < 0.5 else []) + some[at + rng.randint(0, 1) :]
            rows.append((len(rows), " ".join(some)))
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=2).drop("_tag").collect()
    assert sorted(map(tuple, got), key=key) == sorted(brute_components(rows, 2), key=key)


def shifted(rng, n, length, kept):
    """Texts of equal length that share a part of their words with one another, in place."""
    base = [f"b{k}" for k in range(length)]
    return [(i, " ".join(w if rng.random() < kept else f"x{i}_{k}" for k, w in enumerate(base))) for i in range(n)]


def test_a_family_below_the_threshold_stays_apart_in_few_rows(spark, monkeypatch):
    rows = shifted(random.Random(2), 1500, 120, 0.93)
    rows += [(1500 + i, t + f" tail{i}") for i, t in rows[:40]]
    texts = spark.createDataFrame(rows, "doc_id long, text string")
    made = []
    spread = minhash._spread
    monkeypatch.setattr(minhash, "_spread", lambda lists, half: made.append(spread(lists, half)) or made[-1])
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(texts, shingle=2).collect()}
    assert got == {r[0]: r[2] for r in brute_components(rows, 2)}
    assert all(not {"_text", "blob"} & set(m.columns) for m in made)
    assert made[-1].count() <= 4 * len(rows)


def test_one_of_each_group_stays(docs, rows):
    kept = minhash.first_of_each(docs, shingle=5)
    assert kept.columns == docs.columns
    ids = sorted((r.doc_id, r.text) for r in kept.collect() if r.doc_id is not None)
    good = {(r[0], r[1]) for r, b in zip(rows, brute_components(rows, 5)) if b[3] and r[0] is not None}
    assert ids == sorted(good, key=lambda x: (x[0], x[1] or "")) or {x for x in ids} == good and len(ids) == len(good)


def test_empty_tables(empty):
    assert substring.dedup(empty).count() == suffix.dedup(empty).count() == minhash.near_duplicates(empty).count() == 0
