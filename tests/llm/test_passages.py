"""Removal of repeated word windows against brute force."""

import collections

import numpy as np
import pytest

from tallymill.llm import passages, recompression

DOC = "doc_id long, text string, row int, id string, data string, block int, ats int"


def test_equal_windows_have_equal_anchors():
    rng = np.random.default_rng(0)
    for trial in range(200):
        width = int(rng.integers(2, 12))
        words = rng.integers(0, int(rng.integers(1, 6)), 60).astype(np.uint64)
        if trial % 3 == 0:
            words[30:50] = words[5:25]
        bars = np.zeros(60, bool)
        bars[rng.integers(12, 48)] = True
        first = np.array([i for i in range(60 - width + 1) if not bars[i : i + width].any()])
        names, places = recompression.anchors(recompression.mixed(words, 7), bars, first, width, 4)
        seen = {}
        for f, name, place in zip(first.tolist(), names.tolist(), places.tolist()):
            assert f <= place < f + width
            assert seen.setdefault(tuple(words[f : f + width]), (name, place - f)) == (name, place - f)


def brute(texts, window):
    words = [(t or "").encode().split() for t in texts]
    seen = collections.Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = np.zeros(len(w), bool)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = True
        out.append((len(w), int(gone.sum()), b" ".join(x for x, g in zip(w, gone) if not g)))
    return out


def some_texts(rng):
    fresh = lambda n: [f"w{i}" for i in rng.integers(0, 300, n)]
    common, long = fresh(60), fresh(700)
    texts = [" ".join(fresh(50) + common + fresh(int(rng.integers(0, 40)))) for _ in range(12)]
    texts += [" ".join(long), " ".join(long), "  ".join(long[:300] + ["x"] + long[300:]), "\n\t".join(long[100:160]), " ".join(long[100:134])]
    texts += ["a " * 200, "a b " * 90, "a b c " * 30 + " ".join(fresh(100)), " ".join(common * 3), "same " * 34, "same " * 35]
    texts += [None, "", " \n ", "one", "é ü  " * 40, "x" * 5000, "\u0085 \x1c " * 40]
    return texts + texts[:1]


@pytest.mark.parametrize("chunk, block, window", [(1 << 20, 4 << 20, 35), (600, 3000, 35), (1 << 20, 1, 5)])
def test_passages(spark, chunk, block, window):
    texts = some_texts(np.random.default_rng(window))
    rows = [(i % 27 if i != 5 else None, t, 0, str(i), "clash", 7, 7) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, DOC).repartition(3)
    out = passages.remove_passages(docs, window=window, block=block, chunk=chunk).collect()
    got = sorted(((r.doc_id, r.n_words, r.n_removed, bytes(r.kept)) for r in out), key=repr)
    expected = sorted(((row[0], *found) for row, found in zip(rows, brute(texts, window))), key=repr)
    assert got == expected


def test_no_rows(spark):
    assert passages.remove_passages(spark.createDataFrame([], DOC)).count() == 0


def test_text_is_as_it_was_where_no_word_goes(spark):
    words = [f"w{i}" for i in range(40)]
    texts = ["  a\tb\n", "x  " + " ".join(words), "y\n" + "\n".join(words), None]
    df = spark.createDataFrame([(i, t, 0, "", "", 0, 0) for i, t in enumerate(texts)], DOC)
    got = {r.doc_id: (bytes(r.kept), bytes(r.text)) for r in passages.remove_passages(df).collect()}
    assert got == {0: (b"a b", b"  a\tb\n"), 1: (b"x", b"x"), 2: (b"y", b"y"), 3: (b"", b"")}
