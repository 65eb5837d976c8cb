"""Periodic runs against all periods tried one by one."""

import hashlib
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from corpusops.llm import periodic_runs
from corpusops.llm.queries import QUERIES

from .support import awkward, empty, words

SMALL = "/root/testdata/sf0.001"


def plain_runs(s, least):
    """(start, length, period) of maximal stretches with s[i] == s[i + q]; the smallest q of a stretch counts."""
    found = {}
    for q in range(1, len(s) // 2 + 1):
        i = 0
        while i + q < len(s):
            j = i
            while j + q < len(s) and s[j] == s[j + q]:
                j += 1
            if j > i and j + q - i >= max(2 * q, least):
                found.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted(((i, n, q) for (i, n), q in found.items()), key=lambda r: (r[0], r[2]))


def plain_collapse(s, runs):
    return " ".join(w for i, w in enumerate(s) if not any(a + q <= i < a + n for a, n, q in runs))


def periodic(pick, most):
    n, letters = pick.randint(0, most), pick.choice([1, 2, 2, 3, 30])
    s = [pick.randrange(letters) for _ in range(n)]
    if n and pick.random() < 0.5:
        a = pick.randrange(n)
        p = pick.randint(1, max(1, (n - a) // 2))
        s = [s[i] if i < a else s[a + (i - a) % p] for i in range(n)]
    return s


def next_smaller(s):
    return [next((j for j in range(i + 1, len(s)) if s[j:] < s[i:]), len(s)) - i for i in range(len(s))]


def test_grouping_gives_the_lyndon_array():
    pick = random.Random(1)
    for _ in range(1500):
        s = periodic(pick, 40)
        assert periodic_runs.lyndon_array(np.array(s, np.int64)).tolist() == next_smaller(s)


def test_extensions_equal_plain_comparison():
    pick = random.Random(2)
    for _ in range(200):
        s = [0, *periodic(pick, 40)]
        found = periodic_runs.Extensions(np.array(s))
        a, b = map(np.array, zip(*[(i, j) for i in range(len(s)) for j in range(i + 1, len(s) + 1)]))
        forward = [next((k for k in range(len(s) - j) if s[i + k] != s[j + k]), len(s) - j) for i, j in zip(a, b)]
        backward = [next((k for k in range(i) if s[i - 1 - k] != s[j - 1 - k]), int(i)) for i, j in zip(a, b)]
        assert found.forward(a, b).tolist() == forward and found.backward(a, b).tolist() == backward


def test_runs_of_many_texts_equal_all_periods():
    pick = random.Random(3)
    for _ in range(400):
        texts = [[str(x).encode() for x in periodic(pick, 60)] for _ in range(pick.randint(1, 6))]
        for least in (2, 5, 12):
            for text, got in zip(texts, periodic_runs.runs_of_texts(texts, least)):
                assert list(map(tuple, got.tolist())) == plain_runs(text, least)


def test_long_texts_that_repeat():
    block = [str(i * i % 9973).encode() for i in range(3000)]
    assert periodic_runs.runs_of_texts([block * 40, block, [b"x"] * 100_000], 12)[0].tolist() == [[0, 120_000, 3000]]
    found = periodic_runs.runs_of_texts([[b"x"] * 100_000 + block + [b"y"] * 11], 12)[0]
    assert found.tolist() == [[0, 100_000, 1]]


def test_query_equals_plain_version(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(SMALL + "/documents.parquet").collect()}
    with_runs = 0
    rows = QUERIES["op11_lyndon_runs"](spark, SMALL).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        w = words(docs[r.doc_id], fold=False)
        n, h = len(w), zlib.crc32(str(r.doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        runs = plain_runs(w, 12)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2])) if runs else (None, None, None)
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{i},{m},{q}\n" for i, m, q in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(plain_collapse(w, runs).encode()).hexdigest()
        with_runs += bool(runs)
    assert with_runs > 10


def test_runs_of_awkward_rows(spark):
    docs = awkward(spark).withColumn("runs", F.lit("clash")).withColumn("n_words", F.lit(0)).withColumn("collapsed", F.lit("clash"))
    more = spark.createDataFrame([(50, "a b " * 9 + "c"), (50, "a b " * 9 + "c"), (51, "é\x0bü " * 70_000), (52, "A a " * 3)], "doc_id long, text string")
    docs = docs.unionByName(more, allowMissingColumns=True)
    got = periodic_runs.periodic_runs(docs).collect()
    assert len(got) == docs.count()
    for r in got:
        w = words(r.row.text, fold=False)
        if len(w) < 1000:
            want = plain_runs(w, 12)
            assert (r.n_words, [tuple(x) for x in r.runs], r.collapsed) == (len(w), want, plain_collapse(w, want))
    assert [(r.runs[0].length, r.collapsed) for r in got if r.row.doc_id == 51] == [(140_000, "é ü")]
    assert [r.collapsed for r in got if r.row.doc_id == 50] == ["a b c"] * 2
    digests = periodic_runs.run_digests(periodic_runs.periodic_runs(docs, carry=["doc_id"]))
    none = digests.where("doc_id = 0").first()
    assert (none.n_runs, none.start, none.length, none.period, none.exponent_milli) == (0, None, None, None, None)
    assert none.runs_sha256 == none.collapsed_sha256 == hashlib.sha256(b"").hexdigest()
    assert periodic_runs.periodic_runs(empty(spark)).count() == 0
