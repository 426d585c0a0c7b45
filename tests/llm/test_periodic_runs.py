"""Periodic runs against their definition, and the grammar's extensions against comparing word by word."""

import hashlib
import re
import zlib

import duckdb
import numpy as np
import pytest

from tidemark.llm import periodic_runs, queries
from tidemark.llm.run_grammar import Grammar


def stretches(words, exponent=4, least=6):
    """Start, length and smallest period of each run, by looking at every period."""
    words, found = np.asarray(words), {}
    for q in range(1, len(words) // exponent + 1):
        equal = np.concatenate([[False], words[q:] == words[:-q], [False]])
        edges = np.flatnonzero(equal[1:] != equal[:-1])
        for start, end in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if end - start + q >= max(least, exponent * q):
                found.setdefault((start, end + q), q)
    runs = [(start, end - start, q) for (start, end), q in found.items()]
    return sorted(runs, key=lambda run: (run[0], run[2]))


def odd_texts(random):
    for _ in range(random.integers(1, 9)):
        words = random.integers(0, random.integers(1, 5), random.integers(0, 90))
        if len(words) > 10:
            start, period = int(random.integers(0, len(words) - 9)), int(random.integers(1, 9))
            at = np.arange(len(words))
            words = words[np.where(at < start, at, start + (at - start) % period)]
        yield words


@pytest.mark.parametrize("seed", range(40))
def test_runs_are_those_of_the_definition(seed):
    random = np.random.default_rng(seed)
    texts, exponent = list(odd_texts(random)), int(random.integers(2, 6))
    found = periodic_runs.runs_of(texts, exponent)
    for i, words in enumerate(texts):
        assert [tuple(run) for run in found.get(i, np.zeros((0, 3), int)).tolist()] == stretches(words, exponent)


@pytest.mark.parametrize("seed", range(20))
def test_extensions_end_at_the_first_difference(seed):
    random = np.random.default_rng(seed)
    words = np.append(random.integers(0, random.integers(1, 4), random.integers(1, 60)), 9)
    pairs = [(a, b) for a in range(len(words)) for b in range(len(words)) if a != b]
    if pairs:
        found = Grammar(words).extension(*np.array(pairs).T)
        for (a, b), length in zip(pairs, found.tolist(), strict=True):
            reach = len(words) - max(a, b)
            assert length == np.argmin(np.append(words[a : a + reach] == words[b : b + reach], False))


def test_one_word_over_and_over():
    found = periodic_runs.runs_of([np.zeros(100_000, dtype=np.int32)])
    assert found[0].tolist() == [[0, 100_000, 1]]


def plain(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, crc = len(words), zlib.crc32(str(doc_id).encode())
    if crc % 10 == 0 and n:
        g = crc // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    numbers = {w: i for i, w in enumerate(dict.fromkeys(words))}
    runs = stretches([numbers[w] for w in words])
    dropped = {i for start, length, q in runs for i in range(start + q, start + length)}
    longest = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    best = (None,) * 4 if longest is None else (*longest, 1000 * longest[1] // longest[2])
    listed = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    return (doc_id, len(runs), *best, *(hashlib.sha256(x.encode()).hexdigest() for x in (listed, kept)))


def test_query_gives_what_the_definition_gives(spark, small):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{small}/documents.parquet'").fetchall()
    found = queries.REGISTRY["op11_periodic_runs"](spark, small)
    columns = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert set(map(tuple, found.select(columns).collect())) == {plain(*row) for row in rows}
    assert found.filter("n_runs > 0").count() > 5


def test_odd_rows(odd):
    rows = {(r["doc_id"], r["collapsed"]): r for r in periodic_runs.periodic_runs(odd).collect()}
    assert periodic_runs.periodic_runs(odd).count() == odd.count()
    assert rows[3, ""]["n_words"] == rows[4, ""]["n_words"] == rows[6, ""]["n_words"] == rows[None, ""]["n_words"] == 0
    assert rows[5, "the quick brown fox jumps over a lazy dog"]["runs"] == [(0, 27_000, 9)]
    assert rows[7, "Ünïcode and spaces \x1c\x85 \u2003x"]["runs"] == []


def test_clashing_names_and_no_rows(spark, none):
    assert periodic_runs.periodic_runs(none).collect() == []
    clash = spark.createDataFrame([("a b " * 6, "x", "y", 7)], "text string, runs string, collapsed string, n_words int")
    found = periodic_runs.periodic_runs(clash, doc_id="runs").first()
    assert (found[0], found["n_words"], found["collapsed"]) == ("x", 12, "a b")


def test_an_exponent_of_one_is_refused(odd):
    with pytest.raises(ValueError, match="min_exponent"):
        periodic_runs.periodic_runs(odd, min_exponent=1)
