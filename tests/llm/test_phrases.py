"""Frequent phrases against counting them in plain Python; the query's SQL is compared with the other queries'."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidemark.llm import phrase_prints, phrases


def plain(rows, longest=4, min_count=30, top=2000):
    """Rows of the report, for rows of text and group."""
    counts, words_of = defaultdict(Counter), Counter()
    for text, group in rows:
        lower = re.sub("[A-Z]", lambda x: x.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            words_of[group or "und"] += len(words)
            for size in range(1, longest + 1):
                counts[group or "und"].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    report = []
    for group, own in counts.items():
        chosen = {p: a for p, a in own.items() if len(p) > 1 and a >= min_count}
        covered = set()
        for p, a in chosen.items():
            for size in range(2, len(p)):
                covered |= {p[i : i + size] for i in range(len(p) - size + 1) if 100 * a >= 80 * own[p[i : i + size]]}
        scored = []
        for p, a in chosen.items():
            if p not in covered:
                cuts = [(2_000_000 * a // (own[p[:k]] + own[p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                scored.append((-score, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(scored)[:top], 1):
            report.append((group, rank, p.decode(), -a, left, right, words_of[group], -score))
    return sorted(report)


def found_by(spark, rows, **options):
    frame = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], "doc_id long, text string, lang string")
    return sorted(map(tuple, phrases.collocations(frame, **options).collect()))


def invented(random, n):
    kinds = ["of", "The", "ü", "new", "york", "x" * 40, "É", " "]
    for _ in range(n):
        words = random.choice(kinds, random.integers(0, 60), p=[0.3, 0.2, 0.1, 0.1, 0.1, 0.05, 0.1, 0.05]).tolist()
        gaps = random.choice([" ", "  ", "\t", ", ", ".\n", "\r\n"], len(words), p=[0.7, 0.1, 0.05, 0.05, 0.05, 0.05]).tolist()
        yield "".join(w + g for w, g in zip(words, gaps, strict=True)), [None, "en", "de"][int(random.integers(0, 3))]


def test_phrases_are_those_of_plain_counting(spark):
    rows = list(invented(np.random.default_rng(1), 400))
    expected = plain(rows)
    assert len(expected) > 50
    assert found_by(spark, rows) == expected
    assert found_by(spark, rows, top=3, longest=5, min_count=10) == plain(rows, 5, 10, 3)


def test_a_small_filter_and_small_blocks_change_nothing(spark, monkeypatch):
    rows = list(invented(np.random.default_rng(2), 200))
    rows += [(" ".join(["new york of the"] * 3000) + ". " + "of the, " * 9000, "en"), ("a b c d " * 9000, None)]
    monkeypatch.setattr(phrases, "_FILTER_BITS", 64)
    monkeypatch.setattr(phrases, "_TOGETHER", 500)
    assert found_by(spark, rows) == plain(rows)


def test_colliding_fingerprints_are_counted_apart():
    """Fingerprints of a few bits, in the tasks too: only the checks tell the phrases apart."""

    def few(self, at, size, salt):
        return phrase_prints.mix(phrase_prints._wrapped(self._prints, at, at + size, phrase_prints._WRAPPED[1]) ^ salt) & np.uint64(3)

    rows = [("a b c", "en"), ("a b d", "en"), ("e f", "en")]
    counted = Counter()
    for _, _, _, words in phrase_prints.blocks([text.encode() for text, _ in rows]):
        at = words.grams(2)
        counted.update(zip(few(words, at, 2, np.uint64(0)).tolist(), words.checks(at, 2).tolist(), strict=True))
    assert sorted(counted.values()) == [1, 1, 1, 2]
    assert phrases._collide(np.array([1, 1, 2]), np.array([5, 6, 7]))
    assert not phrases._collide(np.array([1, 1, 2]), np.array([5, 5, 7]))


def test_equal_words_have_equal_values_wherever_they_stand():
    texts = [b"of the of", b"OF\tthe  of", b"x, of the of." + b" y" * 500_000 + b" of the of", b""]
    values = set()
    for _, _, _, words in phrase_prints.blocks(texts):
        at = words.grams(3)
        prints = words.prints(at, 3, np.zeros(len(at), dtype=np.uint64))
        values |= {v for v, n in Counter(zip(prints.tolist(), words.checks(at, 3).tolist(), strict=True)).items()}
    # of the of / y y y / y y of / y of the
    assert len(values) == 4


def test_odd_rows(spark, odd, none):
    assert phrases.collocations(none).collect() == []
    rows = [(r["text"], r["lang"]) for r in odd.collect()]
    found = phrases.collocations(odd, min_count=2).collect()
    assert sorted(map(tuple, found)) == plain(rows, min_count=2)


@pytest.mark.parametrize("column", ["phrase", "n", "key", "group"])
def test_clashing_names(spark, column):
    frame = spark.createDataFrame([(1, "a b. " * 40, "en")], f"doc_id long, text string, {column} string")
    found = phrases.collocations(frame, group=column).collect()
    assert [tuple(r)[1:] for r in found] == [(1, "a b", 40, 40, 40, 80, 1_000_000)]
