"""Plain Python versions of whole queries that SQL cannot express, held against their rows."""

import base64
import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
import xxhash

import corpus_pipeline
from tidemark.llm import queries, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SPACES = " \t\n\x0b\x0c\r"
NEAR = 1e-4  # a chance this close to its probability may fall on either side


def documents(folder):
    return duckdb.sql(f"SELECT doc_id, text, lang, source FROM '{folder}/documents.parquet' ORDER BY 1").fetchall()


def fold(doc_id, folds):
    return zlib.crc32(str(doc_id).encode()) % folds


def ascii_lower(text):
    return "".join(c.lower() if c.isascii() else c for c in text)


# Mixing.


def topic(text):
    if text is None:
        return "(none)"
    patterns = {"licence": r"(?i)\b(license|licensed|rights reserved)\b", "contact": r"@[A-Za-z0-9]|\(\d{3}\)", "figures": r"\d", "loud": r"!!|[A-Z]{5}"}
    return next((name for name, p in patterns.items() if re.search(p, text, re.ASCII)), "prose")


def chance(doc_id):
    """Spark's hash of the id's text and the integer 7, as a share of 1."""
    seed = xxhash.xxh64(str(doc_id).encode(), seed=42).intdigest()
    return xxhash.xxh64((7).to_bytes(4, "little"), seed=seed).intdigest() % (1 << 53) / (1 << 53)


def mixed(docs):
    """For each document its cell, the cell's weight and the probability to be kept."""
    cell = [(source or "(none)", lang or "(none)", topic(text)) for _, text, lang, source in docs]
    words = [max(1, len(re.split(r"[\x20\x09-\x0D]+", text or ""))) for _, text, _, _ in docs]
    cells = sorted(set(cell))
    size = np.array([sum(w for c, w in zip(cell, words, strict=True) if c == x) for x in cells], dtype=float)
    weight = size.copy()
    sides = [[np.array([c[d] == v for c in cells]) for v in sorted({c[d] for c in cells})] for d in range(3)]
    targets = [np.array([size[s].sum() ** 0.7 for s in side]) for side in sides]
    for _ in range(2000):
        for side, target in zip(sides, targets, strict=True):
            for members, wanted in zip(side, target / target.sum(), strict=True):
                weight[members] *= wanted / weight[members].sum()
    ratio, low, high = weight / size, 0.0, 1.0
    while (np.minimum(1, high * ratio) * size).sum() < 0.85 * size.sum() and high < 1e18:
        high *= 2
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if (np.minimum(1, middle * ratio) * size).sum() < 0.85 * size.sum() else (low, middle)
    at = {c: (weight[i], min(1, high * ratio[i])) for i, c in enumerate(cells)}
    return {d[0]: (c, w, *at[c]) for d, c, w in zip(docs, cell, words, strict=True)}


def test_mixing(spark, small):
    docs = documents(small)
    expected, found = mixed(docs), queries.REGISTRY["op9_mixing"](spark, small).collect()
    assert len(found) == len(docs)
    for r in found:
        cell, words, weight, probability = expected[r["doc_id"]]
        assert (r["source"] or "(none)", r["lang"] or "(none)", r["topic"], r["words"]) == (*cell, words)
        assert r["weight"] == pytest.approx(weight, abs=1e-5) and r["probability"] == pytest.approx(probability, abs=NEAR)
        own = chance(r["doc_id"])
        assert r["sampled"] == (own < probability) or abs(own - probability) < NEAR


# Language.


class Tree:
    """The symbols after each context of up to three bytes."""

    def __init__(self):
        self.after, self.known = defaultdict(Counter), {}

    def learn(self, data):
        for i in range(3, len(data)):
            for order in range(4):
                self.after[data[i - order : i]][data[i]] += 1

    def bits(self, run):
        if run not in self.known:
            total = 0.0
            for order in (3, 2, 1, 0):
                if (symbols := self.after.get(run[3 - order : 3])) is not None:
                    whole = sum(symbols.values()) + len(symbols)
                    if run[3] in symbols:
                        total += math.log2(whole / symbols[run[3]])
                        break
                    total += math.log2(whole / len(symbols))
            else:
                total += 8
            self.known[run] = total
        return self.known[run]


def test_languages(spark, small):
    def padded(text):
        return b"   " + re.sub(rb"[\t\n\x0b\x0c\r]", b" ", ascii_lower(text).encode())

    docs, trees = documents(small), defaultdict(Tree)
    for doc_id, text, lang, _ in docs:
        if lang is not None and text is not None and fold(doc_id, 3) != 1:
            trees[lang].learn(padded(text))
    names = sorted(trees)
    found = {r["doc_id"]: r for r in queries.REGISTRY["op7_ppm_language"](spark, small).collect()}
    assert set(found) == {d[0] for d in docs}
    for doc_id, text, _, _ in docs:
        own = found[doc_id]
        assert own["held_out"] == (fold(doc_id, 3) == 1)
        if not re.search(r"[^\W\d_]", text or ""):
            assert (own["lang_pred"], own["score"]) == ("und", 0.0)
            continue
        data = padded(text)
        lengths = [sum(trees[n].bits(data[i - 3 : i + 1]) for i in range(3, len(data))) for n in names]
        assert own["lang_pred"] == names[int(np.argmin(lengths))]
        assert own["score"] == pytest.approx(1 / sum(2 ** -((x - min(lengths)) * 0.1) for x in lengths), abs=1e-3)


# Toxicity.


def test_toxicity(spark, medium):
    """Evidence counted row by row, without looking for its places first."""
    docs = {d[0]: d[1] or "" for d in documents(medium)}
    labels = duckdb.sql(f"SELECT doc_id, max(toxic) FROM '{medium}/labels.parquet' WHERE toxic IS NOT NULL GROUP BY 1").fetchall()
    restorer = toxicity.Restorer(toxicity.CharacterModel(toxicity.character_counts(spark.read.parquet(f"{medium}/documents.parquet"))))
    sample = {}
    for doc_id, label in labels:
        if fold(doc_id, 4) != 2 and doc_id in docs:
            sample[docs[doc_id]] = max(label, sample.get(docs[doc_id], 0))
    known = {}
    words = {text: restorer.text_words(text, known) for text in {*sample, *docs.values()}}
    half = {text: xxhash.xxh64(text.encode(), seed=42).intdigest() % 2 for text in sample}

    def weights(halves):
        rows = [(label, {f for w in words[text] for f in toxicity.features(w)}) for text, label in sample.items() if half[text] in halves]
        n = Counter(label for label, _ in rows)
        count = {label: Counter(f for y, own in rows if y == label for f in own) for label in (0, 1)}
        logs = {f: math.log((k + 0.5) / (n[1] + 1)) - math.log((count[0][f] + 2) / (n[0] + 4)) for f, k in count[1].items() if k >= max(4, 0.01 * n[1])}
        return {f: w for f, w in logs.items() if w >= 2}

    def evidence(text, own):
        seen = {w: max((own.get(f, 0.0) for f in toxicity.features(w)), default=0.0) for w in words[text]}
        plain = " ".join(text.lower().split())
        seen.update(toxicity.ToxicityModel(restorer, own)._pieces(plain))
        return sum(seen.values())

    crossed = [weights((1,)), weights((0,))]
    x = np.array([evidence(text, crossed[half[text]]) for text in sample])
    beta = toxicity._logistic(x, np.array(list(sample.values())))
    every = weights((0, 1))
    found = queries.REGISTRY["op1_toxicity"](spark, medium).collect()
    assert {r["doc_id"] for r in found} == set(docs) and every
    for r in found:
        e = evidence(docs[r["doc_id"]], every)
        score = 1 / (1 + math.exp(-(beta @ [1, math.log1p(e), min(e, 50) / 10])))
        assert r["score"] == pytest.approx(score, abs=1e-6)
        assert (r["held_out"], r["predicted"]) == (fold(r["doc_id"], 4) == 2, int(r["score"] >= 0.3))


# The pipeline.


def accepted(docs):
    """Documents that pass the base rules and keep 30 % of their different lines, without their hosts' boilerplate."""

    def key(line):
        return line.strip(SPACES).lower()

    texts = defaultdict(set)
    for _, text, _, source in docs:
        texts[source].add(text)
    common = {}
    for host, own in texts.items():
        held = Counter(k for t in own if t is not None for k in {key(x) for x in t.split("\n")} if k)
        common[host] = {k for k, n in held.items() if n > 10 and n > 0.1 * len(own)}
    kept = []
    for doc_id, text, lang, source in docs:
        words = WORD.findall(text or "")
        windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
        covered = {i + j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(3)}
        if len(words) < 50 or 100 * len(covered) > 50 * len(words):
            continue
        lines = {key(x) for x in text.split("\n")} - {""}
        whole, left = (sum(map(len, x)) for x in (lines, lines - common[source]))
        if left == whole or left >= 0.3 * whole:
            kept.append((doc_id, "\n".join(x for x in text.split("\n") if key(x) not in common[source]), lang, source))
    return kept


def without_frequent_lines(docs):
    """Lines that ten or more documents hold go; documents with the same line keys count once."""

    def key(line):
        return ascii_lower(line.strip(SPACES))

    bodies = {tuple(k for k in map(key, (d[1] or "").split("\n")) if k) for d in docs}
    held = Counter(k for body in bodies for k in set(body))
    return [(d[0], "\n".join(x for x in d[1].split("\n") if held[key(x)] < 10), *d[2:]) for d in docs]


def first_of_each(docs):
    """The smallest id of each class of similar texts; texts without words are one class."""

    def bag(text):
        words = WORD.findall(ascii_lower(text))
        return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else Counter()

    bags = {d[0]: bag(d[1]) for d in docs}
    parent = {i: i for i in bags}

    def top(x):
        return x if parent[x] == x else top(parent[x])

    holders = defaultdict(list)
    for i in sorted(bags):
        for shingle in bags[i] or [()]:
            holders[shingle].append(i)
    for a, b in {(a, b) for ids in holders.values() for n, a in enumerate(ids) for b in ids[n + 1 :]}:
        shared = sum((bags[a] & bags[b]).values())
        if shared >= 0.8 * (sum(bags[a].values()) + sum(bags[b].values()) - shared):
            low, high = sorted((top(a), top(b)))
            parent[high] = low
    return [d for d in docs if top(d[0]) == d[0]]


def test_pipeline(spark, medium):
    import tiktoken

    docs = first_of_each(without_frequent_lines(accepted(documents(medium))))
    probability = {i: x[-1] for i, x in mixed(docs).items()}
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = {d[0]: library.encode_ordinary(d[1]) for d in docs}
    found = {r["doc_id"]: np.frombuffer(r["ids"], dtype="<u4").tolist() for r in corpus_pipeline.run(spark, medium).collect()}
    assert found and set(found) <= set(expected)
    for doc_id, ids in expected.items():
        own = chance(doc_id)
        if abs(own - probability[doc_id]) > NEAR:
            assert (doc_id in found) == (own < probability[doc_id])
        assert found.get(doc_id, ids) == ids
