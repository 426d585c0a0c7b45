"""Toxicity scores of text restored from obfuscation by a noisy channel.

Written words are taken as noisy forms of plain ones. The channel writes letters
as look-alike signs, repeats them, and puts spaces or signs between them. All
plain readings of a word form a lattice of characters; the likeliest one under a
character language model of the whole corpus is found by the Viterbi algorithm.
Words with one reading only are left as they are. Where scores are taken, so are
words none of whose readings could be evidence, which changes no score.

Words and word beginnings that labelled toxic documents have far more often
than others are evidence; a logistic function of a document's evidence is its
score. Labels are used for nothing else.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import utf8
from tidemark.sources.shared import materialize

# The letters that a sign may stand for.
LOOK_ALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "<": "c",
}
SEPARATORS = ".-_*~^"

# Costs in nats of what the channel does.
_LOOK_ALIKE, _REPEATED, _SEPARATED, _BREAK = 1.0, 0.3, 0.6, 1.5
ORDER = 4
SYMBOLS = 27  # a word's end, a to z

# Labelled rows that the evidence and the logistic function are learned from, at most.
SAMPLE_ROWS = 20_000
# A feature of evidence occurs in this share of toxic rows, and in so many, and is this much (nats) likelier there:
# at most 100 times as many as a toxic row of the sample has on average.
LEAST_SHARE, LEAST_ROWS, LEAST_WEIGHT = 0.01, 4, 2.0
# Other rows that every feature is taken to occur in besides, so that a rare one is not much evidence.
_DOUBT = 2.0
THRESHOLD = 0.3
_PREFIXES = (4, 5, 6)
_MEMO = 300_000

_SYMBOL = np.zeros(256, dtype=np.int64)
_SYMBOL[97:123] = np.arange(1, 27)
_SYMBOL[65:91] = np.arange(1, 27)

# Letters and signs that may stand for the same letter as one sign of them, nothing for what may be skipped, one sign
# for all others. Bytes of other characters are their own.
_SIGN = np.arange(256, dtype=np.uint8)
_SIGN[:128] = 1
_SIGN[97:123] = np.arange(97, 123)
for _sign, _letters in LOOK_ALIKES.items():
    _SIGN[ord(_sign)] = ord(_letters[0])
    for _letter in _letters[1:]:
        _SIGN[_SIGN == ord(_letter)] = ord(_letters[0])
_SIGN[[32, *SEPARATORS.encode()]] = 0

_SPACED = re.compile(r"(?<!\S)\S(?:\s+\S(?!\S)){2,}")
_HAS_SPACED = re.compile(r"\s\S\s+\S\s")
# Neighbours of up to four letters, which a word may have been cut into.
_PIECE = rf"[A-Za-z](?:[{re.escape(SEPARATORS)}]?[A-Za-z]){{0,3}}"
_PIECES = re.compile(rf"(?<!\S){_PIECE}(?:\s+{_PIECE}(?!\S))+", re.ASCII)
_LETTERS = re.compile("[a-z]+")
_WORD = re.compile(r"[^\W\d_]+")
_NOISY = re.compile(rf"[^\W\d_].*[{re.escape(''.join(LOOK_ALIKES) + SEPARATORS)}]|[{re.escape(''.join(LOOK_ALIKES) + SEPARATORS)}].*[^\W\d_]", re.S)
_REPEATS = re.compile(r"([^\W\d_])\1")
_REPEATED_LETTER = re.compile(r"(.)\1+")
_NO_LETTERS = re.compile("[^a-z]+")
# What stands at a word's end is rarely a letter.
_EDGES = "\"'()[]{}<>,;:?.!-_*~^|+"


class CharacterModel:
    """Interpolated character n-grams over a to z and the end of a word."""

    def __init__(self, counts: np.ndarray) -> None:
        """``counts`` of all runs of ORDER symbols, flat."""
        table = counts.reshape((SYMBOLS,) * ORDER).astype(np.float64)
        chance = np.full(SYMBOLS, 1 / SYMBOLS)
        for order in range(1, ORDER + 1):
            own = table.sum(axis=tuple(range(ORDER - order)))
            total, kinds = own.sum(axis=-1, keepdims=True), (own > 0).sum(axis=-1, keepdims=True)
            chance = (own + np.maximum(kinds, 1) * chance) / (total + np.maximum(kinds, 1))
        self.costs = -np.log(chance).astype(np.float32)

    def restore(self, span: str) -> str:
        """The likeliest plain reading, words separated by spaces."""
        start = (0,) * (ORDER - 1)
        states: dict[tuple, tuple[float, tuple]] = {start: (0.0, ())}
        costs = self.costs
        previous = ""
        for sign in span + "\0":
            options = _readings(sign, previous)
            reached: dict[tuple, tuple[float, tuple]] = {}
            for context, (cost, path) in states.items():
                for symbol, price in options:
                    if symbol is None or (symbol == 0 and context[-1] == 0):  # nothing written, or the word has ended
                        after, total, way = context, cost + price, path
                    else:
                        after = (*context[1:], symbol)
                        total, way = cost + price + float(costs[context][symbol]), (path, symbol)
                    if after not in reached or total < reached[after][0]:
                        reached[after] = (total, way)
            states = reached
            previous = sign
        path = min(states.values(), key=lambda x: x[0])[1]
        symbols = []
        while path:
            path, symbol = path
            symbols.append(symbol)
        return "".join(chr(96 + s) if s else " " for s in reversed(symbols)).strip()


def _readings(sign: str, previous: str) -> list[tuple[int | None, float]]:
    """What a written sign may stand for (a symbol, or None for nothing), and at what cost."""
    if "a" <= sign <= "z":
        plain = [(ord(sign) - 96, 0.0)]
        return [*plain, (None, _REPEATED)] if sign == previous else plain
    if sign in LOOK_ALIKES:
        letters = [(ord(x) - 96, _LOOK_ALIKE) for x in LOOK_ALIKES[sign]]
        return [*letters, (0, _BREAK), *([(None, _REPEATED)] if sign == previous else [])]
    if sign in SEPARATORS or sign.isspace():
        return [(None, _SEPARATED), (0, 0.0)]
    return [(0, 0.0)]


def character_counts(df: DataFrame, text: str = "text") -> np.ndarray:
    """How often each run of ORDER symbols occurs in all texts; at most SYMBOLS ** ORDER rows reach the driver."""
    size = SYMBOLS**ORDER

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            for value in utf8(batch.column(0)):
                for at in range(0, len(value), 1 << 20):
                    symbols = _SYMBOL[np.frombuffer(value[at : at + (1 << 20)], dtype=np.uint8)]
                    ends = symbols == 0
                    symbols = np.concatenate([np.zeros(ORDER - 1, dtype=np.int64), symbols[~(ends & np.roll(ends, 1))], [0]])
                    codes = np.zeros(len(symbols) - ORDER + 1, dtype=np.int64)
                    for i in range(ORDER):
                        codes = codes * SYMBOLS + symbols[i : i + len(codes)]
                    total += np.bincount(codes, minlength=size)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["run", "times"])

    runs = df.select(text).mapInArrow(count, "run long, times long").groupBy("run").agg(F.sum("times").alias("times"))
    rows = runs.toArrow()
    counts = np.zeros(size, dtype=np.int64)
    counts[rows.column("run").to_numpy()] = rows.column("times").to_numpy()
    return counts


class Restorer:
    """Plain words of written tokens."""

    def __init__(self, model: CharacterModel) -> None:
        self._model = model

    def words(self, token: str) -> list[str]:
        token = token.lower()
        if " " in token:
            return self._model.restore(token).split()
        if token.isalpha() and not _REPEATS.search(token):
            return [token]
        bare = token.strip(_EDGES)
        plain = _WORD.findall(token)
        if _REPEATS.search(bare) or _NOISY.search(bare) or bare != token and _NOISY.search(token.rstrip(",;:?.")):
            return [*plain, *self._model.restore(token.rstrip(",;:?.")).split()]
        return plain

    def text_words(self, text: str, known: dict[str, list[str]] | None = None) -> set[str]:
        """Different plain words of a text; ``known`` remembers those of tokens."""
        known = {} if known is None else known
        found: set[str] = set()
        for token in tokens(text):
            words = known.get(token)
            if words is None:
                words = self.words(token)
                if len(known) >= _MEMO:
                    known.clear()
                if len(token) < 64:
                    known[token] = words
            found.update(words)
        return found


def spaced(text: str) -> list[str]:
    """Single signs in a row, as they are when a word is spaced out."""
    if not _HAS_SPACED.search(f" {text} "):
        return []
    return [" ".join(m[0].split()) for m in _SPACED.finditer(text)]


def tokens(text: str) -> set[str]:
    """The different tokens of a text; single signs in a row also as one."""
    return {*text.split(), *spaced(text)}


def features(word: str) -> list[str]:
    """The word and its beginnings."""
    return [word, *(f"{word[:n]}-" for n in _PREFIXES if len(word) > n)] if len(word) > 2 else []


def _squeezed(word: str) -> str:
    """The word with each letter written once where it is repeated: the same for all readings of letters."""
    return _REPEATED_LETTER.sub(r"\1", word)


def _signs(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The runs of equal signs in UTF-8 without what may be skipped: each one's sign, first and last place."""
    signs = _SIGN[np.frombuffer(data, dtype=np.uint8)]
    places = np.flatnonzero(signs)
    signs = signs[places]
    change = np.flatnonzero(signs[1:] != signs[:-1])
    starts = np.concatenate([[0], change + 1]) if len(signs) else change
    ends = np.append(change, len(signs) - 1) if len(signs) else change
    return signs[starts], places[starts], places[ends]


class ToxicityModel:
    """Weights of the features that are evidence, and the logistic function of their sum."""

    def __init__(self, restorer: Restorer, weights: dict[str, float]) -> None:
        self._restorer, self.weights = restorer, weights
        self.beta = np.zeros(3)
        self._known: dict[str, tuple[tuple[str, float], ...]] = {}
        self._words = {_squeezed(x) for x in weights if not x.endswith("-")}
        self._begun = {_squeezed(x[:-1]) for x in weights if x.endswith("-")}
        self._exact = {x for x in weights if not x.endswith("-")}
        self._longest = max(map(len, self._exact), default=0)
        self._finder = ahocorasick.Automaton()
        for feature in weights:
            runs = _signs(feature.removesuffix("-").encode())[0].tobytes().decode("latin-1")
            self._finder.add_word(runs, len(runs))
        self._finder.make_automaton()

    def _may_be_evidence(self, word: str) -> bool:
        """Whether a reading of the letters could be evidence."""
        squeezed = _squeezed(word)
        return squeezed in self._words or any(squeezed[:n] in self._begun for n in range(1, max(_PREFIXES) + 1))

    def _token(self, token: str) -> tuple[tuple[str, float], ...]:
        """The evidence of a token: its words with their largest weights."""
        found = []
        lower = token.lower()
        if _LETTERS.fullmatch(lower.rstrip(",;:?.")) and not self._may_be_evidence(lower.rstrip(",;:?.")):
            return ()
        for word in self._restorer.words(token):
            if weight := max((self.weights.get(x, 0.0) for x in features(word)), default=0.0):
                found.append((word, weight))
        return tuple(found)

    def _places(self, data: bytes) -> Iterator[str]:
        """The tokens of a text around each place where a reading could be evidence, those that touch it together.

        Every way to write a feature has its runs of signs, whatever stands in between; few places of a text do.
        """
        if not self.weights:
            return
        signs, firsts, lasts = _signs(data)
        start = end = -1
        for at, length in self._finder.iter(signs.tobytes().decode("latin-1")):
            low, high = int(firsts[at - length + 1]), int(lasts[at])
            if start <= low and high < end:
                continue
            start, end = data.rfind(b" ", 0, low) + 1, data.find(b" ", high)
            end = end if end >= 0 else len(data)
            yield data[start:end].decode()

    def _pieces(self, text: str) -> Iterator[tuple[str, float]]:
        """Words of evidence that neighbouring short pieces spell and are likeliest to be together."""
        for run in _PIECES.finditer(text):
            pieces = run[0].split()
            bare = [_NO_LETTERS.sub("", x) for x in pieces]
            for i in range(len(pieces) - 1):
                joined = bare[i]
                for j in range(i + 1, len(pieces)):
                    joined += bare[j]
                    if len(joined) > self._longest:
                        break
                    if joined in self._exact:
                        for word in self._restorer.words(" ".join(pieces[i : j + 1])):
                            if word in self.weights:
                                yield word, max(self.weights.get(x, 0.0) for x in features(word))

    def _remembered(self, token: str) -> tuple[tuple[str, float], ...]:
        found = self._known.get(token)
        if found is None:
            found = self._token(token)
            if len(self._known) >= _MEMO:
                self._known.clear()
            if len(token) < 64:
                self._known[token] = found
        return found

    def evidence(self, text: str) -> float:
        plain = " ".join(text.lower().split())
        seen: dict[str, float] = {}
        near = set(self._places(plain.encode("utf-8", "replace")))
        for place in near:
            for token in place.split():
                seen.update(self._remembered(token))
            if " " in place:
                seen.update(self._pieces(place))
        if near:
            for span in spaced(plain):
                seen.update(self._remembered(span))
        return math.fsum(seen.values())

    def score(self, text: str) -> float:
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, float(_basis(self.evidence(text)) @ self.beta)))))


def _sample(df: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, rows: int) -> DataFrame:
    """Different texts of at most ``rows`` labelled documents, chosen by the hash of their ids, in two halves."""
    one = labels.filter(F.col(label).isNotNull() & F.col(doc_id).isNotNull())
    one = one.groupBy(F.col(doc_id).alias("_id")).agg(F.max(label).alias("_label"))
    chosen = F.broadcast(one.orderBy(F.xxhash64("_id"), "_id").limit(rows))
    known = df.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).join(chosen, "_id")
    return known.groupBy(F.xxhash64("_text").alias("__key")).agg(
        F.first("_text").alias("_text"), F.max("_label").cast("int").alias("_label")
    ).withColumn("_half", F.pmod(F.col("__key"), F.lit(2)).cast("int"))


def _feature_counts(sample: DataFrame, restorer: Restorer) -> DataFrame:
    """For each feature the toxic and the other rows of each half that have it."""
    schema = pa.schema([("feature", pa.string()), ("half", pa.int32()), ("label", pa.int32()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list[str]] = {}
        for batch in batches:
            totals: Counter = Counter()
            for value, half, label in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                own = {x for word in restorer.text_words(value or "", known) for x in features(word)}
                totals.update((x, half, label) for x in own)
            rows = list(zip(*totals, strict=True)) if totals else [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip([*rows, totals.values()], schema)], schema=schema)

    found = sample.select("_text", "_half", "_label").mapInArrow(count, "feature string, half int, label int, n long")
    cells = [F.sum(F.when((F.col("half") == h) & (F.col("label") == y), F.col("n")).otherwise(0)).alias(f"n{h}{y}") for h in (0, 1) for y in (0, 1)]
    return found.groupBy("feature").agg(*cells)


def _weights(counts: DataFrame, sizes: dict[tuple[int, int], int], halves: tuple[int, ...]) -> dict[str, float]:
    """Features that are evidence by these halves' rows, with their log ratios."""
    n_toxic, n_other = (sum(sizes.get((h, y), 0) for h in halves) for y in (1, 0))
    if not n_toxic or not n_other:
        return {}
    toxic, other = (sum((F.col(f"n{h}{y}") for h in halves), F.lit(0)) for y in (1, 0))
    weight = F.log((toxic + 0.5) / (n_toxic + 1.0)) - F.log((other + _DOUBT) / (n_other + 2 * _DOUBT))
    found = counts.filter(toxic >= max(LEAST_ROWS, LEAST_SHARE * n_toxic)).select("feature", weight.alias("weight"))
    return {r["feature"]: r["weight"] for r in found.filter(F.col("weight") >= LEAST_WEIGHT).collect()}


def _basis(evidence: np.ndarray) -> np.ndarray:
    evidence = np.asarray(evidence, dtype=np.float64)
    return np.stack([np.ones_like(evidence), np.log1p(evidence), np.minimum(evidence, 50) / 10], axis=-1)


def _logistic(evidence: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Coefficients of a ridge logistic regression on the basis, by Newton steps."""
    design = _basis(evidence)
    beta, ridge = np.zeros(design.shape[1]), np.diag([1e-3, 1e-2, 1e-2])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (p - y) + ridge @ beta
        step = np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + ridge, gradient)
        beta = beta - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return beta


def train(
    df: DataFrame,
    labels: DataFrame,
    corpus: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    sample_rows: int = SAMPLE_ROWS,
) -> ToxicityModel:
    """Learn the character model from the corpus, evidence and score from a sample of labelled documents.

    The logistic function is fitted to evidence that the other half of the sample
    gives; the evidence used is that of both. Documents with several labels are
    toxic if one of them is. Without toxic or without other documents there is no
    evidence, and the score is the toxic share.
    """
    restorer = Restorer(CharacterModel(character_counts(corpus, text)))
    sample = materialize(_sample(df, labels, doc_id, text, label, sample_rows), "toxicity-sample")
    sizes = {(r["_half"], r["_label"]): r["count"] for r in sample.groupBy("_half", "_label").count().collect()}
    counts = materialize(_feature_counts(sample, restorer), "toxicity-features")
    model = ToxicityModel(restorer, _weights(counts, sizes, (0, 1)))
    measured = []
    for half in (0, 1):
        other = ToxicityModel(restorer, _weights(counts, sizes, (1 - half,)))
        own = _map_texts(sample.filter(F.col("_half") == half).select("_label", "_text"), "_text", other, "evidence")
        measured.append(own.select("_label", "evidence").toArrow())
    x = np.concatenate([t.column("evidence").to_numpy() for t in measured])
    y = np.concatenate([t.column("_label").to_numpy() for t in measured])
    if model.weights and 0 < y.sum() < len(y):
        model.beta = _logistic(x, y)
    else:
        share = (y.sum() + 0.5) / (len(y) + 1)
        model.beta[0] = math.log(share / (1 - share))
    return model


def _map_texts(df: DataFrame, text: str, model: ToxicityModel, measure: str) -> DataFrame:
    """Add the model's ``evidence`` or ``score`` of each text, in place of the text."""
    columns = [c for c in df.columns if c != text]
    fields = df.select(*[F.col(c) for c in columns]).schema.add(measure, "double")
    sent = df.sparkSession.sparkContext.broadcast(model)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = getattr(sent.value, measure)
        for batch in batches:
            found = [own(x.as_py() or "") for x in batch.column(len(columns))]
            arrays = [batch.column(i) for i in range(len(columns))]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(found, pa.float64())], names=[*columns, measure])

    return df.select(*columns, text).mapInArrow(apply, fields)


def score(df: DataFrame, model: ToxicityModel, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Add ``score`` and ``predicted`` to the other columns, without the text; columns with these names are replaced.

    Null texts count as empty ones, which have no evidence. Every row is scored
    by its whole text alone.
    """
    own = df.drop("score", "predicted")
    predicted: Column = F.when(F.col("score") >= threshold, 1).otherwise(0)
    return _map_texts(own, text, model, "score").withColumn("predicted", predicted)
