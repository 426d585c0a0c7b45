"""The lattice's likeliest reading by enumeration, and which words reach the lattice."""

import itertools

import numpy as np
import pytest

from tidemark.llm import toxicity

PLAIN = "a stupid idiot is no loser but the moron was good to the tall student and he is in it at a loss to err " * 30
WEIGHTS = {"stupid": 3.0, "idiot": 3.0, "loser": 3.0, "moron": 3.0, "stup-": 2.5, "idio-": 2.5}


@pytest.fixture(scope="module")
def restorer(spark):
    text = spark.createDataFrame([(PLAIN,)], "text string")
    return toxicity.Restorer(toxicity.CharacterModel(toxicity.character_counts(text)))


@pytest.fixture(scope="module")
def model(restorer):
    return toxicity.ToxicityModel(restorer, WEIGHTS)


def readings(costs, span):
    """Every reading of the span with its least cost, each sign's choices tried in all combinations."""
    signs = list(span + "\0")
    options = [toxicity._readings(sign, before) for sign, before in zip(signs, ["", *signs], strict=False)]
    found = {}
    for choice in itertools.product(*options):
        written, total = [0] * (toxicity.ORDER - 1), 0.0
        for symbol, price in choice:
            total += price
            if symbol is not None and (symbol or written[-1]):
                total += float(costs[(*written[1 - toxicity.ORDER :], symbol)])
                written.append(symbol)
        words = "".join(chr(96 + x) if x else " " for x in written).strip()
        found[words] = min(total, found.get(words, np.inf))
    return found


@pytest.mark.parametrize("span", ["5tup1d", "stuupiid", "m0r0n", "s t u", "i.d i.o t", "l00s3r", "gg66d", "a", "11", "", "stu pid", "t@ll!"])
def test_viterbi_finds_the_cheapest_of_all_readings(restorer, span):
    costs = readings(restorer._model.costs, span)
    assert costs[restorer._model.restore(span)] == pytest.approx(min(costs.values()), rel=1e-6)


WRITTEN = {
    "stuupid": "stupid", "looser": "loser", "sstuupiid": "stupid", "stuuupid": "stupid", "mmoron,": "moron",
    "s t u p i d": "stupid", "s  t  u \n p  i  d": "stupid", "s.t.u.p.i.d": "stupid", "5tup1d": "stupid", "m0r0n": "moron",
    "stu pid": "stupid", "id iot": "idiot", "s-t u-p i-d": "stupid", "STU  PID": "stupid", "the id\niot was": "idiot",
}


@pytest.mark.parametrize("text", WRITTEN)
def test_words_written_in_these_ways_are_evidence(model, text):
    assert model.evidence(text) == model.evidence(WRITTEN[text]) == 3.0


@pytest.mark.parametrize("text", ["", "it is good to go to the tall student", "a stu dent", "he is in it", "id to it", "loss err"])
def test_plain_texts_give_no_evidence(model, text):
    assert model.evidence(text) == 0.0


def test_words_left_out_of_the_lattice_could_be_no_evidence(model, restorer):
    """Tokens of letters that are not decoded when scores are taken have no reading with a weight."""
    letters = ["stupidd", "iidiots", "stup", "stuppp", "loosser", "looserr", "goood", "tall", "iddio", "idi", "moronn", "morons", "z"]
    for token in letters:
        words = restorer.words(token)
        weight = max(WEIGHTS.get(x, 0.0) for word in words for x in [*toxicity.features(word), ""])
        assert max((w for _, w in model._token(token)), default=0.0) == weight


def test_remembered_tokens_give_the_same_words(restorer):
    known = {}
    texts = [*WRITTEN, PLAIN, *WRITTEN]
    assert [restorer.text_words(x, known) for x in texts] == [restorer.text_words(x) for x in texts]


def plain_evidence(model, text):
    """All tokens decoded, and every row of short neighbours of the whole text tried."""
    plain = " ".join(text.lower().split())
    found = {}
    for word in model._restorer.text_words(plain):
        if weight := max((model.weights.get(x, 0.0) for x in toxicity.features(word)), default=0.0):
            found[word] = weight
    found.update(model._pieces(plain))
    return sum(found.values())


def test_places_of_evidence_miss_nothing(restorer):
    """Texts of noise that is near to evidence give what decoding every token gives."""
    model = toxicity.ToxicityModel(restorer, WEIGHTS | {"\u00f6del": 2.5, "bigg": 2.25, "\u00f6de-": 2.0, "gall-": 2.125})
    draw = np.random.default_rng(5)
    parts = ["stup", "id", "idiot", "io", "t", "m0r0n", "l", "oo", "ser", "8166", "big", "g", "\u00f6del", "\u00d6DELN", "ga1", "l", "|", "b"]
    joints = ["", "", "", " ", "  ", "\n", "\u00a0", "\u2003", ".", "-", "_", ",", "!", "1", "\u20ac", "?"]
    evident = 0
    for _ in range(4000):
        text = "".join(x for _ in range(draw.integers(1, 9)) for x in (str(draw.choice(parts)), str(draw.choice(joints))))
        text = " ".join(text) if draw.random() < 0.1 else text
        text = "".join(x * (1 + (draw.random() < 0.1)) for x in text)
        found = model.evidence(text)
        assert found == pytest.approx(plain_evidence(model, text)), text
        evident += found > 0
    assert evident > 1000
    assert toxicity.ToxicityModel(restorer, {}).evidence("stupid") == 0.0
