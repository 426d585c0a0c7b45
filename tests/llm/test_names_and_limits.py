"""Tables with the names that operators use inside, searches for many neighbours, and targets that are hard to meet."""

import warnings

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tidemark.llm import bag_minhash, chunked_bpe, line_frequency, line_index, mixing, nn_descent

INSIDE = [
    "_m", "_bare", "_host", "_line", "__key", "_chars", "_total", "_lines", "_text", "_common", "_lost", "_docs", "_most",
    "_frequent", "_hash", "_source", "_lang", "_topic", "_target", "_sum", "_t_source", "_t_lang", "_t_topic", "_ratio",
    "_scale", "_fits", "_ids", "_id", "_M", "caller_m",
]


@pytest.fixture(scope="module")
def docs(spark):
    words = " ".join(f"word{i}" for i in range(80))
    rows = [(i, f"{words} {i % 4}\nshared line", "en", f"s{i % 2}") for i in range(24)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    names = [n for n in INSIDE if n != "_M"]  # names that differ in case alone cannot be told apart
    return frame.withColumns({name: F.concat(F.lit(f"{name} of "), F.col("doc_id").cast("string")) for name in names})


def own_columns(found, docs):
    """The table's own columns are all there, with the values they had."""
    extra = [c for c in docs.columns if c.startswith(("_", "caller"))]
    rows = found.select("doc_id", *extra).collect()
    assert rows and all(r[c] == f"{c} of {r['doc_id']}" for r in rows for c in extra)


def test_columns_with_inner_names_are_carried(spark, docs):
    codec = chunked_bpe.Codec(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    encoded = chunked_bpe.encode(docs, codec, chunk=64, overlap=16)
    for found in (
        line_frequency.judge(docs),
        line_frequency.judge(docs, remove=True),
        line_frequency.accepted(docs),
        line_frequency.without_boilerplate(docs),
        line_index.drop_frequent_lines(docs),
        bag_minhash.one_of_each(docs),
        mixing.mix(docs),
        mixing.sampled(docs),
        encoded,
        chunked_bpe.decode(encoded, codec),
    ):
        own_columns(found, docs)


def test_parameters_may_name_such_columns(spark):
    frame = spark.createDataFrame([(1, "a\nb", "h"), (2, "a\nc", "h")], "_id long, _text string, _host string")
    found = line_index.drop_frequent_lines(frame, min_docs=2, text="_text", doc_id="_id")
    assert sorted((r["_id"], r["_text"]) for r in found.collect()) == [(1, "b"), (2, "c")]
    judged = line_frequency.judge(frame, host="_host", text="_text", keep=["_id"])
    assert sorted(r["_id"] for r in judged.collect()) == [1, 2] and "_text" not in judged.columns


def test_as_many_neighbours_as_asked_for(spark):
    vectors = np.random.default_rng(1).standard_normal((300, 16))
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    found = nn_descent.search(frame, F.col("vec_id") % 100 == 0, k=100).groupBy("query_id").count().collect()
    assert {r["query_id"]: r["count"] for r in found} == {0: 100, 100: 100, 200: 100}


def test_slow_targets_are_met_and_contradictions_told(spark):
    """Nearly separate groups take many sweeps; two that share no cell can never meet unequal targets."""
    def cells(shared):
        rows = [("a", "x", "t", 1000), ("b", "y", "t", 1000), ("a", "y", "t", shared)]
        return spark.createDataFrame([r for r in rows if r[3]], "source string, lang string, topic string, words long")

    targets = {
        "source": spark.createDataFrame([("a", 0.6), ("b", 0.4)], "source string, _target double"),
        "lang": spark.createDataFrame([("x", 0.5), ("y", 0.5)], "lang string, _target double"),
    }
    with warnings.catch_warnings():
        warnings.simplefilter("error", UserWarning)
        met = mixing.rake(cells(30), targets)
    sums = {r[0]: r[1] for r in met.groupBy("source").agg(F.sum("weight")).collect()}
    assert abs(sums["a"] - 0.6) < 1e-5 and abs(sums["b"] - 0.4) < 1e-5
    with pytest.warns(UserWarning, match="contradict"):
        mixing.rake(cells(0), targets)
