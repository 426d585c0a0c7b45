"""Token ids from units against the library's for whole texts."""

import random

import pyarrow.parquet as pq
import pytest

tokenizers = pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")

from tidemark.llm import id_blocks  # noqa: E402

PIECES = [
    " ", "  ", "\n", " \n", "\t", " ", " ", "'s", "'", "a", "The", "ß", "é", "Ċ", "Ġ", "中", "ⅷ", "́", "1", "_",
    ".", "###", "#\n", "x\n\ny", "Word.\nNext", "<|endoftext|>", "<|endoftext", "|>",
]
PLACED = ["<|endoftext|>", "<|endoftext|> b", "a <|endoftext|> b", "a<|endoftext|>b", "a b <|endoftext|>"]


@pytest.fixture(scope="module")
def stored(small):
    return [x or "" for x in pq.read_table(f"{small}/documents.parquet").column("text").to_pylist()]


@pytest.mark.parametrize("added_tokens", [False, True])
def test_units_give_the_ids_of_the_library(spark, stored, added_tokens):
    path = public_tokenizers.path("byte_bpe_50k.json")
    pick = random.Random(7)
    texts = ["", " ", "  ", " a ", *PLACED, "long " * 50_000, "x" * 3000]
    texts += ["".join(pick.choice(PIECES) for _ in range(pick.randint(1, 30))) for _ in range(4000)]
    texts += stored
    library = tokenizers.Tokenizer.from_file(path)
    library.encode_special_tokens = not added_tokens
    expected = [x.ids + [2] for x in library.encode_batch(texts, add_special_tokens=False)]
    encode = id_blocks.TokenizerFile(spark, path, end_id=2, added_tokens=added_tokens)()
    assert [x.tolist() for x in encode(texts)] == expected
    assert [x.tolist() for at in range(0, len(texts), 700) for x in encode(texts[at : at + 700])] == expected


def test_added_tokens_are_one_id_only_if_asked_for(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    one = id_blocks.TokenizerFile(spark, path, end_id=2, added_tokens=True)()
    text = id_blocks.TokenizerFile(spark, path, end_id=2)()
    assert one(["a <|endoftext|> b"])[0].tolist() == [64, 220, 50256, 275, 2]
    assert 50256 not in text(PLACED[2:3])[0]


def test_forgetting_units_changes_no_ids(spark, stored, monkeypatch):
    texts = stored[:200]
    whole = id_blocks.TokenizerFile(spark, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    expected = [x.tolist() for x in whole()(texts)]
    monkeypatch.setattr(id_blocks.TokenizerFile, "_MEMO", 10)
    encode = whole()
    assert [x.tolist() for at in range(0, len(texts), 20) for x in encode(texts[at : at + 20])] == expected


def test_rows_of_one_id_are_spread_and_kept(spark):
    texts = [f"word{i} of one id" for i in range(300)] + [None, "", ""]
    docs = spark.createDataFrame([(None if i % 2 else 5, x) for i, x in enumerate(texts)], "doc_id long, text string")
    encoder = id_blocks.TokenizerFile(spark, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so small a table would be one partition
    try:
        folder, files = id_blocks.write(docs, encoder, file_ids=50)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    found = id_blocks.read(spark, folder, files).orderBy("start").collect()
    assert [r["doc_id"] for r in found] == [None] * 151 + [5] * 152
    sizes = [r["n_tokens"] for r in found]
    assert [r["start"] for r in found] == [sum(sizes[:i]) for i in range(len(sizes))]
    assert files.select("part").distinct().count() > 1


def test_a_worker_keeps_what_it_learned_for_its_next_task(spark, stored, monkeypatch):
    encoder = id_blocks.TokenizerFile(spark, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    learned = []
    learn = id_blocks._Units._learn
    monkeypatch.setattr(id_blocks._Units, "_learn", lambda self, units: (learned.append(len(units)), learn(self, units))[1])
    first = [x.tolist() for x in encoder()(stored[:100])]
    again = [x.tolist() for x in encoder()(stored[:100])]
    assert first == again and learned and sum(learned[len(learned) // 2 :]) == 0
