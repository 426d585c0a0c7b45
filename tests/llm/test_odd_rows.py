"""Every operator on nulls, empty and very long texts, ties, repeated rows, empty tables and clashing names."""

import hashlib

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import (
    bag_minhash,
    chunked_bpe,
    id_blocks,
    line_frequency,
    line_index,
    mixing,
    nn_descent,
    ppm_language,
    toxicity,
    warc_zst,
)


@pytest.fixture(scope="module")
def codec(spark):
    return chunked_bpe.Codec(spark, P.path("byte_bpe_50k.tiktoken"), P.PATTERN)


def test_line_frequency(odd, none):
    rows = line_frequency.judge(odd).collect()
    assert len(rows) == odd.count() and line_frequency.judge(none).count() == 0
    assert all(r["base_failed"] and not r["kept"] and r["n_words"] == 0 for r in rows if not (r["text"] or "").strip())
    assert {r["doc_id"] for r in rows if r["kept"]} == {1, 2, None}
    assert line_frequency.accepted(odd).columns == odd.columns


def test_boilerplate_depletes_a_document(spark):
    shared = "\n".join(" ".join(f"s{i}y{j}" for j in range(20)) for i in range(4))
    rows = [(i, f"{shared}\n{own}", "h") for i in range(30) for own in [" ".join(f"w{i}x{j}" for j in range(200 if i else 1))]]
    judged = line_frequency.judge(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    assert [r["doc_id"] for r in judged.filter("NOT kept AND NOT base_failed").collect()] == [0]


def test_boilerplate_is_removed_from_the_texts(spark, odd):
    common = "Home  | About"
    own = ["\n".join(" ".join(f"w{i}x{j}y{k}" for k in range(20)) for j in range(4)) for i in range(30)]
    rows = [(i, f"{own[i][:50]}\n {common.upper()}\t\n\n{own[i][50:]}\n{common}", "h" if i % 2 else None) for i in range(30)]
    rows += [(30 + i, f"{common}\n{own[i]}", "other") for i in range(5)] + [(35, None, "h"), (36, "", None), (37, common, "h")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    plain = {i: f"{own[i][:50]}\n\n{own[i][50:]}" for i in range(30)}
    found = {r["doc_id"]: r["text"] for r in line_frequency.without_boilerplate(docs).collect()}
    assert found == {**{r[0]: r[1] for r in rows[30:]}, **plain, 37: ""}
    kept = {r["doc_id"]: r["text"] for r in line_frequency.accepted(docs).collect()}
    assert kept == {**plain, **{r[0]: r[1] for r in rows[30:35]}}
    same = [{r["doc_id"] for r in x.collect()} for x in (line_frequency.judge(docs).filter("kept"), line_frequency.accepted(docs))]
    assert same[0] == same[1]
    assert line_frequency.without_boilerplate(odd).exceptAll(odd).count() == 0


def test_a_line_limit_that_does_not_grow_with_the_host(spark):
    shared = " ".join(f"s{j}" for j in range(300))
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(60)) + (f"\n{shared}" if i % 20 == 0 else ""), "hot") for i in range(800)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert line_frequency.judge(docs).filter("kept").count() == 800  # 5 % of the host is below its share
    assert line_frequency.judge(docs, max_docs=40).filter("kept").count() == 800
    judged = line_frequency.judge(docs, max_docs=39)
    assert {r["doc_id"] for r in judged.filter("NOT kept").collect()} == set(range(0, 800, 20))
    left = line_frequency.without_boilerplate(docs, max_docs=39).filter(F.col("text").contains(shared))
    assert left.count() == 0


def test_line_index(odd, none):
    rows = line_index.drop_frequent_lines(odd, min_docs=3).collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert len(rows) == odd.count() and line_index.drop_frequent_lines(none).count() == 0
    assert {(r["n_lines"], r["n_dropped"], r["kept_sha256"]) for r in rows if not r["text"]} >= {(1, 0, empty)}
    assert sum(r["n_dropped"] for r in rows) == 3  # the text of ids 1, 2 and 2


def test_minimal_perfect_hash():
    keys = np.unique(np.random.default_rng(1).integers(0, 2**63, 20_000).astype(np.uint64))
    index = line_index.LineIndex.from_row(line_index.LineIndex.build(keys, np.arange(len(keys))).to_row())
    assert sorted(index.place(keys).tolist()) == list(range(len(keys)))
    assert (index.count(keys) == np.arange(len(keys))).all()
    assert not index.count(keys + np.uint64(1)).any()
    assert line_index.LineIndex.build(keys[:0], keys[:0]).count(keys[:3]).tolist() == [0, 0, 0]


def test_bag_minhash(odd, none):
    rows = bag_minhash.near_duplicates(odd).collect()
    assert len(rows) == odd.count() and bag_minhash.near_duplicates(none).count() == 0
    assert {r["class_id"] for r in rows if r["doc_id"] in (1, 2, None)} == {1, None}
    assert {r["class_id"] for r in rows if r["doc_id"] in (3, 4, 6)} == {3, 4, 6}
    once = bag_minhash.one_of_each(odd)
    assert once.columns == odd.columns and once.filter("doc_id IN (1, 2)").count() == 1


def test_signatures_agree_as_often_as_multisets_overlap():
    words = [f"w{i}" for i in range(600)]
    a, b = " ".join(words[:500]), " ".join(words[60:560] + words[60:200])
    times, _, _ = bag_minhash.signatures([a.encode(), b.encode()], places=4000)
    bags = [np.unique(bag_minhash.shingle_hashes([x.encode()], 5)[0], return_counts=True) for x in (a, b)]
    assert abs((times[0] == times[1]).mean() - bag_minhash.overlap(*bags)) < 0.03


def test_chunks_give_the_ids_of_whole_texts(odd, none, codec):
    whole = chunked_bpe.encode(odd, codec, chunk=10**9)
    cut = chunked_bpe.encode(odd, codec, chunk=64, overlap=16)
    assert sorted(map(str, whole.collect())) == sorted(map(str, cut.collect()))
    back = chunked_bpe.decode(cut, codec).collect()
    assert all(bytes(r["decoded"]).decode() == (r["text"] or "") for r in back)
    assert chunked_bpe.encode(none, codec).count() == 0


def test_a_word_longer_than_the_overlap(spark, codec):
    texts = spark.createDataFrame([("ab " * 20 + "x" * 200 + " cd ef" * 30,), (" " * 300 + "y",)], "text string")
    rows = [chunked_bpe.encode(texts, codec, chunk=n, overlap=8).collect() for n in (32, 10**6)]
    assert sorted(map(str, rows[0])) == sorted(map(str, rows[1]))


def test_id_files(spark, odd, none):
    encoder = id_blocks.TokenizerFile(spark, P.path("byte_bpe_50k.json"), end_id=2)
    rows = id_blocks.read(spark, *id_blocks.write(odd, encoder)).orderBy("start").collect()
    assert len(rows) == odd.count()
    assert [r["start"] for r in rows] == np.cumsum([0, *(r["n_tokens"] for r in rows[:-1])]).tolist()
    assert sorted(r["doc_id"] for r in rows[2:]) == [r["doc_id"] for r in rows[2:]] and rows[0]["doc_id"] is None
    assert id_blocks.read(spark, *id_blocks.write(none, encoder)).count() == 0


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 100_000])
def test_blocks_round_trip(n):
    ids = np.random.default_rng(n).integers(0, 2**17, n).astype(np.uint32)
    ids[::97] = 2**32 - 1
    file = id_blocks.IdFile(id_blocks.pack_file(ids, [7, None], [n // 2, n - n // 2]))
    assert (file.read(0, n) == ids).all() and (file.read(n // 3, n // 2) == ids[n // 3 : n // 2]).all()
    assert file.doc_ids == [7, None]
    with pytest.raises(ValueError):
        id_blocks.IdFile(b"something else" * 9)


def test_archives(spark):
    pages = [(1, "u v", "a"), (2, None, "a"), (3, "x", None), (4, "y", ""), (None, "z", "a"), (5, "w", "b" * 200_000), (1, "u v", "a")]
    table = spark.createDataFrame(pages, "page_id long, url string, html string")
    rows = warc_zst.read_archives(spark, *warc_zst.write_archives(table)).collect()
    assert len(rows) == 7 and all(r["error"] is None for r in rows)
    revisits = {(r["record_id"], r["refers_to_id"]) for r in rows if r["record_type"] == "revisit"}
    assert revisits == {("urn:x-page:2", "urn:x-page:1"), ("urn:x-page:4", "urn:x-page:3")}
    large = warc_zst.read_archives(spark, *warc_zst.write_archives(table, min_bytes=1)).filter("record_type = 'revisit'")
    assert [r["record_id"] for r in large.collect()] == ["urn:x-page:2"]
    assert warc_zst.read_archives(spark, *warc_zst.write_archives(table.limit(0))).count() == 0


def test_broken_records_and_archives_are_told():
    record = warc_zst.record(1, "u", b"payload", None, "2024-01-01T00:00:00Z")
    assert warc_zst.parse_record(record)["error"] is None
    for wrong in (record[:-1], record.replace(b"payload\r", b"pay1oad\r"), record.replace(b"WARC-Date", b"WARC-Data"), b"x"):
        assert warc_zst.parse_record(wrong)["error"]
    import zstandard

    archive = zstandard.compress(record) + zstandard.compress(record)
    assert len(list(warc_zst.frames(archive))) == 2
    for wrong in (archive[:-3], archive + b"junk"):
        with pytest.raises(ValueError):
            list(warc_zst.frames(wrong))


def test_language(odd, none):
    model = ppm_language.train(odd)
    rows = ppm_language.identify(odd, model).collect()
    assert {r["lang_pred"] for r in rows if not (r["text"] or "").strip()} == {"und"}
    assert all(0 <= r["score"] <= 1 for r in rows) and len(rows) == odd.count()
    assert ppm_language.train(none) is None
    assert {r["lang_pred"] for r in ppm_language.identify(odd, None).collect()} == {"und"}


def test_a_rare_language_is_learned_beside_a_large_one(spark):
    signs = np.frombuffer(b"abcdefghijklmnopqrstuvwxyz0123456789 .,;:-", dtype=np.uint8)
    large = signs[np.random.default_rng(1).integers(0, len(signs), 1_500_000)].tobytes().decode()
    rare = "\u03ba\u03b1\u03bb\u03b7\u03bc\u03ad\u03c1\u03b1 \u03ba\u03cc\u03c3\u03bc\u03b5"
    texts = spark.createDataFrame([(large, "large"), (large, "large"), (rare, "rare"), (None, "none")], "text string, lang string")
    model = ppm_language.train(texts)
    assert model.names == ["large", "rare"]
    assert len(model._leaves) == len(np.unique([*ppm_language.grams(ppm_language.plain_bytes(large.encode(), 4), 4), *ppm_language.grams(ppm_language.plain_bytes(rare.encode(), 4), 4)]))
    found = ppm_language.identify(texts.filter("lang = 'rare'"), model).first()
    assert found["lang_pred"] == "rare"


def test_code_lengths_are_those_of_the_definition():
    text = b"abracadabra"
    codes, times = np.unique(ppm_language.grams(ppm_language.plain_bytes(text, 4), 4), return_counts=True)
    tree = ppm_language.ContextTree(codes, times)
    seen = {}
    padded = b"   " + text
    for i in range(3, len(padded)):
        for order in range(4):
            seen.setdefault(padded[i - order : i], []).append(padded[i])
    for probe in (b"abra", b"brab", b"zzza", b"abrz"):
        bits, context = 0.0, probe[:3]
        while True:
            known = seen.get(context, [])
            whole = len(known) + len(set(known))
            if probe[3] in known:
                bits += np.log2(whole / known.count(probe[3]))
                break
            bits += np.log2(whole / len(set(known))) if known else 0
            if not context:
                bits += 8
                break
            context = context[1:]
        assert np.isclose(tree.bits(np.array([int.from_bytes(probe, "big")], dtype=np.uint32))[0], bits)


def test_toxicity(spark, odd, none):
    labels = spark.createDataFrame([(1, 0), (8, 1), (None, 1), (7, None)], "doc_id long, toxic int")
    for table in (odd, none):
        model = toxicity.train(table, labels, corpus=table)
        rows = toxicity.score(table, model).collect()
        assert len(rows) == table.count() and all(0 <= r["score"] <= 1 for r in rows)


def test_obfuscated_words_are_restored(spark):
    text = spark.createDataFrame([("stupid idiot loser the and of thing " * 50,)], "text string")
    restorer = toxicity.Restorer(toxicity.CharacterModel(toxicity.character_counts(text)))
    for written, plain in {"1d10t": "idiot", "st.u.p.i.d": "stupid", "stuuupid": "stupid", "l0$3r!": "loser"}.items():
        assert plain in restorer.words(written)
    assert "stupid" in restorer.text_words("so s t u p i d it is")


def test_mixing(odd, none):
    rows = mixing.mix(odd).collect()
    assert len(rows) == odd.count() and mixing.mix(none).count() == 0
    assert all(0 <= r["probability"] <= 1 for r in rows)
    assert mixing.sampled(odd).columns == odd.columns
    own = mixing.mix(odd, targets={"lang": {"en": 1.0}}).filter("lang <> 'en'").collect()
    assert own and not any(r["sampled"] for r in own)


def test_neighbours(spark):
    rows = [(i, [float(i % 7), 1.0, 0.5]) for i in range(30)] + [(100, None), (101, [0.0] * 3), (102, [float("nan"), 1.0, 1.0])]
    table = spark.createDataFrame([*rows, (103, []), (None, [1.0, 1.0, 1.0])], "vec_id long, embedding array<float>")
    found = nn_descent.search(table, F.col("vec_id") % 20 == 0, k=20).collect()
    vectors = dict(rows[:30])
    for query in (0, 20):
        expected = sorted((-np.dot(vectors[query], v), i) for i, v in vectors.items() if i != query)[:20]
        own = sorted((r["rank"], r["vec_id"]) for r in found if r["query_id"] == query)
        assert [i for _, i in own] == [i for _, i in expected]
    assert {r["query_id"] for r in found} == {0, 20}
    assert nn_descent.search(table.limit(0), F.lit(True)).count() == 0


def test_pipeline(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, small)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
    rows = corpus_pipeline.run(spark, small).collect()
    assert rows and all(r["n_tokens"] * 4 == len(r["ids"]) for r in rows)
    assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in docs.select("doc_id").collect()}


def test_one_of_a_group_of_copies_keeps_its_lines(spark):
    def text(i):
        return "\n".join(" ".join(f"d{i}l{j}w{k}" for k in range(12)) for j in range(6))

    common = "this line stands in every other text"
    rows = [(i, text(0) if i % 2 else f" {text(0).upper()}\r", "en", "a", 1) for i in range(12)]
    rows += [(20 + i, f"{common}\n{text(20 + i)}", "en", "a", 1) for i in range(10)]
    rows += [(40 + i, common if i else None, "en", "a", 1) for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    left = corpus_pipeline.near_dedup(spark, corpus_pipeline.line_dedup(spark, docs, ""), "").collect()
    found = {r["doc_id"]: r["text"] for r in left}
    assert len(left) == len(found) and set(found) == {0, *range(20, 30), 40}
    assert found[0] == rows[0][1] and not found[40]
    assert all(found[20 + i] == text(20 + i) for i in range(10))


def test_equal_lines_have_the_key_of_the_index(spark):
    texts = ["A b\n\n c", "a B \t\n c\n", "c\na b", "\u00c4 b\nc", None, "", " \n"]
    keys = [r[0] for r in spark.createDataFrame([(x,) for x in texts], "text string").select(line_index.lines_key()).collect()]
    plain = [tuple(k for k in map(line_index.line_key, (x or "").encode().split(b"\n")) if k) for x in texts]
    assert [[a == b for b in keys] for a in keys] == [[a == b for b in plain] for a in plain]
