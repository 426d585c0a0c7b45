"""The queries without SQL, held against plain versions on the small tables."""

import base64
import hashlib
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from tidemark.llm import queries


@pytest.fixture(scope="module")
def rows(small):
    def read(columns, table):
        return duckdb.sql(f"SELECT {columns} FROM '{small}/{table}.parquet' ORDER BY 1").fetchall()

    return read


@pytest.fixture(scope="module")
def run(spark, small):
    return lambda name: queries.REGISTRY[name](spark, small)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_sql_gives_the_same_rows(run, small, name):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{small}/documents.parquet'")
    expected = con.sql(queries.ORACLE[name])
    found = run(name).select(*expected.columns).collect()
    assert sorted(map(tuple, found)) == sorted(expected.fetchall())


def test_bpe_ids_are_those_of_the_library(run, rows):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = set()
    for doc_id, text in rows("doc_id, text", "documents"):
        ids = library.encode_ordinary(text or "")
        sums = [hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), text or "")]
        expected.add((doc_id, len(ids), *sums))
    found = run("op10_chunked_bpe").select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert set(map(tuple, found.collect())) == expected


def test_id_files_hold_what_the_library_encodes(run, rows):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    start, expected = 0, set()
    for doc_id, text in rows("doc_id, text", "documents"):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        expected.add((doc_id, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    found = run("op8_id_blocks").select("doc_id", "start", "n_tokens", "ids_crc32")
    assert set(map(tuple, found.collect())) == expected


def test_archives_hold_every_page(run, rows):
    first, expected = {}, set()
    for page_id, html in rows("page_id, html", "pages"):
        payload = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        refers = first.setdefault(digest, page_id)
        revisit = refers != page_id
        expected.add((page_id, len(payload), digest, "revisit" if revisit else "response", refers if revisit else None, None))
    found = run("op3_warc_zst").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "error")
    assert set(map(tuple, found.collect())) == expected


def test_classes_are_the_components_of_similar_texts(run, rows):
    def bag(text):
        words = "".join(c.lower() if c.isascii() else c for c in text or "").split()
        return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else Counter()

    bags = {i: bag(t) for i, t in rows("doc_id, text", "documents")}
    parent = {i: i for i in bags}

    def top(x):
        return x if parent[x] == x else top(parent[x])

    ids = sorted(bags)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            shared = sum((bags[a] & bags[b]).values())
            if shared and shared >= 0.8 * (sum(bags[a].values()) + sum(bags[b].values()) - shared):
                low, high = sorted((top(a), top(b)))
                parent[high] = low
    found = {r["doc_id"]: r["class_id"] for r in run("op6_bag_minhash").collect()}
    assert found == {i: top(i) for i in ids}


def test_neighbours_are_found(run, rows):
    table = rows("vec_id, embedding", "embeddings")
    ids, vectors = np.array([r[0] for r in table]), np.array([r[1] for r in table], dtype=np.float64)
    found = defaultdict(list)
    for r in run("op2_nn_descent").orderBy("query_id", "rank").collect():
        found[r["query_id"]].append((r["vec_id"], r["score"]))
    hits = []
    for at in np.flatnonzero(ids % 20 == 0):
        near = vectors @ vectors[at]
        near[at] = -np.inf
        best = ids[np.lexsort((ids, -near))[:20]]
        own = found[int(ids[at])]
        assert len(own) == 20 and all(abs(near[list(ids).index(i)] - s) < 1e-12 for i, s in own)
        hits.append(len({i for i, _ in own} & set(best.tolist())) / 20)
    assert np.mean(hits) >= 0.9


def test_mixing_meets_its_marginals(run):
    cells = run("op9_mixing").groupBy("source", "lang", "topic").agg(
        F.sum("words").alias("words"), F.first("weight").alias("weight"), F.first("probability").alias("p")
    ).toPandas()
    for dimension in ("source", "lang", "topic"):
        sums = cells.groupby(dimension, dropna=False)[["words", "weight"]].sum()
        target = sums.words**0.7 / (sums.words**0.7).sum()
        assert np.allclose(sums.weight, target, atol=1e-4)
    assert cells.p.between(0, 1).all()
    assert np.isclose((cells.p * cells.words).sum(), 0.85 * cells.words.sum())


def test_languages_of_held_out_texts(run, rows):
    known = dict(rows("doc_id, lang", "documents"))
    found = run("op7_ppm_language").filter("held_out").collect()
    assert np.mean([r["lang_pred"] == known[r["doc_id"]] for r in found]) >= 0.95


def test_toxic_held_out_texts_score_higher(spark, medium):
    known = dict(duckdb.sql(f"SELECT doc_id, toxic FROM '{medium}/labels.parquet'").fetchall())
    found = queries.REGISTRY["op1_toxicity"](spark, medium).filter("held_out").collect()
    scores = [[r["score"] for r in found if known.get(r["doc_id"]) == y] for y in (0, 1)]
    assert np.mean(scores[1]) > np.mean(scores[0]) + 0.2
    assert all((r["predicted"] == 1) == (r["score"] >= 0.3) for r in found)
