"""Token ids, token files, packing and sharding against plain Python."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from paylane.llm import packing, queries, sharding, token_files, tokens
from paylane.session import work_dir
from tests.llm.conftest import SF


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokens.tokenizer_path(tokens.WORD_BPE))


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_memo_gives_the_library_ids(library):
    odd = ["", " ", "It's we'VE 12 a1b2 ÀÉ ñ ß ÿ µ ª", "<|endoftext|> x<|endoftext|>y dogs' .,;'s é", "\x1c a\x1db", "Σας İ ﬁ 你好 😀"]
    odd += [f"a{chr(c)}b C" for c in (*range(1, 0x250), *range(0x1680, 0x1690), *range(0x2000, 0x2070), 0x3000)]
    for memo in (50, 100_000):
        encoder = tokens.Encoder(tokens.WORD_BPE, memo=memo)
        assert encoder.wordwise
        for text in odd:
            assert encoder.encode(pa.array([text]))[0].tolist() == ids_of(library, text), repr(text)
    ids, sizes = tokens.Encoder(tokens.WORD_BPE).encode(pa.array(odd))
    assert sizes.tolist() == [len(ids_of(library, t)) for t in odd] and len(ids) == sum(sizes)


def test_other_tokenizer_files_get_whole_texts():
    encoder = tokens.Encoder("byte_bpe_50k.json")
    texts = [" two  spaces", "", "é\n"]
    want = [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    ids, sizes = encoder.encode(pa.array(texts))
    assert ids.tolist() == sum(want, []) and sizes.tolist() == [len(x) for x in want]


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_op10(spark, library):
    got = queries.op10_token_files(spark, SF).orderBy("doc_id").collect()
    start = 0
    rows = documents(spark).orderBy("doc_id").collect()
    assert len(got) == len(rows)
    for g, d in zip(got, rows):
        ids = ids_of(library, d["text"]) + [2]
        assert (g["doc_id"], g["start"], g["n_tokens"], g["ids_crc32"]) == (d["doc_id"], start, len(ids), crc(ids))
        start += len(ids)


def test_token_files_read_selectively(spark):
    path = work_dir(spark, "tokens")
    token_files.write_tokens(documents(spark), path, end=2, meta=("lang",))
    part = token_files.read_tokens(spark, path, F.col("doc_id").between(20, 22), ("meta.lang",))
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(doc_id,20)" in plan and "ids:array" not in plan
    whole = {r["doc_id"]: r["start"] for r in token_files.read_tokens(spark, path).collect()}
    assert {r["doc_id"]: r["start"] for r in part.collect()} == {k: whole[k] for k in (20, 21, 22)}


def test_odd_tables(spark, odd, none, clash, library):
    for docs in (odd, none, clash):
        rows = docs.collect()
        path = work_dir(spark, "tokens")
        token_files.write_tokens(docs, path, end=2, meta=("lang",))
        got = token_files.checksums(token_files.read_tokens(spark, path), ["doc_id", "start", "n_tokens"]).collect()
        assert Counter((g["doc_id"], g["ids_crc32"]) for g in got) == Counter((r["doc_id"], crc(ids_of(library, r["text"]) + [2])) for r in rows)
        at = 0
        for g in sorted(got, key=lambda g: g["start"]):
            assert g["start"] == at
            at += g["n_tokens"]
        assert_packed(packing.pack(packing.pieces(docs)).collect(), rows, library)
        assert_shards(docs, work_dir(spark, "shuffled"), 24, spark)


def assert_packed(got, rows, library):
    want = Counter()
    for r in rows:
        ids = ids_of(library, r["text"]) + [0]
        for k in range(0, len(ids), 2048):
            want[r["doc_id"], k // 2048, k, len(ids[k : k + 2048]), crc(ids[k : k + 2048])] += 1
    assert Counter((g["doc_id"], g["piece"], g["start"], g["length"], g["ids_crc32"]) for g in got) == want
    sequences = defaultdict(list)
    for g in got:
        sequences[g["sequence_id"]].append((g["offset"], g["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    return len(sequences)


def test_op6(spark, library):
    got = queries.op6_packing(spark, SF).collect()
    n = assert_packed(got, documents(spark).collect(), library)
    least = -(-sum(g["length"] for g in got) // 2048)
    assert n <= least * 1.02 + 1


def test_genetic_search_is_no_worse_than_best_fit():
    rng = np.random.default_rng(3)
    sizes = rng.integers(300, 1100, 300).tolist()
    pool = packing.Pool(sizes, 2048, np.random.default_rng(1))
    plain = pool.best_fit([], pool.falling(list(range(300))))
    best = pool.evolve([], 6, 60)
    assert sorted(i for b in best for i in b) == list(range(300))
    assert all(pool.room(b) >= 0 for b in best) and pool.fitness(best) >= pool.fitness(plain)
    child = pool.crossover(plain, best)
    assert sorted(i for b in child for i in b) == list(range(300))


def assert_shards(docs, path, shards, spark, **how):
    sharding.write_shuffled(docs, path, **how)
    got = sharding.read_shards(spark, path, shards).collect()
    assert Counter(repr(tuple(r["record"])) for r in got) == Counter(repr(tuple(r)) for r in docs.collect())
    by = defaultdict(list)
    for r in got:
        by[r["shard"]].append(r["slot"])
    counts = [len(by[s]) for s in range(shards)]
    assert all(sorted(v) == list(range(len(v))) for v in by.values()) and max(counts) - min(counts) <= 1
    return got


def test_sharding_over_many_buckets(spark):
    docs = documents(spark)
    got = assert_shards(docs, work_dir(spark, "shuffled"), 24, spark, bucket_bytes=50_000)
    again = assert_shards(docs, work_dir(spark, "shuffled"), 24, spark, bucket_bytes=50_000)
    place = lambda rows: {r["record"]["doc_id"]: (r["shard"], r["slot"]) for r in rows}
    assert place(got) == place(again)
    order = [d for d, _ in sorted(place(got).items(), key=lambda x: x[1])]
    # Neighbours of the shuffled order are not neighbours of the input.
    assert sum(abs(a - b) == 1 for a, b in zip(order, order[1:])) < len(order) / 10


def test_op4(spark):
    got = {r["doc_id"]: r for r in queries.op4_sharding(spark, SF).collect()}
    for d in documents(spark).collect():
        text = (d["text"] or "").encode()
        assert (got[d["doc_id"]]["size"], got[d["doc_id"]]["text_crc32"]) == (len(text) + 8, zlib.crc32(text))
