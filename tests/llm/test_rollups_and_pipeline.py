"""Token count rollups, the pipeline's stages, and the registered queries."""

from collections import Counter

import pyarrow as pa
import pytest

import __spark_entry__ as contract
import check
import corpus_pipeline
from paylane.llm import queries, rollups
from paylane.session import settings, work_dir
from tests.llm.conftest import SF

DELTAS = "source string, lang string, version string, n_docs long, n_tokens long"


def totals(store):
    return {tuple(r)[:3]: tuple(r)[3:] for r in store.totals().collect()}


def test_batches_count_once(spark):
    store = rollups.Rollup(spark, work_dir(spark, "rollup"))
    assert totals(store) == {}
    rows = spark.createDataFrame([("a", "en", "v", 1, 10), ("a", "en", "v", 1, 5), (None, None, "v", 1, 2)], DELTAS)
    assert store.commit("b/1", rows) and not store.commit("b/1", rows)
    assert totals(store) == {("a", "en", "v"): (2, 15), (None, None, "v"): (1, 2)}
    assert store.commit("b2", spark.createDataFrame([("a", "en", "v", -1, -5), ("a", "en", "w", 1, 6), (None, None, "v", -1, -2)], DELTAS))
    assert store.commit("empty", rows.limit(0))
    assert totals(store) == {("a", "en", "v"): (1, 10), ("a", "en", "w"): (1, 6)}


def test_unpublished_batch_is_not_seen_and_can_be_repeated(spark):
    store = rollups.Rollup(spark, work_dir(spark, "rollup"))
    rows = spark.createDataFrame([("a", "en", "v", 1, 10)], DELTAS)
    rows.write.parquet(f"{store.path}/batches/died")
    assert totals(store) == {}
    assert store.commit("x", rows) and totals(store) == {("a", "en", "v"): (1, 10)}


def test_names_that_readers_hide(spark):
    store = rollups.Rollup(spark, work_dir(spark, "rollup"))
    for name in ("_b", ".b", "", "a b/ü", "x" * 60):
        rows = spark.createDataFrame([(name, "en", "v", 1, 3)], DELTAS)
        assert store.commit(name, rows) and not store.commit(name, rows)
        assert totals(store)[name, "en", "v"] == (1, 3)
    assert store.keep_totals() and len(totals(store)) == 5 and not any(store.commit(n, rows) for n in ("_b", ".b", ""))


def test_torn_marker_is_none(spark):
    store = rollups.Rollup(spark, work_dir(spark, "rollup"))
    rows = spark.createDataFrame([("a", "en", "v", 1, 10)], DELTAS)
    for n, torn in enumerate((b"", b"0123", b"0123\n", b"\xff\xfe")):
        where, fs = store._at(f"commits/{store.marker(str(n))}")
        out = fs.create(where, False)
        out.write(bytearray(torn))
        out.close()
        assert not store.committed(str(n)) and totals(store).get(("a", "en", "v"), (0, 0)) == (n, 10 * n)
        assert store.commit(str(n), rows) and not store.commit(str(n), rows)
    assert totals(store) == {("a", "en", "v"): (4, 40)}


def test_two_writers_of_one_batch(spark, monkeypatch):
    """The second commits while the first is writing; one of them counts."""
    path = work_dir(spark, "rollup")
    first, second = rollups.Rollup(spark, path), rollups.Rollup(spark, path)
    rows = spark.createDataFrame([("a", "en", "v", 1, 10)], DELTAS)
    for name, other_ends in (("b", lambda: None), ("c", second.keep_totals)):  # the latter moves the other's marker away
        ask = first.committed

        def in_between(batch, name=name, other_ends=other_ends, ask=ask):
            found = ask(batch)
            if not second.committed(name):
                assert second.commit(name, rows)
                other_ends()
            return found

        monkeypatch.setattr(first, "committed", in_between)
        assert not first.commit(name, rows)
        monkeypatch.undo()
    assert second.commit("d", rows)
    monkeypatch.setattr(first, "committed", lambda batch: False)  # it looked before the other was done
    assert not first.commit("d", rows)
    second.keep_totals()
    first.commit("d", rows)  # later still: its marker is in place, and counts for nothing
    assert totals(first) == {("a", "en", "v"): (3, 30)} and second._names("commits") != []
    assert not second.keep_totals() and second._names("commits") == []
    monkeypatch.undo()
    assert totals(first) == {("a", "en", "v"): (3, 30)}


def test_totals_are_kept_and_few_tables_read(spark):
    store = rollups.Rollup(spark, work_dir(spark, "rollup"), keep_up=8)
    rows = spark.createDataFrame([("a", "en", "v", 1, 10)], DELTAS).coalesce(1)
    for n in range(41):
        assert store.commit(f"b{n}", rows)
    read = store.totals().inputFiles()
    assert len({f.rsplit("/", 2)[1] for f in read}) <= 8
    assert totals(store) == {("a", "en", "v"): (41, 410)} and not store.commit("b3", rows)
    assert len(store._names("covered")) == 40 and len(store._names("commits")) == 1


def test_death_between_generation_and_move(spark, monkeypatch):
    store = rollups.Rollup(spark, work_dir(spark, "rollup"))
    rows = spark.createDataFrame([("a", "en", "v", 1, 10)], DELTAS)
    assert store.commit("x", rows) and store.commit("y", rows)
    put_away = store._put_away
    monkeypatch.setattr(store, "_put_away", lambda: None)
    assert store.keep_totals() and totals(store) == {("a", "en", "v"): (2, 20)}
    assert not store.commit("x", rows) and store.commit("z", rows)
    monkeypatch.setattr(store, "_put_away", put_away)
    assert store.keep_totals() and not store.keep_totals() and totals(store) == {("a", "en", "v"): (3, 30)}


def test_repeated_ids_and_copies_as_in_sql(spark, tmp_path):
    """Also a null id or text, ids held twice, and a text that half of the rows share."""
    rows = [(1, "a b c", "de"), (2, "a b c", "de"), (2, "x y, z", "de"), (3, "x y, z", "fr"), (3, "x y, z", "en"), (None, "a b c", "de"), (4, None, "de"), (5, None, "de"), (5, None, "en")]
    rows += [(100 + i, "the same text", "it") for i in range(60)]
    sf = str(tmp_path)
    spark.createDataFrame([(i, t, lang, "s", None) for i, t, lang in rows], "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.parquet(f"{sf}/p")
    next((tmp_path / "p").glob("*.parquet")).rename(tmp_path / "documents.parquet")
    ok, text = check.compare(spark, check.connect(sf), "op7_token_counts", sf)
    assert ok, text


def test_counts_of_odd_tables(odd, none, clash, spark):
    for docs in (odd, none, clash):
        store = rollups.Rollup(spark, work_dir(spark, "rollup"))
        store.commit("all", rollups.signed(docs.withColumn("tok", rollups.n_tokens(docs["text"], "words-1")), 1, "words-1", "tok"))
        want = Counter()
        for r in docs.collect():
            want[r["source"], r["lang"], "words-1"] += len((r["text"] or "").split())
        assert {k: v[1] for k, v in totals(store).items()} == dict(want)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_agrees_with_duckdb(spark, name):
    ok, text = check.compare(spark, check.connect(SF), name, SF)
    assert ok, text


def test_queries_are_registered():
    names = set(contract.queries())
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in queries.QUERIES} - {"pipeline"} and set(queries.QUERIES) <= names


def test_stages_of_odd_tables(spark, odd, none, clash, tmp_path):
    spark.createDataFrame([(4, 1, 0), (1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "some plain words"), (2, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for docs in (odd, none, clash):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, str(tmp_path))
            assert out.dtypes == docs.dtypes, name
            assert out.count() <= docs.count()
        corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
    left = corpus_pipeline.benchmark_decontamination(spark, clash, str(tmp_path))
    assert [r["doc_id"] for r in left.collect()] == [2]


def test_pipeline(spark):
    from tests.llm.test_decontamination import expected as windows
    from tests.llm.test_line_dedup import expected as lines
    from tests.llm.test_near_dedup import groups, near

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows, seen = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        path = work_dir(spark, name)
        stage(spark, rows, SF).write.parquet(path)
        rows = spark.read.parquet(path)
        seen[name] = rows.collect()
    texts = lambda name: [(r["doc_id"], r["text"]) for r in seen[name]]
    assert all(r["n_chars"] == len(r["text"]) for r in seen["line_dedup"])
    # A document that loses all its words goes, one that had none stays.
    kept = [(d, t) for d, t, _, dropped in lines(texts("quality_classifier")) if not dropped or (t or "").split()]
    assert sorted(texts("line_dedup")) == sorted(kept) and len(kept) < len(seen["quality_classifier"])
    heads = {d for d, _, c in groups(texts("line_dedup"), 5) if d == (near.LAST if c is None else c)}
    assert {d for d, _ in texts("minhash_near_dedup")} == heads
    clean = {d for d, _, hit, _ in windows(texts("minhash_near_dedup"), bench) if not hit}
    assert {d for d, _ in texts("benchmark_decontamination")} == clean
    assert {r["doc_id"] for r in seen["best_fit_packing"]} == clean
    whole = Counter(tuple(r)[:5] for r in corpus_pipeline.run(spark, SF).collect())
    assert whole == Counter(tuple(r)[:5] for r in seen["best_fit_packing"])


def test_stages_hand_texts_to_python_in_small_batches(spark, docs_of):
    """Batches of 10,000 texts, one on each side of every task, made executors grow from stage to stage."""
    sizes = lambda batches: (pa.RecordBatch.from_pydict({"n": [b.nbytes]}) for b in batches)
    with settings(spark, {"spark.sql.execution.arrow.maxBytesPerBatch": "64m"}):
        docs = docs_of([(k, f"{k:07d} " * 10_000) for k in range(100)])
        corpus_pipeline.best_fit_packing(spark, docs, SF)
        taken = docs.coalesce(1).select("text").mapInArrow(sizes, "n long").collect()
    assert sum(r["n"] for r in taken) >= 8_000_000 and max(r["n"] for r in taken) < 4_000_000
