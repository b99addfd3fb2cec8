"""The pipeline's stages on small inputs."""

from __future__ import annotations

import corpus_pipeline as pipeline
import duckdb
import pytest
from compare import SMALL as FOLDER

ODD = [(1, None), (2, ""), (None, "no id"), (None, None), (3, "a b"), (3, "a b"), (4, "x " * 400), (5, "grün 東京 🤖")]


@pytest.fixture(scope="module")
def results(spark):
    docs, kept = spark.read.parquet(f"{FOLDER}/documents.parquet"), {}
    for name, stage in pipeline.STAGES:
        docs = stage(spark, docs, FOLDER).cache()
        kept[name] = docs
    return kept


def ids(df):
    return [r.doc_id for r in df.select("doc_id").collect()]


def test_stages_keep_columns_and_only_remove(results):
    before = set(range(10**6))
    for (name, _), df in list(zip(pipeline.STAGES, results.values()))[:-1]:
        assert df.columns == pipeline.COLUMNS
        now = ids(df)
        assert len(now) == len(set(now)) and set(now) <= before
        before = set(now)
    assert set(ids(results["sentencepiece"])) == before


def test_good_documents_stay(results):
    kept = set(ids(results["quality_rules"]))
    labels = duckdb.sql(f"SELECT doc_id, quality FROM '{FOLDER}/labels.parquet'").fetchall()
    good, bad = ({i for i, q in labels if q == value} for value in (1, 0))
    assert len(good & kept) >= 0.95 * len(good) and len(bad & kept) <= 0.3 * len(bad)


def shingles(text):
    words = text.split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def test_near_copies(results):
    before = {r.doc_id: shingles(r.text.lower()) for r in results["quality_rules"].collect()}
    after = set(ids(results["simhash_near_dedup"]))
    similarity = lambda a, b: len(before[a] & before[b]) / len(before[a] | before[b])
    gone = set(before) - after
    for i in gone:
        assert max(similarity(i, j) for j in before if j != i) > 0.5
    left = sorted(after)
    assert not [(a, b) for a in left for b in left if a < b and similarity(a, b) >= 0.9]


def test_benchmark_items_go(results):
    items = [t for _, t in duckdb.sql(f"SELECT item_id, text FROM '{FOLDER}/benchmark.parquet'").fetchall()]
    before = results["substring_dedup"].collect()
    leaked = {r.doc_id for r in before if any(t in r.text for t in items)}
    after = set(ids(results["benchmark_decontamination"]))
    assert not leaked & after and len(after) >= 0.9 * (len(before) - len(leaked))


def test_near_copies_equal_brute_force(spark):
    """All pairs of the documents that the quality stage keeps, through the shingles they share."""
    folder = FOLDER.replace("0.001", "0.01")
    docs = pipeline.quality(spark, spark.read.parquet(f"{folder}/documents.parquet"), folder).cache()
    sets = {r.doc_id: shingles((r.text or "").lower()) for r in docs.collect()}
    holders, shared = {}, {}
    for i, found in sets.items():
        for shingle in found:
            holders.setdefault(shingle, []).append(i)
    for ids_ in holders.values():
        for n, a in enumerate(ids_):
            for b in ids_[n + 1 :]:
                shared[a, b] = shared.get((a, b), 0) + 1
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for (a, b), n in shared.items():
        if n >= 0.8 * (len(sets[a]) + len(sets[b]) - n):
            a, b = sorted((find(a), find(b)))
            root[b] = a
    assert set(ids(pipeline.near_copies(spark, docs, folder))) == {find(i) for i in sets}


def test_contaminated_rows_are_known_by_their_text(spark):
    item = duckdb.sql(f"SELECT text FROM '{FOLDER}/benchmark.parquet' LIMIT 1").fetchall()[0][0]
    rows = [(None, f"before {item} after"), (7, f"{item} too"), (7, "clean text of the same id"), (None, "clean, no id"), (8, None), (9, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 3) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = pipeline.benchmark_free(spark, docs, FOLDER).collect()
    assert sorted((str(r.doc_id), str(r.text)) for r in kept) == sorted((str(i), str(t)) for i, t in rows[2:])


def test_null_texts_stay_null_and_passages_go(spark):
    passage = " ".join(f"w{i}" for i in range(40))
    rows = [(1, f"one {passage} end"), (2, f"{passage}\n\ntwo"), (None, f"x {passage}"), (3, None), (3, ""), (4, "kept  as\tit is")]
    docs = spark.createDataFrame([(i, t, "en", "s", 5) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    found = sorted((str(r.doc_id), r.text, r.n_chars) for r in pipeline.repeated_passages(spark, docs, FOLDER).collect() if r.text is not None)
    assert found == sorted([("1", "one end", 7), ("2", "two", 3), ("None", "x ", 2), ("3", "", 0), ("4", "kept  as\tit is", 14)])
    nulls = [(r.doc_id, r.n_chars) for r in pipeline.repeated_passages(spark, docs, FOLDER).where("text is null").collect()]
    assert nulls == [(3, 5)]


@pytest.mark.parametrize("rows", [ODD, []])
def test_odd_documents(spark, rows):
    full = [(i, t, "en", "s", len(t or ""), "x") for i, t in rows]
    docs = spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, kept string")
    for name, stage in pipeline.STAGES:
        found = stage(spark, docs, FOLDER)
        assert len(found.collect()) <= len(rows), name


def test_run_is_all_stages(spark, results):
    found = pipeline.run(spark, FOLDER)
    key = lambda df: sorted((r.doc_id, r.n_tokens, tuple(r.ids), r.decoded) for r in df.collect())
    assert key(found) == key(results["sentencepiece"])
