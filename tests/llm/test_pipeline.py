"""The pipeline on the smallest tables: each stage against a brute-force version of its decision."""

import numpy as np
import pyarrow as pa
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

import corpus_pipeline
from pulsegrid.llm import exact_dedup, language_id
from pulsegrid.llm.common import words_of
from pulsegrid.llm.exact_dedup import normalise
from pulsegrid.llm.queries import PIECES


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    outs = []
    for name, stage in corpus_pipeline.STAGES:
        path = corpus_pipeline.materialize(stage(spark, docs, sf_dir), f"test-{name}")
        outs.append(path)
        docs = path
    languages, exact, near, clean, packed = outs
    assert all(o.columns == columns for o in outs[:-1])
    # All documents of the fixture have letters and a language.
    assert languages.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    rows = languages.select("doc_id", "text").collect()
    first = {}
    for r in sorted(rows):
        first.setdefault(normalise(r.text), r.doc_id)
    assert {r.doc_id for r in exact.select("doc_id").collect()} == set(first.values())

    def shingles(text):
        w = words_of(text)
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}

    kept = near.select("doc_id", "text").collect()
    sets = {r.doc_id: shingles(r.text) for r in kept}
    ids = sorted(sets)
    similar = lambda a, b: len(a & b) >= 0.85 * len(a | b) if a and b else False
    assert not [(a, b) for i, a in enumerate(ids) for b in ids[:i] if similar(sets[a], sets[b])]
    items = [shingles(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    left = {r.doc_id for r in clean.select("doc_id").collect()}
    for i, s in sets.items():
        assert (i not in left) == any(len(x & s) >= 0.9 * len(x) for x in items if x), i
    pieces = packed.toPandas()
    assert set(pieces.doc_id) == left
    assert (pieces.groupby("doc_id").length.sum() == pieces.groupby("doc_id").doc_tokens.first()).all()
    assert all(n == 1024 or n & (n - 1) == 0 for n in pieces.groupby("sequence_id").length.sum())
    assert np.frombuffer(pieces.token_ids.iloc[0], "<u4").size == pieces.length.iloc[0]


def test_documents_without_language_go(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(50)
    odd = spark.createDataFrame([(900001, None, None, None, 0), (900002, "12 34 !!", "en", "s", 8)], docs.schema)
    out = corpus_pipeline.identify_language(spark, docs.unionByName(odd), sf_dir)
    assert out.where("doc_id > 900000").count() == 0 and out.count() == 50


def rows_of(df):
    return sorted(((r.doc_id, r.text) for r in df.select("doc_id", "text").collect()), key=str)


def test_copies_are_dropped_by_row(spark):
    texts = [(None, "one text"), (None, "another text"), (None, "third"), (5, "five"), (5, "other five"), (5, "five"), (4, "copied"), (5, "copied"), (None, "third")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in texts], "doc_id long, text string, lang string, source string, n_chars int")
    want = sorted([(None, "one text"), (None, "another text"), (None, "third"), (5, "five"), (5, "other five"), (4, "copied")], key=str)
    assert rows_of(corpus_pipeline.drop_copies(spark, docs, "")) == want


def test_near_copies_are_dropped_by_row(spark):
    text = lambda tag: " ".join(f"{tag}{i}" for i in range(200))
    near = lambda tag: text(tag) + " end"
    rows = [(None, text("a")), (None, near("a")), (None, text("b")), (3, near("b")), (3, text("c")), (None, text("d"))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = rows_of(corpus_pipeline.drop_near_copies(spark, docs, ""))
    one = (None, text("a")) if (None, text("a")) in got else (None, near("a"))
    assert got == sorted([one, (3, near("b")), (3, text("c")), (None, text("d"))], key=str)


def test_rejected_and_leaking_rows_leave_others_of_their_id(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(50)
    item = spark.read.parquet(f"{sf_dir}/benchmark.parquet").where("size(split(text, ' ')) > 30").first().text
    good = [r.text for r in docs.orderBy("doc_id").limit(2).collect()]
    rows = [(None, good[0]), (None, "12 34 !!"), (None, item), (900001, good[1]), (900001, "56 !!"), (900001, item)]
    odd = spark.createDataFrame([(i, t, None, None, 0) for i, t in rows], docs.schema)
    kept = rows_of(corpus_pipeline.identify_language(spark, docs.unionByName(odd), sf_dir).where("doc_id is null or doc_id > 900000"))
    assert {(None, good[0]), (900001, good[1])} <= set(kept) and not [t for _, t in kept if "!!" in t]
    assert rows_of(corpus_pipeline.drop_leaks(spark, odd.where(~odd.text.contains("!!")), sf_dir)) == sorted([(None, good[0]), (900001, good[1])], key=str)


def test_workers_get_texts_in_small_batches(spark, sf_dir):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["size"])

    long = spark.range(0, 6000, 1, 1).selectExpr("id doc_id", "repeat('x', 2000) text")
    for _, stage in corpus_pipeline.STAGES:
        spark.conf.unset(key)
        with pytest.raises(AttributeError):  # the setting comes first
            stage(spark, None, sf_dir)
        got = [r["size"] for r in long.mapInArrow(sizes, "size long").collect()]
        assert sum(got) > 12_000_000 and max(got) < 5 << 20
    spark.conf.set(key, "1m")
    corpus_pipeline.pack(spark, long.limit(1), "")
    assert spark.conf.get(key) == "1m"
    spark.conf.unset(key)


def test_small_tables_start_no_workers_of_another_kind(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"word of text {i // 2}", ["de", "en"][i % 2]) for i in range(40)], "doc_id long, text string, lang string")
    made, create = [], type(spark).createDataFrame
    monkeypatch.setattr(type(spark), "createDataFrame", lambda self, data, *a, **b: made.append(type(data)) or create(self, data, *a, **b))
    assert exact_dedup.exact_duplicates(docs).where("group_size = 2").count() == 40
    assert language_id.fit(docs, public_tokenizers.path(PIECES), max_docs=10).languages == ["de", "en"]
    assert made == [pa.Table, pa.Table]
