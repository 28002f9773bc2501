"""Every operator on nulls, empty and very long texts, ties, repeated rows, empty tables and clashing column names."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from weirflow.llm import bpe, lines, urls
from weirflow.llm.fingerprints import compare_with_next, corpus_fingerprint, fingerprint
from weirflow.llm.jaccard import jaccard_groups, keep_one_of_each
from weirflow.llm.packing import pack_documents
from weirflow.llm.page_text import extract_text
from weirflow.llm.perplexity import judge_quality
from weirflow.llm.vectors import near_vectors
from weirflow.llm.warc import archive_pages

LONG = "lorem ipsum dolor " * 100_000 + "x" * 2_000_000
CLASHES = "run guest place host path line lines key keys set_id perplexity threshold accepted shard piece cell visit dims first weight n p pages".split()
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ROWS = [
    (1, "one two three four five six seven", "en", "a", 33),
    (1, "one two three four five six seven", "en", "a", 33),
    (2, "one two three four five six seven", "en", None, 33),
    (3, None, None, None, None),
    (4, "", "fr", "a", 0),
    (5, " \t\n\r", "xx", "b", 4),
    (6, "word", "en", "b", 4),
    (7, LONG, "en", "b", len(LONG)),
    (None, "one two three four five six seven", "en", "c", 33),
    (None, None, None, None, None),
    (8, "émoji 🎉 中文 ' 's 're end", "en", "c", 20),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, DOCS).select("*", *[F.lit("clash").alias(c) for c in CLASHES])


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i, "http://h.example.com/a" if i != 3 else None, text) for i, text, *_ in ROWS]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    return frame.select("*", *[F.lit("clash").alias(c) for c in CLASHES])


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(1, 1, 0), (1, 1, 0), (2, 1, None), (3, None, None), (None, 1, 0), (6, 0, 1), (99, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def vocabulary():
    return pytest.importorskip("public_tokenizers").path("byte_bpe_50k.tiktoken")


def by_id(df):
    return {r[0]: r for r in df.collect() if r[0] is not None}


def test_fingerprints(docs):
    got = compare_with_next(docs)
    assert got.count() == len(ROWS)
    got = by_id(got)
    assert got[3]["n_chars"] == 0 and got[3]["near_edited"] == 1.0 and got[4]["fingerprint"] == ""
    assert got[1]["fingerprint"] == got[2]["fingerprint"] and got[1]["near_next"] == 1.0
    assert fingerprint(docs).count() == len(ROWS)
    assert corpus_fingerprint(docs, "source").count() == 4
    assert compare_with_next(docs.limit(0)).count() == 0


def test_bpe(docs, vocabulary):
    got = by_id(bpe.round_trip(docs, vocabulary))
    assert len(got) == 8 and got[3]["n_tokens"] == 0 == got[4]["n_tokens"]
    both = bpe.decode(bpe.encode(docs, vocabulary), vocabulary).collect()
    texts = sorted((r[1] or "" for r in ROWS))
    assert sorted(bytes(r["decoded"]).decode() for r in both) == texts
    assert all(r["offsets"][-1] == len(r["decoded"]) for r in both)
    assert bpe.round_trip(docs.limit(0), vocabulary).count() == 0


def test_pages(pages):
    got = extract_text(pages)
    assert got.count() == len(ROWS)
    assert by_id(got)[3]["text"] == "" and by_id(got)[4]["n_chars"] == 0
    assert extract_text(pages.limit(0)).count() == 0


def test_jaccard(docs):
    rows = jaccard_groups(docs).collect()
    assert len(rows) == len(ROWS)
    got = {r["doc_id"]: r for r in rows if r["doc_id"]}
    assert got[2]["component_id"] == 1 and got[2]["n_links"] == 3
    assert got[3]["component_id"] == 3 and got[3]["n_shingles"] == 0 == got[5]["n_links"]
    assert got[6]["n_shingles"] == 1
    assert sorted(r["component_id"] or 0 for r in rows if r["doc_id"] is None) == [0, 1]
    kept = keep_one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 0, 1, 3, 4, 5, 6, 7, 8]
    assert jaccard_groups(docs.limit(0)).count() == 0 == keep_one_of_each(docs.limit(0)).count()


def test_texts_of_one_id_are_judged_each(spark):
    rows = [(1, "a b c d e f g"), (2, "a b c d e f g"), (2, "quite another text of its own"), (3, None), (3, "a real text"), (3, "a second real text"), (3, "a real text")]
    kept = keep_one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["text"] or "") for r in kept) == [(1, rows[0][1]), (2, rows[2][1]), (3, ""), (3, "a real text"), (3, "a second real text")]


def test_packing(docs):
    rows = pack_documents(docs).collect()
    total = sum(r["piece_length"] for r in rows)
    assert total == sum(len((t or "").encode()) for _, t, *_ in ROWS)
    assert {r["doc_id"] for r in rows} == {r[0] for r in ROWS}
    assert pack_documents(docs.limit(0)).count() == 0


def test_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 0), (2, [2.0, 0.0], 0), (2, [2.0, 0.0], 0), (3, None, 0), (4, [], 0), (5, [0.0, 0.0], 0), (6, [1.0, None], 0)]
    rows += [(7, [nan, 1.0], 0), (8, [inf, 1.0], 0), (9, [1.0, 0.0], None), (None, [1.0, 0.0], 0), (10, [1.0, 0.0, 0.0], 0), (11, [1e300, 1e290], 0)]
    rows += [(12, [-0.0, 1.0], 1), (13, [0.0, 1.0], 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("cell", F.lit(1))
    out = near_vectors(frame).collect()
    assert len(out) == len(rows)
    got = {r["vec_id"]: r for r in out}
    assert [got[i]["n_links"] for i in (1, 2, 11)] == [3, 3, 3] and got[11]["component_id"] == 1 and not got[2]["kept"]
    assert all(got[i]["n_links"] == 0 and got[i]["kept"] for i in (3, 4, 5, 6, 7, 8, 9, 10, None))
    assert got[13]["component_id"] == 12
    assert near_vectors(frame.limit(0)).count() == 0


def test_lines(docs, spark):
    assert lines.drop_boilerplate(docs).columns == docs.columns
    got = lines.changed_lengths(docs.drop("n_lines"))
    assert got.count() == len(ROWS)
    assert by_id(got)[3]["text"] is None and by_id(got)[4]["text"] == ""
    rows = [(i, f"menu\n\nmenu\n{i}", "s") for i in range(3)] + [(9, "menu\nown\n", "s")] + [(20 + i, "copied\nmenu", "s") for i in range(5)]
    page = spark.createDataFrame(rows, "doc_id long, text string, source string")
    # Copies are one page, so what only they have stays.
    assert sorted(r["text"] for r in lines.drop_boilerplate(page).collect()) == sorted(["\n0", "\n1", "\n2", "own\n", *["copied"] * 5])
    assert lines.changed_lengths(docs.limit(0)).count() == 0


def test_copies_are_no_boilerplate_in_the_pipeline(spark):
    rows = [(i, "a story\nthat is copied", "s") for i in range(10)] + [(10 + i, f"menu\nstory {i}", "s") for i in range(20)]
    rows += [(40 + i, None, "s") for i in range(500)]
    page = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = by_id(corpus_pipeline.line_dedup(spark, page, ""))
    assert len(got) == len(rows)
    assert all(got[i]["text"] == "a story\nthat is copied" for i in range(10))
    assert all(got[10 + i]["text"] == f"story {i}" for i in range(20))


def test_urls(pages, spark):
    outcomes = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1)], "page_id long, bad int")
    got = urls.filter_urls(pages, outcomes)
    assert got.count() == len(ROWS)
    assert by_id(got)[3].asDict() == {"page_id": 3, "host": "", "path": "", "rule": None, "verdict": "allow"}
    assert urls.filter_urls(pages.limit(0), outcomes.limit(0)).count() == 0


def test_warc(pages):
    got = archive_pages(pages)
    rows = got.collect()
    assert len(rows) == len(ROWS)
    by = {}
    for r in rows:
        by.setdefault(r["page_id"], r)
    assert by[1]["record_type"] == "response" and by[2]["refers_to"] == 1 and by[4]["refers_to"] == 3
    assert by[2]["payload_bytes"] == by[1]["payload_bytes"] == 33
    assert archive_pages(pages.limit(0)).count() == 0


def test_quality(docs, labels):
    got = judge_quality(docs, labels)
    assert got.count() == len(ROWS)
    assert sorted(got.columns) == sorted(docs.columns)
    assert all(r["accepted"] for r in got.where("doc_id in (1, 3, 4)").collect())
    assert judge_quality(docs, labels.limit(0)).where("accepted").count() == len(ROWS)
    assert judge_quality(docs.limit(0), labels).count() == 0


def test_pipeline_stages(docs, labels, spark, tmp_path):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for rows in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            after = stage(spark, rows, str(tmp_path))
            assert after.columns == rows.columns or stage is corpus_pipeline.packing
            after.count()
