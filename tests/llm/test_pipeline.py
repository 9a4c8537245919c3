import duckdb

import corpus_pipeline
from tiffin.llm import catalog


def test_stages_keep_clean_documents(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = corpus_pipeline.run(spark, folder).collect()
    ids = {r.doc_id for r in docs.collect()}
    assert {r.doc_id for r in out} <= ids and len(out) > 0.6 * len(ids)
    assert all(r.round_trip for r in out)


def test_stages_on_odd_rows(spark, odd, nothing):
    docs = odd.select("doc_id", "text", "lang", "source", "n_chars", "score", "spans")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, "/root/testdata/sf0.001")
        assert kept.columns == docs.columns
        docs = corpus_pipeline.materialise(kept, "odd")
    ids = [r.doc_id for r in docs.collect()]
    assert ids.count(1) == 1 and 6 in ids and 7 not in ids and ids.count(None) == 2
    # doc 2 has a copy of doc 1, which goes, and a text of its own, which stays
    assert [r.text for r in docs.collect() if r.doc_id == 2] == ["another text of doc two"]
    coded = corpus_pipeline.to_token_ids(spark, docs, "").collect()
    assert len(coded) == len(ids) and all(r.round_trip for r in coded)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, "/root/testdata/sf0.001").count() == 0


def test_texts_that_share_a_doc_id(spark):
    """Unlike texts stay, copies go, whole rows repeated stay once, and empty ones as they are."""
    a, b = "one two three four five six seven eight", "red green blue black white pink grey brown"
    rows = [(1, a, "x"), (1, b, "y"), (2, a, "z"), (2, b + " teal", "w"), (3, "", "e"), (3, "", "e"),
            (4, a + " nine ten eleven twelve", "n"), (4, a + " nine ten eleven twelve", "n"),
            (None, a, "null")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    got = sorted((r.doc_id or 0, r.source) for r in kept.collect())
    assert got == [(0, "null"), (1, "x"), (1, "y"), (3, "e"), (3, "e"), (4, "n")]


def test_comparison_sql(spark):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for name in ("documents", "benchmark", "labels", "conversations"):
        con.execute(f"create view {name} as from read_parquet('{folder}/{name}.parquet')")
    for key, sql in catalog.ORACLE.items():
        want = con.execute(sql).df()
        got = catalog.QUERIES[key](spark, folder).toPandas()
        columns = sorted(got.columns)
        assert columns == sorted(want.columns)
        got, want = (x[columns].sort_values(columns).reset_index(drop=True) for x in (got, want))
        assert ((got == want) | (got.isna() & want.isna())).all().all(), key
