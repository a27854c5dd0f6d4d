"""Empty tables, repeated rows and columns whose names clash, of operators whose own tests leave these out."""

from __future__ import annotations

from ticksmith.llm import ann, bpe, decontaminate, quality, warc
from ticksmith.llm.queries import vocabulary_path

DOCS = "doc_id long, text string, n_words long, n_tokens string, score string, `row` string"


def test_decontamination_of_an_empty_table(spark):
    items = spark.createDataFrame([(1, "a b c d e f g h i j k l")], "item_id long, text string")
    assert decontaminate.decontaminate(spark.createDataFrame([], DOCS), items).count() == 0


def test_bpe_of_repeated_rows_and_clashing_columns(spark):
    rows = [(1, "Some text.", 5, "x", "y", "z")] * 2 + [(2, None, None, None, None, None)]
    got = bpe.encode_documents(spark.createDataFrame(rows, DOCS), vocabulary_path()).collect()
    assert sorted((r["row"]["doc_id"], r["row"]["n_tokens"], r["n_tokens"] > 0) for r in got if r["row"]["doc_id"] == 1) == [(1, "x", True)] * 2
    assert [r["n_tokens"] for r in got if r["row"]["doc_id"] == 2] == [0]
    assert bpe.encode_documents(spark.createDataFrame([], DOCS), vocabulary_path()).count() == 0


def test_quality_of_an_empty_table(spark):
    docs = spark.createDataFrame([], DOCS)
    model = quality.train(docs, spark.createDataFrame([], "doc_id long, label int"))
    assert quality.score(docs, model).count() == 0


def test_warc_of_an_empty_table_and_clashing_columns(spark, tmp_dir):
    schema = "page_id long, url string, html string, digest string, record_type int, value string"
    pages = spark.createDataFrame([(1, "u", "h" * 200, "d", 3, "v"), (2, "u", "h" * 200, None, None, None)], schema)
    warc.write_archives(pages, f"{tmp_dir}/a")
    got = sorted(tuple(r)[:2] + tuple(r)[3:] for r in warc.records(warc.read_chunks(spark, f"{tmp_dir}/a")).collect())
    assert got == [(1, 200, "response", None), (2, 200, "revisit", 1)]
    warc.write_archives(spark.createDataFrame([], schema), f"{tmp_dir}/b")
    assert warc.records(warc.read_chunks(spark, f"{tmp_dir}/b")).count() == 0


def test_nearest_of_clashing_columns(spark):
    rows = [(i, [1.0, float(i)], "q", 1) for i in range(6)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, query_id string, rank int")
    from pyspark.sql import functions as F
    got = ann.nearest(vectors, F.col("vec_id") == 0).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in got) == [(0, k, k) for k in range(1, 6)]


def test_nearest_broadcasts_nothing(spark, monkeypatch):
    from pyspark.sql import functions as F
    plans = []

    def noted(df, name, write=ann.materialize):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, name)

    monkeypatch.setattr(ann, "materialize", noted)
    rows = [(i, [1.0, float(i)]) for i in range(40)]
    got = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 4 == 0, shard_rows=5)
    assert got.count() == 50
    plans.append(got._jdf.queryExecution().executedPlan().toString())
    assert "MapInArrow" in plans[-1] and not [p for p in plans if "Broadcast" in p]


def test_nearest_merges_blocks_and_shards(spark, monkeypatch):
    import numpy as np
    from pyspark.sql import functions as F
    monkeypatch.setattr(ann, "QUERY_BLOCK", 7)
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 3 + i % 2)]) for i in range(400)]
    rows = [(i, v) for i, v in rows if any(v)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in ann.nearest(df, F.col("vec_id") % 3 == 0, shard_rows=60).collect())
    want = []
    for q, v in rows:
        if q % 3 == 0:
            score = {i: float(np.dot(v, w) / np.sqrt(np.dot(v, v) * np.dot(w, w))) for i, w in rows if i != q and len(w) == len(v)}
            want += [(q, n, score[i]) for n, i in enumerate(sorted(score, key=lambda i: (-score[i], i))[:5], 1)]
    assert [r[:2] for r in got] == [w[:2] for w in want]
    assert all(abs(r[3] - w[2]) < 1e-9 for r, w in zip(got, want, strict=True))


def test_beam_search_orders_ids_of_either_width():
    import numpy as np
    rng = np.random.default_rng(5)
    unit = ann._unit(rng.normal(size=(300, 6)))
    layers = ann.build(unit)
    for kind in (np.int32, np.int64):
        ids, sims = ann.search(unit, [x.astype(kind) for x in layers], unit[:40], 4)
        assert ids[:, 0].tolist() == list(range(40)) and (np.diff(sims, axis=1) <= 0).all()
        assert np.allclose(sims, np.sort(unit[:40] @ unit.T, axis=1)[:, :-5:-1], atol=1e-6)
