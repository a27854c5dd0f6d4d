"""Each stage of the pipeline against plain Python on the rows that the stage before kept."""

from __future__ import annotations

import hashlib
import random
import re

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from ticksmith.llm import quality
from ticksmith.llm.queries import train_quality, vocabulary_path
from ticksmith.plans.storage import materialize

from .test_operators import SF, WORD, brute_components, ngrams

STAGES = dict(corpus_pipeline.STAGES)
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def plain_near(rows):
    """Rows (doc_id, text, ...) that stay: of each component the least (id is null, id), one of equal rows."""
    once = list(dict.fromkeys(rows))
    named = [(i, r[1]) for i, r in enumerate(once)]
    low = {i: c for i, _, c in brute_components(named, 5, 8, 10)}
    sizes = {i: n for i, n, _ in brute_components(named, 5, 8, 10)}
    best = {}
    for i, r in enumerate(once):
        rank = (r[0] is None, r[0] or 0)
        if not sizes[i]:
            best[("alone", i)] = (rank, i)
        elif low[i] not in best or rank < best[low[i]][0]:
            best[low[i]] = (rank, i)
    return [once[i] for _, i in best.values()]


def plain_passages(rows):
    at = {}
    texts = [WORD.findall(t or "") for _, t in rows]
    for d, w in enumerate(texts):
        for p in range(len(w) - 34):
            at.setdefault(tuple(w[p:p + 35]), []).append((d, p))
    gone = {(d, q) for places in at.values() if len(places) > 1 for d, p in places for q in range(p, p + 35)}
    return [(i, t if t is None else t if not any((d, q) in gone for q in range(len(w)))
             else " ".join(x for q, x in enumerate(w) if (d, q) not in gone)) for d, ((i, t), w) in enumerate(zip(rows, texts, strict=True))]


def plain_clean(rows, items):
    grams = set()
    for t in items:
        w = ALNUM.findall(lowered(t))
        grams |= ngrams(w, 10) if len(w) >= 10 else {tuple(w)} if w else set()
    sizes = {len(g) for g in grams}

    def hit(t):
        w = ALNUM.findall(lowered(t))
        return any(tuple(w[p:p + n]) in grams for n in sizes for p in range(len(w) - n + 1))

    return [r for r in rows if not hit(r[1])]


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def same(got, want):
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_every_stage_on_what_the_one_before_kept(spark):
    import tiktoken
    import public_tokenizers
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    good = materialize(STAGES["quality"](spark, docs, SF), "stage")
    scored = quality.score(docs, train_quality(spark, SF, docs)).where("score >= 0.3").select("row.doc_id", "row.text")
    same(pairs(good), pairs(scored))
    near = materialize(STAGES["near_duplicates"](spark, good, SF), "stage")
    same(pairs(near), plain_near(pairs(good)))
    cut = materialize(STAGES["repeated_passages"](spark, near, SF), "stage")
    # words that stay keep one space; texts that lose nothing stay as they are
    same([(i, WORD.findall(t or "")) for i, t in pairs(cut)], [(i, WORD.findall(t or "")) for i, t in plain_passages(pairs(near))])
    clean = materialize(STAGES["decontamination"](spark, cut, SF), "stage")
    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    same(pairs(clean), plain_clean(pairs(cut), items))
    assert good.columns == near.columns == cut.columns == clean.columns == docs.columns
    assert cut.where(F.col("n_chars") != F.length("text")).count() == docs.where(F.col("n_chars") != F.length("text")).count() == 0
    from tiktoken.load import load_tiktoken_bpe
    enc = tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_tiktoken_bpe(vocabulary_path()), special_tokens={})
    want = []
    for i, t in pairs(clean):
        ids = enc.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    same([tuple(r) for r in STAGES["encoding"](spark, clean, SF).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()], want)
    same([tuple(r) for r in corpus_pipeline.run(spark, SF).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()], want)


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, `row` string"


def odd(spark):
    rng = random.Random(4)
    base = [f"v{rng.randrange(900)}" for _ in range(90)]
    near = " ".join([*base[:-1], "changed"])
    texts = [(None, " ".join(base)), (None, " ".join(base)), (None, near), (3, "first text under an id of two"), (3, "other words of the same id here"),
             (4, " ".join(base)), (4, " ".join(base)), (5, None), (5, None), (6, ""), (None, None), (7, " \n"), (2, near),
             (8, " ".join(f"x{i}" for i in range(20_000)))]
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "c") for i, t in texts], SCHEMA)


def test_near_duplicates_of_odd_rows(spark):
    docs = odd(spark)
    got = pairs(STAGES["near_duplicates"](spark, docs, SF))
    same(got, plain_near(pairs(docs)))
    assert (2, docs.where("doc_id = 2").first()["text"]) in got and sum(i is None and t is not None for i, t in got) == 0


@pytest.mark.parametrize("name", list(STAGES))
def test_stages_of_odd_rows_and_an_empty_table(spark, name):
    docs = odd(spark)
    out = STAGES[name](spark, docs, SF)
    assert set(docs.columns) == set(out.columns) or name == "encoding"
    kept = {i for i, *_ in out.select("doc_id").collect()}
    assert name == "quality" or {3, 5, 6, 7} <= kept
    assert STAGES[name](spark, docs.limit(0), SF).count() == 0
