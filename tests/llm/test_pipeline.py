import hashlib
import random

import numpy as np
import pytest
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from loadkit.llm import mixing, pii, quality, simhash
from tests.llm.test_mixing import plain as plain_mix
from tests.llm.test_pii import plain as plain_spans
from tests.llm.test_simhash import plain_components, plain_fingerprint

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def given(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    return spark.createDataFrame(rows, spark.read.parquet(f"{FOLDER}/documents.parquet").schema), rows


def ordered(rows):
    return sorted(tuple("" if v is None else v for v in r) for r in rows)


def test_order_of_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "personal_data", "mix", "bpe"]


def test_whole_pipeline(spark):
    """Every stage on what the stage before it kept, each against a plain version."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    rows = docs.collect()

    model = quality.fit(docs, quality.learnable(labels))
    scores = model.score(np.array([quality.statistics(r.text or "") for r in rows]))
    first = [r for r, s in zip(rows, scores) if s >= 0.7]
    assert 0 < len(first) < len(rows)

    prints = [(r.doc_id, plain_fingerprint(r.text)) for r in first]
    second = [r for r, c in zip(first, plain_components(prints)) if r.doc_id == c]
    assert len(second) < len(first)

    trees = pii.fit(spark.createDataFrame(second, docs.schema))
    third = []
    for r in second:
        base, spans = pii.all_spans(r.text or "", trees)
        assert base == plain_spans(r.text or "") and set(base) <= set(spans)
        text = pii.redact_text(r.text, spans)
        assert not [s for s in base if r.text[s[0] : s[1]] in text]
        third.append((r.doc_id, text, r.source))

    _, _, copies, _ = plain_mix(third, mixing.Mix())
    fourth = [(k, t) for (k, t, _), n in zip(third, copies) for _ in range(n)]

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = []
    for key, text in fourth:
        ids = library.encode(text, add_special_tokens=False).ids
        want.append((key, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    got = [(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(spark, FOLDER).collect()]
    assert sorted(got) == sorted(want)


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(40)
    more = docs.selectExpr("text", "doc_id", "n_chars", "source", "lang", "1 AS score", "'x' AS _copies", "2 AS size", "array(1) AS ids", "3 AS bits")
    for name, function in corpus_pipeline.STAGES[:-1]:
        out = function(spark, more, FOLDER)
        assert out.schema.simpleString() == more.schema.simpleString(), name
        assert out.count() > 0
    assert corpus_pipeline.STAGES[-1][1](spark, more, FOLDER).count() == more.count()


def test_stages_on_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars int"
    text = "the words of a text stand here in some order"
    rows = [(None, None, None, None, None), (1, "", "en", "a", 0), (2, text, None, "a", 3), (2, text, None, "a", 3), (None, text, "en", None, 3), (3, "w " * 60_000, "en", "b", 1)]
    frame = spark.createDataFrame(rows, schema)
    for name, function in corpus_pipeline.STAGES:
        function(spark, frame, FOLDER).collect()
        assert function(spark, frame.limit(0), FOLDER).count() == 0, name
    kept = [(r.doc_id, r.text) for r in corpus_pipeline.one_of_near_copies(spark, frame, FOLDER).collect()]
    assert sorted(kept, key=str) == sorted([(1, ""), (2, text), (3, "w " * 60_000)], key=str)
    nameless = frame.filter("doc_id IS NULL")
    assert corpus_pipeline.one_of_near_copies(spark, nameless, FOLDER).count() == 2


def test_taken_copies_of_repeated_rows(spark):
    source = random.Random(2)
    rows = [(5, "a b c", "x")] * 7 + [(i, "w " * source.randint(1, 9), source.choice(["x", "y", None])) for i in range(30)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.take(frame).collect()
    _, _, copies, _ = plain_mix(rows, mixing.Mix())
    want = [r for r, n in zip(rows, copies) for _ in range(n)]
    assert ordered(got) == ordered(want)
