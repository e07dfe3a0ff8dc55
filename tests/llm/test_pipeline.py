"""The pipeline's stages on planted documents, each against a plain version."""

import random

import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from marketlane.llm import pieces

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    """A folder with documents of known fate, and what they are."""
    rng = random.Random(9)
    words = [a + b for a in "ba de fi go hu ka lo me ni po".split() for b in "ran ten lis mor dus vek nal tor".split()] + ["the", "of"] * 20
    sentence = lambda n: " ".join(rng.choices(words, k=n))
    texts, labels, kinds = [], [], {}

    def add(kind, text, toxic=None):
        kinds[len(texts)] = kind
        if toxic is not None:
            labels.append((len(texts), 1, toxic))
        texts.append((len(texts), text, "en", "src", len(text)))

    insults = ["idiot", "stupid moron", "worthless scum"]
    for i in range(300):
        add("clean", sentence(rng.randint(60, 120)) + f"\n{sentence(30)}", 0)
        if i % 3 == 0:
            add("toxic", " ".join(f"{sentence(6)} {rng.choice(insults)}" for _ in range(10)), 1)
    for _ in range(40):
        add("toxic", " ".join(f"{sentence(6)} {rng.choice(insults)}" for _ in range(10)))
    for _ in range(12):
        add("lines", sentence(80) + "\nCommon Footer of the site\n" + sentence(60))
    for _ in range(5):
        base = sentence(200).split()
        add("clean", " ".join(base))
        for _ in range(3):
            copy = list(base)
            copy[rng.randrange(200)] = "edited"
            add("copy", " ".join(copy))
        add("copy", " ".join(base))
    items = [(i, sentence(40)) for i in range(10)]
    for i, t in items:
        add("leak", f"{sentence(70)} {t} {sentence(50)}")
    folder = str(tmp_path_factory.mktemp("corpus"))
    frame = spark.createDataFrame(texts, "doc_id long, text string, lang string, source string, n_chars long")
    frame.repartition(4).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, kinds, {t[0]: t[1] for t in texts}


def test_fates(spark, planted):
    folder, kinds, texts = planted
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, folder).collect()}
    assert sorted(out) == [i for i, k in kinds.items() if k in ("clean", "lines")]
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    for i, r in out.items():
        text = texts[i].replace("\nCommon Footer of the site", "")
        assert list(r.ids) == library.encode(text) and r.n_tokens == len(r.ids) and r.lossless


def test_stages_keep_columns_and_odd_rows(spark, planted, rows):
    folder, _, _ = planted
    odd = [(1, None, "en", "s", None), (2, "", None, None, 0), (None, "some words without an id", "en", "s", 24), (2, "", None, None, 0), (3, "x " * 50_000, "en", "s", 100_000)]
    docs = spark.createDataFrame(odd, spark.read.parquet(f"{folder}/documents.parquet").schema)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == COLUMNS, name
        assert rows(out.select("doc_id", "n_chars")) == rows(docs.select("doc_id", "n_chars")), name
        assert stage(spark, docs.limit(0), folder).count() == 0
    out = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert out.count() == len(odd) and out.where(F.size("ids") != F.col("n_tokens")).count() == 0


def test_given_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = corpus_pipeline.run(spark, folder)
    assert 0 < out.count() < docs.count() and out.where(~F.col("lossless")).count() == 0
