import random
import zlib

import pyarrow as pa
from pyspark.sql import functions as F

from remitlens.llm import toxicity
from tests.llm.data import edge_docs, empty_docs

SLURS = ["zorkface", "gribbly", "blorfwit", "snarkolt"]


def corpus(n=600, seed=0):
    rng = random.Random(seed)
    parts = ["the", "and", "ing", "tion", "er", "an", "re", "on", "at", "en", "nd", "ti", "es", "or", "te", "of", "ed", "is"]
    docs, labels = [], []
    for i in range(n):
        words = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(60, 250))]
        toxic = rng.random() < 0.2
        if toxic:
            for _ in range(len(words) // 15 + 2):
                words.insert(rng.randrange(len(words)), rng.choice(SLURS) + rng.choice(["", "!", "s", "."]))
        docs.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    return docs, labels


def test_held_out_accuracy(spark):
    docs, labels = corpus()
    d = spark.createDataFrame(docs, "doc_id long, text string")
    model = toxicity.fitted(d, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    out = toxicity.scored(d, model).withColumn("held", toxicity.held_out(F.col("doc_id"))).collect()
    truth = {i: t for i, _, t in labels}
    assert all(r.held == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in out)
    held = [r for r in out if r.held]
    hit = sum(r.predicted and truth[r.doc_id] for r in held)
    assert hit >= 0.9 * sum(truth[r.doc_id] for r in held) and hit >= 0.9 * sum(r.predicted for r in held)


def test_held_out_labels_change_nothing(spark):
    docs, labels = corpus(200)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    flipped = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 4 == 2 else t) for i, q, t in labels]
    a, b = (toxicity.fitted(d, spark.createDataFrame(x, "doc_id long, quality int, toxic int")) for x in (labels, flipped))
    column = pa.array([t for _, t in docs])
    assert a.score(column).tolist() == b.score(column).tolist()


def test_edge_rows(spark):
    docs = edge_docs(spark).withColumn("score", F.lit("old"))
    labels = spark.createDataFrame([(8, 1, 0), (8, 1, 1), (None, 1, 1), (7, 1, None), (60, 0, 1), (61, 0, 0), (62, 1, 0), (3, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    for some in (labels, labels.limit(0), labels.where("toxic = 1")):
        out = toxicity.scored(docs, toxicity.fitted(docs, some)).collect()
        assert len(out) == docs.count()
        assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in out)
    model = toxicity.fitted(empty_docs(spark), labels)
    assert toxicity.scored(empty_docs(spark), model).count() == 0
