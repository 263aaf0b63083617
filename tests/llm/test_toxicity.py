import random

from pyspark.sql import functions as F

from sensorspark.llm import toxicity as t


def corpus(n, seed):
    rng = random.Random(seed)
    plain = [f"word{i}" for i in range(300)]
    bad = ["vilea", "vileb", "vilec", "viled"]
    docs, labels = [], []
    for i in range(n):
        toxic = rng.random() < 0.25
        words = [rng.choice(plain) for _ in range(rng.randint(20, 60))]
        if toxic:
            for _ in range(rng.choice((1, 2, 4))):
                words[rng.randrange(len(words))] = rng.choice(bad).upper() + rng.choice(("", ",", "***"))
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return docs, labels


def test_learns_categories_and_orders_them(spark):
    docs, labels = corpus(900, 1)
    df, known = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels[:600], "doc_id long, toxic int")
    truth = dict(labels)
    rows = {r.doc_id: r for r in t.score_toxicity(df, known).collect()}
    assert len(rows) == 900
    assert sum((rows[i].p_toxic >= 0.5) == bool(truth[i]) for i in range(600, 900)) >= 290
    several = [i for i, text in docs if len({w for w in text.lower().replace("*", "").replace(",", "").split() if w.startswith("vile")}) >= 2]
    assert sum(rows[i].p_severe >= 0.5 for i in several) >= 0.8 * len(several)
    clean = [i for i in rows if not truth[i]]
    assert sum(rows[i].p_severe >= 0.5 or rows[i].p_persistent >= 0.5 for i in clean) <= 0.02 * len(clean)


def test_chain_uses_out_of_fold_probabilities(spark):
    """A second category that is a noisy copy of the first is predicted through it."""
    docs, labels = corpus(500, 2)
    df = spark.createDataFrame([(i, x, bool(y)) for (i, x), (_, y) in zip(docs, labels, strict=True)], "doc_id long, text string, first boolean")
    df = df.withColumn("second", F.col("first"))
    terms = t.telling_terms(df, "first")
    assert set(terms[:4]) == {"vilea", "vileb", "vilec", "viled"}
    chain = t.fit_chain(df, ("first", "second"), terms)
    assert chain.models[1].numFeatures == len(terms) + 1
    assert chain.models[1].coefficients[len(terms)] > 0.5


def test_documents_table(spark, folder):
    from sensorspark.llm.queries import QUERIES

    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = QUERIES["op1_toxicity_chain"](spark, folder).collect()
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    known = [r for r in rows if r.doc_id in labels]
    assert sum(r.toxic == labels[r.doc_id] for r in known) >= 0.9 * len(known)


def test_awkward_rows(spark, odd_docs, no_docs):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {(r.p_toxic, r.p_severe) for r in t.score_toxicity(odd_docs, none).collect()} == {(0.0, 0.0)}
    all_bad = spark.createDataFrame([(5, 1), (8, 1), (8, None), (None, 1)], "doc_id long, toxic int")
    rows = t.score_toxicity(odd_docs, all_bad).collect()
    assert len(rows) == odd_docs.count() and {r.p_toxic for r in rows} == {1.0}
    mixed = spark.createDataFrame([(i, i % 2) for i in range(16)], "doc_id long, toxic int")
    rows = t.score_toxicity(odd_docs, mixed).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.p_persistent <= 1 for r in rows)
    assert t.score_toxicity(no_docs, mixed).count() == 0
