"""Toxicity categories by a classifier chain of linear models.

Categories are predicted one after the other; the model of each sees the words of a text and
the probabilities of the categories before it. While fitting, those probabilities are out of fold: every
labelled document gets them from models that did not see it, so a later model learns how far
the earlier ones can be trusted.

Words are the TERMS words that tell the first category apart best (chi-squared over labelled
documents). The fit uses at most about `max_labelled` labelled rows, drawn by a hash of the id; terms are
counted and models fitted by Spark over that sample. All documents are scored, whole, in the JVM.

Edge cases: missing and empty texts have no terms and get the models' base rates. A category
that is constant among the labelled rows (or has no labelled rows) keeps its observed rate, 0
without rows. Missing labels count as no label; of several label rows of an id the largest counts. Ids may be missing or
repeated; other columns of the input are never read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorspark.llm.common import documents, unit_hash
from sensorspark.plans.shared import materialize

MAX_LABELLED = 20_000
TERMS = 256
LEAST_DOCUMENTS = 3
FOLDS = 3
PARTS = 4
REGULARISATION = 1e-3
# What makes a toxic text severe, or persistent: different and repeated telling words.
SEVERE_WORDS, PERSISTENT_WORDS = 2, 3


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def telling_terms(labelled: DataFrame, label: str, n_terms: int = TERMS) -> list[str]:
    """Words most associated with the label, by chi-squared; at most `n_terms` come to the driver."""
    n, n_pos = labelled.agg(F.count(F.lit(1)), F.sum(F.col(label).cast("int"))).first()
    if not n or not n_pos or n_pos == n:
        return []
    seen = labelled.select(label, F.explode(F.array_distinct(words(F.col("text")))).alias("w")).groupBy("w").agg(
        F.count(F.lit(1)).cast("double").alias("d"), F.sum(F.col(label).cast("int")).cast("double").alias("p"))
    d, p, n, n_pos = F.col("d"), F.col("p"), float(n), float(n_pos)
    cross = p * (n - n_pos - (d - p)) - (d - p) * (n_pos - p)
    chi = n * cross * cross / (d * (n - d + 1) * n_pos * (n - n_pos))
    top = seen.filter((d >= LEAST_DOCUMENTS) & (p * n > d * n_pos)).select("w", chi.alias("chi"))
    return [r["w"] for r in top.orderBy(F.desc("chi"), "w").limit(n_terms).collect()]


@dataclass
class Chain:
    """Terms and one model per category, a rate where the category was constant."""

    categories: tuple[str, ...]
    vectorizer: CountVectorizerModel | None
    models: tuple[LogisticRegressionModel | float, ...]

    def probabilities(self, docs: DataFrame) -> DataFrame:
        """(doc_id, p_<category>...) for (doc_id, text)."""
        out = _vectors(docs, self.vectorizer)
        for i, (name, model) in enumerate(zip(self.categories, self.models, strict=True)):
            out = _predict(out, model, self.categories[:i], name)
        return out.select("doc_id", *[f"p_{c}" for c in self.categories])


def _vectors(docs: DataFrame, vectorizer: CountVectorizerModel | None) -> DataFrame:
    if vectorizer is None:
        return docs
    return vectorizer.transform(docs.withColumn("_words", words(F.col("text")))).drop("_words", "text")


def _assembled(df: DataFrame, before: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=["_terms", *[f"p_{c}" for c in before]], outputCol="_features").transform(df)


def _predict(df: DataFrame, model: LogisticRegressionModel | float, before: Sequence[str], name: str) -> DataFrame:
    if isinstance(model, float):
        return df.withColumn(f"p_{name}", F.lit(model))
    scored = model.transform(_assembled(df, before)).withColumn(f"p_{name}", vector_to_array("_probability")[1])
    return scored.drop("_features", "_raw", "_probability", "_prediction")


def _fit_one(df: DataFrame, before: Sequence[str], name: str) -> LogisticRegressionModel | float:
    n, n_pos = df.agg(F.count(F.lit(1)), F.sum(F.col(name).cast("int"))).first()
    if not n or not n_pos or n_pos == n:
        return float(n_pos or 0) / n if n else 0.0
    data = _assembled(df.withColumn("_label", F.col(name).cast("double")), before)
    return LogisticRegression(featuresCol="_features", labelCol="_label", regParam=REGULARISATION, maxIter=30,
                              rawPredictionCol="_raw", probabilityCol="_probability", predictionCol="_prediction").fit(data)


def fit_chain(labelled: DataFrame, categories: Sequence[str], terms: Sequence[str], folds: int = FOLDS) -> Chain:
    """Chain over (doc_id, text, one boolean column per category), in the order of `categories`."""
    categories = tuple(categories)
    vectorizer = CountVectorizerModel.from_vocabulary(list(terms), "_words", "_terms").setBinary(True) if terms else None
    if vectorizer is None:
        rates = labelled.agg(*[F.avg(F.col(c).cast("double")) for c in categories]).first()
        return Chain(categories, None, tuple(float(r or 0.0) for r in rates))
    data = materialize(_vectors(labelled, vectorizer).withColumn(
        "_fold", F.floor(unit_hash(F.lit("fold"), "doc_id") * folds)), "labelled")
    models = []
    for i, name in enumerate(categories):
        before = categories[:i]
        models.append(_fit_one(data, before, name))
        if i + 1 < len(categories):
            parts = [_predict(data.filter(F.col("_fold") == f), _fit_one(data.filter(F.col("_fold") != f), before, name), before, name)
                     for f in range(folds)]
            out = parts[0]
            for part in parts[1:]:
                out = out.unionByName(part)
            data = materialize(out, "out_of_fold")
    return Chain(categories, vectorizer, tuple(models))


def score_toxicity(df: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id",
                   max_labelled: int = MAX_LABELLED) -> DataFrame:
    """(doc_id, p_toxic, p_severe, p_persistent) of every row, from `labels` (doc_id, toxic).

    Severe and persistent are toxic texts with several different, or repeated, telling words.
    """
    docs = documents(df, text, doc_id)
    known = labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg((F.max("toxic") > 0).alias("toxic"))
    share = min(1.0, max_labelled / max(known.count(), 1))
    sample = known.filter(unit_hash(F.lit("labelled"), "doc_id") < share)
    # The sample has about max_labelled rows at most, whatever the corpus: small enough to broadcast, and for few partitions.
    labelled = materialize(docs.join(F.broadcast(sample), "doc_id").select("doc_id", "text", "toxic").repartition(PARTS), "toxic_sample")
    terms = telling_terms(labelled, "toxic")
    # Telling in earnest: the few words that stand out, not the long tail that chi-squared ranks after them.
    hits = F.filter(words(F.col("text")), lambda w: w.isin(terms[:32])) if terms else F.array().cast("array<string>")
    ready = labelled.withColumns({
        "severe": F.col("toxic") & (F.size(F.array_distinct(hits)) >= SEVERE_WORDS),
        "persistent": F.col("toxic") & (F.size(hits) >= PERSISTENT_WORDS)})
    return fit_chain(ready, ("toxic", "severe", "persistent"), terms).probabilities(docs)
