"""TF-IDF features and a logistic baseline over one text column."""

from __future__ import annotations

from pyspark.ml import Model, PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.missing import quoted
from ..functions.text import TOKEN, tokens
from ..session import drop_staged, staged_alone
from ..spec import LabelRule
from .label import label_positive, label_valid
from .leakage import univariate_auc
from .logistic import Fit, column_blocks, fit_rows, numbered

# A term is hot when it owns more than one in HOT_PARTS of all (document, term)
# pairs.  There can be fewer than HOT_PARTS such terms, whatever the data.
HOT_PARTS = 200_000
# The token pattern inside a SQL string literal.
SQL_TOKEN = TOKEN.replace("\\", "\\\\")


def term_counts(df: DataFrame, doc: str, text: str) -> DataFrame:
    """``(doc, term, tf)``.

    A document is one row, so its repeated terms collapse before the shuffle.
    """
    return _counted(df.select(quoted(doc).alias("doc"), tokens(quoted(text)).alias("words")))


def _counted(listed: DataFrame) -> DataFrame:
    words = listed.select("doc", F.explode("words").alias("term"))
    return words.where("term IS NOT NULL").groupBy("doc", "term").agg(F.count(F.lit(1)).alias("tf"))


def document_frequency(terms: DataFrame) -> DataFrame:
    """``(term, df)``: in how many documents a term occurs, from ``term_counts``.

    Looking at ``tf`` keeps the grouped counts the same plan as elsewhere, so
    that Spark computes and shuffles them once.
    """
    return terms.groupBy("term").agg(F.count_if(F.col("tf") > 0).alias("df"))


def smooth_idf(frequency: Column, n_docs: int) -> Column:
    return F.log(F.lit(1.0 + n_docs) / (F.lit(1.0) + frequency)) + F.lit(1.0)


def tf_idf(df: DataFrame, doc: str, text: str) -> DataFrame:
    """``(doc, term, tf, tfidf)`` with smooth idf and unit length per document.

    Articles and the like occur in almost every document.  Joining the counts
    with the document frequencies on ``term`` alone would send most of the
    pairs to a few tasks.  So the hot terms, a provably short list, are
    broadcast and their pairs never shuffle for this join; the rest joins on
    ``term``, where no key is heavy any more.
    """
    # A token and the gap after it take three characters, which bounds the
    # number of pairs without tokenizing.
    most = F.sum(F.floor((F.length(quoted(text)) + 1) / 3))
    size = df.agg(F.count(F.lit(1)).alias("docs"), most.alias("pairs")).first()
    limit = (size["pairs"] or 0) // HOT_PARTS
    # Token lists are dealt by document once, and are smaller than the pairs; counts, hot pairs and lengths then stay
    # where they are.
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    listed = df.select(quoted(doc).alias("doc"), tokens(quoted(text)).alias("words"))
    terms = _counted(listed.repartition(width, "doc"))
    freq = document_frequency(terms).select(
        "term", "df", smooth_idf(F.col("df"), size["docs"]).alias("idf")
    )
    hot = F.broadcast(freq.where(F.col("df") > limit).select("term", "idf"))
    cold = freq.where(F.col("df") <= limit).select("term", "idf")
    marked = terms.join(hot, "term", "left")
    rest = marked.where("idf IS NULL").drop("idf").join(cold, "term").repartition(width, "doc")
    weighted = marked.where("idf IS NOT NULL").unionByName(rest)
    weighted = weighted.select("doc", "term", "tf", (F.col("tf") * F.col("idf")).alias("w"))
    # One group is the terms of one document, which came from one row.
    length = F.sqrt(F.sum(F.col("w") * F.col("w")).over(W.partitionBy("doc")))
    return weighted.select("doc", "term", "tf", (F.col("w") / length).alias("tfidf"))


def training_rows(df: DataFrame, text: str, rule: LabelRule, max_training_rows: int | None = None) -> DataFrame:
    """The rows a baseline is fitted on, with all their columns: every row with an allowed label.

    Only a caller who gives ``max_training_rows`` gets fewer: where there are more
    labelled rows, a share of them is taken by a hash of text and label, so that
    about that many are left.
    """
    train = df.where(label_valid(rule))
    if max_training_rows is None:
        return train
    labelled = train.count()
    if labelled <= max_training_rows:
        return train
    place = F.pmod(F.xxhash64(quoted(text), label_positive(rule)), F.lit(1 << 40))
    return train.where(place < F.lit(int(max_training_rows / labelled * (1 << 40))))


class Vocabulary:
    """The terms of a fit, in a table that is never fetched."""

    def __init__(self, terms: DataFrame) -> None:
        self.terms = terms

    def __len__(self) -> int:
        return self.terms.count()


class TermLogOdds(Model):
    """Adds ``log_odds``, summed over the tokens of each text from a written table ``(term, n, idf, weight)``."""

    def __init__(self, terms: DataFrame, intercept: float, text: str = "text", tokens: str = "tokens") -> None:
        super().__init__()
        self.terms, self.intercept, self.text, self.tokens = terms, intercept, text, tokens

    @property
    def vocabulary(self) -> Vocabulary:
        return Vocabulary(self.terms)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        # What a text scores depends on nothing else, so it is its own key here; tokens are looked at once.
        keyed = dataset.withColumn("text_key", F.unhex(F.sha2(self.text, 256)))
        words = keyed.select(F.col("text_key").alias("doc"), F.explode(self.tokens).alias("term"))
        # Copies of a text multiply all its counts alike, and its unit vector stays the same.
        counts = words.groupBy("doc", "term").agg(F.count(F.lit(1)).alias("tf"))
        limit = (self.terms.agg(F.sum("n").alias("pairs")).first()["pairs"] or 0) // HOT_PARTS
        known = self.terms.select("term", "idf", "weight")
        hot, cold = known.where(self.terms["n"] > limit), known.where(self.terms["n"] <= limit)
        marked = counts.join(F.broadcast(hot), "term", "left")
        found = marked.where("idf IS NOT NULL").unionByName(
            marked.where("idf IS NULL").drop("idf", "weight").join(cold, "term")
        )
        w = F.col("tf") * F.col("idf")
        sums = found.groupBy(F.col("doc").alias("text_key")).agg(
            F.sum(w * F.col("weight")).alias("pull"), F.sqrt(F.sum(w * w)).alias("length")
        )
        log_odds = F.coalesce(F.col("pull") / F.col("length"), F.lit(0.0)) + F.lit(self.intercept)
        return keyed.join(sums, "text_key", "left").select(*dataset.columns, log_odds.alias("log_odds"))


class LogisticCurve(Model):
    """Adds ``score`` from ``log_odds``; ``fitted`` says how good the weights are."""

    def __init__(self, fit: Fit) -> None:
        super().__init__()
        self.fitted = fit

    @property
    def intercept(self) -> float:
        return self.fitted.intercept

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn("score", F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("log_odds"))))


def fit_baseline(
    df: DataFrame,
    text: str,
    rule: LabelRule,
    max_passes: int = 200,
    tolerance: float = 1e-10,
    max_training_rows: int | None = None,
) -> PipelineModel:
    """TF-IDF and an L2 logistic regression with unit inverse strength, as one pipeline.

    The fit is on ``training_rows``, all labelled rows unless the caller sets a bound;
    every term of those rows becomes a feature and all rows are scored.  The driver
    holds numbers by training row; terms and their weights stay in a table in the
    shared folder.  It ends with a certified optimum, or after ``max_passes`` passes
    over the features; ``model.stages[-1].fitted`` has the passes and the certified gap.
    """
    rows = numbered(
        training_rows(df, text, rule, max_training_rows).select(
            F.coalesce(quoted(text), F.lit("")).alias("text"), label_positive(rule).cast("double").alias("label")
        ),
        "training-rows",
    )
    features = tf_idf(rows, "row", "text")
    entries = staged_alone(
        features.select(F.col("doc").alias("row"), F.col("term").alias("column"), F.col("tfidf").alias("value")),
        "training-entries",
    )
    blocks = column_blocks(rows, entries)
    try:
        fit = fit_rows(blocks, max_passes=max_passes, tolerance=tolerance)
    finally:
        blocks.release()
    weights = blocks.weights(fit.dual).select(
        F.col("column").alias("term"), "n", smooth_idf(F.col("n"), len(blocks.labels)).alias("idf"), "weight"
    )
    terms = staged_alone(weights, "term-weights")
    for read in (rows, entries):
        drop_staged(read)
    tokenizer = SQLTransformer(
        statement=f"SELECT *, regexp_extract_all(lower(text), '{SQL_TOKEN}', 0) AS tokens FROM __THIS__"
    )
    return PipelineModel(
        stages=[tokenizer, TermLogOdds(terms, fit.intercept), LogisticCurve(fit)]
    )


def score(model: PipelineModel, df: DataFrame, text: str) -> DataFrame:
    """The input with ``score``, the probability of the positive class."""
    ready = df if text == "text" else df.withColumn("text", quoted(text))
    ready = ready.withColumn("text", F.coalesce("text", F.lit("")))
    scored = model.transform(ready)
    return scored.drop("tokens", "log_odds", *([] if "text" in df.columns else ["text"]))


def score_auc(scored: DataFrame, rule: LabelRule, column: str = "score") -> DataFrame:
    """One row: exact ROC-AUC of a score, ties counted half."""
    return univariate_auc(scored, rule, [column]).select("auc", "n_pos", "n_neg")


def optimum_gap(
    model: PipelineModel, df: DataFrame, doc: str, text: str, rule: LabelRule
) -> DataFrame:
    """One row, ``(n_pos, n_neg, gap)``: how far the fit is from its own optimality condition.

    At the optimum the weights are the sum of (label - score) times the features.
    They are recomputed from ``tf_idf`` and give each document's log-odds once
    more; ``gap`` is the largest difference.  ``df`` holds the rows of the fit.
    """
    scored = score(model, df.where(label_valid(rule)), text).select(
        quoted(doc).alias("doc"), "score", label_positive(rule).cast("double").alias("y")
    )
    features = tf_idf(df.where(label_valid(rule)), doc, text).select("doc", "term", "tfidf")
    weights = features.join(scored, "doc").groupBy("term").agg(
        F.sum((F.col("y") - F.col("score")) * F.col("tfidf")).alias("weight")
    )
    logits = features.join(weights, "term").groupBy("doc").agg(F.sum(F.col("weight") * F.col("tfidf")).alias("sum"))
    intercept = float(model.stages[-1].intercept)
    log_odds = F.log(F.col("score") / (1 - F.col("score")))
    return scored.join(logits, "doc", "left").agg(
        F.count_if(F.col("y") == 1).alias("n_pos"),
        F.count_if(F.col("y") == 0).alias("n_neg"),
        F.max(F.abs(log_odds - F.coalesce("sum", F.lit(0.0)) - intercept)).alias("gap"),
    )
