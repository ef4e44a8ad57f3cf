"""Title TF-IDF and price scaling, relational form.

Equivalent to the ML pipeline Tokenizer -> StopWordsRemover ->
CountVectorizer(vocabSize, minDF) -> IDF -> MinMaxScaler(price), but computed on
*distinct* cleaned titles weighted by how many products carry them, so the text
work scales with the number of distinct titles, not products. Every term that meets
``min_df`` counts, unless the caller asks for the top ``vocab_size`` only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revue.fixed import MIN_DF
from revue.functions.parse import normalise_title, tokenize


def english_stop_words(spark) -> list[str]:
    """Spark's own default English stop-word list (public ML resource)."""
    from pyspark.ml.feature import StopWordsRemover
    return list(StopWordsRemover.loadDefaultStopWords("english"))


def clean_titles(catalog: DataFrame) -> DataFrame:
    """Add ``cleaned_title``; drop products whose cleaned title is empty."""
    return (catalog.withColumn("cleaned_title", normalise_title("title"))
                   .where(F.length("cleaned_title") > 0))


def title_tokens(title, stop_words: list[str]):
    """Tokens of a cleaned title without stop words, as an array column."""
    stop = F.array(*[F.lit(w) for w in stop_words]) if stop_words else F.array().cast("array<string>")
    return F.filter(tokenize(title), lambda t: ~F.array_contains(stop, t))


def title_terms(docs: DataFrame, stop_words: list[str]) -> DataFrame:
    """(cleaned_title, n_docs, term, tf) over distinct titles, stop words removed."""
    per_title = docs.groupBy("cleaned_title").agg(F.count(F.lit(1)).alias("n_docs"))
    toks = title_tokens("cleaned_title", stop_words)
    return (per_title.select("cleaned_title", "n_docs", F.explode(toks).alias("term"))
                     .groupBy("cleaned_title", "n_docs", "term")
                     .agg(F.count(F.lit(1)).alias("tf")))


def term_frequency(terms: DataFrame) -> DataFrame:
    """Per term: document frequency and total count over all products."""
    return terms.groupBy("term").agg(
        F.sum("n_docs").cast("long").alias("doc_freq"),
        F.sum(F.col("n_docs") * F.col("tf")).cast("long").alias("total_count"))


def vocabulary(terms: DataFrame, n_docs, vocab_size: int | None = None, min_df: float = MIN_DF) -> DataFrame:
    """Terms in >= min_df documents (of them the top ``vocab_size`` by total count, if given), with IDF.

    ``min_df`` below 1.0 is a fraction of documents, as in CountVectorizer.
    IDF = ln((N + 1) / (df + 1)). Count ties at the cut are broken by term.
    """
    tf = term_frequency(terms)
    thresh = F.lit(float(min_df)) if min_df >= 1 else F.lit(float(min_df)) * n_docs
    top = tf.where(F.col("doc_freq") >= thresh)
    if vocab_size is not None:
        top = top.orderBy(F.desc("total_count"), "term").limit(vocab_size)
    return top.withColumn("idf", F.log((n_docs + F.lit(1.0)) / (F.col("doc_freq") + F.lit(1.0))))


def scaled_price(docs: DataFrame) -> DataFrame:
    """Min-max scale of price over the documents; a constant column maps to 0.5."""
    rng = docs.agg(F.struct(F.min("price").alias("lo"), F.max("price").alias("hi"))).scalar()
    lo, hi = rng.getField("lo"), rng.getField("hi")
    return docs.withColumn("scaled_price", F.when(hi == lo, F.lit(0.5))
                           .otherwise((F.col("price") - lo) / (hi - lo)))


class TitleFeatures:
    """Relational TF-IDF features of a product catalog (one row per product)."""

    def __init__(self, catalog: DataFrame, vocab_size: int | None = None, min_df: float = MIN_DF,
                 materialize: bool = False):
        """``materialize`` checkpoints the per-product documents and the title
        vectors (to the shared checkpoint folder): several later steps and
        scalar subqueries read them, and the catalog lineage behind them (scan,
        joins, cleaning) should run once, not once per reader."""
        spark = catalog.sparkSession
        base = clean_titles(catalog).select("product_id", "cleaned_title", "price")
        if materialize:
            from revue.conf import checkpointed, scratch_root
            scratch_root(spark)
            base = checkpointed(base)
        self.docs = scaled_price(base)
        self.terms = title_terms(self.docs, english_stop_words(spark))
        self.n_docs = self.docs.agg(F.count(F.lit(1)).cast("double")).scalar()
        self.vocab = vocabulary(self.terms, self.n_docs, vocab_size, min_df)
        # (cleaned_title, term, tf, idf, weight).
        self.vectors = (self.terms.join(self.vocab.select("term", "idf"), "term")
                        .select("cleaned_title", "term", "tf", "idf",
                                (F.col("tf") * F.col("idf")).alias("weight")))
        if materialize:
            self.vectors = checkpointed(self.vectors)

    def product_weights(self) -> DataFrame:
        """(product_id, term, weight): the TF-IDF matrix in coordinate form."""
        return self.docs.select("product_id", "cleaned_title").join(self.vectors, "cleaned_title") \
                        .select("product_id", "term", "weight")
