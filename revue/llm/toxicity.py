"""Toxicity by weak supervision: voters, a generative label model, a linear classifier.

From a sample of at most ``sample`` labelled rows (smallest hashed ids):

1. Lexicon: words and their first 4 to 7 bytes, each as "occurs" and as "occurs twice",
   whose document frequency differs between the classes (G statistic of at least 20, in
   favour of toxic), the ``terms`` strongest.
2. Voters: every group of lexicon terms, a few surface patterns and the given label say 1 or 0 of a text.
3. Label model: a latent-class model, fitted by EM (the given labels start it), gives
   each voter's accuracy in either class, the given label's too. Conditional correlations given the
   posterior are estimated from the residuals, and a voter's log odds are divided by its share of the
   correlated voters, so a word and its own prefix don't count twice.
4. Classifier: logistic regression over terms and patterns, trained on the posterior labels.

Scoring is one pass over the texts, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revue.llm import textops as T
from revue.llm.prefix import lowest

SAMPLE, TERMS, GROUPS, G_LEAST = 20_000, 512, 32, 20.0
PREFIXES = (4, 5, 6, 7)
PATTERNS = 4  # shouting, exclamation, symbols, repeated characters
_LOW = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
_TABLE = 1 << 16
_LOW_BITS = T.U(0xFFFF)


def document_terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, term hash) of each word, and of its first 4 to 7 bytes if it is longer; the low 16 bits are 0."""
    low = _LOW[data]
    starts, ends, first = T.word_spans(low, offsets)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    texts, hashes = [text], [T.word_hashes(low, starts, ends)]
    for n in PREFIXES:
        long = ends - starts > n
        texts.append(text[long])
        hashes.append(T.mix(T.word_hashes(low, starts[long], starts[long] + n) + T.U(n)))
    return np.concatenate(texts), np.concatenate(hashes) & ~_LOW_BITS


def patterns(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Texts x 4 shares of bytes: capitals, exclamation marks, other symbols, bytes equal to the two before."""
    upper = (data >= 65) & (data <= 90)
    bang = data == 33
    symbol = np.isin(data, np.frombuffer(b"#$%&*@^~<>", np.uint8))
    triple = np.zeros(len(data), bool)
    triple[2:] = (data[2:] == data[1:-1]) & (data[2:] == data[:-2])
    out = np.empty((len(offsets) - 1, PATTERNS))
    for k, hit in enumerate((upper, bang, symbol, triple)):
        run = np.concatenate([[0], np.cumsum(hit)])
        out[:, k] = (run[offsets[1:]] - run[offsets[:-1]]) / np.maximum(1, np.diff(offsets))
    return out


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, end, data, offsets in T.blocks(batch.column(1)):
            for low in range(0, end - row, 1 << 16):  # text numbers fit into the low bits of a term
                high = min(end - row, low + (1 << 16))
                part = data[offsets[low]:offsets[high]], offsets[low:high + 1] - offsets[low]
                toxic = batch.column(0).slice(row + low, high - low).to_numpy(zero_copy_only=False).astype(np.int64)
                text, term = document_terms(*part)
                key, times = np.unique(term | text.astype(T.U), return_counts=True)
                for least in (1, 2):
                    own = key[times >= least]
                    one, at = np.unique(own & ~_LOW_BITS, return_index=True)
                    hot = np.add.reduceat(toxic[(own & _LOW_BITS).astype(np.int64)], at) if len(at) else at
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(one.view(np.int64)), pa.array(np.full(len(one), least, np.int32)), pa.array(hot),
                         pa.array(np.diff(np.append(at, len(own))))], ["term", "least", "hot", "n"])


class Features:
    """Presence of known terms (texts x terms) and pattern shares. A term is (hash, least number of occurrences)."""

    def __init__(self, terms: np.ndarray, least: np.ndarray):
        self.least = least
        self.known, self.column = np.unique(terms, return_inverse=True)
        self.table = np.zeros(_TABLE, bool)
        self.table[terms >> T.U(48)] = True

    def of(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        text, term = document_terms(data, offsets)
        maybe = self.table[term >> T.U(48)]
        text, term = text[maybe], term[maybe]
        times = np.zeros((len(offsets) - 1, len(self.known)), np.int32)
        if len(self.known):
            at = np.minimum(np.searchsorted(self.known, term), len(self.known) - 1)
            hit = self.known[at] == term
            np.add.at(times, (text[hit], at[hit]), 1)
        return np.hstack([times[:, self.column] >= self.least, patterns(data, offsets)])


def _feature_batches(terms: np.ndarray, least: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = Features(terms, least)
        for batch in batches:
            for row, end, data, offsets in T.blocks(batch.column(1)):
                x = made.of(data, offsets)
                r, c = np.nonzero(x)
                begin = np.searchsorted(r, np.arange(len(x) + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, end - row),
                     pa.ListArray.from_arrays(pa.array(begin), pa.array(c.astype(np.int32))),
                     pa.ListArray.from_arrays(pa.array(begin), pa.array(x[r, c]))], ["toxic", "at", "x"])
    return run


def label_model(votes: np.ndarray, start: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Posterior of class 1 by a latent-class model with correlated voters; ``start`` is a first guess (0 to 1)."""
    post = np.clip(start, 0.02, 0.98)
    for _ in range(rounds):
        weight = post.sum()
        prior = np.clip(weight / len(post), 1e-3, 1 - 1e-3)
        fire1 = (post @ votes + 0.5) / (weight + 1)
        fire0 = ((1 - post) @ votes + 0.5) / (len(post) - weight + 1)
        residual = votes - post[:, None] * fire1 - (1 - post)[:, None] * fire0
        scale = np.sqrt((residual ** 2).sum(axis=0) + 1e-9)
        related = (residual.T @ residual) / scale[:, None] / scale
        share = 1 / np.maximum(1, np.where(related > 0.2, related, 0).sum(axis=1))
        odds = np.log(prior / (1 - prior)) + votes @ (share * np.log(fire1 / fire0)) + (1 - votes) @ (
            share * np.log((1 - fire1) / (1 - fire0)))
        new = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        if np.abs(new - post).max() < 1e-6:
            return new
        post = new
    return post


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1, rounds: int = 25) -> np.ndarray:
    """Weights and intercept (last) of a ridge logistic regression on soft labels, by Newton steps."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    keep = np.full(x.shape[1], ridge)
    keep[-1] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-6)[:, None]).T @ x + np.diag(keep), x.T @ (p - y) + keep * w)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


@dataclass
class ToxicityModel:
    terms: np.ndarray
    least: np.ndarray
    weights: np.ndarray


def fit(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", sample: int = SAMPLE, terms: int = TERMS, groups: int = GROUPS) -> ToxicityModel:
    """Fit on the rows of ``df`` that ``labels`` (id, label 0 or 1) names, at most ``sample`` of them.

    Null ids and labels are ignored; of several labels of one id the largest counts.
    Without labelled rows every text scores 0.
    """
    known = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("toxic"))
             .where("id is not null and toxic is not null").groupBy("id").agg(F.max("toxic").alias("toxic"))
             .join(df.select(F.col(id_col).alias("id")).distinct(), "id", "left_semi").withColumn("all", F.lit(1)))
    known = lowest(known, ["all"], "id", "toxic", sample).select("id", "toxic")
    # Bounded: at most ``sample`` (id, label) pairs.
    rows = (df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
            .join(F.broadcast(known), "id").select("toxic", "t"))
    total = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("hot")).first()
    if not total["n"]:
        return ToxicityModel(np.zeros(0, T.U), np.zeros(0, int), np.append(np.zeros(PATTERNS), -30.0))
    n, hot = float(total["n"]), float(total["hot"])
    counted = (rows.mapInArrow(_count_batches, "term long, least int, hot long, n long").groupBy("term", "least")
               .agg(F.sum("hot").cast("double").alias("a"), F.sum("n").cast("double").alias("m"))
               .where(F.col("a") / F.col("m") > 2 * hot / n if hot else F.lit(False)).where("a >= 3"))
    part = lambda k, e: F.when(k > 0, k * F.log(k / e)).otherwise(0.0)
    a, m = F.col("a"), F.col("m")
    g = 2 * (part(a, m * hot / n) + part(m - a, m * (n - hot) / n)
             + part(hot - a, (n - m) * hot / n) + part(n - hot - m + a, (n - m) * (n - hot) / n))
    strong = counted.withColumn("g", g).where(F.col("g") >= G_LEAST).orderBy(F.desc("g"), "term", "least").limit(terms).collect()
    lexicon = np.array([r["term"] for r in strong], np.int64).view(T.U)
    least = np.array([r["least"] for r in strong], int)
    got = rows.mapInArrow(_feature_batches(lexicon, least), "toxic int, at array<int>, x array<double>").collect()
    x = np.zeros((len(got), len(lexicon) + PATTERNS))
    for k, r in enumerate(got):
        x[k, r["at"]] = r["x"]
    y = np.array([r["toxic"] for r in got], float)
    order = np.lexsort([y, *x[:, len(lexicon):].T, x[:, :len(lexicon)].sum(axis=1)])  # rows may arrive in any order
    x, y = x[order], y[order]
    post = label_model(np.column_stack([voters(x, len(lexicon), groups), y]), 0.05 + 0.9 * y)
    return ToxicityModel(lexicon, least, logistic(x, post))


def voters(x: np.ndarray, terms: int, groups: int) -> np.ndarray:
    """One voter for each ``groups``-th lexicon term onwards, and one for the top tenth of each pattern."""
    lexicon = [x[:, g:terms:groups].max(axis=1) for g in range(min(groups, terms))]
    surface = [x[:, terms + k] > max(1e-9, np.quantile(x[:, terms + k], 0.9)) for k in range(PATTERNS)]
    return np.array([*lexicon, *surface], float).T


def _score_batches(model: ToxicityModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = Features(model.terms, model.least)
        for batch in batches:
            for row, end, data, offsets in T.blocks(batch.column(1)):
                odds = made.of(data, offsets) @ model.weights[:-1] + model.weights[-1]
                score = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, end - row), pa.array(score)], ["id", "score"])
    return run


def score(df: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Return id, score (0 to 1): one row per input row. Null counts as empty text, which scores by the
    intercept. Null and repeated ids pass through, other columns are not read; empty table: empty result."""
    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    return rows.mapInArrow(_score_batches(model), f"id {kind}, score double").withColumnRenamed("id", id_col)
