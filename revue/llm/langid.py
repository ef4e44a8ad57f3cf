"""Language identification: nearest of several clustered centroids per language, by cosine.

Vectors: counts of the 1- to 3-byte n-grams of the lower-case text (runs of non-letters
as one space), hashed into 4,096 columns, (1 + log tf) * idf, length 1. Document
frequencies, centroids and thresholds come from all training rows. The centroids of a language come from spherical
k-means: the counts are written once, and each round is a pass over them that sums vectors in tasks, for all
languages at once. A text gets the language of the nearest centroid, and is rejected when its cosine lies below
``slack`` times a low quantile of the cosines that members of that cluster have at the text's length.
Short texts lie farther off, so the members are also cut to ever shorter lengths, two an octave, and a text is
compared at the length nearest to its number of n-grams. The quantile of all members of the
language bounds that of a dense cluster and stands in for one with few members of a length; a length of which a language has few
members takes those of the next shorter ones too, and one without any the threshold of the one below. Quantiles are read from counts of cosines in steps of 1 / 16,384.

Sums are made of whole numbers, so they depend neither on the order of rows nor on partitions. The model (languages x
clusters x 4,096 numbers, and their thresholds) is all that reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revue.conf import materialize, remove, scratch_path
from revue.llm import textops as T

COLUMNS, GRAMS, CLUSTERS, SLACK = 4096, 3, 4, 0.95
#: Texts whose counts are held at once (each 4,096 numbers), and languages that a model can know.
ROWS, LANGUAGES = 64, 1000
#: Share of the members below the quantile, members that a cluster (or language) needs for one of its own, lengths.
LOW, FEWEST, OCTAVES = 0.01, 30, 80
#: Passes for the main direction and for k-means at most, parts of 1 in a sum and in a cosine's step.
TURNS, ROUNDS, UNIT, STEPS = 20, 12, 2.0 ** 32, 1 << 14
#: Distance that a centroid moves in the last round of k-means at most, if there are fewer than ``ROUNDS``.
STILL = 0.01
#: Lengths in bytes; members are cut to the first of them. Between them, numbers of n-grams where the nearest changes.
_LENGTHS = np.array([(8 << k // 2) * (1 + k % 2 / 2) for k in range(OCTAVES)])
_CUTS, _BOUNDS = _LENGTHS[:19].astype(np.int64), GRAMS * np.sqrt(_LENGTHS[:-1] * _LENGTHS[1:])
_STAGE = np.searchsorted(_CUTS, np.arange(_CUTS[-1] + 2)).astype(np.uint8)
UNDETERMINED = "und"
_LETTER = np.array([97 <= b <= 122 or b >= 128 for b in range(256)])


def _column(code: np.ndarray, n: int) -> np.ndarray:
    return (T.mix(code.astype(T.U) + T.U(n << 32)) >> T.U(52)).astype(np.int32)


_COLUMN = {n: _column(np.arange(1 << 8 * n), n) for n in (1, 2)}


def _grams(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text, column, end byte within ``data``) of the hashed n-grams, by n; n-grams of blanks only do not count."""
    rows, size = len(offsets) - 1, len(data)
    letter = _LETTER[data]
    clean = np.where(letter, data, 32).astype(np.uint32)
    text = np.repeat(np.arange(rows, dtype=np.int32), np.diff(offsets))
    code = np.zeros(size, np.uint32)
    for n in range(1, GRAMS + 1):
        if size < n:
            break
        code = (code[:size - n + 1] << np.uint32(8)) | clean[n - 1:]
        ok = letter[:size - n + 1].copy()
        for j in range(1, n):
            ok |= letter[j:size - n + 1 + j]
            # Two blanks in a row belong to the run of one of their neighbours.
            ok &= letter[j - 1:size - n + j] | letter[j:size - n + 1 + j]
        ok &= text[:size - n + 1] == text[n - 1:]
        at = np.flatnonzero(ok)
        yield text[at], _COLUMN[n][code[at]] if n in _COLUMN else _column(code[at], n), at + n


def gram_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Counts (texts x 4,096) of hashed n-grams; n-grams of blanks only do not count."""
    rows = len(offsets) - 1
    cells = [text * COLUMNS + column for text, column, _ in _grams(data, offsets)]
    return np.bincount(np.concatenate([*cells, np.zeros(0, np.int32)]), minlength=rows * COLUMNS).reshape(rows, COLUMNS)


def vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    tf = np.log1p(counts, dtype=np.float32)
    tf *= idf.astype(np.float32)
    norm = np.sqrt(np.einsum("ij,ij->i", tf, tf))
    return tf / np.where(norm > 0, norm, 1)[:, None]


def octave(grams: np.ndarray) -> np.ndarray:
    """Number of the length (two an octave) that is nearest to each text's number of n-grams."""
    return np.searchsorted(_BOUNDS, grams, side="right")


@dataclass
class LanguageModel:
    idf: np.ndarray
    languages: list[str]
    centroids: np.ndarray
    #: Centroids x lengths: the low quantile of the members' cosines.
    low: np.ndarray


def _lower(text_col: str) -> Column:
    return F.lower(F.coalesce(F.col(text_col), F.lit("")))


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Columns and counts of each text's n-grams."""
    for batch in batches:
        for row, end, data, offsets in T.blocks(batch.column(1), rows=ROWS):
            counts = gram_counts(data, offsets)
            cell = np.flatnonzero(counts)
            begin = np.searchsorted(cell, np.arange(end - row + 1) * COLUMNS)
            at, n = (cell % COLUMNS).astype(np.uint16), counts.ravel()[cell].astype(np.uint32)
            cells = [pa.array([x[a:b].tobytes() for a, b in zip(begin[:-1], begin[1:], strict=True)], pa.binary()) for x in (at, n)]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, end - row), *cells], ["lang", "at", "n"])


def _numbers(cells: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of a binary column, and where each row's begin (with the end)."""
    cells = cells.cast(pa.large_binary())
    size = np.dtype(kind).itemsize
    offsets = np.frombuffer(cells.buffers()[1], np.int64)[cells.offset:cells.offset + len(cells) + 1]
    data = np.frombuffer(cells.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    return np.frombuffer(data.tobytes(), kind), (offsets - offsets[0]) // size


def _frequency_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    df, n = np.zeros(COLUMNS, np.int64), 0
    for batch in batches:
        if batch.num_rows:
            df += np.bincount(_numbers(batch.column(0), np.uint16)[0], minlength=COLUMNS)
            n += batch.num_rows
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, COLUMNS)), pa.array(np.concatenate([[n], df]))],
                                     ["bin", "n"])


def _own_products(tables: np.ndarray, of: np.ndarray, at: np.ndarray, v: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Products (texts x k) of sparse vectors with the k vectors (languages x 4,096 x k) of their language."""
    cell = np.repeat(of, np.diff(begin)) * COLUMNS + at
    return np.column_stack([np.add.reduceat(np.ascontiguousarray(tables[:, :, k]).ravel()[cell] * v, begin[:-1]) for k in range(tables.shape[2])])


def _sum_batches(idf: np.ndarray, languages: list[str], choose):
    """Of each language and part: number of texts and sum of their vectors, weighted, in units of 1 / ``UNIT``.

    ``choose`` (language numbers, columns, values, begins) tells each text's part and weight.
    """
    number = {lang: k for k, lang in enumerate(languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], list] = {}
        for batch in batches:
            for row in range(0, batch.num_rows, 4 * ROWS):
                lang, *cells = batch.slice(row, 4 * ROWS).columns
                (at, begin), (n, _) = _numbers(cells[0], np.uint16), _numbers(cells[1], np.uint32)
                known = np.array([number[x] for x in lang.to_pylist()])[np.diff(begin) > 0]
                begin = np.append(begin[:-1][np.diff(begin) > 0], len(at))  # texts without n-grams shape nothing
                if not len(known):
                    continue
                v = np.log1p(n) * idf[at]
                v /= np.repeat(np.sqrt(np.add.reduceat(v * v, begin[:-1])), np.diff(begin))
                part, weight = choose(known, at, v, begin)
                keys, own, texts = np.unique(np.column_stack([known, part]), axis=0, return_inverse=True, return_counts=True)
                whole = np.rint(v * np.repeat(weight, np.diff(begin)) * UNIT)
                cell = np.repeat(own.ravel(), np.diff(begin)) * COLUMNS + at
                block = np.bincount(cell, whole, len(keys) * COLUMNS).astype(np.int64).reshape(-1, COLUMNS)
                for key, many, values in zip(map(tuple, keys.tolist()), texts.tolist(), block, strict=True):
                    held = sums.setdefault(key, [0, np.zeros(COLUMNS, np.int64)])
                    held[0] += many
                    held[1] += values
        yield _sum_rows(sums)
    return run


def _sum_rows(sums: dict[tuple[int, int], list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([k[0] for k in sums], pa.int32()), pa.array([k[1] for k in sums], pa.int32()),
         pa.array([n for n, _ in sums.values()], pa.int64()), pa.array([x.tobytes() for _, x in sums.values()], pa.binary())],
        ["nth", "part", "n", "sums"])


def _added_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[tuple[int, int], list] = {}
    for batch in batches:
        for r in batch.to_pylist():
            held = sums.setdefault((r["nth"], r["part"]), [0, np.zeros(COLUMNS, np.int64)])
            held[0] += r["n"]
            held[1] += np.frombuffer(r["sums"], np.int64)
    yield _sum_rows(sums)


def _unit(v: np.ndarray) -> np.ndarray:
    return v / max(float(np.linalg.norm(v)), 1e-12)


def centroids(counted: DataFrame, idf: np.ndarray, languages: list[str], clusters: int) -> dict[int, np.ndarray]:
    """Spherical k-means of each language over all rows of ``counted`` (lang, at, n): centroids by number of the language.

    It starts from the parts into which quantiles of a normal distribution cut the rows along the main direction of their spread.
    """
    shape = "nth int, part int, n long, sums binary"

    def summed(choose) -> dict[tuple[int, int], tuple[int, np.ndarray]]:
        """Bounded: a row for each language and cluster."""
        rows = (counted.mapInArrow(_sum_batches(idf, languages, choose), shape)
                .repartition("nth", "part").mapInArrow(_added_batches, shape).collect())
        return {(r["nth"], r["part"]): (r["n"], np.frombuffer(r["sums"], np.int64) / UNIT) for r in rows}

    def everything(known, at, v, begin):
        return np.zeros(len(known), int), np.ones(len(known))

    def along(axes, middle):
        return lambda known, at, v, begin: (np.zeros(len(known), int),
                                            _own_products(axes[:, :, None], known, at, v, begin)[:, 0] - middle[known])

    def cut(axes, middle, bounds):
        def choose(known, at, v, begin):
            place = _own_products(axes[:, :, None], known, at, v, begin)[:, 0] - middle[known]
            return (place[:, None] > bounds[known]).sum(axis=1), np.ones(len(known))
        return choose

    def nearest(table, many):
        def choose(known, at, v, begin):
            cos = _own_products(table, known, at, v, begin)
            return np.where(np.arange(cos.shape[1]) < many[known][:, None], cos, -2.0).argmax(axis=1), np.ones(len(known))
        return choose

    means, sizes = np.zeros((len(languages), COLUMNS)), np.ones(len(languages))
    for (k, _), (n, total) in summed(everything).items():
        means[k], sizes[k] = total / n, n
    axes = np.tile(_unit(np.random.default_rng(1).standard_normal(COLUMNS)), (len(languages), 1))
    spread = np.zeros(len(languages))
    for _ in range(TURNS):
        turned = axes.copy()
        for (k, _), (_, total) in summed(along(axes, (means * axes).sum(axis=1))).items():
            spread[k] = np.linalg.norm(total) / sizes[k]
            turned[k] = _unit(total) if spread[k] > 1e-9 else axes[k]
        near = ((turned * axes).sum(axis=1) > 0.99).all()  # the parts are but a start
        axes = turned
        if near:
            break
    bounds = np.sqrt(spread)[:, None] * [NormalDist().inv_cdf(j / clusters) for j in range(1, clusters)]
    found = summed(cut(axes, (means * axes).sum(axis=1), bounds))
    out = {k: np.array([_unit(found[key][1]) for key in sorted(found) if key[0] == k]) for k in {key[0] for key in found}}
    for _ in range(ROUNDS if clusters > 1 else 0):
        table, many = np.zeros((len(languages), COLUMNS, clusters)), np.zeros(len(languages), int)
        for k, c in out.items():
            table[k, :, :len(c)], many[k] = c.T, len(c)
        found = summed(nearest(table, many))
        new = {k: np.array([_unit(found[k, j][1]) if (k, j) in found else c[j] for j in range(len(c))]) for k, c in out.items()}
        moved = max(np.linalg.norm(new[k] - out[k], axis=1).max() for k in out)
        out = new
        if moved <= STILL:
            break
    return out


def _tally(cell: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct cells (numbers below ``cells``) in order, and how often each occurs."""
    if len(cell) < cells // 16:
        return np.unique(cell, return_counts=True)
    times = np.bincount(cell, minlength=cells)
    found = np.flatnonzero(times)
    return found, times[found]


def _member_batches(model: LanguageModel):
    """Number of texts by nearest centroid of their own language, length and step of the cosine, whole and cut to shorter lengths."""
    names, idf = np.array(model.languages, dtype=object), model.idf.astype(np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in T.blocks(batch.column(1), rows=ROWS):
                lang = batch.column(0).slice(row, end - row).to_numpy(zero_copy_only=False)
                other = names != lang[:, None]
                grams = list(_grams(data, offsets))
                cell = np.concatenate([text * COLUMNS + column for text, column, _ in grams] or [np.zeros(0, np.int32)])
                reach = np.concatenate([to - offsets[text] for text, _, to in grams] or [np.zeros(0, np.int64)])
                stage = _STAGE[np.minimum(reach, len(_STAGE) - 1)]  # the shortest cut that holds the n-gram
                order = np.argsort(stage, kind="stable")
                cell, first = cell[order], np.searchsorted(stage[order], np.arange(len(_CUTS) + 2))
                counts = np.zeros((end - row) * COLUMNS, np.int64)
                x = np.zeros((end - row, COLUMNS), np.float32)
                total, found = np.zeros(end - row, np.int64), []
                for k in range(len(_CUTS) + 1):
                    fresh, times = _tally(cell[first[k]:first[k + 1]], len(counts))
                    counts[fresh] += times
                    total += np.bincount(fresh // COLUMNS, times, end - row).astype(np.int64)
                    x.ravel()[fresh] = np.log1p(counts[fresh], dtype=np.float32) * idf[fresh % COLUMNS]
                    own = np.flatnonzero(np.diff(offsets) > (_CUTS[k] if k < len(_CUTS) else -1))
                    if not len(own):
                        continue
                    here = x if len(own) == len(x) else x[own]
                    norm = np.sqrt(np.einsum("ij,ij->i", here, here))
                    cos = (here @ model.centroids.T) / np.where(norm > 0, norm, 1)[:, None]
                    cos[other[own]] = -2
                    step = np.clip(cos.max(axis=1).astype(float) * STEPS, 0, STEPS).astype(np.int64)
                    found.append((cos.argmax(axis=1) * OCTAVES + octave(total[own])) * (STEPS + 1) + step)
                key, n = np.unique(np.concatenate(found), return_counts=True)
                of, step = np.divmod(key, STEPS + 1)
                yield pa.RecordBatch.from_arrays([pa.array(of // OCTAVES), pa.array(of % OCTAVES), pa.array(step), pa.array(n)],
                                                 ["nth", "octave", "step", "n"])
    return run


def thresholds(model: LanguageModel, texts: DataFrame) -> np.ndarray:
    """``LanguageModel.low`` from all ``texts`` (lang, t). Below the least length with enough members it is 0."""
    spark = texts.sparkSession
    mates = spark.createDataFrame(list(enumerate(model.languages)), "nth long, lang string")
    rows = (texts.where(F.col("lang").isin(sorted(set(model.languages)))).select("lang", "t")
            .mapInArrow(_member_batches(model), "nth long, octave long, step long, n long")
            .groupBy("nth", "octave", "step").agg(F.sum("n").alias("n")))
    # At most STEPS + 1 rows for each centroid and length.
    rows = materialize(rows.join(F.broadcast(mates), "nth"), "language-members")
    # Bounded: a row for each language and length.
    many = {(r["lang"], r["octave"]): r["n"] for r in rows.groupBy("lang", "octave").agg(F.sum("n").alias("n")).collect()}
    spans = []
    for lang, o in many:
        least, held = o, many[lang, o]
        while held < FEWEST and least > 0:
            least -= 1
            held += many.get((lang, least), 0)
        spans.append((lang, o, least))
    spans = spark.createDataFrame(spans, "lang string, to long, least long")
    pooled = (rows.join(F.broadcast(spans), "lang").where(F.col("octave").between(F.col("least"), F.col("to")))
              .select("lang", "nth", F.col("to").alias("octave"), "step", "n"))

    def quantiles(rows: DataFrame, key: str) -> dict[tuple, float]:
        """Bounded: a row for each ``key`` and length."""
        upto = Window.partitionBy(key, "octave").orderBy("step")
        ranked = rows.groupBy(key, "octave", "step").agg(F.sum("n").alias("n")).select(
            key, "octave", "step", F.sum("n").over(upto).alias("upto"), F.sum("n").over(Window.partitionBy(key, "octave")).alias("whole"))
        low = (ranked.where((F.col("upto") >= LOW * F.col("whole")) & (F.col("whole") >= FEWEST))
               .groupBy(key, "octave").agg(F.min("step").alias("step")).collect())
        return {(r[key], r["octave"]): r["step"] / STEPS for r in low}

    own, all_ = quantiles(pooled, "nth"), quantiles(pooled, "lang")
    out = np.zeros((len(model.languages), OCTAVES))
    for k, lang in enumerate(model.languages):
        last = 0.0
        for o in range(OCTAVES):
            if (lang, o) in all_:
                last = min(all_[lang, o], own.get((k, o), 1.0))
            out[k, o] = last
    return out


def fit(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        clusters: int = CLUSTERS) -> LanguageModel:
    """Fit on all rows of ``df`` with a language, text and id.

    Without such rows the model knows no language. More than ``LANGUAGES`` different languages are an error: the model,
    which goes to every worker, grows with them.
    """
    named = df.where(F.col(lang_col).isNotNull()).select(lang_col).distinct().limit(LANGUAGES + 1).count()
    if named > LANGUAGES:
        raise ValueError(f"column {lang_col} has more than {LANGUAGES} languages")
    rows = df.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), _lower(text_col).alias("t")).where(
        "id is not null and lang is not null and t <> ''").select("lang", "t")
    spark = df.sparkSession
    path = scratch_path(spark, "language-grams")
    rows.mapInArrow(_count_batches, "lang string, at binary, n binary").write.parquet(path)
    counted = spark.read.parquet(path)
    grams = counted.select("at").mapInArrow(_frequency_batches, "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n"))
    count = {r["bin"]: r["n"] for r in grams.collect()}
    seen = np.array([count.get(b, 0) for b in range(COLUMNS)])
    idf = np.log((1 + count.get(-1, 0)) / (1 + seen)) + 1
    # Bounded: at most ``LANGUAGES`` names.
    languages = sorted(r["lang"] for r in counted.select("lang").distinct().collect())
    found = centroids(counted, idf, languages, clusters) if languages else {}
    remove(spark, path)  # near the size of the texts, and no pass reads it any more
    model = [(languages[k], c) for k in sorted(found) for c in found[k]]
    out = LanguageModel(idf, [lang for lang, _ in model],
                        np.array([c for _, c in model], np.float32).reshape(len(model), COLUMNS),
                        np.zeros((len(model), OCTAVES)))
    if model:
        out.low = thresholds(out, rows)
    return out


def _nearest(model: LanguageModel, slack: float, letters: np.ndarray, data: np.ndarray, offsets: np.ndarray):
    """Number of the nearest centroid (their count: none), cosine, whether rejected; of the texts of a block."""
    best = np.full(len(letters), len(model.languages))
    sim, far = np.zeros(len(letters)), np.ones(len(letters), bool)
    if model.languages:
        counts = gram_counts(data, offsets)
        cos = vectors(counts, model.idf) @ model.centroids.T
        best = np.where(letters, cos.argmax(axis=1), best)
        sim = np.where(letters, np.clip(cos.max(axis=1), 0, 1), 0.0)
        far = ~letters | (sim < slack * model.low[cos.argmax(axis=1), octave(counts.sum(axis=1))])
    return best, sim.astype(float), far


def _flags(letters: pa.Array) -> np.ndarray:
    return letters.to_numpy(zero_copy_only=False).astype(bool)


def _predict_batches(model: LanguageModel, slack: float):
    names = np.array([*model.languages, UNDETERMINED], dtype=object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            letters = _flags(batch.column(1))
            for row, end, data, offsets in T.blocks(batch.column(2), rows=ROWS):
                best, sim, far = _nearest(model, slack, letters[row:end], data, offsets)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, end - row), pa.array(names[best], pa.string()),
                     pa.array(sim), pa.array(far)], ["id", "lang_pred", "score", "rejected"])
    return run


def _has_letter(text_col: str) -> Column:
    return F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))


def identify(df: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text",
             slack: float = SLACK) -> DataFrame:
    """Return id, lang_pred, score, rejected: one row per input row.

    ``score`` is the cosine with the nearest centroid (0 to 1); of equal cosines the
    first language by code point wins. A null text, one without a letter, or any text
    if the model knows no language, is ``und`` with score 0 and rejected. Empty table:
    empty result. Null and repeated ids pass through; other columns are not read.
    """
    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(id_col).alias("id"), _has_letter(text_col), _lower(text_col))
    return rows.mapInArrow(_predict_batches(model, slack),
                           f"id {kind}, lang_pred string, score double, rejected boolean").withColumnRenamed("id", id_col)


def identified(df: DataFrame, model: LanguageModel, text_col: str = "text", slack: float = SLACK) -> DataFrame:
    """The rows of ``df``, whole, whose text ``identify`` does not reject; nothing is shuffled."""
    def decide(extra: list[pa.Array]) -> np.ndarray:
        letters = _flags(extra[0])
        keep = np.zeros(len(letters), bool)
        for row, end, data, offsets in T.blocks(extra[1], rows=ROWS):
            keep[row:end] = ~_nearest(model, slack, letters[row:end], data, offsets)[2]
        return keep
    return T.row_filter(df, {"letters": _has_letter(text_col), "text": _lower(text_col)}, decide)
