"""Toxic passages: maximum-scoring segments of token log-odds, with extreme-value statistics."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from lumentide.llm.common import utf8, with_arrow_columns, written

#: ASCII letters lower-cased, other ASCII characters to spaces, everything beyond as it is.
_LETTERS = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32 for c in range(256))
#: Lengths of the word beginnings that are tokens besides the word itself.
STEMS = (3, 4, 5, 6, 7)
#: Bytes of memory for words whose scores a worker remembers, and what one takes besides.
REMEMBERED, _ENTRY = 120 << 20, 150


#: Scripts written without spaces: South-East Asian ones, Han and kana.
_UNSPACED = "[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u2e80-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]"
_RUNS = re.compile(f"({_UNSPACED}+)")
_BEYOND = re.compile(rb"[\xe0-\xff]")


def words_of(text: bytes) -> list[bytes]:
    """Runs of letters; in scripts without spaces every character with the one after it."""
    words = text.translate(_LETTERS).split()
    if not _BEYOND.search(text):
        return words
    found: list[bytes] = []
    for word in words:
        if not _BEYOND.search(word):
            found.append(word)
            continue
        for i, run in enumerate(_RUNS.split(word.decode(errors="replace"))):
            if i % 2:
                found += [run[k:k + 2].encode() for k in range(len(run))]
            elif run:
                found.append(run.encode())
    return found


def stems_of(word: bytes) -> list[bytes]:
    """The word and its beginnings (marked with *), counted in characters, longest first."""
    found = [word]
    if len(word) > STEMS[0]:
        chars = word.decode(errors="replace")
        found += [chars[:k].encode() + b"*" for k in reversed(STEMS) if k < len(chars)]
    return found


@dataclass(frozen=True)
class Model:
    """What scoring needs; all of it is learned from a bounded sample."""

    log_odds: dict[bytes, float]  # of tokens, where not those of their beginnings
    cut: float         # taken off each word's log-odds
    decay: float       # lambda of the extreme-value distribution
    scale: float       # K
    weights: tuple[float, float]  # of the logistic calibration


class Scorer:
    """Log-odds of words, remembered for the frequent ones."""

    def __init__(self, log_odds: dict[bytes, float]):
        self.log_odds = log_odds
        self.known: dict[bytes, float] = {}
        self.held = 0

    def score(self, word: bytes) -> float:
        found = self.known.get(word)
        if found is None:
            found = next((self.log_odds[s] for s in stems_of(word) if s in self.log_odds), 0.0)
            if self.held < REMEMBERED:
                self.known[word] = found
                self.held += _ENTRY + len(word)
        return found

    def scores(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.score, words), np.float64, len(words))


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (`begin`, `end` exclusive, score), in linear time.

    Ruzzo and Tompa, "A linear time algorithm for finding all maximal scoring subsequences".
    Only positive scores open a segment, so the scan steps from one to the next.
    """
    total = np.concatenate([[0.0], np.cumsum(scores)])
    held: list[tuple[int, int, float, float]] = []  # begin, end, sum before, sum after
    before_in: list[int] = []  # for each held one, the last earlier one with a smaller sum before
    for at in np.flatnonzero(scores > 0).tolist():
        begin, left, right = at, float(total[at]), float(total[at + 1])
        while True:
            j = len(held) - 1
            while j >= 0 and held[j][2] >= left:
                j = before_in[j]
            if j < 0 or held[j][3] >= right:
                held.append((begin, at + 1, left, right))
                before_in.append(j)
                break
            begin, _, left, _ = held[j]
            del held[j:], before_in[j:]
    return [(a, b, right - left) for a, b, left, right in held]


def excess(found: list[tuple[int, int, float]], n: int, decay: float, scale: float,
           most: float) -> tuple[float, list[tuple[int, int, float, float]]]:
    """The evidence of a text and its significant segments with their E-values.

    A segment of score S is expected K n exp(-lambda S) times in a clean text of n words.
    Those expected at most `most` times are significant; the evidence adds up their
    -ln E, and is that of the best segment, which may be negative, where none is. Without
    any segment it is that of a score of zero.
    """
    space = math.log(scale * max(n, 1))
    rated = [(a, b, s, decay * s - space) for a, b, s in found]
    chosen = [(a, b, s, math.exp(-min(x, 700.0))) for a, b, s, x in rated if x >= -math.log(most)]
    if chosen:
        return sum(-math.log(max(e, 1e-300)) for *_, e in chosen), chosen
    return max([x for *_, x in rated], default=-space), []


def held_out(doc_id: Column, folds: int = 5) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % folds == 0


def training_sample(
    docs: DataFrame, labels: DataFrame, per_class: int, id_col: str, text_col: str,
    label_col: str, folds: int = 5,
) -> DataFrame:
    """`_text`, `_label`, `_fold` of about `per_class` labelled documents of either class.

    The sample is by a hash of the id, at a rate from the class's size. Its ids, bounded by
    `per_class`, are broadcast to the documents, so that no text moves before it is chosen.
    Equal texts count once, in a fold by a hash of the text, and a document labelled both
    ways is toxic: the sample is the same whatever the order of the rows.
    """
    rows = (
        labels.select(F.col(id_col).alias("_doc"), F.col(label_col).cast("int").alias("_label"))
        .filter(F.col("_doc").isNotNull() & F.col("_label").isin(0, 1))
        .filter(~held_out(F.col("_doc"), folds)).groupBy("_doc").agg(F.max("_label").alias("_label")))
    sizes = {r[0]: r[1] for r in rows.groupBy("_label").count().collect()}
    rate = F.lit(0)
    for label in (0, 1):
        rate = F.when(F.col("_label") == label, F.lit(
            math.ceil(min(1.0, per_class / max(sizes.get(label, 0), 1)) * 1_000_000))).otherwise(rate)
    chosen = rows.filter(F.pmod(F.xxhash64("_doc"), F.lit(1_000_000)) < rate)
    return (
        docs.select(F.col(id_col).alias("_doc"), F.coalesce(text_col, F.lit("")).alias("_text"))
        .join(F.broadcast(chosen), "_doc")
        .withColumn("_fold", F.pmod(F.xxhash64("_text"), F.lit(folds - 1)) + 1)
        .withColumn("_hash", F.sha2("_text", 256))
        .dropDuplicates(["_hash", "_label"]).select("_text", "_label", "_fold"))


def _token_counts(sample: DataFrame) -> DataFrame:
    """Documents of either class that hold a token; added up map-side.

    A token counts once in a document: one that a single text repeats is not more frequent
    in its class for that.
    """
    schema = "token binary, clean long, toxic long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: tuple[Counter, Counter] = (Counter(), Counter())

        def flush() -> pa.RecordBatch:
            tokens = list({**counts[0], **counts[1]})
            made = pa.RecordBatch.from_arrays(
                [pa.array(tokens, pa.binary()),
                 *(pa.array([c[t] for t in tokens], pa.int64()) for c in counts)],
                names=["token", "clean", "toxic"])
            for c in counts:
                c.clear()
            return made

        for batch in batches:
            for text, label in zip(utf8(batch.column(0)), batch.column(1).to_pylist()):
                counts[label].update({s for word in set(words_of(text)) for s in stems_of(word)})
                if len(counts[0]) + len(counts[1]) > 500_000:
                    yield flush()
        yield flush()

    return (
        sample.select("_text", "_label").mapInArrow(run, schema).groupBy("token")
        .agg(*[F.sum(c).alias(c) for c in ("clean", "toxic")]))


def token_log_odds(counted: DataFrame, prior: float, same: float) -> DataFrame:
    """`token` and `d`, its log-odds, without those that differ from their beginning's by up to `same`.

    The share of toxic ones among a token's documents has a Dirichlet prior of `prior`
    documents with the share found for its beginning, next shorter, in documents that do not
    hold the token itself: each counts once on the way from the shortest beginning to the
    word. Log-odds are against the share of toxic ones among all words; rare tokens keep
    close to their beginnings, and those to zero. With one class only there are none.
    """
    n0, n1 = counted.filter(~F.col("token").endswith(F.lit(b"*"))).agg(
        F.sum("clean"), F.sum("toxic")).first()
    if not n0 or not n1:
        return counted.limit(0).select("token", F.lit(0.0).alias("d"))
    text = F.col("token").cast("string")
    body = F.when(text.endswith("*"), F.substring(text, F.lit(1), F.length(text) - 1)).otherwise(text)
    begins = F.transform(
        F.filter(F.array(*map(F.lit, STEMS)), lambda k: k < F.length(body)),
        lambda k: F.concat(F.substring(body, F.lit(1), k), F.lit("*")).cast("binary"))
    own = F.struct(F.lit(99).alias("size"), "clean", "toxic")
    above = counted.select("token", own.alias("own"), F.explode_outer(begins).alias("_begin"))
    met = above.join(
        counted.select(F.col("token").alias("_begin"), F.struct(
            F.length("token").alias("size"), "clean", "toxic").alias("begin")), "_begin", "left")
    chain = met.groupBy("token").agg(
        F.sort_array(F.collect_list("begin")).alias("begins"), F.first("own").alias("own"))

    def share(way: Column) -> Column:
        """From the outermost inwards, each without the documents of the next."""
        rings = F.transform(way, lambda x, i: F.struct(
            *[(x[c] - F.coalesce(F.get(way, i + 1)[c], F.lit(0))).alias(c) for c in ("clean", "toxic")]))
        return F.aggregate(rings, F.lit(n1 / (n0 + n1)), lambda q, x: (
            (x["toxic"] + prior * q) / (x["clean"] + x["toxic"] + prior)))

    def log_odds(way: Column) -> Column:
        q = share(way)
        return F.log(q / (1 - q)) - math.log(n1 / n0)

    return chain.select(
        "token", log_odds(F.array_append("begins", F.col("own"))).alias("d"),
        log_odds(F.col("begins")).alias("_begin")
    ).filter(F.abs(F.col("d") - F.col("_begin")) > same).select("token", "d")


def fit(
    docs: DataFrame, labels: DataFrame, per_class: int = 20_000, id_col: str = "doc_id",
    text_col: str = "text", label_col: str = "toxic", prior: float = 2.0, same: float = 0.25,
    cuts: Sequence[float] = (0.25, 0.5, 1.0, 1.5, 2.0, 2.5, 3.0, 4.0), most: float = 0.05,
) -> Model:
    """Learn the model from at most about `per_class` labelled documents of either class.

    Folds 1 to 3 give every token its log-odds with a Dirichlet prior (Monroe et al.,
    "Fightin' words"), that of rare words from their beginnings; a word not seen has those of
    its longest beginning seen. Fold 4 gives the rest. Lesser odds, as between subjects or languages, would add up over a long
    text, so each word costs a cut, the one of `cuts` under which the calibrated scores of
    fold 4 have the greatest likelihood. Its clean texts give the extreme-value parameters.
    Fold 0 is held out. With one class only, or no labels, every text gets that class's
    share as its score.
    """
    # Stored: the documents are read once for the sample, whatever is learned from it.
    sample = written(
        training_sample(docs, labels, per_class, id_col, text_col, label_col), "sample")
    counted = written(_token_counts(sample.filter("_fold < 4")), "tokens")
    # As two columns: rows of objects would take the driver several times the memory.
    listed = token_log_odds(counted, prior, same).orderBy("token").toArrow()
    log_odds = dict(zip(*(listed[c].to_pylist() for c in ("token", "d"))))
    calibration = sample.filter("_fold = 4")
    values, counts = _clean_scores(calibration, log_odds)
    best = _per_text(
        calibration, log_odds, lambda n, found, _: max((s for *_, s in found), default=0.0), cuts)
    fits = []
    for i, cut in enumerate(cuts):
        decay = _decay(values - cut, counts)
        clean = [(max(n, 1), own[i]) for label, n, own in best if label == 0]
        scale = (len(clean) + 1) / (sum(n * math.exp(-decay * s) for n, s in clean) + 1)
        fits.append((decay, scale))
    evidence = _per_text(
        calibration, log_odds, lambda n, found, i: excess(found, n, *fits[i], most)[0], cuts)
    y = np.array([label for label, *_ in evidence])
    models = []
    for i, cut in enumerate(cuts):
        x = np.array([own[i] for *_, own in evidence])
        weights = _logistic(x, y)
        models.append((_loss(x, y, weights), -cut, Model(log_odds, cut, *fits[i], weights)))
    return min(models, key=lambda m: m[:2])[2]


def _clean_scores(sample: DataFrame, log_odds: dict[bytes, float]) -> tuple[np.ndarray, np.ndarray]:
    """Log-odds of the words of clean texts, in thousandths, and how many words have them."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer, found = Scorer(log_odds), Counter()
        for batch in batches:
            for text in utf8(batch.column(0)):
                found.update(np.rint(1000 * scorer.scores(words_of(text))).astype(int).tolist())
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.int64())],
            names=["value", "n"])

    rows = sorted(tuple(r) for r in (
        sample.filter("_label = 0").select("_text").mapInArrow(run, "value long, n long")
        .groupBy("value").agg(F.sum("n").alias("n")).collect()))
    return np.array([r[0] for r in rows]) / 1000, np.array([r[1] for r in rows])


def _per_text(sample: DataFrame, log_odds: dict[bytes, float], measure, cuts: Sequence[float]) -> list:
    """Label, words and `measure` under each cut of each text of the (bounded) sample, in order."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(log_odds)
        for batch in batches:
            sizes, values = [], []
            for text in utf8(batch.column(0)):
                scores = scorer.scores(words_of(text))
                sizes.append(len(scores))
                values.append([
                    measure(len(scores), segments(scores - c), i) for i, c in enumerate(cuts)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array(sizes, pa.int64()),
                 pa.array(values, pa.list_(pa.float64()))], names=["label", "n", "own"])

    return sorted(tuple(r) for r in sample.select("_text", "_label").mapInArrow(
        run, "label int, n long, own array<double>").collect())


def _decay(scores: np.ndarray, counts: np.ndarray) -> float:
    """The positive root of the mean of exp(lambda score) over clean words being one."""
    if not len(scores) or scores.max() <= 0 or (scores * counts).sum() >= 0:
        return 1.0  # what true log-odds have
    words = counts.sum()
    mean = lambda x: (np.exp(np.minimum(x * scores, 700)) * counts).sum() / words
    low, high = 1e-6, 1.0
    while mean(high) < 1 and high < 64:
        high *= 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if mean(middle) < 1 else (low, middle)
    return high


def _loss(x: np.ndarray, y: np.ndarray, weights: tuple[float, float]) -> float:
    """Mean negative log-likelihood of the labels under calibrated scores."""
    if not len(y):
        return 0.0
    z = np.clip(weights[0] + weights[1] * np.clip(x, -50, 50), -30, 30)
    return float(np.mean(np.log1p(np.exp(z)) - y * z))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> tuple[float, float]:
    """Intercept and slope by Newton's method; the slope is held at or above zero."""
    if not len(y) or y.min() == y.max():
        share = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 0.0
        return (math.log(share / (1 - share)) if 0 < share < 1 else -20.0), 0.0
    x = np.clip(x, -50, 50)
    design = np.stack([np.ones_like(x), x], 1)
    weights = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ weights, -30, 30)))
        slope = design.T @ (y - p) - ridge * weights
        curve = (design * (p * (1 - p))[:, None]).T @ design + ridge * np.eye(2)
        step = np.linalg.solve(curve, slope)
        weights += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(weights[0]), float(max(weights[1], 0.0))


def toxicity(
    docs: DataFrame, model: Model, text_col: str = "text", most: float = 0.05,
) -> DataFrame:
    """Score every whole text and list its significant toxic passages.

    Adds `score` (0 to 1), `predicted` (1 from 0.5 on) and `passages` (words `begin`..`end`,
    `score`, `expected`: how often a clean text of this length has such a passage by chance);
    an input column of one of these names is replaced. One narrow pass: the model, bounded by
    the training sample, goes along with the tasks, no text moves.

    NULL, empty and wordless texts have no passage and the score of no evidence. Long texts
    are scanned whole, in linear time. Repeated rows are scored alike.
    """
    passage = T.ArrayType(T.StructType([
        T.StructField("begin", T.IntegerType()), T.StructField("end", T.IntegerType()),
        T.StructField("score", T.DoubleType()), T.StructField("expected", T.DoubleType())]))
    sent = docs.sparkSession.sparkContext.broadcast(model)
    scorers: list[Scorer] = []

    def compute(texts: pa.Array) -> list[pa.Array]:
        fitted = sent.value
        if not scorers:
            scorers.append(Scorer(fitted.log_odds))
        scores, passages = [], []
        for text in utf8(texts):
            words = words_of(text)
            found = segments(scorers[0].scores(words) - fitted.cut)
            x, chosen = excess(found, len(words), fitted.decay, fitted.scale, most)
            a, b = fitted.weights
            scores.append(1 / (1 + math.exp(-max(-30.0, min(30.0, a + b * max(-50.0, min(50.0, x)))))))
            passages.append([{"begin": i, "end": j, "score": s, "expected": e} for i, j, s, e in chosen])
        return [pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32()),
                pa.array(passages, to_arrow_type(passage))]

    from pyspark.sql.pandas.types import to_arrow_type
    return with_arrow_columns(
        docs, compute, [text_col],
        [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()),
         T.StructField("passages", passage)])
