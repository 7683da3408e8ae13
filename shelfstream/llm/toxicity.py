"""Toxic passages by maximum-scoring segment search over token log-odds.

A token is a word; it also counts under its first 3 to 6 letters, so that rare forms of a stem share evidence, and scores as the
strongest of these. Training counts tokens in labelled documents. A token's score is its log-odds ratio between toxic and clean documents under an
informative Dirichlet prior, drawn towards zero by two standard deviations; every token also pays a small drift, so that text
without evidence sums below zero. A linear scan finds all maximal scoring segments of a document. Segment scores are
compared with the extreme-value law of the best segment in clean text (Karlin and Altschul): S' = lambda * S - ln(K * n); the
significant excess of a document, summed over its segments, is calibrated to a probability.

A null text is empty and gets the score of no evidence; a null label or doc_id trains nothing; of repeated label rows the
highest counts; repeated documents are scored each; without labels of both kinds every score is the share of toxic labels
(0 without labels); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_steps, settled, texts

#: Bound on the labelled rows that train. Every form with enough evidence in them has a score, so the model is bounded by them too.
TRAIN_ROWS = 20_000
PRIOR_TOKENS = 10_000.0
DRIFT = 0.05
LEAST_Z = 5.0
THRESHOLD = 0.7
PASSAGES = "array<struct<start: int, stop: int, score: double, excess: double>>"
_WORD = re.compile(r"[^\W\d_]+")


def tokens(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def forms(word: str) -> list[str]:
    """The word and its openings, marked as such."""
    return [word, *(f"{word[:k]}~" for k in range(3, min(7, len(word))))]


@dataclass(frozen=True)
class Model:
    base: float = 0.0
    scores: dict[str, float] = field(default_factory=dict)
    decay: float = 1.0
    log_k: float = 0.0
    slope: float = 0.0
    offset: float = 0.0
    drift: float = DRIFT
    met: dict[str, float | None] = field(default_factory=dict, compare=False)

    def of_word(self, word: str) -> float | None:
        """The strongest score of the word's forms; words met before are remembered, up to a bound."""
        if word not in self.met:
            if len(self.met) >= 200_000:
                self.met.clear()
            known = [s for s in map(self.scores.get, forms(word)) if s is not None]
            self.met[word] = max(known, key=abs) if known else None
        return self.met[word]

    def passages(self, text: str) -> list[tuple[int, int, float, float]]:
        """(first token, end, score, S') of the segments of ``text`` whose S' is above 0, in order."""
        words = tokens(text)
        found = [(i, s) for i, s in enumerate(map(self.of_word, words)) if s is not None]
        room = self.log_k + math.log(len(words)) if found else 0.0
        marked = ((a, z, s, self.decay * s - room) for a, z, s in maximal_segments(found, self.drift))
        return [m for m in marked if m[3] > 0]

    def probability(self, excess: float) -> float:
        if not self.scores:
            return self.base
        return 1 / (1 + math.exp(-min(50.0, max(-50.0, self.slope * math.log1p(excess) + self.offset))))


def maximal_segments(found: list[tuple[int, float]], drift: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments of a sequence whose tokens score ``-drift`` each, those in ``found`` their score on top.

    The linear-time scan of Ruzzo and Tompa; runs of plain tokens are one step, as no segment starts or ends in them.
    """
    # start, end, sum before, sum through, and the nearest earlier segment that begins lower (-1: none)
    stack: list[tuple[int, int, float, float, int]] = []
    total, at = 0.0, 0
    for place, score in found:
        total -= drift * (place - at)
        at = place + 1
        gain = score - drift
        if gain <= 0:
            total += gain
            continue
        start, before = place, total
        total += gain
        lower = len(stack) - 1
        while True:
            # Segments between one and its link all begin as high as that one or higher, so they need no look.
            while lower >= 0 and stack[lower][2] >= before:
                lower = stack[lower][4]
            if lower < 0 or stack[lower][3] >= total:
                # Without a segment that begins lower, or if that one ends as high, this one stands.
                break
            start, _, before, _, link = stack[lower]
            del stack[lower:]
            lower = link
        stack.append((start, place + 1, before, total, lower))
    return [(a, z, after - before) for a, z, before, after, _ in stack]


def _counted(sample: DataFrame) -> DataFrame:
    """(word, y1, y0): toxic and clean documents with each form, combined per step before they are summed."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        counts: tuple[Counter, Counter] = (Counter(), Counter())
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            # Once per document: a rare word repeated in one text is no evidence.
            counts[bool(toxic)].update({f for w in set(tokens(text)) for f in forms(w)})
        for toxic, own in enumerate(counts):
            if own:
                kind = pa.array([toxic] * len(own), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(own), kind, pa.array(own.values(), pa.int64())], ["word", "toxic", "n"])

    return map_steps(sample, run, "word string, toxic int, n long").groupBy("word").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("y1"),
        F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("y0"),
    )


def _apart(sample: DataFrame) -> DataFrame:
    """``sample`` with one document for each smallest hash of three words and label: copies are not evidence of their own."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        marks = []
        for text in batch.column("text").to_pylist():
            words = text.encode().lower().split()
            marks.append(min((zlib.crc32(b" ".join(words[i : i + 3])) for i in range(max(1, len(words) - 2))), default=0))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(marks, pa.int64())], ["text", "toxic", "mark"])

    return map_steps(sample, run, "text string, toxic int, mark long").dropDuplicates(["mark", "toxic"]).drop("mark")


def _log_odds(counts: DataFrame, n1: int, n0: int) -> DataFrame:
    prior = PRIOR_TOKENS * (F.col("y1") + F.col("y0")) / (n1 + n0)
    odds = lambda y, n: F.log((F.col(y) + prior) / (n + PRIOR_TOKENS - F.col(y) - prior))
    deviation = F.sqrt(1 / (F.col("y1") + prior) + 1 / (F.col("y0") + prior))
    return counts.select("word", "y1", "y0", (odds("y1", n1) - odds("y0", n0)).alias("delta"), deviation.alias("deviation"), prior.alias("prior"), _strength(n1, n0).alias("strength"))


def _strength(n1: int, n0: int) -> Column:
    """The root of the likelihood ratio of two rates against one, in standard deviations."""
    both = F.col("y1") + F.col("y0")
    term = lambda y, n: F.when(F.col(y) > 0, F.col(y) * F.log(F.col(y) / (both * n / (n1 + n0)))).otherwise(0.0)
    return F.sqrt(F.greatest(F.lit(0.0), 2 * (term("y1", n1) + term("y0", n0))))


def _decay(scores: np.ndarray, chances: np.ndarray) -> float:
    """The positive root of sum(chance * exp(lambda * score)) = 1, the rest of the chance scoring the drift alone."""
    worth = lambda x: float((chances * np.exp(x * scores)).sum())
    low, high = 0.0, 1.0
    while worth(high) < 1 and high < 64:
        high *= 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if worth(middle) < 1 else (low, middle)
    return high


def _calibrated(excess: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve over ln(1 + excess), fitted by Newton steps to smoothed targets."""
    n1, n0 = toxic.sum(), (~toxic).sum()
    aim = np.where(toxic, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([np.log1p(excess), np.ones(len(excess))], axis=1)
    at = np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -50, 50)))
        slope = x.T @ (aim - p) - 1e-6 * at
        curve = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        at = at + step * min(1.0, 4 / max(1e-12, np.abs(step).max()))
        if np.abs(step).max() < 1e-9:
            break
    return float(at[0]), float(at[1])


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """A model from at most ``rows`` labelled documents, the first by hash of their id. ``labels`` has (doc_id, toxic)."""
    known = labels.select(F.col("doc_id").cast("long").alias("label_id"), F.col("toxic").cast("int").alias("toxic")).dropna()
    chosen = settled(known.groupBy("label_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("label_id"), "label_id").limit(rows))
    texted = texts(docs, F.col("doc_id").cast("long").alias("doc_id"))
    sample = texted.join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id")).select("text", "toxic")
    sample = settled(_apart(sample))
    shares = {bool(toxic): n for toxic, n in sample.groupBy(F.col("toxic") > 0).count().collect()}
    if len(shares) < 2:
        return Model(base=1.0 if shares.get(True) else 0.0)
    counts = settled(_counted(sample))
    n1, n0 = counts.agg(F.sum("y1"), F.sum("y0")).first()
    base = shares[True] / sum(shares.values())
    if not n1 or not n0:
        return Model(base=base)
    odds = _log_odds(counts, n1, n0)
    shrunk = F.signum("delta") * F.greatest(F.lit(0.0), F.abs("delta") - 2 * F.col("deviation"))
    kept = odds.withColumn("score", shrunk).where((F.col("score") != 0) & (F.col("strength") >= LEAST_Z))
    lexicon = kept.orderBy(F.desc("strength"), "word").select("word", "score", ((F.col("y0") + F.col("prior")) / (n0 + PRIOR_TOKENS)).alias("chance")).collect()
    if not any(r["score"] > DRIFT for r in lexicon):
        return Model(base=base)
    chances = np.array([r["chance"] for r in lexicon])
    decay = _decay(
        np.array([*(r["score"] for r in lexicon), 0.0]) - DRIFT, np.append(chances, max(0.0, 1 - chances.sum()))
    )
    scores = {r["word"]: r["score"] for r in lexicon}
    plain = Model(base=base, scores=scores, decay=decay, log_k=-math.inf)
    best = _evidence(sample, plain).toPandas()
    clean = best[(best["toxic"] == 0) & (best["words"] > 0)]
    # The mean of the extreme-value law is ln(K n) + Euler's constant in units of lambda.
    log_k = float(np.clip((decay * clean["best"] - np.log(clean["words"])).mean() - np.euler_gamma, -12, 0)) if len(clean) else 0.0
    model = Model(base=base, scores=scores, decay=decay, log_k=log_k)
    excess = _evidence(sample, model).toPandas()
    slope, offset = _calibrated(excess["excess"].to_numpy(), excess["toxic"].to_numpy() > 0)
    return Model(base=base, scores=scores, decay=decay, log_k=log_k, slope=slope, offset=offset)


def _evidence(sample: DataFrame, model: Model) -> DataFrame:
    """Words, best segment score and summed excess of the training documents: three numbers for each of at most TRAIN_ROWS."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found = [model.passages(t) for t in batch.column("text").to_pylist()]
        words = [len(tokens(t)) for t in batch.column("text").to_pylist()]
        best = [max((p[2] for p in f), default=0.0) for f in found]
        excess = [sum(p[3] for p in f) for f in found]
        yield pa.RecordBatch.from_arrays(
            [batch.column("toxic"), pa.array(words, pa.int64()), pa.array(best, pa.float64()), pa.array(excess, pa.float64())],
            ["toxic", "words", "best", "excess"],
        )

    return map_steps(sample, run, "toxic int, words long, best double, excess double")


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, score, predicted, passages) of every row; passages count tokens."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found = [model.passages(t) for t in batch.column("text").to_pylist()]
        marks = [model.probability(sum(p[3] for p in f)) for f in found]
        kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("score", pa.float64()), ("excess", pa.float64())]))
        spans = pa.array([[dict(zip(("start", "stop", "score", "excess"), p)) for p in f] for f in found], kind)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(marks, pa.float64()), pa.array([int(m >= threshold) for m in marks], pa.int32()), spans],
            ["doc_id", "score", "predicted", "passages"],
        )

    rows = texts(docs, F.col("doc_id").cast("long").alias("doc_id"))
    return map_steps(rows, run, f"doc_id long, score double, predicted int, passages {PASSAGES}")


def is_held_out(doc_id: str = "doc_id"):
    """Whether a row is kept from training."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def reject_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` without the rows whose text the model predicts to be toxic."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        said = batch.column("text").to_pylist()
        keep = [model.probability(sum(p[3] for p in model.passages(t or ""))) < THRESHOLD for t in said]
        yield batch.filter(pa.array(keep, pa.bool_()))

    return map_steps(docs, run, docs.schema)
