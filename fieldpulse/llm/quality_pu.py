"""Quality classifier by positive-unlabelled learning.

Trusted positives and unlabelled text train a linear model by the non-negative unbiased
risk: with class prior p and logistic loss, the risk of the unlabelled rows as negatives
less p times that of the positives as negatives estimates the negatives' risk. Where a
batch's estimate falls below zero the model has begun to fit single rows, and the step
goes the other way. No negative label is used, in training or for the prior.

The class prior is estimated from all unlabelled rows: a model that tells positives
from unlabelled text, fitted on half of each sample, ranks the rest, and the share of all
other unlabelled rows above a cut over that of held-back positives bounds the prior from
above at every cut; the smallest bound, with a margin for the numbers of rows, is taken, and
of several splits the middle one. At the end the model's bias is shifted so that the mean
score of all unlabelled rows is the prior. So the samples decide the model's direction alone.

Features see the text only: how often each pair of neighbouring character classes
occurs, and a few measures of words and lines. They are computed once, in tasks from whole
texts, and written beside the rows; fitting, prior, shift and scores read them from there.
Only two samples of rows, bounded by ``POSITIVES`` and ``UNLABELLED``, reach the
driver, as features; their rows are chosen by a hash of id, text and the row's place, so that
rows of one id, or equal ones, are in or out one by one. Scoring is a map over
all rows without a shuffle; prior and shift come from sums over tasks.

Defined cases: null and empty texts have all-zero features and a score like any text;
labelled ids that are absent from the documents are ignored, ids labelled twice count
as positive if any of their rows is; without positives every score is 0.5, without
unlabelled text the prior is 1; an empty table gives an empty result. Other columns pass
through and may have any name; none is an input of a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BinaryType, DoubleType

from fieldpulse.llm.common import fresh_name, slices
from fieldpulse.session import written

#: Expected sizes of the samples the model is fitted on.
POSITIVES = 6_000
UNLABELLED = 12_000
THRESHOLD = 0.3
#: Steps of a fit, and the positives a step sees at least.
STEPS = 1_500
BATCH_POSITIVES = 100
#: Splits into halves the class prior is estimated on.
SPLITS = 5
#: Draws of a row, and shifts of the bias that one pass over the margins tries.
DRAWS = 1 << 30
SHIFTS = 65
RATE = 0.03
DECAY = 1e-2
CLASSES = 16


# --- Features -------------------------------------------------------------------------


def _classes() -> np.ndarray:
    """Class of every byte of UTF-8: letters by case, digits, space, line end, marks by kind."""
    table = np.full(256, 15, np.uint8)
    for kind, members in enumerate((
        "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t\r", "\n",
        ".,;:", "!", "?", "'\"()-", "*", "$#%", "&|", "<>=/\\{}[]", "@_~^`+",
    )):
        table[[ord(c) for c in members]] = kind
    table[128:] = 14  # letters beyond ASCII, for the most part
    return table


_TABLE = _classes()
_MARKS = (8, 9, 10, 11, 12, 13, 6)
FEATURES = CLASSES * CLASSES + 12


def features_of(text: str | None) -> np.ndarray:
    """Features of one whole text, all finite."""
    found = np.zeros(FEATURES, np.float32)
    raw = (text or "").encode("utf-8", "surrogatepass")
    if not raw:
        return found
    kinds = _TABLE[np.frombuffer(raw, np.uint8)]
    pairs = np.bincount(kinds[:-1].astype(np.int64) * CLASSES + kinds[1:], minlength=CLASSES * CLASSES)
    found[: CLASSES * CLASSES] = np.log1p(pairs * (1000.0 / len(raw)))
    words = raw.split()
    n = max(len(words), 1)
    lines = [line for line in raw.split(b"\n") if line.strip()]
    sizes = np.fromiter(map(len, words), np.float64, len(words)) if words else np.zeros(1)
    counts = np.bincount(kinds, minlength=CLASSES) / len(raw)
    found[CLASSES * CLASSES :] = (
        np.log1p(len(raw)) / 10, np.log1p(n) / 10, sizes.mean() / 10, min(sizes.std() / 10, 5.0),
        sum(map(eq, words, words[1:])) / n * 5, len(set(zip(words, words[1:], strict=False))) / n,
        len(set(words)) / n, len(set(lines)) / max(len(lines), 1),
        sum(counts[k] for k in _MARKS) * 10, counts[1] * 5,
        min(n / max(len(lines), 1) / 50, 5.0),
        sum(line.rstrip().endswith((b".", b"?", b"!", b'"')) for line in lines) / max(len(lines), 1),
    )
    return found


# --- Model ----------------------------------------------------------------------------


@dataclass(frozen=True)
class Model:
    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float

    def score(self, features: np.ndarray) -> np.ndarray:
        """Probability of being positive per row, 0 to 1."""
        return 1 / (1 + np.exp(-self.margin(features).clip(-40, 40)))

    def margin(self, features: np.ndarray) -> np.ndarray:
        return ((features - self.centre) / self.scale).clip(-8, 8) @ self.weights + self.bias


def _descend(x: np.ndarray, gradient, steps: int, rng: np.random.Generator) -> tuple[np.ndarray, float]:
    """Adam on a linear margin, averaged over the second half; ``gradient(rng)`` yields batches of (rows, d risk / d margin by margin)."""
    w, b = np.zeros(x.shape[1]), 0.0
    mean = np.zeros(x.shape[1] + 1)
    first, second = np.zeros(x.shape[1] + 1), np.zeros(x.shape[1] + 1)
    step = 0
    while step < steps:
        for rows, slope in gradient(rng):
            step += 1
            part = x[rows]
            d = slope(part @ w + b)
            g = np.append(part.T @ d + DECAY * w, d.sum())
            first = 0.9 * first + 0.1 * g
            second = 0.999 * second + 0.001 * g * g
            move = RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
            w, b = w - move[:-1], b - move[-1]
            if step > steps // 2:
                mean += (np.append(w, b) - mean) / (step - steps // 2)
    return mean[:-1], mean[-1]


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-z.clip(-40, 40)))


def _batches(n_positive: int, n_unlabelled: int, rng: np.random.Generator):
    """Pairs of row numbers, positives first, that together go through both samples once."""
    batches = max(1, min(n_positive // BATCH_POSITIVES, n_unlabelled))
    p = np.array_split(rng.permutation(n_positive), batches)
    u = np.array_split(rng.permutation(n_unlabelled) + n_positive, batches)
    return zip(p, u, strict=True)


def _non_negative(n_positive: int, n_unlabelled: int, prior: float):
    """Gradient of the non-negative unbiased risk with logistic loss."""

    def gradient(rng: np.random.Generator):
        for a, b in _batches(n_positive, n_unlabelled, rng):

            def slope(z: np.ndarray, cut: int = len(a)) -> np.ndarray:
                s = _sigmoid(z)
                loss_negative = np.logaddexp(0, z)
                as_negative = loss_negative[cut:].mean() - prior * loss_negative[:cut].mean()
                up = (s[:cut] - 1) / cut * prior
                down = np.concatenate([-prior * s[:cut] / cut, s[cut:] / (len(s) - cut)])
                if as_negative < 0:
                    return -down
                down[:cut] += up
                return down

            yield np.concatenate([a, b]), slope

    return gradient


def _domain(n_positive: int, n_unlabelled: int):
    """Gradient of the plain logistic loss that tells the two samples apart, equally weighted."""

    def gradient(rng: np.random.Generator):
        for a, b in _batches(n_positive, n_unlabelled, rng):

            def slope(z: np.ndarray, cut: int = len(a)) -> np.ndarray:
                s = _sigmoid(z)
                s[:cut] = (s[:cut] - 1) / cut
                s[cut:] /= len(z) - cut
                return s / 2

            yield np.concatenate([a, b]), slope

    return gradient


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray, rng: np.random.Generator) -> float:
    """Share of positives in the unlabelled sample: the middle one of several splits."""
    return float(np.median([_prior_of_split(positive, unlabelled, rng) for _ in range(SPLITS)]))


def _prior_of_split(positive: np.ndarray, unlabelled: np.ndarray, rng: np.random.Generator) -> float:
    """The smallest bound on the held-back halves by a model fitted on the other halves."""
    p, u = rng.permutation(len(positive)), rng.permutation(len(unlabelled))
    p_fit, p_hold = positive[p[::2]], positive[p[1::2]]
    u_fit, u_hold = unlabelled[u[::2]], unlabelled[u[1::2]]
    if min(len(p_hold), len(u_hold)) < 10:
        return 1.0
    w, b = _descend(np.concatenate([p_fit, u_fit]), _domain(len(p_fit), len(u_fit)), 500, rng)
    of_p, of_u = p_hold @ w + b, u_hold @ w + b
    cuts = np.quantile(of_p, np.linspace(0, 0.95, 96))
    share_p = np.array([(of_p >= c).mean() for c in cuts])
    share_u = np.array([(of_u >= c).mean() for c in cuts])
    margin = np.sqrt(np.log(40) / 2) * (1 / np.sqrt(len(of_p)) + 1 / np.sqrt(len(of_u)))
    best = np.argmin((share_u + margin) / share_p)
    return float(np.clip(share_u[best] / share_p[best], 0.05, 1.0))


def _matched(margins: np.ndarray, prior: float) -> float:
    """Shift of the margins at which the mean score is the prior."""
    low, high = -40.0, 40.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if _sigmoid(margins + middle).mean() < prior else (low, middle)
    return (low + high) / 2


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None = None, seed: int = 7) -> Model:
    """Model of the two samples; ``prior`` is estimated unless it is given."""
    rng = np.random.default_rng(seed)
    both = np.concatenate([positive, unlabelled]).astype(np.float64)
    if not len(positive):
        return Model(np.zeros(FEATURES), np.ones(FEATURES), np.zeros(FEATURES), 0.0, prior or 0.5)
    centre, scale = both.mean(axis=0), both.std(axis=0) + 0.05
    x = ((both - centre) / scale).clip(-8, 8)
    n = len(positive)
    if prior is None:
        prior = estimate_prior(x[:n], x[n:], rng)
    if not len(unlabelled):
        return Model(centre, scale, np.zeros(FEATURES), 40.0, prior)
    w, b = _descend(x, _non_negative(n, len(unlabelled), prior), STEPS, rng)
    b += _matched(x[n:] @ w + b, prior)
    return Model(centre, scale, w, float(b), prior)


# --- On Spark -------------------------------------------------------------------------


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows whose labels may not be learned from; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def _draw(salt: int) -> Column:
    """A number below 2 ** 30 for each row by itself; the same ones for the same files."""
    return F.pmod(F.xxhash64(F.lit(salt), F.col("doc_id"), F.col("text"), F.monotonically_increasing_id()), F.lit(DRAWS))


def _limit(wanted: int, of: int) -> int:
    """Draws below it take about ``wanted`` of ``of`` rows."""
    return int(DRAWS * min(1.0, wanted / max(of, 1)))


def _sample(docs: DataFrame, salt: int, wanted: int, of: int) -> DataFrame:
    """About ``wanted`` of ``of`` rows, each one by itself."""
    return docs.where(_draw(salt) < _limit(wanted, of))


@F.arrow_udf(BinaryType())
def _features(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for column in texts:
        yield pa.array([features_of(text.as_py()).tobytes() for text in column], pa.binary())


def _matrix(column: pa.Array) -> np.ndarray:
    """Features of the rows of an Arrow column."""
    if not len(column):
        return np.zeros((0, FEATURES), np.float32)
    return np.stack([np.frombuffer(row.as_buffer(), np.float32) for row in column])


@dataclass(frozen=True)
class Featured:
    """A written table of rows with their features and draws, and the names of these columns."""

    rows: DataFrame
    x: str
    as_positive: str
    as_unlabelled: str


def featured(docs: DataFrame, columns: list[str]) -> Featured:
    """``columns`` of ``docs``, and the features of every whole text, computed once."""
    x, one, other = (fresh_name(docs, name) for name in ("features", "draw_positive", "draw_unlabelled"))
    drawn = docs.select(*columns, "text", _draw(1).alias(one), _draw(2).alias(other)) if "text" not in columns else (
        docs.select(*columns, _draw(1).alias(one), _draw(2).alias(other))
    )
    made = drawn.withColumn(x, _features("text")).select(*columns, one, other, x)
    return Featured(written(made, "features"), x, one, other)


def _collected(rows: DataFrame, x: str, *more: str) -> tuple[np.ndarray, ...]:
    """Features of a bounded sample, and further columns, in an order that does not depend on tasks."""
    found = rows.select(x, *more).toArrow()
    matrix = _matrix(found.column(0).combine_chunks())
    others = [found.column(n + 1).to_numpy() for n in range(len(more))]
    order = sorted(range(len(matrix)), key=lambda i: (matrix[i].tobytes(), *(column[i] for column in others)))
    return (matrix[order], *(column[order] for column in others))


def train(
    docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED
) -> Model:
    """Fit on a sample of trusted positives and one of all documents taken as unlabelled.

    Labels of held-out ids are never read. Documents of the held-out ids are also left
    out of the unlabelled rows, so that they stay unseen.
    """
    return _train(featured(docs, ["doc_id"]), labels, positives, unlabelled)


def _train(known: Featured, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> Model:
    learned = labels.select("doc_id", "quality").where(~held_out())
    trusted = learned.where("quality = 1").select("doc_id").distinct()
    of_trusted = known.rows.select("doc_id").join(trusted, "doc_id", "left_semi").count()
    chosen = known.rows.where(F.col(known.as_positive) < _limit(positives, of_trusted)).join(trusted, "doc_id", "left_semi")
    positive, = _collected(chosen, known.x)
    rest = known.rows.where(~held_out())
    limit = _limit(unlabelled, rest.count())
    sample, draws = _collected(rest.where(F.col(known.as_unlabelled) < limit), known.x, known.as_unlabelled)
    if not len(positive):
        return fit(positive, sample)
    prior = prior_of_all(known, rest, positive, sample, draws, limit)
    return _shifted(fit(positive, sample, prior), rest.select(known.x))


def _fits(draws: np.ndarray, split: int) -> np.ndarray:
    """Which half of a sample a split fits on, by the rows' draws."""
    mixed = (draws.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(40 + split)) & np.uint64(1) == 0


def prior_of_all(
    known: Featured, rest: DataFrame, positive: np.ndarray, sample: np.ndarray, draws: np.ndarray, limit: int
) -> float:
    """Share of positives among all ``rest`` rows, of which ``sample`` are those drawn below ``limit``."""
    rng = np.random.default_rng(11)
    both = np.concatenate([positive, sample]).astype(np.float64)
    centre, scale = both.mean(axis=0), both.std(axis=0) + 0.05
    standard = lambda x: ((x - centre) / scale).clip(-8, 8)
    rankings = []
    for split in range(SPLITS):
        order = rng.permutation(len(positive))
        p_fit, p_hold = standard(positive[order[::2]]), standard(positive[order[1::2]])
        u_fit = standard(sample[_fits(draws, split)])
        if len(p_hold) < 10 or not len(u_fit):
            return 1.0
        w, b = _descend(np.concatenate([p_fit, u_fit]), _domain(len(p_fit), len(u_fit)), 500, rng)
        of_p = p_hold @ w + b
        cuts = np.quantile(of_p, np.linspace(0, 0.95, 96))
        rankings.append((w, b, cuts, np.array([(of_p >= c).mean() for c in cuts]), len(of_p)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        above, rows = np.zeros((SPLITS, 96), np.int64), np.zeros(SPLITS, np.int64)
        for batch in slices(batches, 4096):
            x = standard(_matrix(batch.column(0)).astype(np.float64))
            drawn = batch.column(1).to_numpy()
            for split, (w, b, cuts, _, _) in enumerate(rankings):
                margins = np.sort((x @ w + b)[~(_fits(drawn, split) & (drawn < limit))])
                above[split] += len(margins) - np.searchsorted(margins, cuts, "left")
                rows[split] += len(margins)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(SPLITS), pa.int32()), pa.array(rows), pa.array(list(above), pa.list_(pa.int64()))],
            names=["split", "n", "above"],
        )

    counted = rest.select(known.x, known.as_unlabelled).mapInArrow(count, "split int, n long, above array<long>")
    sums = counted.groupBy("split").agg(
        F.sum("n").alias("n"), F.array(*[F.sum(F.get("above", F.lit(k))) for k in range(96)]).alias("above")
    ).collect()
    priors = []
    for row in sums:
        _, _, _, share_p, n_p = rankings[row["split"]]
        if row["n"] < 10:
            return 1.0
        share_u = np.array(row["above"]) / row["n"]
        margin = np.sqrt(np.log(40) / 2) * (1 / np.sqrt(n_p) + 1 / np.sqrt(row["n"]))
        best = np.argmin((share_u + margin) / share_p)
        priors.append(float(np.clip(share_u[best] / share_p[best], 0.05, 1.0)))
    return float(np.median(priors)) if priors else 1.0


def _shifted(model: Model, rest: DataFrame) -> Model:
    """``model`` with the bias at which the mean score of all ``rest`` rows of features is the prior."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4096):
            margins = model.margin(_matrix(batch.column(0)).astype(np.float64))
            yield pa.RecordBatch.from_arrays([pa.array(margins, pa.float64())], names=["margin"])

    margins = written(rest.mapInArrow(compute, "margin double"), "margins")
    low, high = -80.0, 80.0
    while high - low > 1e-9:
        # The mean grows with the shift: each pass over the margins leaves one of the parts between these shifts.
        shifts = np.linspace(low, high, SHIFTS)
        mean = lambda shift: F.avg(1 / (1 + F.exp(-F.greatest(F.lit(-40.0), F.least(F.lit(40.0), F.col("margin") + float(shift))))))
        means = margins.agg(*[mean(shift).alias(f"m{k}") for k, shift in enumerate(shifts)]).first()
        if means[0] is None:
            return model
        below = sum(m < model.prior for m in means)
        low, high = float(shifts[max(below - 1, 0)]), float(shifts[min(below, SHIFTS - 1)])
    # Sums differ in their last digits by the order of tasks; the shift should not.
    return replace(model, bias=model.bias + round((low + high) / 2, 7))


def _scored(x: Column, model: Model) -> Column:
    @F.arrow_udf(DoubleType())
    def scores(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            parts = [model.score(_matrix(column.slice(start, 4096)).astype(np.float64)) for start in range(0, len(column), 4096)]
            yield pa.array(np.concatenate(parts) if parts else np.zeros(0), pa.float64())

    return scores(x)


def score(docs: DataFrame, model: Model, column: str = "score") -> DataFrame:
    """``docs`` plus the score of every whole text."""
    return docs.withColumn(column, _scored(_features("text"), model))


def learn_and_score(docs: DataFrame, labels: DataFrame, columns: list[str], column: str = "score") -> DataFrame:
    """``columns`` of ``docs`` plus the score of every whole text, by a model of the same rows."""
    kept = columns if "doc_id" in columns else [*columns, "doc_id"]
    known = featured(docs, kept)
    model = _train(known, labels)
    return known.rows.select(*columns, _scored(F.col(known.x), model).alias(column))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` whose score reaches ``threshold``, columns unchanged."""
    name = fresh_name(docs, "quality_score")
    return learn_and_score(docs, labels, docs.columns, name).where(F.col(name) >= threshold).drop(name)
