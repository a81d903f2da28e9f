"""Online variational Bayes for topic models, as `LDA` does it, on blocks of documents.

`LDA` works on one document at a time, and on one that a pass draws twice two times. Here a task works
on blocks of documents of about the same length with batched matrix products, and once on each. Draws,
starts, steps and bounds are those of `LDA`, so topics are the same up to rounding.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.clustering import LDA
from pyspark.sql import DataFrame, SparkSession, functions as F

from agoralens.sources.scratch import new_folder

#: A document is settled when its topic weights change by no more than this on average.
SETTLED = 1e-3
#: Shape of the distribution that starting weights are drawn from; its mean is 1.
START_SHAPE = 100.0
#: Cells (words of a document times topics) of a block: 4 MB.
BLOCK_CELLS = 1 << 19
#: What keeps probabilities of words from being 0.
TINY = 1e-100
#: i * (7 - i) for i below 4.
_PAIRS = np.array([0.0, 6.0, 10.0, 12.0])


def digamma(x: np.ndarray) -> np.ndarray:
    """The derivative of the logarithm of the gamma function, for x > 0."""
    # The sum of 1 / (x + i) for i below 8, two at a time. Calls are few, as arrays are small.
    below = np.add.reduce(1 / np.add.outer(_PAIRS, x * (x + 7))) * (2 * x + 7)
    y = x + 8
    s = 1 / y
    r = s * s
    tail = 1 / 132 - r * (691 / 32760)
    for c in (1 / 240, 1 / 252, 1 / 120, 1 / 12):
        tail = c - r * tail
    return np.log(y) - (below + s * (0.5 + s * tail))


def exp_digamma(x: np.ndarray) -> np.ndarray:
    """e to the power of `digamma`, in few calls on whole arrays and with one logarithm less."""
    # The sum of 1 / (x + i) for i below 8 is (2 x + 7) times a ratio of polynomials in x (x + 7).
    u = x + 7
    u *= x
    below = u * 4
    over = u + 28
    for c, d in ((84, 252), (504, 720)):
        below += c
        below *= u
        over *= u
        over += d
    below += 720
    over *= u
    below /= over
    over = 2 * x
    over += 7
    below *= over
    y = x + 8
    s = 1 / y
    r = s * s
    tail = r * (-691 / 32760)
    tail += 1 / 132
    for c in (-1 / 240, 1 / 252, -1 / 120, 1 / 12):
        tail *= r
        tail += c
    tail *= s
    tail += 0.5
    tail *= s
    tail += below
    np.negative(tail, out=tail)
    np.exp(tail, out=tail)
    tail *= y
    return tail


def trigamma(x: np.ndarray) -> np.ndarray:
    """The derivative of `digamma`, for x > 0."""
    x = np.asarray(x, float)
    below = sum(1 / (x + i) ** 2 for i in range(8))
    x = x + 8
    r = 1 / (x * x)
    tail = 1 / 6 - r * (1 / 30 - r * (1 / 42 - r * (1 / 30 - r * (5 / 66 - r * (691 / 2730 - r * 7 / 6)))))
    return 1 / x + r / 2 + tail * r / x + below


def expected_logs(weights: np.ndarray) -> np.ndarray:
    """Expected logarithms of shares that are Dirichlet with these weights (of the last axis)."""
    k = weights.shape[-1]
    both = np.empty((*weights.shape[:-1], k + 1))
    both[..., :k] = weights
    both[..., k] = weights @ np.ones(k)
    logs = digamma(both)
    return logs[..., :k] - logs[..., k:]


def settle(
    words: np.ndarray, times: np.ndarray, weights: np.ndarray, alpha: np.ndarray, enough: int = 0
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Improve the topic `weights` of a block of documents until at most `enough` of them still change.

    `words` (document, topic, word) are the topics' factors of the words, `times` (document, word) how
    often these are there: 0 for what only fills the block up. Returns which documents are settled, all
    weights, and for the settled ones factors of their topics and words, of which products go into the
    topics: a factor that all topics of a document share falls out of them. Documents that are not settled
    can go on from their weights.
    """
    n, k = weights.shape
    each = np.full(k, 1 / k)
    settled, weights, thetas, ratios = np.zeros(n, bool), weights.copy(), np.empty((n, k)), np.empty(times.shape)
    left, done, new, now = np.arange(n), np.zeros(n, bool), np.zeros(n, bool), weights
    while n > enough:
        theta = exp_digamma(now)
        ratio = np.matmul(theta[:, None, :], words)[:, 0, :]
        ratio += TINY
        np.divide(times, ratio, out=ratio)
        if new.any():
            at = left[new]
            settled[at], weights[at], thetas[at], ratios[at] = True, now[new], theta[new], ratio[new]
            done |= new
            n -= len(at)
            # Settled documents go along until they are some: taking them out copies the others.
            if n <= 0.875 * len(left):
                go = ~done
                left, now, theta, ratio = left[go], now[go], theta[go], ratio[go]
                words, times, done = words[go], times[go], done[go]
            if n <= enough:
                break
        before = now
        now = np.matmul(words, ratio[:, :, None])[:, :, 0]
        now *= theta
        now += alpha
        change = now - before
        np.abs(change, out=change)
        new = change @ each <= SETTLED
        new &= ~done
    go = ~done
    weights[left[go]] = now[go]
    return settled, weights, thetas, ratios


def _blocks(sizes: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """Places of documents of like size, about `BLOCK_CELLS` cells at a time."""
    order = np.argsort(sizes, kind="stable")
    first = 0
    for at in range(1, len(order) + 1):
        if at == len(order) or sizes[order[at]] * k * (at - first + 1) > BLOCK_CELLS:
            yield order[first:at]
            first = at


def _pass(counts: DataFrame, factors: np.ndarray, starts: np.ndarray, alpha: np.ndarray) -> tuple[np.ndarray, np.ndarray, int, int]:
    """Sums over all rows of `counts` (row, indices, values; a row drawn more than once stands
    together): what documents with words add to the topics, their expected logarithms, their number,
    and that of all rows."""
    size, k = factors.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start = starts[TaskContext.get().partitionId()]
        # By word; below, the documents' expected logarithms, their number and that of all rows.
        total = np.zeros((size + 3, k))
        for batch in batches:
            row = batch.column(0).to_numpy()
            total[size + 2] += len(row)
            first = np.flatnonzero(np.append(True, row[1:] != row[:-1])[: len(row)])
            often = np.diff(np.append(first, len(row)))
            bounds = batch.column(1).offsets.to_numpy()
            indices, values = batch.column(1).values.to_numpy(), batch.column(2).values.to_numpy()
            sizes = (bounds[1:] - bounds[:-1])[first]
            filled = sizes > 0
            begins, often, sizes = bounds[:-1][first][filled], often[filled], sizes[filled]
            total[size + 1] += often.sum()
            todo, now = np.arange(len(sizes)), np.tile(start, (len(sizes), 1))
            # Some documents settle in a hundredth of the steps of others: those that are left when half
            # of a block is settled go on together in new blocks.
            while len(todo):
                blocks, rest = [todo[at] for at in _blocks(sizes[todo], k)], []
                for block in blocks:
                    place = np.arange(sizes[block].max())
                    real = place < sizes[block][:, None]
                    cells = np.where(real, begins[block][:, None] + place, 0)
                    at, times = indices[cells], np.where(real, values[cells], 0.0)
                    words = np.ascontiguousarray(factors[at].transpose(0, 2, 1))
                    enough = len(block) // 2 if len(blocks) > 1 else 0
                    done, now[block], thetas, ratios = settle(words, times, now[block], alpha, enough)
                    rest.append(block[~done])
                    block, real, at, thetas, ratios = block[done], real[done], at[done], thetas[done], ratios[done]
                    total[size] += often[block] @ expected_logs(now[block])
                    owner = np.broadcast_to(np.arange(len(block))[:, None], real.shape)[real]
                    at, ratios = at[real], (ratios * often[block][:, None])[real]
                    for topic in range(k):
                        total[:size, topic] += np.bincount(at, ratios * thetas[owner, topic], size)
                todo = np.concatenate(rest)
        used = np.flatnonzero(total.any(1))
        for at in range(0, len(used), 10_000):
            part = used[at : at + 10_000]
            yield pa.RecordBatch.from_arrays([pa.array(part), *[pa.array(total[part, t]) for t in range(k)]], names=["word", *names])

    names = [f"t{topic}" for topic in range(k)]
    found = counts.mapInArrow(run, ", ".join(["word long", *[f"{n} double" for n in names]]))
    added = found.groupBy("word").agg(*[F.sum(n).alias(n) for n in names]).toArrow()
    total = np.zeros((size + 3, k))
    for topic, name in enumerate(names):
        total[added["word"].to_numpy(), topic] = added[name].to_numpy()
    return total[:size], total[size], int(total[size + 1, 0]), int(total[size + 2, 0])


def _starts(spark: SparkSession, seed: int, parts: int, k: int) -> np.ndarray:
    """The topic weights that documents of each partition start from."""
    jvm = spark.sparkContext._jvm
    random, statistics = jvm.org.apache.commons.math3.random, jvm.breeze.stats.distributions
    rows = []
    for part in range(parts):
        basis = statistics.RandBasis(random.MersenneTwister(seed + part))
        gamma = statistics.Gamma(START_SHAPE, 1 / START_SHAPE, basis)
        rows.append([gamma.draw() for _ in range(k)])
    return np.array(rows)


def _next_priors(alpha: np.ndarray, logs: np.ndarray, documents: int, rate: float) -> np.ndarray:
    """A Newton step of the priors towards the documents' mean expected logarithms."""
    gradient = documents * (logs / documents - expected_logs(alpha))
    c, q = documents * trigamma(alpha.sum()), -documents * trigamma(alpha)
    b = (gradient / q).sum() / (1 / c + (1 / q).sum())
    new = alpha - rate * (gradient - b) / q
    return new if (new > 0).all() else alpha


def fit(vectors: DataFrame, lda: LDA) -> tuple[np.ndarray, np.ndarray]:
    """What `lda`, with its online optimizer, learns from `vectors` (one column of sparse vectors): the
    weights of each word in each topic, and those that topics have before any word is read.

    The driver holds the topics, as in `lda.fit`.
    """
    spark, column = vectors.sparkSession, lda.getFeaturesCol()
    folder = new_folder(spark, "counts")
    vectors.select(column).write.parquet(folder)
    counts = spark.read.schema(vectors.select(column).schema).parquet(folder)
    begun = lda.copy({lda.maxIter: 0}).fit(counts)
    topics, alpha = begun.topicsMatrix().toArray(), begun.estimatedDocConcentration().toArray()
    k, share = lda.getK(), lda.getSubsamplingRate()
    eta = lda.getTopicConcentration() if lda.isSet(lda.topicConcentration) else 1 / k
    plain = spark.read.schema(f"`{column}` struct<indices: array<int>, values: array<double>>").parquet(folder)
    rows = plain.select(F.monotonically_increasing_id().alias("row"), f"`{column}`.indices", f"`{column}`.values")
    documents, parts = rows.count(), rows.rdd.getNumPartitions()
    random = spark.sparkContext._jvm.java.util.Random(lda.getSeed())
    random.nextLong()  # that of the first topics
    step = 0
    for _ in range(lda.getMaxIter()):
        drawn = rows.sample(True, share, random.nextLong())
        factors = np.exp(expected_logs(topics.T).T)
        added, logs, n, read = _pass(drawn, factors, _starts(spark, random.nextLong(), parts, k), alpha)
        step += read > 0
        if n:
            rate = (lda.getLearningOffset() + step) ** -lda.getLearningDecay()
            topics = (1 - rate) * topics + rate * (added * factors * documents / np.ceil(share * documents) + eta)
            if lda.getOptimizeDocConcentration():
                alpha = _next_priors(alpha, logs, n, rate)
    return topics, alpha
