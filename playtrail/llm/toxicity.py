"""Toxicity: a linear classifier learned from confirmed toxic texts and unlabelled ones, by the non-negative
estimate of the risk that knows only the share of toxic texts."""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playtrail.llm.tokens import OTHER_THAN_LETTERS, byte_values, latin_lower, mixed, steps

N_FEATURES = 1 << 20
PREFIXES = (4, 5, 6, 7, 8)  # bytes
MAX_POSITIVE, MAX_UNLABELLED = 4_000, 12_000
SEED = 3
THRESHOLD = 0.7
STEEPNESS = 4.0  # spreads scores on both sides of the threshold

_VALUES = byte_values(SEED)


def text_features(texts: pa.Array, n_features: int = N_FEATURES):
    """For each step of a batch `first, owners, features, n`: the words of the texts and the beginnings of words, hashed.

    A beginning finds words that occur in many forms; each feature counts once a text.
    """
    for words in steps(texts, OTHER_THAN_LETTERS, latin_lower):
        roll, owners = words.rolling(_VALUES), words.owners()
        found, whose = [mixed(roll(words.starts, words.ends) + np.uint64(1))], [owners]
        sizes = words.ends - words.starts
        for size in PREFIXES:
            longer = sizes > size
            starts = words.starts[longer]
            found.append(roll(starts, starts + size))
            whose.append(owners[longer])
        features = (np.concatenate(found) & np.uint64(n_features - 1)).astype(np.int64)
        yield words.first, np.concatenate(whose), features, len(words)


@dataclass
class Model:
    weights: np.ndarray
    bias: float

    def scores(self, texts: pa.Array) -> np.ndarray:
        """Between 0 and 1 for each text; without words it is the score of no sign."""
        out = np.zeros(len(texts))
        n_features = len(self.weights)
        for first, owners, features, n in text_features(texts, n_features):
            telling = self.weights[features] != 0
            keys = np.unique(owners[telling] * n_features + features[telling])
            out[first : first + n] = np.bincount(keys // n_features, self.weights[keys % n_features], minlength=n)
        return 1 / (1 + np.exp(-np.clip(out + self.bias, -30, 30)))


def _log_loss(margin: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, -margin)


def learn(
    positive: list[np.ndarray],
    unlabelled: list[np.ndarray],
    prior: float,
    n_features: int = N_FEATURES,
    n_steps: int = 300,
    rate: float = 0.03,
    decay: float = 2e-4,
    min_positive: int = 3,
    min_surprise: float = 6.0,
) -> Model:
    """Minimises prior * R_p(+) + max(0, R_u(-) - prior * R_p(-)) for the logistic loss.

    R_u(-) is the loss of calling unlabelled texts clean; taking away what the toxic among them add leaves
    the loss on clean texts. Where the rest falls below zero, which only over-fitting does, the step goes
    the other way. Only features of at least `min_positive` toxic texts, and
    by `min_surprise` standard deviations more than their share of unlabelled texts, get a weight.
    """
    if not 0 < prior < 1:
        raise ValueError(f"the prior must lie between 0 and 1, not at {prior}")
    if not positive or not unlabelled:
        return Model(np.zeros(n_features), float(np.log(prior / (1 - prior))))
    in_toxic = np.bincount(np.concatenate(positive), minlength=n_features)
    share = (np.bincount(np.concatenate(unlabelled), minlength=n_features) + 1) / (len(unlabelled) + 2)
    expected = len(positive) * share
    surprise = (in_toxic - expected) / np.sqrt(expected * (1 - share))
    used = np.flatnonzero((in_toxic >= min_positive) & (surprise >= min_surprise))
    place = np.full(n_features, -1)
    place[used] = np.arange(len(used))

    def packed(rows):
        rows = [place[row] for row in rows]
        rows = [row[row >= 0] for row in rows]
        bounds = np.concatenate([[0], np.cumsum([len(row) for row in rows])])
        return np.concatenate([np.zeros(0, np.int64), *rows]), bounds

    (toxic, toxic_bounds), (texts, text_bounds) = packed(positive), packed(unlabelled)
    n_toxic, n_texts = len(positive), len(unlabelled)
    of_toxic, of_text = np.repeat(np.arange(n_toxic), np.diff(toxic_bounds)), np.repeat(np.arange(n_texts), np.diff(text_bounds))
    weights, bias = np.zeros(len(used)), float(np.log(prior / (1 - prior)))
    first, second = np.zeros(len(used) + 1), np.zeros(len(used) + 1)
    # All texts in every step: with parts of them the sign of the clean risk would be left to chance.
    for step in range(1, n_steps + 1):
        gp = np.bincount(of_toxic, weights[toxic], minlength=n_toxic) + bias
        gu = np.bincount(of_text, weights[texts], minlength=n_texts) + bias
        risk_clean = _log_loss(-gu).mean() - prior * _log_loss(-gp).mean()
        sp, su = 1 / (1 + np.exp(-np.clip(gp, -30, 30))), 1 / (1 + np.exp(-np.clip(gu, -30, 30)))
        # Derivatives by the margins: s - 1 of the loss as toxic, s of the loss as clean.
        if risk_clean >= 0:
            dp, du = prior * (sp - 1) / n_toxic - prior * sp / n_toxic, su / n_texts
        else:
            dp, du = prior * sp / n_toxic, -su / n_texts
        gradient = np.append(
            np.bincount(toxic, dp[of_toxic], minlength=len(used)) + np.bincount(texts, du[of_text], minlength=len(used)) + decay * weights,
            dp.sum() + du.sum(),
        )
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        move = rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
        weights, bias = weights - move[:-1], bias - move[-1]
    full = np.zeros(n_features)
    full[used] = np.where(np.abs(weights) > 0.02, weights, 0)
    # The score's threshold is put where as many unlabelled texts lie above it as are toxic by the prior.
    margins = np.bincount(of_text, full[used][texts], minlength=n_texts)
    cut = np.quantile(margins, 1 - 0.95 * prior)
    above = margins[margins > 0]
    cut = max(cut, above.min() if len(above) else 1.0)
    return Model(full * STEEPNESS, float(np.log(THRESHOLD / (1 - THRESHOLD)) - cut * STEEPNESS))


def held_out(doc_id: Column) -> Column:
    """A third of all ids, told by their text's checksum; their labels are never learned from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 3 == 1


def _draw(ids: DataFrame, most: int, seed: int) -> DataFrame:
    """At most so many ids, drawn by hash; the hash's bound leaves few for the last step to order."""
    n = ids.count()
    draw = ids.withColumn("draw", F.xxhash64(F.lit(seed), "id"))
    if n > 2 * most:
        draw = draw.where(F.col("draw") < F.lit(int((3 * most / n - 1) * 2**63) if 3 * most < 2 * n else 2**63 - 1))
    return draw.orderBy("draw").limit(most).select("id")


def train(
    documents: DataFrame,
    labels: DataFrame,
    max_positive: int = MAX_POSITIVE,
    max_unlabelled: int = MAX_UNLABELLED,
    n_features: int = N_FEATURES,
    seed: int = SEED,
) -> Model:
    """A model from at most `max_positive` confirmed toxic documents and `max_unlabelled` others as they come.

    The prior is the share of toxic ones among all labels that may be learned from, with one label of each kind added,
    so that it is neither 0 nor 1 whatever the labels are. An id with several labels is toxic if one of them says so;
    of an id with several rows one text counts, the last in order. Held-out documents take no part. Without toxic texts
    or without others the model has no weights and scores all texts by the prior.
    """
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").alias("id")).agg(F.max("toxic").alias("toxic"))
    n_toxic, n_known = known.agg(F.coalesce(F.sum((F.col("toxic") == 1).cast("bigint")), F.lit(0)), F.count("*")).first()
    prior = (n_toxic + 1) / (n_known + 2)
    toxic = _draw(known.where("toxic = 1").select("id"), max_positive, seed)
    texts = documents.select(F.col("doc_id").alias("id"), "text").where(F.col("id").isNotNull() & ~held_out(F.col("id")))
    mixed_ids = _draw(texts.select("id"), max_unlabelled, seed + 1).distinct()
    # Bounded by the two limits, so they may be broadcast.
    wanted = toxic.withColumn("part", F.lit(1)).unionByName(mixed_ids.withColumn("part", F.lit(0)))
    sample = texts.join(F.broadcast(wanted), "id").groupBy("id", "part").agg(F.max("text").alias("text"))

    def features(batches):
        for batch in batches:
            found = []
            for _, owners, features, n in text_features(batch.column(2), n_features):
                keys = np.unique(owners * n_features + features)
                bounds = np.searchsorted(keys, np.arange(n + 1) * n_features)
                own = (keys % n_features).astype(np.int32)
                found += [own[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.binary())], ["id", "part", "features"])

    kind = texts.schema["id"].dataType.simpleString()
    rows = sample.mapInArrow(features, f"id {kind}, part int, features binary").orderBy("part", "id").toLocalIterator()
    parts: tuple[list, list] = ([], [])
    for row in rows:
        parts[row.part].append(np.frombuffer(row.features, np.int32).astype(np.int64))
    return learn(parts[1], parts[0], prior, n_features)


def score(df: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`doc_id, score`, one row for each row of `df`: 0 to 1, higher where a toxic text is likelier.

    Null and empty texts have no sign of toxicity and get the lowest score of a text without signs.
    Repeated rows stay repeated, an empty table gives no rows, other columns are ignored. Nothing is
    shuffled; the model, of a fixed size, is broadcast.
    """
    used = np.flatnonzero(model.weights)
    shared = df.sparkSession.sparkContext.broadcast((len(model.weights), used, model.weights[used], model.bias))

    def run(batches):
        size, places, weights, bias = shared.value
        full = np.zeros(size)
        full[places] = weights
        own = Model(full, bias)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own.scores(batch.column(1)))], ["doc_id", "score"])

    kind = df.schema[doc_id].dataType.simpleString()
    return df.select(doc_id, text).mapInArrow(run, f"doc_id {kind}, score double")
