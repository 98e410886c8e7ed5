"""Quality by ordinal cumulative-link regression on graded ratings (operator 7).

``P(grade <= k) = sigmoid(theta_k - w.x)``: one weight for each hashed word feature, shared by
all grades, and ordered thresholds. A text gives its expected grade and the probability of the
top grade, by which it is kept or rejected.

The model is fitted on a bounded sample of rated rows inside one task; its weights (a fixed number)
are broadcast and every whole text is scored in numpy.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from corpusloom.llm.hashing import SAMPLE_RANGE, sample_share
from corpusloom.llm.shipping import ship
from corpusloom.llm.words import split_words, text_slices
from corpusloom.llm.workers import at_end_of_task, released
from corpusloom.sources.store import drop_staged, stage

FEATURE_BITS = 18
FEATURES = 1 << FEATURE_BITS
KNOWN_WORDS = 100_000
_RIM = re.compile(r"^[\W_]+|[\W_]+$")


@dataclass(frozen=True)
class QualityModel:
    """``thresholds`` has one value less than there are grades, rising."""

    weights: np.ndarray
    thresholds: np.ndarray

    def probabilities(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1.. of each row."""
        return 1.0 / (1.0 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -700, 700)))


_known: dict[str, tuple[int, ...]] = {}
at_end_of_task(_known.clear)


def _word_features(word: str) -> tuple[int, ...]:
    """Buckets of the word, its first four and five letters, and its shape: case and marks around it."""
    found = _known.get(word)
    if found is None:
        core = _RIM.sub("", word)
        case = "U" if core.isupper() and len(core) > 1 else "T" if core.istitle() else "l"
        marks = word.replace(core, "w", 1) if core else word[:3]
        low = core.lower()
        names = (low, f"\0{low[:4]}", f"\0{low[:5]}", f"\0\0{case}{marks[:6]}")
        found = tuple(zlib.crc32(name.encode()) & (FEATURES - 1) for name in names)
        if len(_known) > KNOWN_WORDS:
            _known.clear()
        _known[word] = found
    return found


def text_features(texts: pa.Array, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, feature) of every feature a text has, each once, sorted; and each text's number of words.

    ``wanted`` says which features are of interest."""
    counts, index, distinct = split_words(texts)
    none = np.zeros(0, np.int64)
    if not len(index):
        return none, none, counts
    table = np.array([_word_features(w) for w in distinct.to_pylist()], dtype=np.int64)
    rows = np.repeat(np.arange(len(counts)), counts)
    # How many of a text's words repeat the word before, in tenths.
    again = np.zeros(len(index), dtype=np.int64)
    again[1:] = (index[1:] == index[:-1]) & (rows[1:] == rows[:-1])
    tenths = np.bincount(rows, weights=again, minlength=len(counts)) * 10 // np.maximum(counts, 1)
    own = np.array([zlib.crc32(f"\0\0\0{t}".encode()) & (FEATURES - 1) for t in range(11)])
    shares = (np.arange(len(counts)) << FEATURE_BITS | own[tenths.astype(np.int64)])[counts > 0]
    if wanted is not None:
        some = wanted[table].any(axis=1)[index]
        rows, index = rows[some], index[some]
    rows, index = np.divmod(np.unique(rows * len(table) + index), len(table))
    codes = np.concatenate([rows << FEATURE_BITS | table[index, k] for k in range(table.shape[1])] + [shares])
    if wanted is not None:
        codes = codes[wanted[codes & (FEATURES - 1)]]
    codes = np.unique(codes)
    return codes >> FEATURE_BITS, codes & (FEATURES - 1), counts


def telling_features(
    rows: np.ndarray, features: np.ndarray, grades: np.ndarray, n_grades: int, least_score: float, least_effect: float
) -> np.ndarray:
    """Features whose rows are graded above some step more or less often than all rows, by
    ``least_score`` standard deviations and by ``least_effect`` in log odds. The second keeps out
    common words that merely go with the length of a text."""
    n = len(grades)
    have = np.bincount(features, minlength=FEATURES)
    best = np.zeros(FEATURES)
    for step in range(1, n_grades):
        share = np.mean(grades >= step)
        if 0 < share < 1:
            above = np.bincount(features, weights=(grades >= step)[rows], minlength=FEATURES)
            spread = np.sqrt(np.maximum(have * share * (1 - share) * (1 - have / n), 1e-9))
            odds = np.log((above + share) / (have - above + 1 - share)) - np.log(share / (1 - share))
            score = np.where((have > 0) & (np.abs(odds) >= least_effect), np.abs(above - have * share) / spread, 0)
            best = np.maximum(best, score)
    return best >= least_score


def fit_ordinal(
    rows: np.ndarray,
    features: np.ndarray,
    grades: np.ndarray,
    n_grades: int,
    steps: int = 300,
    rate: float = 0.3,
    decay: float = 1e-6,
    least_score: float | None = None,
    least_effect: float = 1.0,
) -> QualityModel:
    """Maximum likelihood with a quadratic penalty, by Adam over the whole sample.

    Only :func:`telling_features` get a weight, which keeps out the many that fit by chance. Unless
    given, ``least_score`` rises with the root of the sample from 4 to 10.
    """
    n = len(grades)
    if least_score is None:
        least_score = min(10.0, max(4.0, n**0.5 / 9))
    use = telling_features(rows, features, grades, n_grades, least_score, least_effect)[features]
    names, column = np.unique(features[use], return_inverse=True)
    row = rows[use]
    shares = np.cumsum(np.bincount(grades, minlength=n_grades) + 1.0)[:-1] / (n + n_grades)
    start = np.log(shares / (1 - shares))
    # Thresholds as a first value and positive steps stay in order.
    free = np.concatenate((np.zeros(len(names)), start[:1], np.log(np.maximum(np.diff(start), 1e-3))))
    mean, spread = np.zeros_like(free), np.zeros_like(free)
    k = len(names)
    reached = np.arange(1, n_grades)
    for step in range(1, steps + 1):
        steps_up = np.exp(free[k + 1 :])
        thresholds = free[k] + np.concatenate(([0.0], np.cumsum(steps_up)))
        score = np.bincount(row, weights=free[:k][column], minlength=n)
        above = np.clip(1.0 / (1.0 + np.exp(np.clip(thresholds[None, :] - score[:, None], -500, 500))), 1e-12, 1 - 1e-12)
        slope = above * (1 - above)
        # P(grade) = above[grade - 1] - above[grade]
        padded = np.concatenate((np.ones((n, 1)), above, np.zeros((n, 1))), axis=1)
        chance = np.maximum(padded[np.arange(n), grades] - padded[np.arange(n), grades + 1], 1e-12)
        up = (grades[:, None] == reached[None, :]) * slope / chance[:, None]
        down = (grades[:, None] == reached[None, :] - 1) * slope / chance[:, None]
        by_threshold = (up - down) / n
        by_score = -by_threshold.sum(axis=1)
        gradient = np.empty_like(free)
        gradient[:k] = np.bincount(column, weights=by_score[row], minlength=k) + decay * free[:k]
        down_sums = by_threshold.sum(axis=0)
        gradient[k] = down_sums.sum()
        gradient[k + 1 :] = steps_up * np.cumsum(down_sums[::-1])[::-1][1:]
        mean += 0.1 * (gradient - mean)
        spread += 0.01 * (gradient**2 - spread)
        free -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(spread / (1 - 0.99**step)) + 1e-9)
    weights = np.zeros(FEATURES)
    weights[names] = free[:k]
    return QualityModel(weights, free[k] + np.concatenate(([0.0], np.cumsum(np.exp(free[k + 1 :])))))


def fit_quality_model(
    docs: DataFrame,
    ratings: DataFrame,
    key: str,
    text: str,
    grade: str,
    n_grades: int,
    max_fit_rows: int = 10_000,
) -> QualityModel:
    """Learn from ``ratings`` (key, grade from 0 to ``n_grades`` - 1) of the texts in ``docs``.

    ``max_fit_rows`` bounds, about, how many rated keys are learned from, by a hash of the key, and then how many
    rows, by a hash of key, grade and text. The chosen keys with their grades (``n_grades`` for a key at
    most) are the only side broadcast. Ratings that repeat key and grade, and rows that repeat key and text, count
    once; a key with several grades teaches each. Null keys, grades and texts teach nothing. Without ratings the model
    gives every text the top grade.
    """
    ship(docs)
    rated = ratings.select(F.col(key).alias("r_key"), F.col(grade).cast("int").alias("grade")).where(
        f"r_key is not null and grade between 0 and {n_grades - 1}"
    ).distinct()
    hashed = F.pmod(F.xxhash64("r_key"), F.lit(SAMPLE_RANGE))
    n, least = rated.agg(F.count_distinct("r_key"), F.min(hashed)).first()
    chosen = rated.where(hashed < sample_share(n, max_fit_rows, least))
    met = (
        docs.select(F.col(key).alias("k"), F.col(text).alias("text"))
        .where("text is not null")
        .join(F.broadcast(chosen), F.col("k") == F.col("r_key"))
        .select("k", "grade", "text", F.pmod(F.xxhash64("k", "grade", "text"), F.lit(SAMPLE_RANGE)).alias("h"))
        .distinct()
    )
    met = stage(met, "rated-texts")
    # One key may have any number of texts.
    n, least = met.agg(F.count(F.lit(1)), F.min("h")).first()
    sample = met.where(F.col("h") < sample_share(n, 2 * max_fit_rows, least)).select("k", "grade", "text")
    sample = sample.repartition(1).sortWithinPartitions("k", "grade", "text")

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, features, grades, base = [], [], [], 0
        for batch in batches:
            for part in text_slices(batch, "text"):
                r, f, _ = text_features(part.column(2))
                rows.append((r + base).astype(np.int32))
                features.append(f.astype(np.int32))
                grades.append(part.column(1).to_numpy())
                base += part.num_rows
        if base:
            model = fit_ordinal(*map(np.concatenate, (rows, features, grades)), n_grades)
            some = np.flatnonzero(model.weights)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate((some, -1 - np.arange(n_grades - 1)))),
                 pa.array(np.concatenate((model.weights[some], model.thresholds)))],
                names=["place", "value"],
            )

    # At most FEATURES + n_grades rows.
    table = sample.mapInArrow(released(fit), "place bigint, value double").toArrow()
    drop_staged(met)
    weights, thresholds = np.zeros(FEATURES), np.full(n_grades - 1, -np.inf)
    place, value = table["place"].to_numpy(), table["value"].to_numpy()
    weights[place[place >= 0]] = value[place >= 0]
    thresholds[-1 - place[place < 0]] = value[place < 0]
    return QualityModel(weights, thresholds)


def score_quality(df: DataFrame, text: str, model: QualityModel, keep_above: float = 0.5) -> DataFrame:
    """``df`` with ``quality`` = (expected_grade, p_top, keep) of every whole text.

    Kept is what has at least ``keep_above`` as its probability of the top grade. Texts without words
    (null, empty, blank) get grade 0 and are rejected. A column named ``quality`` is replaced; repeated
    rows are scored alike.
    """
    ship(df)
    shared = df.sparkSession.sparkContext.broadcast(model)

    def scores(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = shared.value
        wanted = known.weights != 0
        for texts in batches:
            batch = pa.RecordBatch.from_arrays([texts], names=["text"])
            found = [np.zeros((0, 2))]
            for part in text_slices(batch, "text"):
                rows, features, words = text_features(part.column(0), wanted)
                score = np.bincount(rows, weights=known.weights[features], minlength=part.num_rows)
                above = known.probabilities(score) * (words > 0)[:, None]
                found.append(np.stack([above.sum(axis=1), above[:, -1]], axis=1))
            both = np.concatenate(found)
            yield pa.StructArray.from_arrays([both[:, 0], both[:, 1]], names=["expected_grade", "p_top"])

    @F.arrow_udf("struct<expected_grade:double,p_top:double>")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from released(scores)(batches)

    scored = df.withColumn("quality", score(F.col(f"`{text}`")))
    return scored.withColumn(
        "quality",
        F.struct("quality.expected_grade", "quality.p_top", (F.col("quality.p_top") >= keep_above).alias("keep")),
    )
