"""Language identification by multinomial naive Bayes over hashed character trigrams (operator 9).

Learning counts trigrams of labelled texts by language and bucket, inside tasks and then by a sum.
The log-probability matrix (buckets x languages, a bounded size) is broadcast, and batches of texts
are scored in numpy: one gather for each trigram, one sum for each text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from corpusloom.llm.hashing import SAMPLE_RANGE, sample_share
from corpusloom.llm.shipping import ship
from corpusloom.llm.words import text_slices

BUCKET_BITS = 16
BUCKETS = 1 << BUCKET_BITS
MAX_LANGUAGES = 500
UNDETERMINED = "und"
SLICE_BYTES = 2 << 20


@dataclass(frozen=True)
class LanguageModel:
    """``log_probs`` has a row per bucket and a column per language."""

    languages: list[str]
    log_probs: np.ndarray
    log_priors: np.ndarray


@cache
def _letters() -> np.ndarray:
    """For each code point, whether it is a letter."""
    surrogates = range(0xD800, 0xE000)
    return np.array([c not in surrogates and chr(c).isalpha() for c in range(0x110000)])


def trigram_buckets(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of each trigram, first trigram of each text, whether the text has a letter).

    Texts are lower-cased; whatever is no letter is a blank, and two blanks stand before a text and one behind, so
    every text has a trigram, and what reaches beyond its end meets the next text's blanks alone.
    """
    framed = ["  " + (t or "").lower() + " " for t in texts]
    sizes = np.fromiter(map(len, framed), dtype=np.int64, count=len(framed))
    codes = np.frombuffer(("".join(framed) + "  ").encode("utf-32-le"), dtype=np.uint32)
    letter = _letters()[codes]
    codes = np.where(letter, codes, np.uint32(32))
    mixed = codes[:-2] * np.uint32(0x9E3779B1)
    mixed ^= codes[1:-1] * np.uint32(0x85EBCA6B)
    mixed = (mixed ^ (mixed >> np.uint32(15))) + codes[2:] * np.uint32(0xC2B2AE35)
    mixed *= np.uint32(0x27D4EB2F)
    starts = np.cumsum(sizes) - sizes
    has_letter = np.add.reduceat(letter[:-2], starts) > 0 if len(texts) else np.zeros(0, dtype=bool)
    return (mixed >> np.uint32(32 - BUCKET_BITS)).astype(np.int32), starts, has_letter


def _quota(counts: list[int], bound: int) -> int:
    """The most rows of one language if at most ``bound`` rows are taken in all, at least one."""
    left = bound
    for i, n in enumerate(sorted(counts)):
        even = left // (len(counts) - i)
        if n > even:
            return max(1, even)
        left -= n
    return max(counts)


def fit_language_model(
    df: DataFrame, text: str, lang: str, row_hash: Column, max_fit_rows: int = 20_000
) -> LanguageModel:
    """Learn from the rows of ``df`` with a language, of whole texts.

    The languages and their priors are those of all labelled rows. ``max_fit_rows`` bounds, about, how many
    rows trigrams are learned from: of more rows, every language has as many as fit if rarer ones keep all
    of theirs (:func:`_quota`). Taken are those whose ``row_hash`` (an integer) falls into the language's share, the
    same ones at each run. Null texts teach the priors only. Without any labelled row the model knows no language.
    """
    ship(df)
    labelled = df.select(F.col(lang).alias("lang"), F.col(text).alias("text"), row_hash.alias("h")).where(
        "lang is not null"
    )
    hashed = F.pmod(F.xxhash64("h"), F.lit(SAMPLE_RANGE))
    per_language = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.min(hashed).alias("least"))
    known = sorted(tuple(r) for r in per_language.limit(MAX_LANGUAGES + 1).collect())
    if len(known) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not known:
        return LanguageModel([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0))
    languages, totals = [name for name, _, _ in known], np.array([n for _, n, _ in known])
    quota = _quota(totals.tolist(), max_fit_rows)
    sample = labelled
    if totals.max() > quota:
        shares = [(name, sample_share(n, quota, least)) for name, n, least in known]
        bounds = F.broadcast(df.sparkSession.createDataFrame(shares, "b_lang string, share bigint"))
        sample = labelled.join(bounds, F.col("lang") == F.col("b_lang")).where(hashed < F.col("share"))
    sample = sample.select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, np.ndarray] = {}
        rows: dict[str, int] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for name, counts in found.items():
                some = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * (len(some) + 1)), pa.array(np.append(some, -1)),
                     pa.array(np.append(counts[some], rows[name]))],
                    names=["lang", "bucket", "n"],
                )

        for batch in batches:
            for part in text_slices(batch, "text", SLICE_BYTES):
                buckets, starts, _ = trigram_buckets(part.column(1).to_pylist())
                names = part.column(0).to_pylist()
                ends = np.append(starts[1:], len(buckets))
                for name in dict.fromkeys(names):
                    mine = [buckets[s:e] for s, e, x in zip(starts, ends, names) if x == name]
                    counts = np.bincount(np.concatenate(mine), minlength=BUCKETS)
                    found[name] = found.get(name, 0) + counts
                    rows[name] = rows.get(name, 0) + len(mine)
                if len(found) > 64:
                    yield from out()
                    found, rows = {}, {}
        yield from out()

    sums = (
        sample.mapInArrow(count, "lang string, bucket bigint, n bigint")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
    )
    # At most MAX_LANGUAGES * (BUCKETS + 1) sums.
    table = sums.toArrow()
    counts = np.zeros((BUCKETS + 1, len(languages)))
    column = np.searchsorted(np.array(languages), table["lang"].to_numpy())
    counts[table["bucket"].to_numpy(), column] = table["n"].to_numpy()
    grams, priors = counts[:BUCKETS] + 0.5, totals + 1.0
    return LanguageModel(
        languages,
        np.log(grams / grams.sum(axis=0)).astype(np.float32),
        np.log(priors / priors.sum()),
    )


def score_languages(texts: list[str | None], model: LanguageModel) -> tuple[list[str], np.ndarray]:
    """Language and its posterior probability for each text; ``und`` and 0 without a letter."""
    buckets, starts, has_letter = trigram_buckets(texts)
    if not texts or not model.languages:
        return [UNDETERMINED] * len(texts), np.zeros(len(texts))
    total = np.stack(
        [np.add.reduceat(model.log_probs[:, k][buckets].astype(np.float64), starts) for k in range(len(model.languages))],
        axis=1,
    )
    total += model.log_priors
    best = total.argmax(axis=1)
    odds = np.exp(total - total[np.arange(len(best)), best][:, None]).sum(axis=1)
    names = [model.languages[b] if ok else UNDETERMINED for b, ok in zip(best, has_letter)]
    return names, np.where(has_letter, 1.0 / odds, 0.0)


def identify_language(df: DataFrame, key: str, text: str, model: LanguageModel) -> DataFrame:
    """(key, lang_pred, score) of every row, from its whole text alone.

    Null, empty and letterless texts are ``und`` with score 0, as is everything under a model without
    languages. Ties go to the language that sorts first. Keys may repeat or be null; other
    columns are not read.
    """
    ship(df)
    shared = df.sparkSession.sparkContext.broadcast(
        LanguageModel(model.languages, np.asfortranarray(model.log_probs), model.log_priors)
    )
    kind = to_arrow_type(df.schema[key].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for part in text_slices(batch, batch.schema.names[1], SLICE_BYTES):
                names, scores = score_languages(part.column(1).to_pylist(), known)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(kind), pa.array(names, pa.string()), pa.array(scores)],
                    names=[key, "lang_pred", "score"],
                )

    schema = f"`{key}` {df.schema[key].dataType.simpleString()}, lang_pred string, score double"
    return df.select(key, text).mapInArrow(run, schema)
