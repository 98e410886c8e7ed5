"""Token statistics, losses over score tables, and annotation spans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.arrays import explode_elements, let
from corpusloom.functions.text import as_column
from corpusloom.operators.labels import IGNORE


def _runs(xs: Column) -> Column:
    """Distinct values of an array with their counts: sort, then measure the runs."""

    def measure(s: Column) -> Column:
        n = F.array_size(s)
        starts = F.filter(
            F.sequence(F.lit(0), n - 1),
            lambda i: (i == 0) | ~F.get(s, i).eqNullSafe(F.get(s, i - 1)),
        )

        def counted(at: Column) -> Column:
            ends = F.concat(F.slice(at, F.lit(2), F.array_size(at)), F.array(n))
            return F.zip_with(
                at,
                ends,
                lambda a, b: F.struct(F.get(s, a).alias("token"), (b - a).cast("bigint").alias("n")),
            )

        return F.when(n > 0, let(starts, counted))

    return let(F.array_sort(xs), measure)


def token_bin_counts(
    df: DataFrame, keep: list[str], input_length: Column | int, column: str = "input_ids"
) -> DataFrame:
    """Histogram of each sequence's tokens, ``(*keep, part, token, n)``.

    The first ``input_length`` tokens are the prompt part, the others the output part. A
    token without a row is absent. A sequence is one row, so it is counted inside the row
    and nothing is shuffled.
    """
    cut = F.lit(input_length) if isinstance(input_length, int) else input_length

    def labelled(part: str, tokens: Column) -> Column:
        return F.transform(
            _runs(tokens), lambda r: F.struct(F.lit(part).alias("part"), r["token"], r["n"])
        )

    def parts(ids: Column) -> Column:
        prompt = labelled("prompt", F.slice(ids, F.lit(1), F.greatest(cut, F.lit(0))))
        output = labelled("output", F.slice(ids, F.greatest(cut, F.lit(0)) + 1, F.array_size(ids)))
        nothing = F.array().cast("array<struct<part: string, token: %s, n: bigint>>" % element)
        return F.concat(F.coalesce(prompt, nothing), F.coalesce(output, nothing))

    element = df.schema[column].dataType.elementType.simpleString()
    counts = let(F.col(column), parts)
    return (
        df.select(*keep, explode_elements(counts, "_pos", "_c"))
        .where(F.col("_pos").isNotNull())
        .select(*keep, "_c.part", "_c.token", "_c.n")
    )


def repetition_ratio(df: DataFrame, keep: list[str], column: str = "input_ids") -> DataFrame:
    """Share of tokens that repeat an earlier one; null for an empty sequence."""
    n = F.array_size(column)
    distinct = F.array_size(F.array_distinct(column))
    return df.select(
        *keep, F.when(n > 0, F.lit(1.0) - distinct / n).alias("repetition_ratio")
    )


def log_sum_exp(scores: Column | str) -> Column:
    """log(sum(exp(z))) shifted by the maximum, so that it cannot overflow."""
    z = as_column(scores)
    return let(
        F.array_max(z),
        lambda top: top + F.log(F.aggregate(z, F.lit(0.0), lambda a, x: a + F.exp(x - top))),
    )


def cross_entropy_loss(scores: Column | str, label: Column | str) -> Column:
    """Loss of one row; null if the label is ignored, so that averages skip it."""
    y = as_column(label)
    return let(
        as_column(scores),
        lambda z: F.when(y != IGNORE, log_sum_exp(z) - F.get(z, y.cast("int"))),
    )


def masked_cross_entropy(
    df: DataFrame, scores: str = "scores", label: str = "label", by: list[str] | None = None
) -> DataFrame:
    """Mean cross-entropy over rows whose label is not ignored."""
    loss = cross_entropy_loss(F.col(scores).cast("array<double>"), label)
    return df.withColumn("_loss", loss).groupBy(*(by or [])).agg(
        F.avg("_loss").alias("loss"), F.count("_loss").alias("num_labels")
    )


def _squared_errors(z: Column, y: Column) -> Column:
    return F.aggregate(
        F.zip_with(z, y, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x
    )


def _bce_terms(z: Column, y: Column) -> Column:
    # max(z, 0) - z*y + log(1 + exp(-|z|)): finite for every z.
    def term(a, b):
        return F.greatest(a, F.lit(0.0)) - a * b + F.log1p(F.exp(-F.abs(a)))

    return F.aggregate(F.zip_with(z, y, term), F.lit(0.0), lambda s, x: s + x)


def problem_type(num_labels: int, integer_labels: bool) -> str:
    """Which loss the label kind asks for."""
    if num_labels == 1:
        return "regression"
    return "single_label_classification" if integer_labels else "multi_label_classification"


def label_losses(
    df: DataFrame, kind: str, scores: str = "scores", labels: str = "labels"
) -> DataFrame:
    """Mean loss of a score table. ``scores`` is an array of double; ``labels`` an array of
    the same width, or one class number for single-label classification.

    Squared and binary losses average over every entry, cross-entropy over rows.
    """
    z, y = F.col(scores), F.col(labels)
    if kind == "single_label_classification":
        loss, weight = cross_entropy_loss(z, y), None
    elif kind == "regression":
        loss, weight = _squared_errors(z, y), F.array_size(z)
    elif kind == "multi_label_classification":
        loss, weight = _bce_terms(z, y), F.array_size(z)
    else:
        raise ValueError(f"unknown problem type {kind!r}")
    rows = df.select(loss.alias("_l"), (F.lit(1) if weight is None else weight).alias("_w"))
    counted = F.sum(F.when(F.col("_l").isNotNull(), F.col("_w")))
    return rows.agg(
        F.lit(kind).alias("problem_type"),
        F.when(counted > 0, F.sum("_l") / counted).alias("loss"),
        F.count("_l").alias("num_rows"),
    )


#: Scores are summed in steps of this many units, so that no sum of exponentials overflows.
STEP = 64


def long_cross_entropy(
    df: DataFrame, keys: list[str], entry: str = "token", score: str = "score", label: str = "label"
) -> DataFrame:
    """``(*keys, label, loss)`` of score tables in long form: one row for each prediction and entry, with the prediction's
    label on each of them. ``loss`` is null where the label is ignored or null.

    log(sum(exp(score))) is put together from sums that any two tasks can merge: the scores of a prediction fall
    into steps of ``STEP`` units, each with its own sum of exp(score - start of the step), which are added up
    before the shuffle. The highest step then scales the others. So a prediction over any number of entries takes as
    many rows through the shuffle as it has steps, and no array is made.

    Null scores do not count. A score of -inf adds nothing; +inf and NaN make the loss NaN, as does a label without an entry
    null. Repeated entries each count in the sum, and the largest is the label's.
    """
    z = F.col(score).cast("double")
    finite = ~F.isnan(z) & (F.abs(z) != float("inf"))
    odd = F.isnan(z) | (z == float("inf"))
    # A bound keeps scores that are not finite out of the numbering of steps.
    step = F.when(finite, F.floor(z / STEP)).otherwise(F.lit(-(1 << 40)))
    part = F.when(finite, F.exp(z - F.floor(z / STEP) * STEP)).otherwise(F.lit(0.0))
    own = F.when(F.col(entry) == F.col(label), z)
    sums = (
        df.where(F.col(score).isNotNull())
        .groupBy(*keys, label, step.alias("_step"))
        .agg(F.sum(part).alias("_sum"), F.max(own).alias("_own"), F.max(odd).alias("_odd"))
    )
    found = sums.groupBy(*keys, label).agg(
        F.collect_list(F.struct("_step", "_sum")).alias("_steps"), F.max("_own").alias("_own"), F.max("_odd").alias("_odd")
    )

    def total(steps: Column) -> Column:
        return let(
            F.array_max(F.transform(F.filter(steps, lambda s: s["_sum"] > 0), lambda s: s["_step"])),
            lambda top: top * STEP
            + F.log(F.aggregate(steps, F.lit(0.0), lambda a, s: a + s["_sum"] * F.exp((s["_step"] - top).cast("double") * STEP))),
        )

    loss = F.when(F.col("_odd"), F.lit(float("nan"))).otherwise(total(F.col("_steps")) - F.col("_own"))
    counts = F.col(label).isNotNull() & (F.col(label) != IGNORE)
    return found.select(*keys, label, F.when(counts, loss).alias("loss"))


def long_masked_cross_entropy(
    df: DataFrame, keys: list[str], entry: str = "token", score: str = "score", label: str = "label", by: list[str] | None = None
) -> DataFrame:
    """:func:`masked_cross_entropy` of a score table in long form; ``by`` are among ``keys``."""
    losses = long_cross_entropy(df, keys, entry, score, label)
    return losses.groupBy(*(by or [])).agg(F.avg("loss").alias("loss"), F.count("loss").alias("num_labels"))


def long_label_losses(df: DataFrame, kind: str, keys: list[str], entry: str = "entry", score: str = "score", label: str = "label") -> DataFrame:
    """:func:`label_losses` of a score table in long form, one row for each entry with its own label; for
    single-label classification with the row's class on each. Rows with a null score or label do not count."""
    z, y = F.col(score).cast("double"), F.col(label).cast("double")
    if kind == "single_label_classification":
        rows = long_cross_entropy(df, keys, entry, score, label)
        return rows.agg(F.lit(kind).alias("problem_type"), F.avg("loss").alias("loss"), F.count("loss").alias("num_rows"))
    if kind == "regression":
        loss = (z - y) * (z - y)
    elif kind == "multi_label_classification":
        loss = F.greatest(z, F.lit(0.0)) - z * y + F.log1p(F.exp(-F.abs(z)))
    else:
        raise ValueError(f"unknown problem type {kind!r}")
    sums = df.select(*keys, loss.alias("_l")).groupBy(*keys).agg(F.sum("_l").alias("_sum"), F.count("_l").alias("_n"))
    return sums.agg(
        F.lit(kind).alias("problem_type"),
        F.when(F.sum("_n") > 0, F.sum("_sum") / F.sum("_n")).alias("loss"),
        F.count(F.when(F.col("_n") > 0, 1)).alias("num_rows"),
    )


# The shortest run between << and >>, over line breaks too.
ANNOTATION = r"(?s)<<(.*?)>>"


def calc_annotations(df: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``(*keep, annotations, clean_text)``: the ``<<name=expression>>`` spans of a text.

    Each annotation is ``(name, expression)``, cut at the first ``=``; without one the
    expression is null. Nothing is evaluated.
    """
    spans = F.regexp_extract_all(text, F.lit(ANNOTATION), F.lit(1))

    def parts(span):
        halves = F.split(span, "=", 2)
        return F.struct(F.get(halves, F.lit(0)).alias("name"), F.get(halves, F.lit(1)).alias("expression"))

    return df.select(
        *keep,
        F.transform(spans, parts).alias("annotations"),
        F.regexp_replace(text, ANNOTATION, "").alias("clean_text"),
    )
