"""Token statistics, routing, losses and annotations."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.operators import metrics, routing
from corpusloom.operators.packing import concat_sources
from corpusloom.operators.tokens import tokenize
from corpusloom.queries import Registry
from corpusloom.queries import tables as t

R = Registry({}, {})


@R.add(
    "token_bin_counts",
    f"""WITH {t.INSTRUCT_SQL}, w AS (SELECT conv_id, turn, {t.words_sql("prompt")} AS p, {t.words_sql("response")} AS r FROM instruct),
flat AS (SELECT conv_id, turn, 'prompt' AS part, unnest(p) AS token FROM w
  UNION ALL SELECT conv_id, turn, 'output', unnest(r) FROM w)
SELECT conv_id, turn, part, token, count(*) AS n FROM flat GROUP BY ALL""",
)
def _(spark, sf):
    pairs = t.instruct(spark, sf)
    both = F.concat("prompt", F.lit("\n"), "response")
    ids = tokenize(
        pairs.withColumn("cut", F.array_size(F.regexp_extract_all("prompt", F.lit(r"[^ \t\n\r]+"), F.lit(0)))).withColumn(
            "text", both
        ),
        "text",
        ["conv_id", "turn", "cut"],
    )
    return metrics.token_bin_counts(ids, ["conv_id", "turn"], F.col("cut"))


@R.add(
    "repetition_ratio",
    f"""SELECT doc_id, round(1.0 - CAST(len(list_distinct(ids)) AS DOUBLE) / len(ids), 6) AS repetition_ratio
FROM (SELECT doc_id, {t.words_sql("text")} AS ids FROM documents)""",
)
def _(spark, sf):
    ids = tokenize(t.documents(spark, sf), "text", ["doc_id"])
    ratios = metrics.repetition_ratio(ids, ["doc_id"])
    return ratios.withColumn("repetition_ratio", F.round("repetition_ratio", 6))


def _vectors(spark, sf):
    return t.table(spark, sf, "embeddings", t.EMBEDDINGS)


def _centroids(spark, sf):
    """The first sixteen vectors, in four groups, with a small bias."""
    return _vectors(spark, sf).where("vec_id < 16").select(
        F.col("vec_id").alias("bucket"),
        F.call_function("div", F.col("vec_id"), F.lit(4).cast("bigint")).alias("grp"),
        (F.col("vec_id") % 3 * 0.05).alias("bias"),
        F.col("embedding").alias("vector"),
    )


_ROUTES = """x AS (SELECT vec_id, list_transform(embedding, lambda v: CAST(v AS DOUBLE)) AS v FROM embeddings), c AS (
  SELECT vec_id AS bucket, vec_id // 4 AS grp, CAST(vec_id % 3 AS DOUBLE) * 0.05 AS bias, v AS cv FROM x WHERE vec_id < 16), s AS (
  SELECT vec_id, bucket, grp, bias, 1.0 / (1.0 + exp(-list_dot_product(v, cv))) AS score FROM x, c), g AS (
  SELECT vec_id, grp, sum(score + bias) AS total FROM (
    SELECT *, row_number() OVER (PARTITION BY vec_id, grp ORDER BY score + bias DESC) AS r FROM s) WHERE r <= 2 GROUP BY ALL), gg AS (
  SELECT vec_id, grp FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY total DESC, grp) AS r FROM g) WHERE r <= 2), m AS (
  SELECT s.vec_id, s.bucket, s.score, row_number() OVER (PARTITION BY s.vec_id
    ORDER BY CASE WHEN gg.grp IS NULL THEN 0.0 ELSE s.score + s.bias END DESC, s.bucket) - 1 AS rank
  FROM s LEFT JOIN gg ON gg.vec_id = s.vec_id AND gg.grp = s.grp), routes AS (
  SELECT vec_id, CAST(rank AS INTEGER) AS rank, CAST(bucket AS INTEGER) AS bucket,
    score / (sum(score) OVER (PARTITION BY vec_id) + 1e-20) * 2.5 AS weight FROM m WHERE rank < 4)"""


def _routes(spark, sf):
    return routing.route_topk(
        _vectors(spark, sf),
        _centroids(spark, sf),
        ["vec_id"],
        "embedding",
        top_k=4,
        top_groups=2,
        scale=2.5,
    )


@R.add("route_topk", f"WITH {_ROUTES} SELECT vec_id, rank, bucket, round(weight, 6) AS weight FROM routes")
def _(spark, sf):
    return _routes(spark, sf).withColumn("weight", F.round("weight", 6))


@R.add(
    "route_load",
    f"""WITH {_ROUTES}, loads AS (
  SELECT CAST(c.bucket AS INTEGER) AS bucket, count(r.vec_id) AS load FROM c LEFT JOIN routes r ON r.bucket = c.bucket GROUP BY c.bucket)
SELECT bucket, load, round(load / avg(load) OVER (), 6) AS load_ratio FROM loads""",
)
def _(spark, sf):
    loads = routing.route_load(_routes(spark, sf), _centroids(spark, sf))
    return loads.withColumn("load_ratio", F.round("load_ratio", 6))


# Label 9 plays the ignored one.
@R.add(
    "masked_cross_entropy",
    """WITH z AS (SELECT list_transform(embedding, lambda v: CAST(v AS DOUBLE)) AS z,
  CASE WHEN label = 9 THEN -100 ELSE label END AS y FROM embeddings), l AS (
  SELECT CASE WHEN y <> -100 THEN list_max(z) + ln(list_sum(list_transform(z, lambda x: exp(x - list_max(z))))) - z[y + 1] END AS loss FROM z)
SELECT round(avg(loss), 6) AS loss, count(loss) AS num_labels FROM l""",
)
def _(spark, sf):
    label = F.when(F.col("label") == 9, -100).otherwise(F.col("label"))
    rows = _vectors(spark, sf).select(F.col("embedding").alias("scores"), label.alias("label"))
    return metrics.masked_cross_entropy(rows).withColumn("loss", F.round("loss", 6))


def _long_scores(spark, sf):
    """One row for each vector and component, with the vector's label on each."""
    label = F.when(F.col("label") == 9, -100).otherwise(F.col("label"))
    return _vectors(spark, sf).select("vec_id", label.alias("label"), F.posexplode("embedding").alias("token", "score"))


# Scores far apart: the exponentials of the plain ones would overflow.
_LONG = """z AS (SELECT vec_id, CASE WHEN label = 9 THEN -100 ELSE label END AS label,
    list_transform(embedding, lambda v: CAST(v AS DOUBLE) * 2000) AS z FROM embeddings), losses AS (
  SELECT vec_id, label, CASE WHEN label <> -100 THEN list_max(z)
    + ln(list_sum(list_transform(z, lambda x: exp(x - list_max(z))))) - z[label + 1] END AS loss FROM z)"""


def _scaled(spark, sf):
    return _long_scores(spark, sf).withColumn("score", F.col("score").cast("double") * 2000)


@R.add("long_cross_entropy", f"WITH {_LONG} SELECT vec_id, label, round(loss, 5) AS loss FROM losses")
def _(spark, sf):
    losses = metrics.long_cross_entropy(_scaled(spark, sf), ["vec_id"])
    return losses.withColumn("loss", F.round("loss", 5))


@R.add("long_masked_cross_entropy", f"WITH {_LONG} SELECT round(avg(loss), 5) AS loss, count(loss) AS num_labels FROM losses")
def _(spark, sf):
    return metrics.long_masked_cross_entropy(_scaled(spark, sf), ["vec_id"]).withColumn("loss", F.round("loss", 5))


_SCORED = """r AS (SELECT d.n_chars / 10000.0 AS a, l.quality AS q, l.toxic AS x FROM documents d JOIN labels l USING (doc_id)
  WHERE l.quality IS NOT NULL AND l.toxic IS NOT NULL)"""
_BCE = "greatest({z}, 0.0) - {z} * {y} + ln(1.0 + exp(-abs({z})))"


@R.add(
    "label_losses",
    f"""WITH {_SCORED}
SELECT 'regression' AS source, 0 AS source_ord, 'regression' AS problem_type, round(avg((a - q) * (a - q)), 6) AS loss, count(*) AS num_rows FROM r
UNION ALL SELECT 'single', 1, 'single_label_classification',
  round(avg(greatest(a, 1.0) + ln(exp(a - greatest(a, 1.0)) + exp(1.0 - greatest(a, 1.0))) - CASE WHEN q = 0 THEN a ELSE 1.0 END), 6), count(*) FROM r
UNION ALL SELECT 'multi', 2, 'multi_label_classification',
  round(avg(({_BCE.format(z="(a - 1.0)", y="q")} + {_BCE.format(z="0.5", y="x")}) / 2), 6), count(*) FROM r""",
)
def _(spark, sf):
    labels = t.table(spark, sf, "labels", t.LABELS).where("quality IS NOT NULL AND toxic IS NOT NULL")
    rows = t.documents(spark, sf).select("doc_id", "n_chars").join(labels, "doc_id").select(
        (F.col("n_chars") / F.lit(10000.0)).alias("a"),
        F.col("quality").cast("double").alias("q"),
        F.col("toxic").cast("double").alias("x"),
    )
    one = rows.select(F.array("a").alias("scores"), F.array("q").alias("labels"))
    single = rows.select(F.array("a", F.lit(1.0)).alias("scores"), F.col("q").cast("int").alias("labels"))
    multi = rows.select(
        F.array(F.col("a") - 1.0, F.lit(0.5)).alias("scores"), F.array("q", "x").alias("labels")
    )
    tables = {"regression": (one, 1, False), "single": (single, 2, True), "multi": (multi, 2, False)}
    losses = {
        name: metrics.label_losses(df, metrics.problem_type(width, integers))
        for name, (df, width, integers) in tables.items()
    }
    return concat_sources(losses).withColumn("loss", F.round("loss", 6))


_COMPONENTS = """c AS (SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS z, unnest(range(len(embedding))) AS i FROM embeddings),
  y AS (SELECT *, CASE WHEN i = label THEN 1.0 ELSE 0.0 END AS y FROM c)"""


@R.add(
    "long_label_losses",
    f"""WITH {_COMPONENTS}, w AS (
  SELECT label, list_transform(embedding, lambda v: CAST(v AS DOUBLE)) AS z FROM embeddings WHERE label IS NOT NULL)
SELECT 'regression' AS source, 0 AS source_ord, 'regression' AS problem_type, round(avg((z - y) * (z - y)), 6) AS loss,
  count(DISTINCT vec_id) AS num_rows FROM y
UNION ALL SELECT 'single', 1, 'single_label_classification',
  round(avg(list_max(z) + ln(list_sum(list_transform(z, lambda x: exp(x - list_max(z))))) - z[label + 1]), 6), count(*) FROM w
UNION ALL SELECT 'multi', 2, 'multi_label_classification', round(avg({_BCE.format(z="z", y="y")}), 6), count(DISTINCT vec_id) FROM y""",
)
def _(spark, sf):
    rows = _vectors(spark, sf).select("vec_id", F.col("label").alias("own"), F.posexplode("embedding").alias("entry", "score"))
    each = rows.withColumn("label", F.when(F.col("entry") == F.col("own"), 1.0).otherwise(0.0))
    single = rows.withColumn("label", F.col("own"))
    losses = {
        "regression": metrics.long_label_losses(each, "regression", ["vec_id"]),
        "single": metrics.long_label_losses(single, "single_label_classification", ["vec_id"]),
        "multi": metrics.long_label_losses(each, "multi_label_classification", ["vec_id"]),
    }
    return concat_sources(losses).withColumn("loss", F.round("loss", 6))


_ANNOTATED = "replace(replace(html, '<', '<<'), '>', '>>')"


@R.add(
    "calc_annotations",
    f"""WITH h AS (SELECT page_id, {_ANNOTATED} AS text FROM pages), s AS (
  SELECT page_id, unnest(k) AS span, unnest(range(len(k))) AS pos FROM (
    SELECT page_id, regexp_extract_all(text, '(?s)<<(.*?)>>', 1) AS k FROM h))
SELECT page_id, CAST(pos AS INTEGER) AS pos,
  CASE WHEN strpos(span, '=') > 0 THEN substr(span, 1, strpos(span, '=') - 1) ELSE span END AS name,
  CASE WHEN strpos(span, '=') > 0 THEN substr(span, strpos(span, '=') + 1) END AS expression FROM s""",
)
def _(spark, sf):
    return _annotations(spark, sf).select("page_id", F.posexplode("annotations").alias("pos", "a")).select(
        "page_id", "pos", "a.name", "a.expression"
    )


def _annotations(spark, sf):
    doubled = F.replace(F.replace("html", F.lit("<"), F.lit("<<")), F.lit(">"), F.lit(">>"))
    pages = t.table(spark, sf, "pages", t.PAGES).select("page_id", doubled.alias("text"))
    return metrics.calc_annotations(pages, ["page_id"])


@R.add(
    "calc_annotations_text",
    f"SELECT page_id, regexp_replace({_ANNOTATED}, '(?s)<<(.*?)>>', '', 'g') AS clean_text FROM pages",
)
def _(spark, sf):
    return _annotations(spark, sf).select("page_id", "clean_text")
