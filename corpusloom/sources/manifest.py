"""File selection: which files of a manifest to fetch, where from, what is left."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import globs_to_regex

NAME = "rfilename"


def select_files(
    manifest: DataFrame, include: list[str] | None = None, exclude: list[str] | None = None
) -> DataFrame:
    """Files that match some include glob and no exclude glob; no include keeps all.

    The match is unanchored: ``*.parquet`` also keeps ``a.parquet.tmp``.
    """
    files = manifest.where(F.col(NAME).isNotNull())
    if include:
        files = files.where(F.col(NAME).rlike(globs_to_regex(include)))
    if exclude:
        files = files.where(~F.col(NAME).rlike(globs_to_regex(exclude)))
    return files


def manifest_layout(
    manifest: DataFrame, endpoint: str, repo: str, revision: str = "main"
) -> DataFrame:
    """``url``, ``dir`` and ``out`` of each file; ``dir`` is empty at the top level."""
    name = F.col(NAME)
    out = F.substring_index(name, "/", -1)
    return manifest.select(
        name,
        F.concat_ws("/", F.lit(endpoint), F.lit(repo), F.lit("resolve"), F.lit(revision), name).alias("url"),
        F.regexp_extract(name, r"(?s)^(.*)/[^/]*\z", 1).alias("dir"),
        out.alias("out"),
    )


def config_fingerprint(config: dict[str, str | list[str]]) -> Column:
    """One hash for the options a file list was built from."""
    parts = [F.lit(f"{k}={v if isinstance(v, str) else ','.join(v)}") for k, v in sorted(config.items())]
    return F.sha2(F.concat_ws("\n", *parts), 256)


def pending_files(
    manifest: DataFrame, done: DataFrame, config: dict[str, str | list[str]] | None = None
) -> DataFrame:
    """Files not finished yet. With ``config``, only finished files recorded under the
    same ``fingerprint`` count, so changed options list everything again."""
    if config is not None:
        done = done.where(F.col("fingerprint") == config_fingerprint(config))
    return manifest.join(done.select(NAME), NAME, "left_anti")
