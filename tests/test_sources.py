import json
import os
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from corpusloom.operators.packing import pack_text
from corpusloom.operators.render import chat_prompt_response
from corpusloom.plans.pretrain import CorpusSource, pretrain_mixture
from corpusloom.session import shared_path
from corpusloom.sources.manifest import config_fingerprint, manifest_layout, pending_files, select_files
from corpusloom.sources import scan
from corpusloom.sources.scan import (
    INSTRUCT,
    Catalog,
    Source,
    require_columns,
    scan_files,
    scan_jsonl,
    scan_parquet,
)
from corpusloom.sources.store import materialize_or_reuse, write_blocks
from corpusloom.sources import builds
from corpusloom.sources.builds import build_shards, last_published, read_published
from corpusloom.streaming.source import drain_to_parquet, drain_totals, read_totals, running_totals, stream_source


def write_jsonl(path, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        for row in rows:
            f.write(json.dumps(row) + "\n")


@pytest.fixture
def tree(tmp_path):
    rows = [{"prompt": f"p{i} x", "response": f"r{i}"} for i in range(30)]
    write_jsonl(f"{tmp_path}/a.jsonl", rows[:10])
    write_jsonl(f"{tmp_path}/b/c.jsonl", rows[10:20])
    write_jsonl(f"{tmp_path}/b/d/e.jsonl", rows[20:])
    write_jsonl(f"{tmp_path}/b/d/e.json", [{"prompt": "no", "response": "no"}])
    return str(tmp_path), rows


def test_jsonl_recursion_and_order(spark, tree):
    root, rows = tree
    df = scan_jsonl(spark, root, INSTRUCT, row_key=True)
    assert [r.prompt for r in df.orderBy("row_key").collect()] == [r["prompt"] for r in rows]
    two = scan_files(spark, [f"{root}/a.jsonl", f"{root}/b/c.jsonl"], INSTRUCT)
    assert two.count() == 20


def test_broken_lines(spark, tmp_path):
    with open(tmp_path / "a.jsonl", "w") as f:
        f.write('{"prompt": "a", "response": "b"}\n\n   \nnot json\n{"prompt": "c", "response": "d"}\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        scan_jsonl(spark, str(tmp_path), INSTRUCT).collect()
    lenient = scan_jsonl(spark, str(tmp_path), INSTRUCT, row_key=True, mode="PERMISSIVE")
    rows = lenient.orderBy("row_key").collect()
    assert [r.prompt for r in rows] == ["a", None, "c"]
    # The keys alone are the same keys.
    assert [r.row_key for r in lenient.select("row_key").orderBy("row_key").collect()] == [r.row_key for r in rows]
    with pytest.raises(ValueError):
        scan_jsonl(spark, str(tmp_path), INSTRUCT, row_key=True, mode="DROPMALFORMED")


@pytest.mark.parametrize("broadcast", [10_000, 0])
def test_line_keys_do_not_depend_on_splits(spark, tmp_path, monkeypatch, broadcast):
    """Rows are numbered by file, through blank lines and whatever the split size."""
    monkeypatch.setattr(scan, "BROADCAST_SPLITS", broadcast)
    expected = {}
    for name, n in (("b", 400), ("a", 1), ("c", 0), ("d/e", 150)):
        os.makedirs(os.path.dirname(f"{tmp_path}/{name}"), exist_ok=True)
        with open(f"{tmp_path}/{name}.jsonl", "w") as f:
            for i in range(n):
                f.write(json.dumps({"prompt": f"{name} {i} " + "x" * (i % 90), "response": "r"}) + "\n" + "\n" * (i % 3 == 0))
                expected[name, i] = None
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    seen = []
    try:
        for size in ("700b", "5k", "128m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            keyed = scan_jsonl(spark, str(tmp_path), INSTRUCT, row_key=True)
            rows = keyed.orderBy("row_key").collect()
            seen.append([(r.prompt, r.row_key) for r in rows])
            numbers = [(tuple(r.prompt.split(" ")[:2]), int(r.row_key.rsplit(":", 1)[1])) for r in rows]
            assert all(int(i) == number for (_, i), number in numbers) and len(rows) == len(expected)
            parts = keyed.rdd.getNumPartitions() if broadcast else 0
        assert seen[0] == seen[1] == seen[2]
        spark.conf.set("spark.sql.files.maxPartitionBytes", "700b")
        with pytest.raises(Exception, match="split otherwise"):
            keyed.select("row_key").collect()
        assert parts or not broadcast
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_line_keys_with_clashing_columns(spark, tmp_path):
    write_jsonl(f"{tmp_path}/a.jsonl", [{"n": i, "first": "f", "a b": i} for i in range(5)])
    df = scan_jsonl(spark, str(tmp_path), "n INT, first STRING, `a b` INT", row_key=True)
    assert df.columns == ["n", "first", "a b", "row_key"]
    assert [r.n for r in df.orderBy("row_key").collect()] == list(range(5))


def test_natural_order_packing(spark, tree, tmp_path_factory):
    """Blocks follow file and row order when the data has no id."""
    root, rows = tree
    docs = pretrain_mixture(
        {"i": CorpusSource(scan_jsonl(spark, root, INSTRUCT, row_key=True), "row_key", instruct=True)},
        seq_len=7,
        batch_rows=8,
    )
    flat = {}
    for i, r in enumerate(rows):
        text = f"### Instruction:\n{r['prompt']}\n### Response:\n{r['response']}"
        flat.setdefault(i // 8, []).extend(text.split())
    expected = {
        (b, j // 7): ts[j : j + 7] for b, ts in flat.items() for j in range(0, len(ts) // 7 * 7, 7)
    }
    assert {(r.batch_id, r.block_id): r.input_ids for r in docs.collect()} == expected

    out = str(tmp_path_factory.mktemp("parquet") / "t")
    spark.createDataFrame([(f"t{i}",) for i in range(50)], "text string").repartition(3).write.parquet(out)
    keyed = scan_parquet(spark, out, "text STRING", row_key=True)
    stored = []
    for name in sorted(f for f in os.listdir(out) if f.endswith(".parquet")):
        stored += [r.text for r in spark.read.parquet(f"{out}/{name}").collect()]
    blocks = pack_text(keyed, "text", "row_key", 50, 100).collect()
    assert [b.input_ids for b in blocks] == [stored]


def test_globs(spark, tmp_path):
    for i in (3, 14, 25):
        spark.range(i, i + 1).coalesce(1).write.parquet(f"{tmp_path}/part-0{i:02d}-of-99")
    df = scan_parquet(spark, f"{tmp_path}/part-0[0-1][0-9]-of-99", "id BIGINT")
    assert sorted(r.id for r in df.collect()) == [3, 14]


def test_catalog(spark, sf):
    catalog = Catalog().register(
        "docs", Source(f"{sf}/{{config}}.parquet", splits={"en": "lang = 'en'"})
    )
    every = catalog.load_source(spark, "docs", "documents")
    assert every.count() == 200
    assert catalog.load_source(spark, "docs", "documents", "train").count() == 200
    assert catalog.load_source(spark, "docs", "documents", "en").count() == every.where("lang='en'").count()
    with pytest.raises(KeyError):
        catalog.load_source(spark, "docs", "documents", "zh")
    spark.range(3).createOrReplaceTempView("some_view")
    assert catalog.load_source(spark, "some_view").count() == 3
    with pytest.raises(ValueError, match="score"):
        require_columns(every, "score")


def names(df):
    return sorted(r.rfilename for r in df.collect())


def test_manifest(spark):
    files = ["a.parquet", "a.parquet.tmp", "x/b.parquet", "x/y/c.jsonl", "aparquet", None]
    manifest = spark.createDataFrame([(f,) for f in files], "rfilename string")
    assert names(select_files(manifest)) == sorted(f for f in files if f)
    assert names(select_files(manifest, ["*.parquet"])) == ["a.parquet", "a.parquet.tmp", "x/b.parquet"]
    assert names(select_files(manifest, ["*.parquet", "c.*"], ["x/b", "*.tmp"])) == ["a.parquet", "x/y/c.jsonl"]
    layout = {r.rfilename: (r.url, r.dir, r.out) for r in manifest_layout(manifest.where("rfilename is not null"), "https://h", "d/r").collect()}
    assert layout["x/y/c.jsonl"] == ("https://h/d/r/resolve/main/x/y/c.jsonl", "x/y", "c.jsonl")
    assert layout["a.parquet"] == ("https://h/d/r/resolve/main/a.parquet", "", "a.parquet")
    now = {"include": ["*.parquet"]}
    done = spark.createDataFrame([("a.parquet",), ("aparquet",)], "rfilename string").withColumn(
        "fingerprint", F.when(F.col("rfilename") == "a.parquet", config_fingerprint(now)).otherwise("old")
    )
    left = manifest.where("rfilename is not null")
    assert "a.parquet" not in names(pending_files(left, done)) and len(names(pending_files(left, done))) == 3
    assert "aparquet" in names(pending_files(left, done, now))
    assert len(names(pending_files(left, done, {"include": ["*"]}))) == 5


def test_reuse(spark, tmp_path):
    path, calls = f"{tmp_path}/t", []

    def build():
        calls.append(1)
        return spark.range(5)

    assert materialize_or_reuse(spark, path, build).count() == 5
    assert materialize_or_reuse(spark, path, build).count() == 5
    assert len(calls) == 1
    unfinished = f"{path}-unfinished"
    os.makedirs(f"{unfinished}/_temporary/0")
    assert materialize_or_reuse(spark, unfinished, build).count() == 5
    assert len(calls) == 2
    os.makedirs(f"{path}-foreign")
    with open(f"{path}-foreign/mine.txt", "w") as f:
        f.write("mine")
    with pytest.raises(FileExistsError):
        materialize_or_reuse(spark, f"{path}-foreign", build)
    assert os.listdir(f"{path}-foreign") == ["mine.txt"] and len(calls) == 2


def shards_of(spark, calls, names="abc", fails=(), rows=3):
    def shard(name):
        def build():
            calls.append(name)
            if name in fails:
                raise RuntimeError("breaks")
            return spark.range(rows).withColumn("shard", F.lit(name))

        return build

    return {name: shard(name) for name in names}


def test_builds_resume_and_rebuild(spark, tmp_path):
    root, calls = str(tmp_path / "build"), []
    with pytest.raises(FileNotFoundError):
        read_published(spark, root)
    with pytest.raises(RuntimeError):
        build_shards(spark, root, shards_of(spark, calls, fails="c"), {"size": 1})
    assert calls == ["a", "b", "c"]
    with pytest.raises(FileNotFoundError):
        read_published(spark, root)
    # Only the shard that broke is built; then none; then all, under other options.
    assert build_shards(spark, root, shards_of(spark, calls), {"size": 1}).count() == 9
    assert calls[3:] == ["c"]
    first = last_published(spark, root)
    assert build_shards(spark, root, shards_of(spark, calls), {"size": 1}).count() == 9
    assert calls[4:] == [] and last_published(spark, root) == first
    with pytest.raises(RuntimeError):
        build_shards(spark, root, shards_of(spark, calls, fails="b", rows=5), {"size": 2})
    # The old build is whole while the new one is not.
    assert read_published(spark, root).count() == 9
    assert build_shards(spark, root, shards_of(spark, calls, rows=5), {"size": 2}).count() == 15
    assert calls[4:] == ["a", "b", "b", "c"]
    assert read_published(spark, root).groupBy("shard").count().collect() != []
    # Back to the first options: nothing is built again.
    assert build_shards(spark, root, shards_of(spark, calls), {"size": 1}).count() == 9 and len(calls) == 8
    assert build_shards(spark, root, shards_of(spark, calls, "ab"), {"size": 1}).count() == 6 and len(calls) == 8


def test_builds_check_their_shards(spark, tmp_path):
    with pytest.raises(ValueError, match="columns"):
        build_shards(spark, str(tmp_path / "x"), {"a": lambda: spark.range(2), "b": lambda: spark.range(2).withColumn("y", F.lit(1))}, {})
    with pytest.raises(ValueError, match="one shard"):
        build_shards(spark, str(tmp_path / "y"), {}, {})
    assert builds.options_fingerprint({"a": 1, "b": [2]}) == builds.options_fingerprint({"b": [2], "a": 1})
    assert builds.options_fingerprint({"a": 1}) != builds.options_fingerprint({"a": "1"})
    empty = build_shards(spark, str(tmp_path / "z"), {"a": lambda: spark.range(0)}, {})
    assert empty.columns == ["id"] and empty.count() == 0


def test_block_folders(spark, tmp_path):
    df = spark.range(10).withColumn("source", F.when(F.col("id") < 9, "a").otherwise("b"))
    write_blocks(df, f"{tmp_path}/out")
    assert spark.read.parquet(f"{tmp_path}/out/source=a").count() == 9


def test_stream_equals_batch(spark, tree, tmp_path):
    root, rows = tree
    out = str(tmp_path / "streamed")
    stream = stream_source(spark, root, "json", INSTRUCT, "*.jsonl", max_files_per_trigger=1)
    totals = running_totals(stream.withColumn("s", F.substring("prompt", 1, 2)), "prompt", ["s"])
    drain_totals(totals, f"{out}/totals", f"{out}/c1")
    drain_to_parquet(stream, f"{out}/rows", f"{out}/c2")
    # Nothing new has come: a second run adds nothing.
    drain_to_parquet(
        stream_source(spark, root, "json", INSTRUCT, "*.jsonl"), f"{out}/rows", f"{out}/c2"
    )
    assert sorted(r.prompt for r in spark.read.parquet(f"{out}/rows").collect()) == sorted(r["prompt"] for r in rows)
    chats = chat_prompt_response(stream_source(spark, root, "json", INSTRUCT, "*.jsonl"), ["prompt"])
    drain_to_parquet(chats, f"{out}/chats", f"{out}/c3")
    batch = chat_prompt_response(scan_jsonl(spark, root, INSTRUCT), ["prompt"])
    assert sorted(spark.read.parquet(f"{out}/chats").collect()) == sorted(batch.collect())
    got = {r.s: (r.num_rows, r.total_tokens) for r in read_totals(spark, f"{out}/totals", totals.schema).collect()}
    assert len([d for d in os.listdir(f"{out}/totals") if d.startswith("epoch=")]) == 3
    expected = {}
    for r in rows:
        n, m = expected.get(r["prompt"][:2], (0, 0))
        expected[r["prompt"][:2]] = (n + 1, m + 2)
    assert got == expected


def test_shared_folder():
    def session(folder, master):
        conf = SimpleNamespace(get=lambda key, default: folder)
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))

    path = shared_path(session("hdfs://x/shared/", "yarn"), "t")
    assert path.startswith("hdfs://x/shared/t-")
    assert path != shared_path(session("hdfs://x/shared/", "yarn"), "t")
    assert os.path.isdir(os.path.dirname(shared_path(session(None, "local[2]"), "t")))
    with pytest.raises(ValueError):
        shared_path(session(None, "spark://host:7077"), "t")
