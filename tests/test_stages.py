"""Sinks, listings, model hooks and side outputs of the stages."""

import glob
import gzip
import json
import time

import pytest
from pyspark.sql import functions as F

from corpusmill.functions import markup
from corpusmill.functions import text as tx
from corpusmill.operators import annotate, batching, features, lines
from corpusmill.plans import curation
from corpusmill.sources import crawl, sinks

RECORDS = "url string, warc_date string, warc_block_digest string, payload binary"


def test_warc_round_trip(spark, tmp_path):
    rows = [(f"http://a/{i}", "2024-01-01", f"d{i}", bytearray(f"<p>{i}\r\n\r\nWARC/1.0\r\n".encode() * i)) for i in range(20)]
    records = spark.createDataFrame([*rows, ("http://n/", None, None, None), (None, None, None, bytearray(b"x"))], RECORDS)
    out = str(tmp_path / "w")
    sinks.write_warc(records.repartition(3), out)
    sinks.write_warc(records.filter("false"), out)
    sinks.write_warc(records.filter("warc_block_digest = 'd3'"), out)
    assert not glob.glob(f"{out}/.tmp*")
    back = sorted((r["url"], r["warc_date"], r["warc_block_digest"], bytes(r["payload"])) for r in crawl.read_warc(spark, out).collect())
    want = [(u, t, d, bytes(p)) for u, t, d, p in [*rows, rows[3]]]
    assert back == sorted(want)
    assert crawl.damaged(spark, out).count() == 0


def test_failed_warc_task_leaves_nothing(tmp_path):
    writer = sinks.WarcWriter(str(tmp_path), "run")
    good = dict(url="u", warc_date=None, warc_block_digest=None, payload=b"1")
    with pytest.raises(TypeError):
        writer.write(iter([good, good | {"payload": None}]))
    kept = writer.write(iter([good]))
    assert writer.write(iter([])).name is None and kept.records == 1
    writer.commit([kept, None])
    assert [f.name for f in tmp_path.iterdir()] == [kept.name]


def test_source_shard_layout(spark, tmp_path):
    rows = spark.createDataFrame([(3, "/x/2024-10/0001.parquet"), (1, "/x/2024-10/0001.parquet"), (2, "/x/2024-18/0001.parquet")], "id int, shard string")
    sinks.write_by_source_shard(rows, str(tmp_path / "o"), order="id")
    files = glob.glob(f"{tmp_path}/o/dump=2024-10/shard=0001/*.parquet")
    assert len(files) == 1 and [r["id"] for r in spark.read.parquet(files[0]).collect()] == [1, 3]
    assert glob.glob(f"{tmp_path}/o/dump=2024-18/shard=0001/*.parquet")
    with pytest.raises(Exception, match="no shard in"):
        sinks.write_by_source_shard(rows.withColumn("shard", F.lit("/nowhere")), str(tmp_path / "p"))


def test_text_index_and_prediction_sinks(spark, tmp_path):
    sinks.write_text(spark.createDataFrame([(1, "a", 2)], "id int, text string, more int"), str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).dtypes == [("id", "string"), ("text", "string")]
    index = crawl.warc_index(spark.createDataFrame([("f é", 5, 2), ("f é", 1, 2)], "filename string, offset long, length long"))
    sinks.write_index(index, str(tmp_path / "i"))
    (line,) = [x for f in glob.glob(f"{tmp_path}/i/*.json.gz") for x in gzip.open(f, "rt", encoding="utf-8")]
    assert json.loads(line) == {"filename": "f é", "ranges": [{"offset": 1, "length": 2}, {"offset": 5, "length": 2}]}
    rows = spark.range(50).select(F.col("id").alias("n"), F.array(F.lit(0.5)).alias("line_predictions")).repartition(7)
    sinks.write_predictions(rows, str(tmp_path / "j"), "n")
    told = [json.loads(x) for f in sorted(glob.glob(f"{tmp_path}/j/part-*.json")) for x in open(f)]
    assert [t["n"] for t in told] == list(range(50)) and told[0]["line_predictions"] == [0.5]


def test_listing(spark, tmp_path):
    assert crawl.listed(spark, str(tmp_path / "absent")).count() == 0
    (tmp_path / "a").mkdir()
    whole = gzip.compress(b"x" * 1000)
    (tmp_path / "a/1.json.gz").write_bytes(whole)
    (tmp_path / "a/2.json.gz").write_bytes(whole[:-3])
    (tmp_path / "a/3.json.gz").write_bytes(b"")
    (tmp_path / "a/4.txt").write_bytes(b"x")
    assert sorted(r["path"][-9:] for r in crawl.listed(spark, str(tmp_path)).collect()) == ["1.json.gz", "2.json.gz"]
    assert sorted(r["path"][-9:] for r in crawl.damaged(spark, str(tmp_path)).collect()) == ["2.json.gz"]
    assert not crawl.gzip_whole(b"")


def test_annotations_are_read_and_looked_up(spark, tmp_path):
    text = '{"url": "u1", "content": "a\\n", "selected_lines": [0]}\n{"url": "u2", "is_ignored": true}\n'
    with gzip.open(tmp_path / "a.jsonl.gz", "wt") as f:
        f.write(text)
    (tmp_path / "b.jsonl").write_text(text)
    for name in ("a.jsonl.gz", "b.jsonl"):
        rows = annotate.with_defaults(annotate.read_annotations(spark, str(tmp_path / name)))
        assert [r["url"] for r in annotate.kept(rows).collect()] == ["u1"]
        assert annotate.looked_up(rows, "u2").first()["selected_lines"] == []
        assert annotate.looked_up(rows, "u3").isEmpty()


def test_slow_and_bad_pages_are_told_apart_from_good_ones(spark):
    def slow(page):
        time.sleep(5)

    began = time.time()
    assert markup.limited(slow, 0.1)("x") is None and time.time() - began < 2
    assert markup.limited(markup.markdown_of)("<p>a") == markup.markdown_of("<p>a")
    rows = spark.createDataFrame([("1", "u", "f", "d", "b", bytearray(b"<p>a")), ("2", "u", "f", "d", "b", None)], "id string, url string, warc_file string, warc_date string, warc_block_digest string, payload binary")
    pages = curation.converted(rows)
    assert [r["id"] for r in curation.failed(pages).collect()] == ["2"]
    assert [r["id"] for r in curation.to_markdown(rows).collect()] == ["1"]


def test_model_in_executors(spark):
    model = features.executor_model(lambda: {"a": "x"}, lambda m, t: m.get(t, "und"), "string")
    docs = spark.createDataFrame([(1, "u", "a"), (2, "u", "b"), (3, "u", None)], "id int, url string, text string")
    done = features.with_features(docs, features.default_features(language=model))
    assert [r["language"] for r in done.orderBy("id").collect()] == ["x", "und", None]


def test_line_scorer_learns(spark):
    good = [(f"This is the sentence number {i}, and it has words enough.", 1) for i in range(200)]
    bad = [(f"Home | Login | {i} | http://x/{i}", 0) for i in range(200)]
    rows = spark.createDataFrame([*good[:150], *bad[:150], (None, 1), ("x", None)], "line string, label int")
    scorer = lines.fit_line_scorer(rows)
    held = spark.createDataFrame([*good[150:], *bad[150:]], "line string, label int")
    told = lines.binary_metrics(held, tx.sigmoid(scorer(F.col("line"))), F.col("label")).first()
    assert told["f1"] == 1.0
    kept = held.filter("label = 1").limit(1).select(lines.filter_lines(F.col("line"), lines.line_scores(F.col("line"), scorer)).alias("t")).first()["t"]
    assert kept
    same = lines.fit_line_scorer(rows.filter("label = 1"))
    assert held.select(tx.sigmoid(same(F.col("line"))).alias("p")).filter("p < 0.9").isEmpty()
    assert lines.fit_line_scorer(rows.filter("false")) is not None


def test_batches_split_and_padding(spark):
    rows = spark.range(40).select("id", (F.col("id") * 7 % 40).alias("n"))
    got = batching.length_batches(rows, "id", "n").collect()
    assert sorted({(r["batch_no"], r["pad_to"]) for r in got}) == [(0, 15), (1, 31), (2, 39)]
    assert all(r["n"] // 16 == r["batch_no"] for r in got)
    one = spark.range(1).select(batching.padded(F.array(F.lit(1), F.lit(2)), F.lit(4), F.lit(0)).alias("t")).first()["t"]
    assert one == [1, 2, 0, 0]
    split = batching.train_val_split(spark.createDataFrame([(i,) for i in [None, *range(9)]], "id int"), ["id"], 3)
    assert {r["id"] for r in split.filter("split = 'val'").collect()} == {None, 0, 1} and split.count() == 10


def test_stages_that_do_not_align_fail(spark):
    a, b = spark.range(5).withColumn("x", F.lit(1)), spark.range(6).withColumn("y", F.lit(2))
    assert batching.aligned(a, b.filter("id < 5"), "id").count() == 5
    for l, r in ((a, b), (b, a)):
        with pytest.raises(Exception, match="only one of the stages has id 5"):
            batching.aligned(l, r, "id").count()
