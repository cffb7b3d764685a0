from collections import OrderedDict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusmill.config import FilterConfig, MinHashConfig, PipelineConfig
from corpusmill.functions import minhash as mh
from corpusmill.operators import annotate, batching, dedup, features, lines
from corpusmill.plans import curation
from corpusmill.streaming.incremental import run_new_files
from tests.conftest import SMALL


def bucket_rows(spark, rows):
    return spark.createDataFrame(rows, "id long, minhash_bucket_0 long, minhash_bucket_1 long")


def test_greedy_chain_depends_on_order(spark):
    # A and B share the first bucket, B and C the second
    assert {r["id"] for r in dedup.survivors_by_pass(bucket_rows(spark, [(1, 5, 1), (2, 5, 9), (3, 6, 9)]))[-1].collect()} == {1, 3}
    assert {r["id"] for r in dedup.survivors_by_pass(bucket_rows(spark, [(2, 5, 1), (1, 5, 9), (3, 6, 9)]))[-1].collect()} == {1}


def test_dedup_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    low = docs.select("doc_id", mh.normalize_for_minhash(F.col("text")).alias("t")).collect()
    alive = sorted((r["doc_id"], mh.buckets(mh.signature(r["t"]))) for r in low)
    want = []
    for i in range(14):
        seen, left = set(), []
        for d, b in alive:
            if b[i] not in seen:
                seen.add(b[i])
                left.append((d, b))
        alive = left
        want.append(len(alive))
    b = features.with_minhash(docs.select(F.col("doc_id").alias("id"), "text")).drop("text")
    passes = dedup.survivors_by_pass(b)
    assert {r["id"] for r in passes[-1].collect()} == {d for d, _ in alive}
    assert passes[0].count() == want[0]
    flags = dedup.with_dedup_keep(docs.select(F.col("doc_id").alias("id")), b)
    assert flags.filter("dedup_keep").count() == len(alive) and flags.count() == docs.count()


def test_null_texts_collide_with_nothing(spark):
    rows = spark.createDataFrame([(1, None), (2, None), (3, "short"), (4, "brief")], "id long, text string")
    b = features.with_minhash(rows, MinHashConfig()).drop("text")
    assert {r["id"] for r in dedup.with_dedup_keep(rows, b).filter("dedup_keep").collect()} == {1, 2, 3}
    done = features.with_verdict(features.with_features(rows.withColumn("url", F.lit("http://a/")), features.default_features()))
    assert not done.filter("passes_all_quality_filters").count()


def test_filter_bounds(spark):
    base = dict(content_length=100, is_domain_blacklisted=False, ratio_alphanumeric_chars=0.9, ratio_headings_per_non_heading_word=0.0, unigram_entropy=0.1)
    row = lambda **k: spark.createDataFrame([base | k])
    verdict = lambda df, cfg=FilterConfig(): features.with_verdict(df, cfg).first()["passes_all_quality_filters"]
    assert verdict(row()) and not verdict(row(content_length=99))
    assert not verdict(row(), FilterConfig(apply_entropy=True))
    assert not verdict(row(is_domain_blacklisted=True))


def test_paragraph_dedup(spark):
    got = dedup.paragraph_dedup(spark.createDataFrame([(1, "a\nb\n A "), (2, "b\nc"), (3, "c")], "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["text"] for r in got} == {1: "a\nb", 2: "c", 3: ""}


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 300), st.integers(1, 80))
def test_groups_cover_once(n, g):
    bounds = batching.group_bounds(n, num_groups=g)
    assert [i for a, b in bounds for i in range(a, b)] == list(range(n))


def test_group_sizes():
    sizes = lambda n, g: [b - a for a, b in batching.group_bounds(n, num_groups=g)]
    assert sizes(3, 5) == [1, 0, 1, 0, 1] and sizes(10, 4) == [2, 3, 3, 2] and sizes(7, 3) == [2, 3, 2]
    with pytest.raises(ValueError):
        batching.group_bounds(3)


def test_numbered(spark):
    got = batching.numbered(spark.range(1000).repartition(7), ["id"]).collect()
    assert all(r["id"] == r["row_no"] for r in got) and len(got) == 1000


def test_alignment(spark):
    a, b = spark.range(5), spark.range(5)
    batching.assert_aligned(a, b, "id")
    with pytest.raises(ValueError):
        batching.assert_aligned(a, spark.range(6), "id")


@settings(max_examples=100, deadline=None)
@given(st.text("a![]() x\n", max_size=40))
def test_image_round_trip(text):
    plain, images = lines.split_images(text)
    again = lines.insert_images(plain, images)
    assert lines.split_images(again)[0] == plain or "![" in plain


def test_images(spark):
    assert lines.split_images("x![a](u)y") == ("xy", [(1, "u")])
    assert lines.split_images("![a](u)![b](v)") == ("", [(0, "u"), (0, "v")])
    assert lines.insert_images("xy", OrderedDict([(1, "u")])) == "x![](u)y"
    with pytest.raises(ValueError):
        lines.insert_images("xy", OrderedDict([("1", "u")]))
    with pytest.raises(ValueError):
        lines.insert_images("xy", 7)
    df = spark.createDataFrame([("![a](u)![b](v)z",)], "t string").select(lines.image_places(F.col("t")).alias("p"))
    assert df.select(lines.image_map(F.col("p")).alias("m")).first()["m"] == {0: "v"}


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=80), st.integers(600, 900))
def test_stitched_equals_unsplit(gaps, size):
    places = [sum(gaps[: i + 1]) for i in range(len(gaps))]
    n = (places[-1] + 1) if places else 0
    stride = size - 512 if n > size else size
    windows = []
    for s in range(0, n, stride):
        at = [p for p in places if s <= p < s + size]
        windows.append((at, s, [float(p) for p in at]))
    assert lines.stitch(windows) == [float(p) for p in places]


def test_line_rules(spark):
    df = spark.createDataFrame([("a\nb", [0.05, 0.9])], "t string, s array<double>")
    keep = lambda strict: df.select(lines.filter_lines(F.col("t"), F.col("s"), 0.05, strict).alias("x")).first()["x"]
    assert keep(False) == "a\nb" and keep(True) == "b"
    l = spark.createDataFrame([([0], 3)], "s array<int>, n int")
    assert l.select(lines.line_labels(F.col("s"), F.col("n")).alias("x")).first()["x"] == [1, 0, 0]
    assert l.select(lines.line_labels(F.col("s"), F.col("n"), compat=True).alias("x")).first()["x"] == [0, 0, 0]
    seven = spark.createDataFrame([(1, i) for i in range(7)], "doc_id int, line_no int")
    assert [r["line_no"] for r in lines.every_nth_separator(seven, 3).filter("is_global").orderBy("line_no").collect()] == [0, 3, 6]
    assert not lines.every_nth_separator(seven, 1).filter("is_global").count()


def test_annotations(spark):
    rows = spark.createDataFrame([("u", "a\nb\n", None, None, [0.5, 0.4])], annotate.SCHEMA)
    full = annotate.with_defaults(rows)
    assert annotate.kept(rows).count() == 1 and full.first()["selected_lines"] == []
    assert [r["shown"] for r in annotate.view(full, "url", "output").orderBy("line_no").collect()] == [True, False]
    assert [r["shown"] for r in annotate.view(full, "url", "predictions").orderBy("line_no").collect()] == [False, False]
    assert annotate.upserted(full, full.withColumn("content", F.lit("z"))).first()["content"] == "z"


def test_curation_end_to_end(spark):
    html = "<body><h1>T</h1><p>" + "Good plain words make a long enough paragraph of text here. " * 5 + "</p></body>"
    rows = [(str(i), f"http://x{i}.se/", "s3://b/crawl-data/f.gz", "d", "g", (html + ("other words entirely, told at some length now. " * 4 if i == 2 else "")).encode()) for i in range(3)]
    records = spark.createDataFrame(rows, "id string, url string, warc_file string, warc_date string, warc_block_digest string, payload binary")
    out = curation.curate(records, PipelineConfig()).collect()
    assert {r["id"] for r in out} == {"0", "2"} and out[0]["warc_file"] == "crawl-data/f.gz"


def test_new_files_once(spark, tmp_path):
    src, out, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    spark.range(5).write.mode("append").parquet(src)
    assert run_new_files(spark, src, "id long", lambda d: d.withColumn("x", F.col("id") * 2), out, check) == 5
    spark.range(5, 8).write.mode("append").parquet(src)
    assert run_new_files(spark, src, "id long", lambda d: d.withColumn("x", F.col("id") * 2), out, check) == 3
    assert spark.read.parquet(out).count() == 8
