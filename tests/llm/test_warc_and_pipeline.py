"""WARC round trips, and the pipeline's stages."""

import gzip
import hashlib
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tidemark.llm import contamination, line_dedup, mixing, near_dedup, quality, warc

from .conftest import DOCS, SF_SMALL, words

pipeline = pytest.importorskip("corpus_pipeline")

PAGES = "page_id bigint, url string, html string"


def _pages(spark):
    big, small = "<p>" + "é" * 700 + "</p>", "<p>tiny</p>"
    rows = [(i, f"http://h/{i}", f"<html>{' '.join(words(i, 400))}</html>") for i in range(60)]
    rows += [(100, "u", big), (101, "u", big), (102, None, big), (103, "u", small), (104, "u", small), (105, "u", None), (106, "u", ""), (107, "u\r\nX: y", "a\r\n\r\nb")]
    rows += [(None, "n", big), (102, None, big), (103, "u", small), (None, None, None)]
    return spark.createDataFrame(rows, PAGES)


def test_round_trip_keeps_every_page(spark):
    pages = _pages(spark).withColumn("payload", F.lit(1)).withColumn("sha1", F.lit("x"))
    root = tempfile.mkdtemp(prefix="tidemark-warc-") + "/a"
    warc.write_warc(pages, root, file_bytes=4000, shard_bytes=30_000)
    got = warc.read_warc(spark, root).collect()
    assert len(got) == pages.count()
    want = sorted(((r["page_id"] is None, r["page_id"] or 0, hashlib.sha1((r["html"] or "").encode()).hexdigest(), len((r["html"] or "").encode())) for r in pages.collect()))
    assert sorted((r["page_id"] is None, r["page_id"] or 0, r["payload_digest"], r["payload_bytes"]) for r in got) == want
    assert all(hashlib.sha1(bytes(r["payload"])).hexdigest() == r["payload_digest"] for r in got if r["record_type"] == "response")
    big = [r for r in got if r["payload_bytes"] > 1000 and r["page_id"] in (100, 101, 102, None)]
    assert [r["page_id"] for r in big if r["record_type"] == "response"] == [102]
    assert all(r["refers_to"] == 102 for r in big if r["record_type"] == "revisit") and len(big) == 5
    assert all(r["record_type"] == "response" and r["refers_to"] is None for r in got if r["payload_bytes"] < 1000)
    files = [f for f in os.listdir(root) if f.endswith(".warc.gz")]
    assert len(files) > 3 and not os.listdir(f"{root}/_temporary") and os.path.exists(f"{root}/manifest/_SUCCESS")
    ids = []
    for f in files:
        with gzip.open(f"{root}/{f}") as z:
            ids += [line for line in z.read().split(b"\r\n") if line.startswith(b"WARC-Record-ID")]
    assert len(ids) == len(set(ids)) == pages.count()


def test_same_records_give_the_same_files(spark):
    sums = []
    for n in (1, 6):
        root = tempfile.mkdtemp(prefix="tidemark-warc-") + "/a"
        warc.write_warc(_pages(spark).repartition(n), root, file_bytes=4000, shard_bytes=30_000)
        sums.append({f: hashlib.sha1(open(f"{root}/{f}", "rb").read()).hexdigest() for f in os.listdir(root) if f.endswith(".warc.gz")})
    assert sums[0] == sums[1]


@pytest.mark.parametrize("hot", [7, None])
def test_an_id_with_a_third_of_all_rows_lies_in_many_shards(spark, hot):
    pages = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(hot).cast("long")).otherwise(F.col("id")).alias("page_id"), F.lit("u").alias("url"),
        F.repeat(F.sha2(F.col("id").cast("string"), 256), 20).alias("html"),
    )
    root = tempfile.mkdtemp(prefix="tidemark-warc-") + "/a"
    warc.write_warc(pages, root, shard_bytes=150_000)
    per = {r["shard"]: r["n"] for r in spark.read.parquet(f"{root}/manifest").groupBy("shard").agg(F.sum("records").alias("n")).collect()}
    assert len(per) > 20 and sum(per.values()) == 3000 and max(per.values()) < 2 * 3000 / len(per)
    got = warc.read_warc(spark, root)
    assert got.count() == 3000 and got.where("page_id is null" if hot is None else "page_id = 7").count() >= 1000


def test_a_large_record_is_read_in_linear_time(spark):
    import io
    import time

    def read(size):
        data = gzip.compress(warc.record(1, "u", os.urandom(size), None, 0), 1)
        began = time.process_time()
        ((_, block),) = warc.records(io.BytesIO(data))
        assert len(block) > size
        return time.process_time() - began

    read(1 << 20)
    assert read(128 << 20) < 60 * max(read(8 << 20), 0.02)  # 16 times the bytes


def test_lost_attempts_are_not_published(spark):
    root = tempfile.mkdtemp(prefix="tidemark-warc-") + "/a"
    os.makedirs(f"{root}/_temporary")
    open(f"{root}/_temporary/dead-00000-00000.warc.gz", "wb").write(b"half")
    warc.write_warc(_pages(spark), root)
    assert warc.read_warc(spark, root).count() == _pages(spark).count()
    warc_files = [f for f in os.listdir(root) if f.endswith(".warc.gz")]
    assert all("dead" not in f for f in warc_files)


def test_damage_is_noticed(spark):
    with pytest.raises(ValueError, match="block digest"):
        raw = warc.record(1, "u", b"payload", None, 0)
        head, _, rest = raw.partition(b"\r\n\r\n")
        fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
        warc._parsed(fields, rest[: int(fields["Content-Length"])].replace(b"payload", b"PAYLOAD"))


def test_empty_table_gives_an_empty_archive(spark):
    assert warc.archived(spark.createDataFrame([], PAGES)).count() == 0


def test_stages_take_effect_and_keep_columns(spark):
    """Every stage against its operator's own definition, on its own input."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = {}
    for name, stage in pipeline.STAGES:
        out = pipeline.written(stage(spark, docs, SF_SMALL), "test")
        assert out.columns[: len(docs.columns)] == docs.columns, name
        if name != "mixing":
            assert out.columns == docs.columns
        rows[name] = (docs, out)
        docs = out
    before, after = rows["quality classifier"]
    kept = {r["doc_id"] for r in quality.scored(before, spark.read.parquet(f"{SF_SMALL}/labels.parquet")).where("kept").collect()}
    assert {r["doc_id"] for r in after.collect()} == kept and 0 < len(kept) < before.count()
    before, after = rows["line dedup"]
    want = {r["doc_id"]: r["clean_text"] for r in line_dedup.drop_boilerplate(before).select("row.doc_id", "clean_text").collect()}
    assert {r["doc_id"]: r["text"] for r in after.collect()} == want
    assert after.where("n_chars != length(text)").join(before.select("doc_id", F.col("text").alias("t")), "doc_id").where("text != t").count() == 0
    before, after = rows["near dedup"]
    assert {r["doc_id"] for r in after.collect()} == {r["doc_id"] for r in near_dedup.near_classes(before).where("kept").select("row.doc_id").collect()}
    before, after = rows["decontamination"]
    bench = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    leaked = {r["doc_id"] for r in contamination.contaminated_documents(before, bench).collect()}
    assert {r["doc_id"] for r in after.collect()} == {r["doc_id"] for r in before.collect()} - leaked
    before, after = rows["mixing"]
    assert {r["doc_id"] for r in after.collect()} == {r["doc_id"] for r in mixing.mixed(before).where("sampled").select("row.doc_id").collect()}


def test_stages_on_edge_rows_and_empty_tables(spark, edges, empty):
    base = tempfile.mkdtemp(prefix="tidemark-pipe-")
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{SF_SMALL}/{t}.parquet").write.parquet(f"{base}/{t}.parquet")
    for docs in (edges.select(*[f"`{c}`" for c in spark.createDataFrame([], DOCS).columns]), empty):
        for name, stage in pipeline.STAGES:
            docs = pipeline.written(stage(spark, docs, base), "edge")
        assert docs.count() >= 0
