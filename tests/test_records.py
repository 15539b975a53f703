import json

import pytest
from pyspark.sql import functions as F

from ticket_topics.operators import records as R
from ticket_topics.operators.ranking import number_rows, top_per_group
from ticket_topics.schema import FLAT_COMPLAINT, RAW_COMPLAINT
from ticket_topics.sources import complaints, stages

from .plans import explained

TEXTS = [None, "", "   ", "!!! ...", 'He said "no",\nthen\tleft ', "fee  fee"]


def raw_rows():
    return [
        {
            "_index": "i",
            "_type": "complaint",
            "_id": str(n),
            "_score": 0.0,
            "_source": {"state": "CA", "complaint_what_happened": t},
        }
        for n, t in enumerate(TEXTS)
    ]


@pytest.mark.parametrize("shape", ["lines", "array", "pretty"])
def test_json_shapes(spark, tmp_path, shape):
    path = tmp_path / "raw.json"
    rows = raw_rows()
    path.write_text(
        {
            "lines": "\n".join(json.dumps(r) for r in rows),
            "array": json.dumps(rows),
            "pretty": json.dumps(rows, indent=2),
        }[shape]
    )
    raw = complaints.read_complaints(spark, str(path), multi_line=shape == "pretty")
    flat = R.flatten_complaints(raw)
    assert flat.schema == FLAT_COMPLAINT
    assert [r.complaint_what_happened for r in flat.orderBy("id").collect()] == TEXTS


def raw(spark):
    return spark.createDataFrame(raw_rows(), RAW_COMPLAINT)


def test_blank_dropped_spaces_kept(spark):
    ids = [r.id for r in R.with_text(raw(spark)).orderBy("id").collect()]
    assert ids == ["2", "3", "4", "5"]
    steps = R.drop_null_text(R.blank_to_null(R.flatten_complaints(raw(spark))))
    assert [r.id for r in steps.orderBy("id").collect()] == ids


def test_null_filter_is_below_the_projection(spark, tmp_path):
    path = str(tmp_path / "p")
    R.flatten_complaints(raw(spark)).write.parquet(path)
    plan = explained(R.drop_null_text(spark.read.parquet(path)).select("id"))
    assert "IsNotNull(complaint_what_happened)" in plan
    assert "ReadSchema: struct<id:string,complaint_what_happened:string>" in plan


def test_fill_and_profile(spark):
    flat = R.flatten_complaints(raw(spark))
    assert R.profile(flat).first()[:3] == (6, 1, 1)
    filled = R.fill_null_text(flat).where("complaint_what_happened is null").count()
    assert filled == 0


def test_csv_roundtrip(spark, tmp_path):
    flat = R.flatten_complaints(raw(spark))
    stages.write_csv(flat, str(tmp_path / "c"))
    back = R.fill_null_text(stages.read_csv(spark, str(tmp_path / "c"), flat.schema, True))
    got = [r.complaint_what_happened for r in back.orderBy("id").collect()]
    assert got == [t or "" for t in TEXTS]


def test_partition_overwrite_keeps_other_partitions(spark, tmp_path):
    path = str(tmp_path / "p")
    day = lambda d, n: spark.range(n).select("id", F.lit(d).alias("ingest_date"))
    stages.write_parquet(day("2024-01-01", 3), path, ("ingest_date",))
    stages.write_parquet(day("2024-01-02", 4), path, ("ingest_date",))
    stages.write_parquet(day("2024-01-02", 5), path, ("ingest_date",))
    assert spark.read.parquet(path).count() == 8


def test_rows_to_frame_all_null(spark):
    one = complaints.rows_to_frame(spark, {R.TEXT: None})
    assert R.fill_null_text(one).first()[0] == ""
    assert complaints.rows_to_frame(spark, [{R.TEXT: "a"}, {R.TEXT: None}]).count() == 2


def test_lineage_and_catalog(spark, tmp_path):
    catalog = stages.StageCatalog(str(tmp_path))
    source = "s3a://bucket/complaints-2021.json"
    path = catalog.preprocessed(source)
    stages.write_parquet(spark.range(5).toDF("id"), path)
    stems = stages.with_lineage(spark.read.parquet(path)).select("stage_stem").distinct()
    assert [r[0] for r in stems.collect()] == ["complaints-2021"]
    assert catalog.stem(path) == "complaints-2021"


@pytest.mark.parametrize("partitions", [1, 5])
def test_number_rows(spark, partitions):
    rows = spark.range(1000).select(((F.col("id") * 7919) % 1000).alias("k")).repartition(partitions)
    got = {r.k: r.n for r in number_rows(rows, F.desc("k"), name="n").collect()}
    assert got == {k: 1000 - k for k in range(1000)}


def test_renumber(spark):
    rows = spark.createDataFrame([("b",), ("a",), ("c",)], "id string")
    assert [(r.id, r.row_id) for r in R.renumber(rows).orderBy("id").collect()] == [
        ("a", 0),
        ("b", 1),
        ("c", 2),
    ]


def test_top_per_group_limits_before_the_shuffle(spark):
    rows = spark.range(500).select("id", F.when(F.col("id") % 50 == 0, 1).otherwise(0).alias("g"))
    top = top_per_group(rows, "g", F.asc("id"), n=3)
    assert sorted((r.g, r.id) for r in top.collect()) == [
        (0, 1), (0, 2), (0, 3), (1, 0), (1, 50), (1, 100),
    ]
    plan = explained(top)
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_head_is_top_k(spark):
    rows = spark.range(100).repartition(4)
    assert [r.id for r in R.head(rows, n=4).collect()] == [0, 1, 2, 3]
