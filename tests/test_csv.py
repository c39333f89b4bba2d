"""Fixed-schema CSV sources: positional binding, strict parsing, discovery."""

from __future__ import annotations

import gzip
import os

import pytest
from pyspark.sql import types as T

from appmart.schemas import RAW_SCHEMAS
from appmart.sources.csv import discover_sources, read_csv, relative_path, table_name_of, write_csv

SCHEMA = T.StructType([T.StructField("name", T.StringType()), T.StructField("n", T.LongType()),
                       T.StructField("x", T.DoubleType())])


def write_text(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def test_round_trip_keeps_blanks_quotes_and_commas(spark, scratch):
    data = [("  Com.App  1 ", 1, 1.5), ('say "hi", ok', 2, None), (None, None, -0.25)]
    df = spark.createDataFrame(data, SCHEMA)
    path = write_csv(df, os.path.join(scratch, "t.csv"))
    back = read_csv(spark, path, SCHEMA)
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(data, key=repr)


def test_header_names_are_ignored_columns_bind_by_position(spark, scratch):
    p = write_text(os.path.join(scratch, "t.csv"), "x,name,n\nfoo,7,2.5\n")
    assert read_csv(spark, p, SCHEMA).collect() == [("foo", 7, 2.5)]


def test_missing_text_is_null_and_quoted_empty_text_is_empty(spark, scratch):
    p = write_text(os.path.join(scratch, "t.csv"), 'name,n,x\n,,\n"",1,""\n"","",\n')
    assert sorted(map(tuple, read_csv(spark, p, SCHEMA).collect()), key=repr) == \
        sorted([(None, None, None), ("", 1, None), ("", None, None)], key=repr)


def test_empty_texts_and_nulls_survive_a_round_trip(spark, scratch):
    data = [("", 1, None), (None, 2, 0.5), (" ", None, None), ('""', 3, None), ("", None, None), (None, None, 1.0)]
    path = write_csv(spark.createDataFrame(data, SCHEMA), os.path.join(scratch, "t.csv"))
    assert sorted(map(tuple, read_csv(spark, path, SCHEMA).collect()), key=repr) == sorted(data, key=repr)


def test_doubled_quotes_are_escaped_quotes(spark, scratch):
    p = write_text(os.path.join(scratch, "t.csv"), 'name,n,x\n"a ""b"" c",1,1\n')
    assert read_csv(spark, p, SCHEMA).first()["name"] == 'a "b" c'


@pytest.mark.parametrize("body", ["a,notanumber,1\n", "a,1\n", "a,1,2,3\n", "a,4.0,1\n"])
def test_bad_rows_fail_a_full_width_write(spark, scratch, body):
    p = write_text(os.path.join(scratch, "t.csv"), "name,n,x\n" + body)
    df = read_csv(spark, p, SCHEMA)
    with pytest.raises(Exception):
        df.write.format("noop").mode("overwrite").save()


def test_bad_numbers_fail_without_ansi_too(spark, scratch):
    p = write_text(os.path.join(scratch, "t.csv"), "name,n,x\na,notanumber,1\n")
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception, match="notanumber"):
            read_csv(spark, p, SCHEMA).write.format("noop").mode("overwrite").save()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_bad_value_in_unread_column_is_not_seen_by_a_pruned_scan(spark, scratch):
    # Why the pipeline writes the full-width raw table before counting it.
    p = write_text(os.path.join(scratch, "t.csv"), "name,n,x\na,notanumber,1\n")
    assert read_csv(spark, p, SCHEMA).select("name").count() == 1


def test_table_name_is_file_name_up_to_first_dot():
    assert table_name_of("user_installs.csv") == "user_installs"
    assert table_name_of("user_installs.2024.csv") == "user_installs"
    assert table_name_of("app_ratings.csv/part-0000.csv") == "app_ratings"


def test_relative_path_with_and_without_scheme():
    for root in ("/shared/in", "/shared/in/", "hdfs:///shared/in", "hdfs://nn:8020/shared/in", "file:/shared/in"):
        for path in ("hdfs://nn:8020/shared/in/a.csv/part-0", "/shared/in/a.csv/part-0", "file:///shared/in/a.csv/part-0"):
            assert relative_path(root, path) == "a.csv/part-0"
    assert relative_path("s3a://bucket", "s3a://bucket/a.csv") == "a.csv"
    with pytest.raises(ValueError):
        relative_path("/shared/in", "/shared/other/a.csv")


def test_discover_sources_takes_any_csv_name_and_part_folders(spark, scratch):
    write_text(os.path.join(scratch, "app_ratings.CSV"), "a\n")
    with gzip.open(os.path.join(scratch, "user_installs.csv.gz"), "wt") as f:
        f.write("a\n")
    os.makedirs(os.path.join(scratch, "ua_campaign_spendings.csv"))
    for i in range(2):
        write_text(os.path.join(scratch, "ua_campaign_spendings.csv", f"part-0000{i}"), "a,b\n")
    names = ["app_ratings", "user_installs", "ua_campaign_spendings"]
    found = discover_sources(spark, scratch, names)
    assert sorted(found) == sorted(names)
    assert found["ua_campaign_spendings"][1] == 8
    schema = T.StructType([T.StructField("a", T.StringType())])
    assert read_csv(spark, found["user_installs"][0], schema).count() == 0


def test_strange_and_missing_sources_are_errors(spark, scratch):
    write_text(os.path.join(scratch, "app_ratings.csv"), "a\n")
    with pytest.raises(ValueError, match="missing.*user_installs"):
        discover_sources(spark, scratch, ["app_ratings", "user_installs"])
    assert list(discover_sources(spark, scratch, ["app_ratings", "user_installs"], optional=["user_installs"])) == ["app_ratings"]
    write_text(os.path.join(scratch, "notes.txt"), "x\n")
    with pytest.raises(ValueError, match="notes.txt"):
        discover_sources(spark, scratch, ["app_ratings"])


def test_raw_schemas_are_all_nullable_with_declared_types():
    assert len(RAW_SCHEMAS) == 8
    for schema in RAW_SCHEMAS.values():
        assert all(f.nullable for f in schema.fields)
        assert {type(f.dataType) for f in schema.fields} <= {T.StringType, T.LongType, T.DoubleType}


def test_list_sources_reports_sizes(spark, scratch):
    from appmart.sources.csv import list_sources
    write_text(os.path.join(scratch, "app_ratings.csv"), "a,b\n1,2\n")
    assert list_sources(spark, scratch)["app_ratings.csv"][1] == len("a,b\n1,2\n")


def test_shuffle_width_is_raised_never_lowered(spark):
    from appmart.session import SOURCE_BYTES_PER_SHUFFLE_PARTITION, MAX_SHUFFLE_PARTITIONS, fit_shuffle_partitions
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        assert fit_shuffle_partitions(spark, 1000) == 8
        assert fit_shuffle_partitions(spark, 20 * SOURCE_BYTES_PER_SHUFFLE_PARTITION) == 20
        assert fit_shuffle_partitions(spark, 100 << 40) == 25600      # 100 TiB
        assert fit_shuffle_partitions(spark, 1 << 50) == MAX_SHUFFLE_PARTITIONS
        assert fit_shuffle_partitions(spark, 1000) == MAX_SHUFFLE_PARTITIONS
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_unknown_source_name_has_no_schema():
    from appmart.schemas import raw_schema
    with pytest.raises(KeyError):
        raw_schema("not_a_table")


@pytest.mark.parametrize("text,expected", [("134217728b", 1 << 27), ("512m", 512 << 20), ("1g", 1 << 30),
                                           ("4096", 4096), ("2KB", 2048)])
def test_conf_bytes(text, expected):
    from appmart.session import conf_bytes
    assert conf_bytes(text) == expected


def test_split_size_is_raised_never_lowered(spark):
    from appmart.session import MAX_SPLIT_BYTES, conf_bytes, fit_split_size
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "128m")
        assert fit_split_size(spark, 1 << 30) == 128 << 20            # small input: unchanged
        assert fit_split_size(spark, 100 << 40) == 549_755_814        # 100 TiB / 200k splits, ~524 MiB
        assert conf_bytes(spark.conf.get(key)) == 549_755_814
        assert fit_split_size(spark, 100 << 50) == MAX_SPLIT_BYTES     # capped at 1 GiB
        assert fit_split_size(spark, 1 << 30) == MAX_SPLIT_BYTES       # never lowered
    finally:
        spark.conf.set(key, before)
