from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ratewright.operators import dictionary as dic


@pytest.fixture
def tables(spark):
    df = spark.createDataFrame(
        [(1, "a", None, [1.0]), (2, "bcd", Decimal("2.5"), None)], "id long, name string, x decimal(9,2), e array<float>"
    )
    return {("s", "t"): df, ("INFORMATION_SCHEMA", "hidden"): df.select("id")}


def notes(spark, rows):
    return spark.createDataFrame([(*r, None) for r in rows], dic.DESCRIPTIONS)


def test_columns(tables):
    rows = {r["COLUMN_NAME"]: r for r in dic.column_profile(tables).where("TABLE_NAME = 't'").collect()}
    assert [rows[c]["DATA_TYPE"] for c in ("id", "name", "x", "e")] == ["BIGINT", "VARCHAR", "DECIMAL(9,2)", "FLOAT[]"]
    assert rows["name"]["MAX_LENGTH"] == 3 and rows["id"]["MAX_LENGTH"] is None
    assert (rows["x"]["NUMERIC_PRECISION"], rows["x"]["NUMERIC_SCALE"], rows["x"]["NULL_COUNT"]) == (9, 2, 1)


def test_newest_description_wins_and_coverage(spark, tables):
    current = notes(spark, [("s", "t", None, "old"), ("s", "t", "id", "key")])
    merged = dic.describe(current, notes(spark, [("s", "t", None, "new")]))
    assert merged.count() == 2
    book = dic.build_dictionary(dic.table_profile(tables), dic.column_profile(tables), merged)
    assert len(book.columns) == 14 and book.count() == 4  # the system schema is left out
    assert {r["TABLE_DESCRIPTION"] for r in book.collect()} == {"new"}
    assert [r["COLUMN_NAME"] for r in dic.undocumented(book).collect()] == ["name", "x", "e"]
    assert dic.coverage(book).first()["COVERAGE"] == 25.0
    assert [r["COL_POSITION"] for r in dic.of_table(book, "t").collect()] == [1, 2, 3, 4]
    roll = dic.schema_rollup(dic.table_profile(tables)).collect()
    assert [(r["TABLE_SCHEMA"], r["TABLES"], r["ROW_COUNT"]) for r in roll] == [("s", 1, 2)]


def test_updates_out_of_order_and_repeated(spark):
    def timed(rows):
        df = spark.createDataFrame(rows, "TABLE_SCHEMA string, TABLE_NAME string, COLUMN_NAME string, DESCRIPTION string, at string")
        return df.withColumn("UPDATED_AT", F.to_timestamp("at")).drop("at")

    current = timed([("s", "t", None, "now", "2024-05-01"), ("s", "t", "id", "old key", "2024-01-01"), ("s", "t", "x", "kept", None)])
    update = timed(
        [
            ("s", "t", None, "late arrival", "2024-02-01"),
            ("s", "t", "id", "new key", "2024-03-01"),
            ("s", "t", "id", "older still", "2023-03-01"),
            ("s", "t", "x", "same time", None),
        ]
    )
    found = {r["COLUMN_NAME"]: r["DESCRIPTION"] for r in dic.describe(current, update).collect()}
    assert found == {None: "now", "id": "new key", "x": "same time"}
    assert dic.describe(current, update).count() == 3


def test_sizes_count_empty_files(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(5).coalesce(1).write.parquet(path)
    spark.range(0).coalesce(1).write.mode("append").parquet(path)
    row = dic.table_sizes(spark, {("s", "t"): path}).first()
    files = list((tmp_path / "t").glob("*.parquet"))
    assert row["FILES"] == len(files) == 2 and row["BYTES"] == sum(f.stat().st_size for f in files)


def test_catalog_comments_are_mirrored_and_read_back(spark, tmp_path):
    path = (tmp_path / "dictionary_t").as_uri()
    spark.sql(f"CREATE TABLE dictionary_t (id BIGINT, name STRING) USING parquet LOCATION '{path}'")
    try:
        given = notes(spark, [("default", "dictionary_t", None, "It's a table"), ("default", "dictionary_t", "id", "key")])
        assert dic.mirror_descriptions(spark, given) == 2
        tables = {k: v for k, v in dic.catalog_tables(spark, "default").items() if k[1] == "dictionary_t"}
        book = dic.build_dictionary(dic.table_profile(tables), dic.column_profile(tables), dic.no_descriptions(spark))
        found = {r["COLUMN_NAME"]: r["COLUMN_DESCRIPTION"] for r in book.collect()}
        assert found == {"id": "key", "name": None}
        described = spark.sql("DESCRIBE TABLE EXTENDED dictionary_t").where(F.col("col_name") == "Comment").first()
        assert described["data_type"] == "It's a table"
    finally:
        spark.sql("DROP TABLE dictionary_t")


def test_sizes_distincts_and_the_view(spark, sf_dir):
    from ratewright.operators import sketches as sk

    tables = {("s", t): spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("nation", "region")}
    sizes = dic.table_sizes(spark, {("s", "nation"): f"{sf_dir}/nation.parquet"})
    profile = dic.with_sizes(dic.table_profile(tables), sizes)
    sketched = sk.profile(sk.merge_batches(sk.sketch_batch(tables["s", "nation"], "nation", "1")))
    columns = dic.with_distincts(dic.column_profile(tables), sketched)
    name = dic.register_dictionary(dic.build_dictionary(profile, columns, dic.no_descriptions(spark)), "DICTIONARY_T")
    rows = {(r["TABLE_NAME"], r["COLUMN_NAME"]): r for r in spark.sql(f"SELECT * FROM {name}").collect()}
    assert rows["nation", "n_nationkey"]["DISTINCT_COUNT"] == 25 and rows["nation", "n_nationkey"]["BYTES"] > 0
    assert rows["region", "r_name"]["BYTES"] is None and rows["region", "r_name"]["DISTINCT_COUNT"] is None
    rolled = dic.schema_rollup(profile).first()
    assert rolled["BYTES"] == rows["nation", "n_nationkey"]["BYTES"] and rolled["TABLES"] == 2
    assert "BYTES" not in dic.schema_rollup(dic.table_profile(tables)).columns
