import gzip
import os

import pytest
from pyspark.sql import functions as F

from epiweave import session, sinks
from epiweave.catalog import queries
from epiweave.session import work_path
from epiweave.sources import landing, readers

SCHEMA = "id int, nombre string"


def write(folder, name, data: bytes):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "wb") as f:
        f.write(data)


def test_encoding_per_file(spark, tmp_path):
    write(tmp_path, "a.csv", "id,nombre\n1,Nariño\n".encode("utf-8"))
    write(tmp_path, "b.csv", "id,nombre\n2,Bogotá\nx,Cali\n".encode("latin-1"))
    write(tmp_path, "c.csv", "﻿id,nombre\n3,Tadó\n".encode("utf-8"))
    schema = spark.createDataFrame([], SCHEMA).schema
    got = readers.read_source_any_encoding(spark, str(tmp_path), schema).collect()
    assert sorted(((r.id or 0), r.nombre) for r in got) == [(0, "Cali"), (1, "Nariño"), (2, "Bogotá"), (3, "Tadó")]


def test_every_readable_page_is_read(spark, tmp_path):
    schema = spark.createDataFrame([], SCHEMA).schema

    def page(name, ids):
        write(tmp_path, name, ("[" + ",".join(f'{{"id":{i},"nombre":"x"}}' for i in ids) + "]").encode())

    page("page-000000.json", [1, 2])
    page("page-000001.json", [3])
    page("page-000004.json", [4, 5])
    write(tmp_path, "page-000005.json", b"<html>error</html>")
    page("page-000006.json", [6])
    page("late.json", [7])
    got = readers.read_json_pages(spark, str(tmp_path), schema, page_rows=2).collect()
    assert sorted(r.id for r in got) == [1, 2, 3, 4, 5, 6, 7]
    report = readers.json_pages_report(spark, str(tmp_path), schema, 2).collect()
    assert sorted(((-1 if r.page is None else r.page), r.rows, r.status) for r in report) == [
        (-1, 1, "unnumbered"), (0, 2, "ok"), (1, 1, "short"), (2, 0, "gap"), (4, 2, "ok"), (5, 0, "unreadable"), (6, 1, "last"),
    ]
    with pytest.raises(ValueError, match="not complete"):
        readers.read_json_pages(spark, str(tmp_path), schema, page_rows=2, strict=True)


def test_columns_are_found_by_header(spark, tmp_path):
    write(tmp_path, "a.csv", "código,Semana, Año,Departamento,conteo\n77,3,2020,VALLE,5\n78,x,2021,CAUCA,6\n".encode())
    schema = spark.createDataFrame([], "ano int, semana int, departamento string").schema
    got = sorted(map(tuple, readers.read_source(spark, f"{tmp_path}/a.csv", schema).collect()), key=str)
    assert got == [(2020, 3, "VALLE"), (2021, None, "CAUCA")]
    with pytest.raises(ValueError, match="municipio"):
        readers.read_source(spark, f"{tmp_path}/a.csv", spark.createDataFrame([], "ano int, municipio string").schema)


def test_each_file_has_its_own_header(spark, tmp_path):
    schema = spark.createDataFrame([], "ano int, municipio string, conteo int").schema
    write(tmp_path, "a.csv", "ano,municipio,conteo\n2020,CALI,5\n".encode())
    write(tmp_path, "b.csv", "conteo,ano,municipio\n7,2022,BUGA\n".encode())
    write(tmp_path / "more", "c [x].csv", '\ufeff"Año",código,"Conteo ",MUNICIPIO\n2023,1,8,"TULUA, V"\n'.encode())
    write(tmp_path, "d.csv.gz", gzip.compress("municipio,conteo,ano\nPALMIRA,x,2024\n".encode()))
    write(tmp_path, "empty.csv", b"")
    write(tmp_path, "only header.csv", b"conteo,municipio,ano\n")
    write(tmp_path, "_hidden.csv", b"nothing\n")
    want = [(2020, "CALI", 5), (2022, "BUGA", 7), (2023, "TULUA, V", 8), (2024, "PALMIRA", None)]
    got = readers.read_source(spark, str(tmp_path), schema)
    assert sorted(map(tuple, got.collect())) == want
    some = readers.read_source(spark, [f"{tmp_path}/a.csv", f"{tmp_path}/b.csv", f"{tmp_path}/a.csv"], schema)
    assert sorted(map(tuple, some.collect())) == want[:2]
    assert sorted(map(tuple, readers.read_source(spark, f"{tmp_path}/?.csv", schema).collect())) == want[:2]
    with pytest.raises(FileNotFoundError):
        readers.read_source(spark, f"{tmp_path}/absent.csv", schema)


def test_a_file_without_a_column_is_named(spark, tmp_path):
    schema = spark.createDataFrame([], "ano int, municipio string").schema
    write(tmp_path, "a.csv", b"ano,municipio\n2020,CALI\n")
    write(tmp_path, "b.csv", b"ano,departamento\n2021,VALLE\n")
    with pytest.raises(ValueError, match=r"b\.csv: no column for municipio"):
        readers.read_source(spark, str(tmp_path), schema)


def test_headers_that_collide_are_named(spark, tmp_path):
    schema = spark.createDataFrame([], "ano int, municipio string").schema
    write(tmp_path, "a.csv", "ano,Año,municipio\n2020,2021,CALI\n".encode())
    with pytest.raises(ValueError, match=r"a\.csv: more than one column for ano \(ano, Año\)"):
        readers.read_source(spark, str(tmp_path), schema)
    write(tmp_path / "other", "a.csv", "ano,x,X,municipio\n2020,1,2,CALI\n".encode())
    assert [tuple(r) for r in readers.read_source(spark, f"{tmp_path}/other", schema).collect()] == [(2020, "CALI")]


def test_each_file_has_its_own_header_and_encoding(spark, tmp_path):
    schema = spark.createDataFrame([], SCHEMA).schema
    write(tmp_path / "in 1", "a.csv", "nombre,id\nNariño,1\n".encode("utf-8"))
    write(tmp_path, "b.csv", "id,nombre\n2,Bogotá\n".encode("latin-1"))
    write(tmp_path, "c 2.csv", "extra,nombre,id\né,Tadó,3\n".encode("latin-1"))
    write(tmp_path, "d.csv", 'id,nombre\n4,"two\nlines é"\n'.encode("utf-8"))
    got = readers.read_source_any_encoding(spark, str(tmp_path), schema, multi_line=True)
    assert sorted(map(tuple, got.collect())) == [(1, "Nariño"), (2, "Bogotá"), (3, "Tadó"), (4, "two\nlines é")]


def test_a_file_is_scanned_once(spark, tmp_path):
    """One scan for each layout, whatever the number of files."""
    schema = spark.createDataFrame([], "ano int, municipio string").schema
    for i in range(6):
        write(tmp_path, f"{i}.csv", b"ano,municipio\n2020,CALI\n" if i % 2 else b"municipio,ano\nBUGA,2021\n")
    rows = readers.read_source(spark, str(tmp_path), schema)
    assert rows.count() == 6 and plan_of(rows).count("FileScan csv") == 2


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_page_size_is_enforced(spark):
    rows = spark.range(5).withColumn("page", F.lit(0))
    with pytest.raises(Exception, match="more than the page size"):
        landing.land_json_pages(rows, work_path(spark, "pages"), "page", 4)


def test_a_larger_page_is_split_into_files(spark, tmp_path):
    rows = spark.range(5).withColumn("page", F.lit(0)).union(spark.range(5, 6).withColumn("page", F.lit(None).cast("int")))
    landing.land_json_pages(rows, f"{tmp_path}/pages", "page", 2, split=True)
    assert sorted(r.id for r in readers.read_json_pages(spark, f"{tmp_path}/pages", spark.range(1).schema, 2).collect()) == list(range(6))
    report = readers.json_pages_report(spark, f"{tmp_path}/pages", spark.range(1).schema, 2).collect()
    assert sorted(map(tuple, report), key=str) == [(0, 5, "last"), (None, 1, "unnumbered")]
    arrays = spark.read.option("recursiveFileLookup", True).text(f"{tmp_path}/pages")
    assert max(r.value.count('"id"') for r in arrays.collect()) == 2 and arrays.count() == 4


def test_orders_whose_page_number_is_taken(spark, tmp_path):
    """Orders past the two millionth meet the pages that have landed under later numbers."""
    keys = spark.range(3 * 2000, 6 * 2000).union(spark.range(1000 * 2000, 1003 * 2000))
    keys.withColumnRenamed("id", "o_orderkey").write.parquet(f"{tmp_path}/orders.parquet")
    report = queries.REGISTRY["json_pages_report"](spark, str(tmp_path)).collect()
    found = {r.page: (r.rows, r.status) for r in report}
    assert found == {
        0: (0, "gap"), 3: (1000, "short"), 4: (2000, "ok"), 5: (0, "gap"), 1000: (3000, "ok"), 1001: (2000, "ok"), 1002: (4000, "last"),
    }
    assert queries.REGISTRY["scan_json_pages"](spark, str(tmp_path)).distinct().count() == 6 * 2000


def test_ingest_reports_failures(spark, tmp_path):
    write(tmp_path, "Uno (a) +[1].csv", "id,nombre\n1,á\n2,b\n".encode("latin-1"))
    write(tmp_path, "dos.csv", b"id,id\n1,2\n")
    write(tmp_path, "notes.txt", b"ignored")
    write(tmp_path, "empty.csv", b"")
    write(tmp_path, "a-b.csv", b"id\n1\n")
    write(tmp_path, "a b.csv", b"id\n2\n")
    write(tmp_path, "cells.csv", b'id,nombre\n1,"two\nlines"\n2,one\n')
    write(tmp_path / "below", "dos.csv", b"id\n1\n")
    saved = {}

    def save(df, name):
        if name == "dos":
            raise RuntimeError("no")
        saved[name] = [tuple(r) for r in df.orderBy("id").collect()]
        return df

    got = sorted(tuple(r) for r in landing.ingest_folder(spark, str(tmp_path), save).collect())
    assert got == [
        ("Uno (a) +[1].csv", "uno__a__+[1]", "ok", 2, 2), ("a b.csv", "a_b", "error: name collision", None, None),
        ("a-b.csv", "a_b", "error: name collision", None, None), ("cells.csv", "cells", "ok", 2, 2),
        ("dos.csv", "dos", "error: RuntimeError", None, None), ("empty.csv", "empty", "error: empty file", None, None),
    ]
    assert saved == {"uno__a__+[1]": [("1", "á"), ("2", "b")], "cells": [("1", "two\nlines"), ("2", "one")]}


def test_sinks(spark):
    df = spark.createDataFrame([(2020, ' "quoted", text '), (2021, "line")], "ano int, t string")
    path = work_path(spark, "csv")
    sinks.write_csv(df, path)
    assert sorted(map(tuple, readers.read_source(spark, path, df.schema).collect())) == sorted(map(tuple, df.collect()))
    path = work_path(spark, "table")
    sinks.write_table(df, path)
    assert spark.read.parquet(path).where("ano = 2021").count() == 1


def listed(path):
    return sorted(os.listdir(path)) if os.path.isdir(path) else []


def test_guarded_export(spark, tmp_path):
    df = spark.range(50).withColumn("ano", F.lit(2020))
    assert sinks.guarded_export(df, f"{tmp_path}/a", 50) == 50 and sinks.guarded_export(df, f"{tmp_path}/b") == 50
    assert readers.read_source(spark, f"{tmp_path}/a", df.schema).count() == 50
    stored = listed(session.work_root(spark) + "/epiweave/" + spark.sparkContext.applicationId)
    with pytest.raises(sinks.ExportTooLarge):
        sinks.guarded_export(df, f"{tmp_path}/c", 49)
    assert not os.path.exists(f"{tmp_path}/c") and listed(session.work_root(spark) + "/epiweave/" + spark.sparkContext.applicationId) == stored
    report = [tuple(r) for n in (50, 49) for r in sinks.export_report(df, f"{tmp_path}/d", n).collect()]
    assert report == [("written", 50, 50), ("refused", 50, 49)]


def test_a_reader_finishes_while_a_table_is_replaced(spark, tmp_path):
    path = f"{tmp_path}/a [1] table"
    with pytest.raises(FileNotFoundError):
        sinks.read_table(spark, path)
    sinks.replace_table(spark.range(3).withColumn("ano", F.col("id") % 2), path)
    before = sinks.read_table(spark, path)
    sinks.replace_table(before.withColumn("id", F.col("id") + 10).withColumn("more", F.lit("x")), path)
    assert sorted(r.id for r in before.collect()) == [0, 1, 2]
    now = sinks.read_table(spark, path)
    assert sorted(r.id for r in now.collect()) == [10, 11, 12] and "more" in now.columns
    assert len(sinks.versions(spark, path)) == 2
    sinks.replace_table(spark.range(1), path, [], keep=0)
    assert sinks.versions(spark, path) == [sinks.current_version(spark, path)] and sinks.read_table(spark, path).count() == 1


def test_a_failed_write_leaves_the_table(spark, tmp_path):
    path = f"{tmp_path}/table"
    sinks.save_as_table(spark.range(4), "replaced_table", path, [])
    broken = spark.range(4, 100, 1, 4).select(F.when(F.col("id") > 90, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="broken"):
        sinks.save_as_table(broken, "replaced_table", path, [])
    assert spark.table("replaced_table").count() == 4 and len(sinks.versions(spark, path)) == 1
    sinks.save_as_table(spark.range(5).withColumn("b", F.lit(1)), "replaced_table", path, ["b"])
    assert spark.table("replaced_table").columns == ["id", "b"] and spark.table("replaced_table").count() == 5


def test_ingested_tables_have_names(spark, tmp_path):
    write(tmp_path, "Uno (a).csv", b"id,nombre\n1,x\n2,y\n")
    write(tmp_path, "a+b.csv", b"id\n1\n")
    write(tmp_path, "a~b.csv", b"id\n2\n")
    report = landing.ingest_folder(spark, str(tmp_path), sinks.table_saver(spark, f"{tmp_path}/lake"), at_once=1).collect()
    assert sorted((r.table_name, r.status) for r in report) == [("a+b", "ok"), ("a~b", "error: ValueError"), ("uno__a_", "ok")]
    assert sorted(map(tuple, spark.table("uno__a_").collect())) == [("1", "x"), ("2", "y")] and spark.table("a_b").first().id == "1"
