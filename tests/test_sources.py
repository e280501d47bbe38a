"""CSV ingest (typed, blanks, corrupt rows) and Parquet sink round trip."""

import os
import tempfile

from pyspark.sql import functions as F

from ledgerlens.sources import files
from ledgerlens.sources.schemas import RAW_CHANGE_ORDERS

HEADER = ("change_order_id,co_type,description,submitted_date,approved_date,status,cost_impact,"
          "schedule_impact_days,responsible_party,building_id,wbs_code,wbs_level_1")


def _write(lines):
    d = tempfile.mkdtemp(prefix="ledgerlens-csv-")
    with open(os.path.join(d, "co.csv"), "w", encoding="utf-8") as fh:
        fh.write("\n".join([HEADER, *lines]) + "\n")
    return d


def test_typed_ingest_blanks_and_corrupt_rows(spark):
    path = _write([
        'CO-1,OCO,"Scope change – A, B",2024-01-05,,Pending,1250.5,3,Owner,BLD-A,01.10,01-SITE',
        "CO-2,COR,Text,01/07/2024,01/20/2024,Approved,not-a-number,x,Owner,BLD-B,01.10,01-SITE",
    ])
    df = files.read_csv_typed(spark, path, RAW_CHANGE_ORDERS, corrupt_column="_corrupt")
    rows = {r.change_order_id: r for r in df.collect()}
    assert rows["CO-1"].description == "Scope change – A, B" and rows["CO-1"].approved_date is None
    assert rows["CO-1"].cost_impact == 1250.5 and rows["CO-1"]._corrupt is None
    assert rows["CO-2"].cost_impact is None and rows["CO-2"].schedule_impact_days is None
    assert rows["CO-2"]._corrupt.startswith("CO-2,")


def test_overwrite_replaces(spark):
    root = tempfile.mkdtemp(prefix="ledgerlens-sink-")
    a = spark.range(10).withColumn("x", F.lit("a"))
    files.write_table(a, root)
    files.write_table(spark.range(3).withColumn("x", F.lit("b")), root)
    back = spark.read.parquet(root)
    assert back.count() == 3 and {r.x for r in back.collect()} == {"b"}


def test_columns_follow_the_header_and_quotes_are_doubled(spark, tmp_path):
    import pytest
    from pyspark.sql.types import IntegerType, StringType, StructField, StructType

    schema = StructType([StructField("id", IntegerType()), StructField("name", StringType()), StructField("n", IntegerType())])
    path = tmp_path / "x.csv"
    path.write_text('n,extra,name,id\n7,e,"He said ""go"", then left",1\nzz,e,plain,2\n')
    df = files.read_csv_typed(spark, str(path), schema, corrupt_column=files.CORRUPT)
    rows = {r.id: r for r in df.collect()}
    assert df.columns == ["id", "name", "n", files.CORRUPT]
    assert (rows[1].name, rows[1].n, rows[1][files.CORRUPT]) == ('He said "go", then left', 7, None)
    assert rows[2].n is None and rows[2][files.CORRUPT]
    path.write_text("id,name\n1,x\n")
    with pytest.raises(ValueError):
        files.read_csv_typed(spark, str(path), schema)
