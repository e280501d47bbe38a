"""What a Python worker keeps beside the executor's heap stays small."""

import sys

from pyspark.sql import functions as F

from ledgerlens.llm import common, packing
from ledgerlens.llm.queries import tokenizer_path

KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


def test_kept_pieces_are_bounded():
    ids = packing.Ids(tokenizer_path())
    for i in range(0, 90_000, 1000):
        text = " ".join(f"w{n:x}q" for n in range(i, i + 1000))
        assert ids(text) == ids.whole(text)
    kept = sys.getsizeof(ids.known) + sum(sys.getsizeof(k) + sys.getsizeof(v) for k, v in ids.known.items())
    assert ids.known and kept < 16 << 20


def test_packing_reads_small_batches(spark, monkeypatch):
    seen, whole = [], common.stage
    monkeypatch.setattr(packing, "stage", lambda df, name: seen.append((name, spark.conf.get(KEY))) or whole(df, name))
    before = spark.conf.get(KEY)
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("one two").alias("text"))
    got = packing.pack(docs, tokenizer_path())
    assert got.agg(F.sum("length"), F.countDistinct("doc_id")).first()[1] == 3000
    assert seen[0] == ("packed", "1000") and spark.conf.get(KEY) == before


def test_other_operators_tables_are_dropped():
    common._HELD.clear()
    common.held("one", lambda: "large")
    assert list(common.tidy(lambda b: iter([common._HELD.get("one")]), holds=True)([])) == ["large"]
    assert list(common.tidy(lambda b: iter([common._HELD.get("one")]))([])) == [None]
