"""The training-data pipeline: five stages over ``documents``.

Each stage is a function (spark, docs, sf_dir) -> DataFrame that works on all
its predecessor kept.  Every result is written as Parquet under the shared work
folder and read again as the next stage's ``docs``, so that no stage recomputes
an earlier one and a lost executor costs only its own tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import op1_mixing, op3_line_rules, op5_packing, op7_line_dedup, op10_ngram_join
from tidemark.llm.common import DOCUMENT_COLUMNS, stored, table

STAGES = [
    ("quality rules", op3_line_rules.stage),
    ("line dedup", op7_line_dedup.stage),
    ("n-gram Jaccard join", op10_ngram_join.stage),
    ("mixing", op1_mixing.stage),
    ("packing", op5_packing.stage),
]

#: Mixing (a fitted classifier) and packing (a tokenizer) cannot be expressed in
#: SQL; the pipeline is tested against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*DOCUMENT_COLUMNS)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
