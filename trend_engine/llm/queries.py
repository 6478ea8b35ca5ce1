"""Registered queries of the subpackage: ``name -> fn(spark, sf_dir) -> DataFrame`` and their SQL."""

from __future__ import annotations

import importlib
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from trend_engine.llm import licence, sql

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
_MODULES = {
    "op1_line_dedup": "line_dedup",
    "op2_topk": "topk",
    "op3_packing": "packing",
    "op4_lm_score": "lm_score",
    "op5_licence": "licence",
    "op6_warc": "warc",
    "op7_mixing": "mixing",
    "op8_near_dedup": "near_dedup",
    "op9_toxicity": "toxicity",
    "op10_fingerprint": "fingerprint",
    "op11_phrases": "phrases",
    "op12_decontaminate": "decontaminate",
    "op13_whitening": "whitening",
}


def with_package(spark: SparkSession) -> None:
    """Let Python workers started from here find this package (a cluster gets it with --py-files)."""
    env = spark.sparkContext.environment
    if _ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [_ROOT, env.get("PYTHONPATH")]))


def _query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        with_package(spark)
        # Imported when first run, so that a query loads its own libraries only.
        return getattr(importlib.import_module(f"trend_engine.llm.{_MODULES[name]}"), name)(spark, sf_dir)
    run.__name__ = name
    return run


QUERIES = {name: _query(name) for name in _MODULES}

ORACLE_SQL = {"op5_licence": licence.SQL, "op6_warc": sql.WARC, "op11_phrases": sql.PHRASES,
              "op12_decontaminate": sql.DECONTAMINATE}
