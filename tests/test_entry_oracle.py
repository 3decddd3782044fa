"""Driver contract: entry() runs; a sample of queries equals the DuckDB oracle."""
import os
import shutil
import subprocess
import sys

import duckdb
import pytest

from conftest import SF_SMALL
import __spark_entry__ as E
from pyspark.sql import functions as F

from framewatch.config import FIXTURE_CONFIG
from framewatch.operators import incidents
from framewatch.plans import catalog
from framewatch.plans.pipeline import GatePipeline

SAMPLE = ["qa_batches", "missing_column", "unreadable_column", "row_rules_fallback", "unknown_feeds", "rule_failures", "rolling_quarantine_rate", "drift_status", "batch_telemetry"]


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) >= 0 and df.columns == ["camera_id", "feed_id", "batch_round",
                                              "rolling_quarantine_rate", "reason_types"]


def test_every_query_has_oracle_or_is_documented():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    own = catalog.registry()
    assert len(own) >= 64 and set(own) <= set(o)


def test_entry_without_the_training_data_operators(tmp_path):
    """The registry works with that subpackage and its pipeline gone."""
    root = os.path.dirname(os.path.abspath(E.__file__))
    for name in ("__spark_entry__.py", "framewatch"):
        source = os.path.join(root, name)
        if os.path.isdir(source):
            shutil.copytree(source, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        else:
            shutil.copy(source, tmp_path / name)
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"],
                          cwd=tmp_path, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"}, capture_output=True, text=True, check=True)
    n = str(len(catalog.registry()))
    assert said.stdout.split() == [n, n]


@pytest.mark.parametrize("name", SAMPLE)
def test_sample_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("events", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t)}.parquet')")
    want = con.sql(E.oracle_sql()[name]).df()
    got = E.queries()[name](spark, SF_SMALL).toPandas()
    assert sorted(got.columns) == sorted(want.columns)
    cols = sorted(got.columns)

    def norm(pdf):
        out = []
        for rec in pdf[cols].itertuples(index=False, name=None):
            out.append(tuple(None if (x is None or (isinstance(x, float) and x != x)) else
                             (float(x) if isinstance(x, float) else x) for x in rec))
        return sorted(out, key=repr)
    assert norm(got) == norm(want)


def test_incident_json_encoding(spark):
    p = GatePipeline.from_sf(spark, SF_SMALL)
    payload = incidents.incident_payloads(p.incidents, FIXTURE_CONFIG).drop("rolling_quarantine_rate")
    js = payload.select(F.to_json(F.struct("*")).alias("j")).collect()
    assert js and all('"incident_id":"inc_' in r["j"] and '"severity":"critical"' in r["j"] for r in js)
