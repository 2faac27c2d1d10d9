import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from compare import check, connect  # noqa: E402

from rigweave.llm import queries as module  # noqa: E402

QUERIES, SQL = module.queries(), module.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, folder, name):
    check(QUERIES[name](spark, folder), connect(folder), SQL[name])


@pytest.mark.parametrize("name", sorted(QUERIES.keys() - SQL.keys()))
def test_runs(spark, folder, name):
    assert QUERIES[name](spark, folder).count() > 0


def test_sample_keeps_its_members_as_batches_arrive(spark, folder):
    from pyspark.sql import functions as F

    from rigweave.llm.group_split import episode_number
    from rigweave.llm.stable_sample import stable_sample

    rows = spark.read.parquet(f"{folder}/source_provenance.parquet").select(episode_number(F.col("source_episode_id"), F.col("curated_path")).alias("e"), "batch_no")
    last = set()
    for wave in range(1, rows.agg(F.max("batch_no")).first()[0] + 1):
        now = {r["e"] for r in stable_sample(rows.where(F.col("batch_no") <= wave), "e", 0.3, 23).collect()}
        assert last <= now
        last = now
