import os
import subprocess
import sys
from types import SimpleNamespace

import pytest

from rigweave.session import _written, clear_scratch, discard, settle_at, shared_dir, tasks_for


class Nothing:
    def isDefined(self):
        return False

    def isEmpty(self):
        return True


@pytest.mark.parametrize("master,refused", [("spark://host:7077", True), ("yarn", True), ("local-cluster[3,2,1024]", True), ("local[4]", False), ("local", False)])
def test_a_machine_local_folder_serves_local_masters_only(master, refused):
    made = []
    context = SimpleNamespace(master=master, setCheckpointDir=made.append, _jsc=SimpleNamespace(sc=lambda: SimpleNamespace(getCheckpointDir=Nothing)))
    spark = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: default), sparkContext=context)
    if refused:
        with pytest.raises(RuntimeError):
            shared_dir(spark)
        assert not made
    else:
        assert os.path.isdir(shared_dir(spark)) and len(made) == 1


def test_scratch_tables_can_be_removed(spark):
    one, first = settle_at(spark.range(3), "a")
    _, second = settle_at(spark.range(4), "b")
    local = lambda p: p.removeprefix("file://")
    assert one.count() == 3 and os.path.isdir(local(first))
    discard(spark, first)
    assert not os.path.exists(local(first)) and first not in _written and os.path.isdir(local(second))
    clear_scratch(spark)
    assert not os.path.exists(local(second)) and not _written


def test_tasks_follow_the_size(spark, tmp_path):
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert tasks_for(spark.range(10)) == least
    # 8 bytes a row: a gigabyte and a half asks for 24 tasks of 64 MB
    assert tasks_for(spark.range(200_000_000)) == 24 and tasks_for(spark.range(200_000_000), 2.0) == 48
    assert tasks_for(spark.sparkContext.parallelize([(1,)], 1).toDF("a int")) == least


def test_queries_of_the_core_load_without_the_subpackage():
    code = "import sys; sys.modules['xxhash'] = None; import __spark_entry__ as e; q = e.queries(); assert 'sync_transitions' in q and 'p2_found' in q and 'p8_found' not in q and e.oracle_sql().keys() <= q.keys()"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))), timeout=120)
