import os

from martworks.session import CORE_CONF, checkpoint_dir, scratch, work_path


def test_work_paths_live_under_the_checkpoint_dir(spark):
    base = checkpoint_dir(spark)
    assert base == spark.sparkContext.getCheckpointDir()
    a, b = work_path(spark, "x"), work_path(spark, "x")
    assert a.startswith(base.rstrip("/") + "/work/") and a != b
    assert a.rsplit("/", 1)[1].startswith("x-") and spark.sparkContext.applicationId in a


def _local(path):
    return path.removeprefix("file:")


def test_scratch_tables_go_with_their_block(spark):
    kept = work_path(spark, "kept")
    with scratch(spark):
        inner = work_path(spark, "inner")
        for path in (kept, inner):
            spark.range(3).write.parquet(path)
        with scratch(spark):
            deep = work_path(spark, "deep")
            spark.range(1).write.parquet(deep)
        assert not os.path.exists(_local(deep)) and os.path.exists(_local(inner))
    assert not os.path.exists(_local(inner)) and spark.read.parquet(kept).count() == 3


def test_clear_work_removes_this_applications_tables(tmp_path):
    """In a session of its own folder, so that other tests keep theirs."""
    import subprocess
    import sys

    code = (
        "import os, sys; from martworks.session import get_session, work_path, clear_work\n"
        f"s = get_session('local[1]', 1, extra_conf={{'spark.checkpoint.dir': {str(tmp_path)!r}}})\n"
        "p = work_path(s, 'x'); s.range(2).write.parquet(p); local = p.removeprefix('file:')\n"
        "assert os.path.exists(local); clear_work(s); assert not os.path.exists(local)\n"
        "print('cleared')"
    )
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120)
    assert "cleared" in done.stdout, done.stderr[-1500:]


def test_core_settings_applied(spark):
    for key in ("spark.sql.session.timeZone", "spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold"):
        assert spark.conf.get(key) == CORE_CONF[key]


def test_results_do_not_depend_on_the_session_time_zone(spark):
    import __spark_entry__ as entry
    from tests.conftest import SF_SMALL

    names = ["m6_incremental_load", "t15_conform_customer", "m4_reload_day", "t4_coerce_timestamp"]
    base = {n: sorted(map(tuple, entry.queries()[n](spark, SF_SMALL).collect()), key=repr) for n in names}
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        other = {n: sorted(map(tuple, entry.queries()[n](spark, SF_SMALL).collect()), key=repr) for n in names}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert base == other
