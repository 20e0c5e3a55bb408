from chainlake.session import settle, shared_dir


def test_the_shared_folder_is_the_one_the_session_names(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_settled_rows_start_at_a_table(spark):
    df = settle(spark.range(5).selectExpr("id", "id * 2 as twice"))
    assert df.count() == 5
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Range" not in plan and "Relation" in plan
    assert any(f.startswith(("file:" + shared_dir(spark), "file://" + shared_dir(spark))) for f in df.inputFiles())


def test_workers_need_no_copy_of_the_package(tmp_path):
    """Run an Arrow function from a folder the package cannot be imported from."""
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = tmp_path / "job.py"
    script.write_text(
        f"import sys; sys.path.insert(0, {root!r})\n"
        "from chainlake.session import local_session\n"
        "from chainlake.functions.hexes import base58\n"
        "spark = local_session('1', 1, '1g')\n"
        "df = spark.createDataFrame([('0x' + '0' * 64,)], 'x string')\n"
        "print('got', df.select(base58('x')).first()[0])\n")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=180)
    assert "got QmNLei78zWmzUdbeRB3CiUfAizWUrbeeZh5K1rhAQKCh51" in done.stdout, done.stderr[-2000:]
