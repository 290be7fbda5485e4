import subprocess
import sys

from quarry.session import scratch_path


def test_run_manifest_cli(spark, tmp_path):
    manifest = tmp_path / "jobs.csv"
    manifest.write_text("sql_name,output_name,period,criterion,target,enabled\n"
                        "orders_by_date,orders_recent,前日まで累積,登録日時,parquet,TRUE\n"
                        "customer_master,customers,,,CSV,TRUE\n"
                        "orders_live,skipped,,,parquet,FALSE\n", encoding="utf-8")
    specs = tmp_path / "cli_specs.py"
    specs.write_text("from quarry.plans.registry import dataset_specs\n"
                     "def specs():\n    return dataset_specs('/root/testdata/sf0.001')\n", encoding="utf-8")
    out = scratch_path(spark, "cli")
    env = {"PYTHONPATH": f"{tmp_path}:{__import__('os').getcwd()}", "PATH": __import__("os").environ["PATH"]}
    done = subprocess.run([sys.executable, "-m", "quarry", "run-manifest", "--manifest", str(manifest),
                           "--specs", "cli_specs:specs", "--out", out, "--as-of", "1998-06-15",
                           "--master", "local[2]"], capture_output=True, text=True, env=env, timeout=600)
    assert done.returncode == 0, done.stderr[-2000:]
    lines = sorted(line.split("\t")[0] for line in done.stdout.strip().splitlines())
    assert lines == ["customer_master", "orders_by_date"]   # no display-name column: named by SQL name


def test_only_changed_jobs_and_pruning(spark, tmp_path, capsys):
    """Two runs over unchanged inputs, then a changed one; then its old versions go."""
    import json

    from quarry.__main__ import main
    from quarry.sinks.versions import read_version, version_numbers
    spark.range(3).write.parquet(f"{tmp_path}/in/a")
    spark.range(3).write.parquet(f"{tmp_path}/in/b")
    (tmp_path / "jobs.csv").write_text("sql_name,output_name,target,enabled,timeout_s\na,a,parquet,TRUE,60\nb,b,parquet,TRUE,\n")
    module = f"cli_specs_{tmp_path.name.replace('-', '_')}"
    (tmp_path / f"{module}.py").write_text(
        "from quarry.spec import DatasetSpec\n"
        f"def specs():\n    return {{n: DatasetSpec(n, lambda s, n=n: s.read.parquet(f'{tmp_path}/in/{{n}}')) for n in 'ab'}}\n")
    import sys
    sys.path.insert(0, str(tmp_path))
    args = ["run-manifest", "--manifest", f"{tmp_path}/jobs.csv", "--specs", f"{module}:specs", "--out", f"{tmp_path}/out", "--as-of", "2024-01-31",
            "--committed", "--timeout", "300", "--inputs", json.dumps({n: [f"{tmp_path}/in/{n}"] for n in "ab"})]
    try:
        ran = []
        for touch in (None, None, "b", "b"):
            if touch:
                spark.range(2).write.mode("append").parquet(f"{tmp_path}/in/{touch}")
            capsys.readouterr()
            assert main(args) == 0
            ran.append(sorted(line.split("\t")[0] for line in capsys.readouterr().out.splitlines() if "\t" in line))
        assert ran == [["a", "b"], [], ["b"], ["b"]]
        assert read_version(spark, f"{tmp_path}/out/b.parquet").count() == 7 and version_numbers(spark, f"{tmp_path}/out/b.parquet") == [1, 2, 3]
        assert main(["prune-versions", "--target", f"{tmp_path}/out/b.parquet", "--keep", "1", "--older-than", "0"]) == 0
        assert capsys.readouterr().out.split() == ["1", "2"] and read_version(spark, f"{tmp_path}/out/b.parquet").count() == 7
    finally:
        sys.path.remove(str(tmp_path))
