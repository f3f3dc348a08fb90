"""The command line: option mapping, an available-now run, table repair."""

import tempfile

from conftest import SF_SMALL
from shoal.__main__ import build_job, main, parser
from shoal.sources.envelope import device_messages
from shoal.sources.stream import kafka_options
from shoal.streaming.sinks import read_table


def test_options_map_to_the_source(spark):
    args = parser().parse_args([
        "run", "e7", "--topic", "t", "--starting-offsets", "earliest", "--max-offsets", "100",
        "--min-offsets", "10", "--max-trigger-delay", "5m", "--poll-ms", "512",
        "--kafka-option", "kafka.bootstrap.servers=b:9092", "--root", tempfile.mkdtemp(),
    ])
    job = build_job(spark, args)
    opts = kafka_options(job.source)
    assert opts["subscribe"] == "t" and opts["startingOffsets"] == "earliest"
    assert opts["maxOffsetsPerTrigger"] == "100" and opts["minOffsetsPerTrigger"] == "10"
    assert opts["kafkaConsumer.pollTimeoutMs"] == "512" and opts["kafka.bootstrap.servers"] == "b:9092"
    assert job.profile.name == "kafka_to_hive_v7_events"


def test_available_now_run_and_repair(spark, capsys):
    root = tempfile.mkdtemp()
    device_messages(spark, SF_SMALL, "metrics").select("value").write.text(f"{root}/in")
    assert main(["run", "m7", "--source-format", "text", "--source-path", f"{root}/in", "--root",
                 f"{root}/job", "--available-now", "--table-name", "shoal_cli_m7"], spark=spark) == 0
    assert read_table(spark, f"{root}/job/table").count() == 500  # classes 2, 6, 7, 8, 9
    assert main(["repair", "shoal_cli_m7"], spark=spark) == 0
    assert "repaired shoal_cli_m7" in capsys.readouterr().out
    assert spark.table("shoal_cli_m7").count() == 500


def test_replay_command(spark, capsys):
    from shoal.plans.profiles import PROFILES
    from shoal.streaming.jobs import StreamPaths
    from shoal.streaming.sinks import TableWriter

    root = tempfile.mkdtemp()
    paths = StreamPaths(root)
    w = TableWriter(PROFILES["m7"], paths.table, quarantine_path=paths.quarantine)
    good = w.write
    w.write = lambda *a: (_ for _ in ()).throw(RuntimeError("disk full"))
    w(spark.createDataFrame([('{"metrics":{"i":"1"},"thedate":"2024-01-01"}',)], "value string"), 0)
    w.write = good
    assert main(["replay", "m7", "--root", root], spark=spark) == 0
    assert "replayed 0000-000000000000" in capsys.readouterr().out
    assert read_table(spark, paths.table).count() == 1


def test_allow_list_option(spark):
    import os

    d = tempfile.mkdtemp()
    with open(os.path.join(d, "allowed.csv"), "w") as f:
        f.write("HUB,MENU\n")
    args = parser().parse_args(["run", "e5", "--topic", "t", "--root", d, "--allow-list", os.path.join(d, "allowed.csv"),
                                "--layout", "salted", "--files-per-hour", "3"])
    job = build_job(spark, args)
    assert job.profile.allow_list == ("HUB", "MENU") and job.files_per_hour == 3
