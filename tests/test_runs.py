"""Run folders: outputs appear together or not at all, and scratch goes."""

import json

import pytest

from blockbeam.sinks import writers as Wr
from blockbeam.sinks.runs import run_folder
from blockbeam.sinks.scratch import hadoop, scratch_path
from blockbeam.sinks.staging import staged


def names(spark, path):
    fs, p = hadoop(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def scratch(spark):
    from blockbeam.session import ensure_checkpoint_dir
    return set(names(spark, f"{ensure_checkpoint_dir(spark)}/blockbeam-out"))


def test_a_finished_job_publishes_and_leaves_no_scratch(spark, tmp_out):
    out = tmp_out("jobs")
    before = scratch(spark)
    for n in (10, 3):  # a second run replaces the first one's output
        with run_folder(spark, out, "squares") as run:
            df = staged(spark.range(n).selectExpr("id", "id * id as sq"), "squares")
            assert len(scratch(spark)) == len(before) + 1
            Wr.write_parquet(df, run.path("squares"))
            assert names(spark, out) in (["." + run.hidden.rsplit("/.", 1)[1]], sorted(["." + run.hidden.rsplit("/.", 1)[1], "_manifest", "squares"]))
        assert scratch(spark) == before
        assert names(spark, out) == ["_manifest", "squares"]
        assert spark.read.parquet(f"{out}/squares").count() == n
    told = json.loads("".join(r.value for r in spark.read.option("wholetext", True).text(f"{out}/_manifest/squares.json").collect()))
    assert told["job"] == "squares" and [o["name"] for o in told["outputs"]] == ["squares"] and told["outputs"][0]["bytes"] > 0


def test_a_failed_job_leaves_no_visible_output(spark, tmp_out):
    out = tmp_out("failed")
    with run_folder(spark, out, "good") as run:
        Wr.write_parquet(spark.range(5), run.path("numbers"))
    before = scratch(spark)
    with pytest.raises(RuntimeError, match="half way"):
        with run_folder(spark, out, "bad") as run:
            Wr.write_parquet(staged(spark.range(9), "more"), run.path("numbers"))
            Wr.write_parquet(spark.range(9), run.path("others"))
            raise RuntimeError("half way")
    assert names(spark, out) == ["_manifest", "numbers"] and names(spark, f"{out}/_manifest") == ["good.json"]
    assert spark.read.parquet(f"{out}/numbers").count() == 5
    assert scratch(spark) == before
    with pytest.raises(FileNotFoundError):
        with run_folder(spark, out, "idle") as run:
            run.path("never written")
    assert names(spark, out) == ["_manifest", "numbers"]


def test_scratch_folders_are_fresh_and_shared(spark):
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_files_of_a_folder_follow_its_bytes(spark, tmp_out):
    """20 tasks that each hold rows of every folder: one file a folder, not 20; and files in order."""
    df = spark.range(0, 4000, 1, 20).selectExpr("id", "cast(id % 5 as int) as part", "id * 7 % 1000 as score")
    path = tmp_out("parts")
    Wr.write_parquet(df, path, partition_by=["part"])
    assert all(len([n for n in names(spark, f"{path}/part={k}") if n.startswith("part-")]) == 1 for k in range(5))
    assert spark.read.parquet(path).count() == 4000
    text = tmp_out("tuples")
    Wr.write_tuple_text(df, text, ["id", "score"], partition_by=["part"], order=["score"])
    got = [int(r.value.strip("()").split(",")[1]) for r in spark.read.text(f"{text}/part=3").collect()]
    assert len(got) == 800 and got == sorted(got)
    csv = tmp_out("csv")
    Wr.write_csv(df, csv, partition_by=["part"])
    assert len([n for n in names(spark, f"{csv}/part=0") if n.startswith("part-")]) == 1
