import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.conftest import document, feature
from tremorlake.operators import canonical as C
from tremorlake.schemas import CANONICAL_SILVER, columns
from tremorlake.sources import commits
from tremorlake.sources import layers as L

NUMBERS = columns("n int")


def numbers(spark, n):
    return spark.range(n).selectExpr("CAST(id AS int) AS n")


def failing(spark, n):
    """Rows of which the last one fails in its task, after others have been written."""
    row = F.when(F.col("n") < n - 1, F.col("n")).otherwise(F.raise_error(F.lit("lost disk")).cast("int"))
    return numbers(spark, n).repartition(3).select(row.alias("n"))


def names(folder):
    return sorted(path.name for path in Path(folder).iterdir() if not path.name.endswith(".crc"))


def test_a_write_leaves_a_manifest(spark, tmp_path):
    path = L.write_silver(numbers(spark, 10), str(tmp_path / "silver"))
    manifest = commits.manifest_of(spark, path)
    assert manifest.rows == 10 and manifest.files == len([name for name in names(path) if name != commits.MANIFEST])
    assert json.loads((Path(path) / commits.MANIFEST).read_text())["rows"] == 10
    assert L.read_silver(spark, path, NUMBERS).count() == 10
    assert L.read_silver(spark, f"{path}/*.parquet", NUMBERS).count() == 10
    assert names(tmp_path) == ["silver"]


def test_a_failed_write_leaves_the_former_folder(spark, tmp_path):
    path = str(tmp_path / "silver")
    with pytest.raises(Exception, match="lost disk"):
        L.write_silver(failing(spark, 50), path)
    assert names(tmp_path) == []
    with pytest.raises(FileNotFoundError):
        L.read_silver(spark, path, NUMBERS)
    L.write_silver(numbers(spark, 7), path)
    with pytest.raises(Exception, match="lost disk"):
        L.write_silver(failing(spark, 50), path)
    assert L.read_silver(spark, path, NUMBERS).count() == 7 and names(tmp_path) == ["silver"]


def test_unfinished_folders_are_refused(spark, tmp_path):
    """A plain write that fails in a task leaves files, but no manifest."""
    path = str(tmp_path / "silver")
    with pytest.raises(Exception, match="lost disk"):
        failing(spark, 50).write.parquet(path)
    numbers(spark, 5).write.mode("overwrite").parquet(path)
    with pytest.raises(FileNotFoundError, match="no finished write"):
        L.read_silver(spark, path, NUMBERS)


def test_lost_and_added_files_are_noticed(spark, tmp_path):
    path = L.write_silver(numbers(spark, 10).repartition(3), str(tmp_path / "silver"))
    first = next(Path(path).glob("part-*"))
    kept = first.read_bytes()
    first.unlink()
    with pytest.raises(FileNotFoundError, match="files"):
        L.read_silver(spark, path, NUMBERS)
    first.write_bytes(kept)
    numbers(spark, 1).write.mode("append").parquet(path)
    with pytest.raises(FileNotFoundError, match="files"):
        L.read_silver(spark, path, NUMBERS)


def test_globs_over_days_need_each_day(spark, tmp_path):
    for day in ("20240101", "20240102"):
        L.write_silver(numbers(spark, 4), str(tmp_path / day / "transformed_data"))
    pattern = str(tmp_path / "*" / "transformed_data" / "*.parquet")
    assert L.read_silver(spark, pattern, NUMBERS).count() == 8
    (tmp_path / "20240102" / "transformed_data" / commits.MANIFEST).unlink()
    with pytest.raises(FileNotFoundError, match="20240102"):
        L.read_silver(spark, pattern, NUMBERS)


def test_a_failed_switch_brings_the_former_folder_back(spark, tmp_path, monkeypatch):
    path = L.write_silver(numbers(spark, 4), str(tmp_path / "silver"))
    rename = commits.Folder.rename

    def refused(folder, to):
        if ".side." in folder.path:
            raise OSError("busy")
        rename(folder, to)

    monkeypatch.setattr(commits.Folder, "rename", refused)
    with pytest.raises(OSError, match="busy"):
        L.write_silver(numbers(spark, 9), path)
    assert L.read_silver(spark, path, NUMBERS).count() == 4


def test_landing_publishes_or_discards(spark, lines, tmp_path):
    path = str(tmp_path / "bronze")
    assert L.land_bronze(lines("{}", "[]"), path) and commits.manifest_of(spark, path).rows == 2
    assert L.land_bronze(lines("{}").filter("false"), path) is False
    assert L.read_bronze_text(spark, path).count() == 2 and names(tmp_path) == ["bronze"]


def test_rows_and_losses_in_one_write(spark, lines, tmp_path):
    silver, quarantine = str(tmp_path / "silver"), str(tmp_path / "lost")
    frame = lines(document(feature(), feature({"place": None}), feature()), "no json", document(feature()))
    jobs_before = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    counts = L.write_tagged(C.tagged_project(frame), CANONICAL_SILVER, silver, quarantine, n_files=1)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) - jobs_before == 1
    assert counts == {"row": 2, "document": 1, "feature": 2}
    assert L.read_silver(spark, silver, CANONICAL_SILVER).count() == 2
    assert len(list(Path(silver).glob("*.parquet"))) == 1
    lost = sorted((row.kind, row.value[:7]) for row in L.read_quarantine(spark, quarantine).collect())
    assert [kind for kind, _ in lost] == ["document", "feature", "feature"] and lost[0][1] == "no json"


@pytest.mark.parametrize("texts", [[], ["no json"], [document(feature())]])
def test_rows_or_losses_may_be_missing(spark, lines, tmp_path, texts):
    silver, quarantine = str(tmp_path / "silver"), str(tmp_path / "lost")
    frame = lines(*texts) if texts else spark.createDataFrame([], "value string")
    counts = L.write_tagged(C.tagged_project(frame), CANONICAL_SILVER, silver, quarantine)
    assert L.read_silver(spark, silver, CANONICAL_SILVER).count() == counts["row"]
    assert L.read_quarantine(spark, quarantine).count() == counts["document"] + counts["feature"]


def test_a_failed_tagged_write_leaves_both_places(spark, lines, tmp_path):
    silver, quarantine = str(tmp_path / "silver"), str(tmp_path / "lost")
    L.write_tagged(C.tagged_project(lines("no json", document(feature()))), CANONICAL_SILVER, silver, quarantine)
    broken = C.tagged_project(lines(document(feature()))).withColumn("area", F.raise_error(F.lit("lost disk")).cast("string"))
    with pytest.raises(Exception, match="lost disk"):
        L.write_tagged(broken, CANONICAL_SILVER, silver, quarantine)
    assert L.read_silver(spark, silver, CANONICAL_SILVER).count() == 1
    assert L.read_quarantine(spark, quarantine).count() == 1 and names(tmp_path) == ["lost", "silver"]
