import pytest

import submit
from tests.conftest import document, feature


@pytest.fixture
def staged(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.json").write_text(document(feature({"mag": 6.5, "updated": 1706600000000})))
    (folder / "b.json").write_text(document(feature({"mag": 2.5, "updated": 1706600000000}), feature()))
    return str(folder)


def arguments(job, staged, tmp_path, *more):
    layers = ["--staged", staged, "--root", str(tmp_path / "lake"), "--run-date", "2024-01-30"]
    return [job, "--table", f"submit_{job}.gold", *layers, *more]


@pytest.mark.parametrize(
    ("job", "more", "rows"),
    [
        ("historical", [], 3),
        ("daily", [], 3),
        ("append", [], 6),
        ("canonical", ["--without-place", "--n-files", "1"], 6),
        ("audited", ["--audit-table", "submit_log.audit", "--job-id", "7"], 3),
    ],
)
def test_job_twice(spark, staged, tmp_path, job, more, rows):
    for _run in range(2):
        submit.main(arguments(job, staged, tmp_path, *more))
    assert spark.table(f"submit_{job}.gold").count() == rows


def test_report(spark, staged, tmp_path, capsys):
    submit.main(arguments("daily", staged, tmp_path))
    submit.main(["report", "--table", "submit_daily.gold", "--run-date", "2024-01-30"])
    shown = capsys.readouterr().out
    assert "top_area_last_week" in shown and "|Here|6.5" in shown


def test_missing_arguments(capsys):
    with pytest.raises(SystemExit):
        submit.parse(["audited", "--table", "t"])
    assert "--staged, --root, --run-date, --audit-table" in capsys.readouterr().err
