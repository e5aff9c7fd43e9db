import json
from pathlib import Path

import pandas as pd
import pytest

from cohort import (
    build_if_absent,
    load_interim,
    load_metrics,
    load_raw,
    read_csv,
    save_interim,
    save_metrics,
    write_csv,
)
from cohort.functions.values import NULL_MARKERS
from cohort.plans.workspace import shared_folder
from cohort.sources.tables import metrics_frame


def csv(tmp_path, text):
    path = tmp_path / "t.csv"
    path.write_text(text)
    return str(path)


def test_types_like_pandas(spark, tmp_path):
    path = csv(
        tmp_path,
        "i,gap,f,b,s,none,big,mixed\n"
        '1,1,1.5,True,"a, ""q""",,99999999999999999999,1\n'
        "-2,NA,inf,False,None,nan,1,x\n"
        "3,3,2e3,True, pad ,,2,3\n",
    )
    df = read_csv(spark, path)
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    assert kinds == {
        "i": "bigint", "gap": "double", "f": "double", "b": "boolean",
        "s": "string", "none": "double", "big": "double", "mixed": "string",
    }
    ours, theirs = df.toPandas(), pd.read_csv(path)
    for c in ("i", "gap", "f", "b", "none"):
        pd.testing.assert_series_equal(ours[c], theirs[c])
    assert ours["s"].tolist() == ['a, "q"', None, " pad "]


def test_every_null_marker(spark, tmp_path):
    path = csv(tmp_path, "k,v\n" + "".join(f"{i},{m}\n" for i, m in enumerate(NULL_MARKERS)) + "99,none\n")
    df = read_csv(spark, path)
    assert [r["k"] for r in df.where("v is not null").collect()] == [99]


def test_files_of_a_folder_share_one_header(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "1.csv").write_text("a,b\n1,2\n")
    (tmp_path / "d" / "2.csv").write_text("a,b\r\n3,4\r\n")
    assert sorted(read_csv(spark, str(tmp_path / "d")).collect()) == [(1, 2), (3, 4)]
    (tmp_path / "d" / "3.csv").write_text("b,a\n6,5\n")
    with pytest.raises(ValueError, match="headers"):
        read_csv(spark, str(tmp_path / "d"))


def test_repeated_and_blank_headers(spark, tmp_path):
    path = csv(tmp_path, "a,a,,A,a.1,a\n1,2,3,4,5,6\n")
    assert read_csv(spark, path).columns == pd.read_csv(path).columns.tolist()


def test_given_schema_skips_inference(spark, tmp_path):
    path = csv(tmp_path, "a,b\n1,x\noops,NA\n")
    df = read_csv(spark, path, schema="b string, a int")
    assert [tuple(r) for r in df.collect()] == [("x", 1), (None, None)]


def test_line_breaks_in_quotes(spark, tmp_path):
    path = csv(tmp_path, 'a,b\n1,"x\ny"\n')
    assert read_csv(spark, path, multiline=True).first()["b"] == "x\ny"


def test_missing_files(spark, tmp_path):
    for load in (load_raw, load_interim, load_metrics):
        with pytest.raises(FileNotFoundError):
            load(spark, str(tmp_path / "nothing"))
    with pytest.raises(ValueError, match="header"):
        read_csv(spark, csv(tmp_path, ""))


def test_csv_keeps_blanks_and_missing(spark, tmp_path):
    df = spark.createDataFrame([(1, " a ", 'say "x", y'), (2, None, "")], "i long, s string, t string")
    path = write_csv(df, str(tmp_path / "out"))
    assert sorted(tuple(r) for r in read_csv(spark, path).collect()) == [(1, " a ", 'say "x", y'), (2, None, None)]


@pytest.mark.parametrize("format", ["parquet", "csv"])
def test_interim(spark, tmp_path, format):
    df = spark.createDataFrame([(1, "a", 0.5), (2, None, None)], "i long, s string, d double")
    path = save_interim(df, str(tmp_path / "t"), format=format)
    back = load_interim(spark, path, format=format)
    assert sorted(back.collect()) == sorted(df.collect())


def test_build_if_absent(spark, tmp_path):
    path, built = str(tmp_path / "stage"), []

    def build():
        built.append(1)
        return spark.range(len(built))

    assert [build_if_absent(spark, path, build).count() for _ in range(3)] == [1, 1, 1]
    # A run that broke off leaves no success mark and is done again.
    Path(path, "_SUCCESS").unlink()
    assert build_if_absent(spark, path, build).count() == 2


def test_metrics_round_trip(spark, tmp_path):
    metrics = {
        "roc_auc": None, "accuracy": 0.5, "precision": 0.25, "recall": 1.0, "f1": 0.4,
        "confusion_matrix": [[1, 2], [3, 4]], "n_samples": 10,
    }
    path = save_metrics(spark, metrics, str(tmp_path / "m"))
    text = next(Path(path).glob("part-*")).read_text()
    assert json.loads(text) == metrics and '\n  "accuracy"' in text
    assert load_metrics(spark, path) == {k: v for k, v in metrics.items() if v is not None}
    row = metrics_frame(spark, metrics).first()
    assert row["confusion_matrix"] == [[1, 2], [3, 4]] and row["roc_auc"] is None
    with pytest.raises(ValueError, match="unknown"):
        metrics_frame(spark, {"speed": 1.0})


class Session:
    """A session that names a folder, or a cluster session that names none."""

    def __init__(self, named):
        self.conf = {"spark.checkpoint.dir": named} if named else {}
        self.sparkContext = self
        self.master = "yarn"

    def getCheckpointDir(self):
        return None


def test_shared_folder_is_the_one_the_session_names(spark):
    assert shared_folder(Session("hdfs:///shared/")) == "hdfs:///shared"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Session(None))
    assert shared_folder(spark)
