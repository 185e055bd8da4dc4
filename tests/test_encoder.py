"""The encoder as a saved pipeline stage."""

import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler

from stopcast.plans.encoder import LexicalEncoder

ROWS = [(i, ["10", "9", "b", None, "A"][i % 5], i % 7, float(i % 2)) for i in range(60)]
SCHEMA = "event_id long, stop string, hour int, label double"


def test_codes_are_lexicographic_and_unseen_are_null(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    model = LexicalEncoder(inputCols=["stop", "hour"]).fit(df)
    got = {r["stop"]: r["stop_code"] for r in model.transform(df).collect()}
    assert got == {None if v == "nan" else v: float(i) for i, v in enumerate(sorted(["10", "9", "b", "A", "nan"]))}
    new = spark.createDataFrame([(1, "zz", 3, 0.0), (2, "9", 99, 0.0)], SCHEMA)
    assert [(r["stop_code"], r["hour_code"]) for r in model.transform(new).orderBy("event_id").collect()] == [(None, 3.0), (1.0, None)]
    minus = LexicalEncoder(inputCols=["stop"], unseen="minus_one").fit(df).transform(new).orderBy("event_id").collect()
    assert [r["stop_code"] for r in minus] == [-1.0, 1.0]
    with pytest.raises(ValueError):
        LexicalEncoder(inputCols=["stop"], unseen="guess").fit(df)


def test_saved_in_one_session_loaded_in_another(spark, tmp_path):
    df = spark.createDataFrame(ROWS, SCHEMA)
    pipe = Pipeline(stages=[LexicalEncoder(inputCols=["stop", "hour"], unseen="minus_one"),
                            VectorAssembler(inputCols=["stop_code", "hour_code"], outputCol="features"), LogisticRegression()])
    model = pipe.fit(df)
    path = f"file://{tmp_path}/model"
    model.write().overwrite().save(path)
    new = spark.createDataFrame(ROWS[:10] + [(100, "unseen", 3, 0.0)], SCHEMA)
    want = {r["event_id"]: (r["stop_code"], r["hour_code"], round(float(r["probability"][1]), 12)) for r in model.transform(new).collect()}
    again = {r["event_id"]: (r["stop_code"], r["hour_code"], round(float(r["probability"][1]), 12))
             for r in PipelineModel.load(path).transform(new).collect()}
    assert again == want and want[100][0] == -1.0
    code = (f"from stopcast.session import get_spark\nfrom pyspark.ml import PipelineModel\ns = get_spark('local[2]', 2)\n"
            f"df = s.createDataFrame({ROWS[:10] + [(100, 'unseen', 3, 0.0)]!r}, {SCHEMA!r})\n"
            f"print({{r['event_id']: (r['stop_code'], r['hour_code'], round(float(r['probability'][1]), 12)) "
            f"for r in PipelineModel.load({path!r}).transform(df).collect()}})")
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=240, cwd=Path(__file__).parent.parent)
    assert eval(out.stdout.strip().splitlines()[-1]) == want, out.stderr[-2000:]
