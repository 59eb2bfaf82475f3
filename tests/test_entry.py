"""The contract holds in a fresh process outside the repository folder."""

import subprocess
import sys
from pathlib import Path

from pyspark.ml.feature import StopWordsRemover

from glotta.resources import spanish_stopwords

ROOT = Path(__file__).resolve().parents[1]


def test_stopwords_equal_the_ones_in_spark(spark):
    assert spanish_stopwords() == tuple(dict.fromkeys(StopWordsRemover.loadDefaultStopWords("spanish")))


def run_elsewhere(code, folder):
    prefix = f"import sys; sys.path.insert(0, {str(ROOT)!r}); import __spark_entry__ as e\n"
    return subprocess.run([sys.executable, "-c", prefix + code], cwd=folder, capture_output=True, text=True, timeout=300)


def test_oracles_need_no_jar_folder(tmp_path):
    code = "import pyspark; pyspark.__file__ = '/nowhere/__init__.py'; print(len(e.oracle_sql()))"
    done = run_elsewhere(code, tmp_path)
    assert done.returncode == 0 and int(done.stdout.split()[-1]) >= 59, done.stderr


def test_model_hook_runs_outside_the_repository(tmp_path, sf_dir):
    code = ("from pyspark.sql import SparkSession\n"
            "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate()\n"
            f"print(e.queries()['translate_with_model'](s, {sf_dir!r}).count())")
    done = run_elsewhere(code, tmp_path)
    assert done.returncode == 0 and int(done.stdout.split()[-1]) == 200, done.stderr[-2000:]
