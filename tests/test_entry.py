"""The driver's contract in a process of its own, where no session runs."""

import os
import subprocess
import sys
import zipfile
from pathlib import Path

import pyspark
import pytest
from quern import store
from quern.functions.wordlists import english_stop_words

ROOT = Path(__file__).resolve().parents[1]


def fresh(code):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    return subprocess.run([sys.executable, "-c", code], cwd=ROOT, env=env, capture_output=True, text=True, timeout=120)


def test_registry_needs_no_session():
    said = fresh("import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert len(q) > 30 and set(o) <= set(q); print('text_stats' in q)")
    assert said.returncode == 0, said.stderr
    assert said.stdout.strip() == "True"


def test_core_does_without_the_training_data_operators():
    code = "import sys; sys.modules['quern.llm'] = None; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; print(len(e.queries()) == len(e.registry.QUERIES))"
    said = fresh(code)
    assert said.returncode == 0, said.stderr
    assert said.stdout.strip() == "True"


def test_registry_needs_no_archives_of_spark():
    """An installation whose archives lie elsewhere than beside pyspark."""
    code = "import pyspark; pyspark.__file__ = '/nowhere/pyspark/__init__.py'; import __spark_entry__ as e; print(len(e.queries()) > 30 and len(e.oracle_sql()) > 30)"
    said = fresh(code)
    assert said.returncode == 0, said.stderr
    assert said.stdout.strip() == "True"


def test_stop_words_are_those_of_spark():
    jar = next((Path(pyspark.__file__).parent / "jars").glob("spark-mllib_*.jar"), None)
    if jar is None:
        pytest.skip("no archives of Spark")
    with zipfile.ZipFile(jar) as archive:
        text = archive.read("org/apache/spark/ml/feature/stopwords/english.txt").decode()
    assert english_stop_words() == tuple(sorted({w.lower() for w in text.split()}))


class Elsewhere:
    """A session on a cluster that names no shared folder."""

    class conf:
        get = staticmethod(lambda key, default=None: default)

    class sparkContext:
        master = "spark://host:7077"

        class _jsc:
            class sc:
                class getCheckpointDir:
                    isDefined = staticmethod(lambda: False)


def test_cluster_without_shared_folder_is_refused():
    with pytest.raises(ValueError):
        store.shared_dir(Elsewhere)
