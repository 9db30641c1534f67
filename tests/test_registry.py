import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SHOW = "import __spark_entry__ as e; q = e.queries(); print(len(q), len(e.oracle_sql()), 'pipeline' in q, any(n.startswith('op1_') for n in q))"


def copy(folder, *without):
    shutil.copytree(ROOT, folder, ignore=shutil.ignore_patterns(".git", "__pycache__", ".pytest_cache"))
    for name in without:
        path = os.path.join(folder, name)
        shutil.rmtree(path) if os.path.isdir(path) else os.remove(path) if os.path.exists(path) else None
    return folder


def shown(folder, script=SHOW):
    done = subprocess.run([sys.executable, "-c", script], cwd=folder, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": str(folder)})
    assert done.returncode == 0, done.stderr
    return done.stdout.split()


@pytest.mark.parametrize("without", [
    ("deskmatch/llm", "tests/llm"), ("deskmatch/llm", "tests/llm", "corpus_pipeline.py"), ("corpus_pipeline.py",)])
def test_the_rest_is_registered_without_training_text(tmp_path, without):
    queries, sqls, pipeline, optional = shown(copy(tmp_path / "copy", *without))
    assert int(queries) == int(sqls) > 60 and (pipeline, optional) == ("False", "False")


def test_a_missing_library_of_training_text_ends_nothing_else(tmp_path):
    queries, _, pipeline, optional = shown(copy(tmp_path / "copy"), "import sys; sys.modules['public_tokenizers'] = None; " + SHOW)
    assert int(queries) > 60 and (pipeline, optional) == ("False", "False")


def test_a_query_runs_without_training_text(tmp_path):
    folder = copy(tmp_path / "copy", "deskmatch/llm", "tests/llm", "corpus_pipeline.py")
    script = (
        "import sys, __spark_entry__ as e; from deskmatch.session import session; "
        f"s = session('copy', 'local[2]', **{{'spark.checkpoint.dir': {str(tmp_path / 'shared')!r}, 'spark.ui.enabled': 'false', "
        f"'spark.sql.warehouse.dir': {str(tmp_path / 'warehouse')!r}}}); "
        "print(e.queries()['parsed_links'](s, '/root/testdata/sf0.001').count())")
    assert int(shown(folder, script)[-1]) > 0
