import os
import shutil
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def run(folder, code):
    return subprocess.run([sys.executable, "-B", "-c", code], cwd=folder, capture_output=True, text=True, timeout=120, env=os.environ | {"PYTHONPATH": str(folder)})


def test_the_rest_works_without_the_corpus_folder(tmp_path):
    for name in ("framewright", "__spark_entry__.py"):
        source = os.path.join(REPO, name)
        shutil.copytree(source, tmp_path / name) if os.path.isdir(source) else shutil.copy(source, tmp_path / name)
    shutil.rmtree(tmp_path / "framewright/llm", ignore_errors=True)
    done = run(tmp_path, "import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); assert 'tar_address' in q and set(s) == set(q); print(len(q))")
    assert done.returncode == 0, done.stderr
    for folder, _, files in os.walk(tmp_path / "framewright"):
        for f in files:
            if f.endswith(".py"):
                with open(os.path.join(folder, f)) as text:
                    assert "llm" not in text.read(), f


def test_other_missing_modules_are_errors(tmp_path):
    """Only the corpus folder may be absent; without a library that it needs the entry says so."""
    for name in ("framewright", "__spark_entry__.py"):
        source = os.path.join(REPO, name)
        shutil.copytree(source, tmp_path / name) if os.path.isdir(source) else shutil.copy(source, tmp_path / name)
    folder = tmp_path / "framewright/llm"
    shutil.rmtree(folder, ignore_errors=True)
    folder.mkdir()
    (folder / "__init__.py").write_text("")
    (folder / "queries.py").write_text("import a_library_that_is_not_there\n")
    done = run(tmp_path, "import __spark_entry__")
    assert done.returncode and "a_library_that_is_not_there" in done.stderr


def test_entry(spark):
    import __spark_entry__

    got = __spark_entry__.entry(spark)
    assert got.count() > 0 and "key" in got.columns
