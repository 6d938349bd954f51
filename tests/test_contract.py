"""The contract holds with and without the parts that may be removed."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
ASK = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), sum('op' == n[:2] for n in e.queries()))"


def asked(folder):
    result = subprocess.run([sys.executable, "-c", ASK], cwd=folder, capture_output=True, text=True, timeout=120)
    return result.returncode, result.stdout.split(), result.stderr


def copied(tmp_path, *names):
    for name in names:
        source = os.path.join(ROOT, name)
        if os.path.isdir(source):
            shutil.copytree(source, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        else:
            shutil.copy(source, tmp_path / name)


def test_without_the_optional_parts(tmp_path):
    copied(tmp_path, "variantry", "__spark_entry__.py")
    code, counts, _ = asked(tmp_path)
    assert code == 0 and int(counts[0]) == int(counts[1]) > 90 and counts[2] == "0"


def test_pipeline_left_behind(tmp_path):
    copied(tmp_path, "variantry", "__spark_entry__.py")
    (tmp_path / "corpus_pipeline.py").write_text("import variantry.llm.bpe\nQUERIES = {'pipeline': None}\nORACLES = {}\n")
    assert asked(tmp_path)[0] == 0


def test_errors_inside_are_raised(tmp_path):
    copied(tmp_path, "variantry", "__spark_entry__.py")
    (tmp_path / "variantry" / "llm").mkdir()
    (tmp_path / "variantry" / "llm" / "__init__.py").write_text("")
    (tmp_path / "variantry" / "llm" / "queries.py").write_text("import variantry.llm.gone\n")
    code, _, errors = asked(tmp_path)
    assert code != 0 and "variantry.llm.gone" in errors
