"""The entry module without the training-data subpackage and without the pipeline."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
LISTED = "import __spark_entry__ as e; print(' '.join(sorted(e.queries()))); print(' '.join(sorted(e.oracle_sql())))"


@pytest.mark.parametrize("pipeline", [True, False])
def test_entry_without_training_data_operators(scratch, pipeline):
    shutil.copytree(os.path.join(ROOT, "cardflow"), f"{scratch}/cardflow", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), scratch)
    if pipeline and os.path.exists(os.path.join(ROOT, "corpus_pipeline.py")):
        shutil.copy(os.path.join(ROOT, "corpus_pipeline.py"), scratch)
    out = subprocess.run([sys.executable, "-c", LISTED], cwd=scratch, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    built, oracles = (line.split() for line in out.stdout.splitlines())
    assert len(built) > 50 and all(k.startswith("q_") for k in built)
    assert set(oracles) <= set(built)


def test_other_missing_modules_are_errors(scratch):
    """Only the optional parts may be absent: a module that they lack for another reason is an error."""
    os.makedirs(f"{scratch}/cardflow")
    shutil.copytree(os.path.join(ROOT, "cardflow"), f"{scratch}/cardflow", dirs_exist_ok=True,
                    ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), scratch)
    with open(f"{scratch}/corpus_pipeline.py", "w") as f:
        f.write("import no_such_module_anywhere\n")
    out = subprocess.run([sys.executable, "-c", LISTED], cwd=scratch, capture_output=True, text=True, timeout=120)
    assert out.returncode != 0 and "no_such_module_anywhere" in out.stderr
