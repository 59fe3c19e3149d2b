"""The scratch folder is shared or refused; optional packages hide no errors."""

import subprocess
import sys
from types import SimpleNamespace

import pytest

from lossline import session


class Context:
    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder

    def getConf(self):
        return SimpleNamespace(get=lambda key, default=None: default)

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_no_machine_local_scratch_on_a_cluster():
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            session.checkpoint_root(SimpleNamespace(sparkContext=Context(master)))
        assert session.checkpoint_root(SimpleNamespace(sparkContext=Context(master, "s3a://b/x/"))) == "s3a://b/x"
    local = Context("local[2]")
    assert session.checkpoint_root(SimpleNamespace(sparkContext=local)) == local.folder


@pytest.mark.parametrize("broken, found", [("", "False"), ("import no_such_library", "ModuleNotFoundError")])
def test_entry_without_or_with_a_broken_package(tmp_path, broken, found):
    """A copy without the training-data package imports; a broken one fails loudly."""
    import os
    import shutil

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copytree(f"{root}/lossline", tmp_path / "lossline", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    if broken:
        (tmp_path / "lossline/llm").mkdir()
        (tmp_path / "lossline/llm/__init__.py").write_text("")
        (tmp_path / "lossline/llm/queries.py").write_text(broken)
    ran = subprocess.run([sys.executable, "-B", "-c", "import __spark_entry__ as e; print(e.llm_queries is not None)"], cwd=tmp_path,
                         capture_output=True, text=True, env={**os.environ, "PYTHONPATH": str(tmp_path)})
    assert found in ran.stdout + ran.stderr
