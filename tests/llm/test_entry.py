"""The entry point lists every operator, and does without the subpackage."""

import subprocess
import sys
from pathlib import Path

import __spark_entry__

ROOT = Path(__file__).resolve().parents[2]


def test_every_operator_is_registered():
    names = __spark_entry__.queries()
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names
    assert set(__spark_entry__.oracle_sql()) <= set(names)


def test_the_rest_works_without_the_subpackage(tmp_path):
    (tmp_path / "__spark_entry__.py").symlink_to(ROOT / "__spark_entry__.py")
    (tmp_path / "ledgerlark").mkdir()
    for part in (ROOT / "ledgerlark").iterdir():
        if part.name not in ("llm", "__pycache__"):
            (tmp_path / "ledgerlark" / part.name).symlink_to(part)
    code = f"import sys; sys.path[:0] = [{str(tmp_path)!r}]; import __spark_entry__ as e; print(len(e.queries()), 'op2_secret_scan' in e.queries())"
    out = subprocess.run([sys.executable, "-P", "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True, timeout=120)
    assert out.stdout.split()[-1] == "False" and int(out.stdout.split()[-2]) >= 84


def test_nothing_else_imports_the_subpackage():
    for path in (ROOT / "ledgerlark").rglob("*.py"):
        if "llm" not in path.parts:
            assert "ledgerlark.llm" not in path.read_text(), path
