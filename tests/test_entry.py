import sys
from pathlib import Path

import __spark_entry__ as entry
from rodaje.plans import registry

ROOT = Path(__file__).resolve().parent.parent


def test_every_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(registry.queries()) <= set(entry.queries())


def test_core_does_not_import_the_text_subpackage():
    for path in (ROOT / "rodaje").rglob("*.py"):
        if "llm" not in path.relative_to(ROOT).parts:
            assert "rodaje.llm" not in path.read_text()


def test_entry_without_the_text_subpackage(monkeypatch):
    for name in [n for n in sys.modules if n.startswith("rodaje.llm")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setattr(sys, "meta_path", [_Hidden(), *sys.meta_path])
    assert set(entry.queries()) == set(registry.queries())
    assert set(entry.oracle_sql()) == set(registry.oracle_sql())


class _Hidden:
    def find_spec(self, name, path=None, target=None):
        if name.startswith("rodaje.llm"):
            raise ModuleNotFoundError(name, name=name)
        return None
