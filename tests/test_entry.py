"""The entry file without the text operators."""

import importlib
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.mark.parametrize("missing", ["jobloom.llm.leaks", "ahocorasick", "corpus_pipeline"])
def test_what_cannot_be_imported_is_left_out(monkeypatch, missing):
    import __spark_entry__ as entry

    core = {n for m in entry.MODULES for n in m.QUERIES}
    for name in list(sys.modules):
        if name.startswith("jobloom.llm") or name == "corpus_pipeline":
            monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, missing, None)
    try:
        with pytest.warns(UserWarning, match="left out"):
            alone = importlib.reload(entry)
        assert core <= set(alone.queries())
        assert "pipeline" not in alone.queries()
    finally:
        monkeypatch.undo()
        importlib.reload(entry)
