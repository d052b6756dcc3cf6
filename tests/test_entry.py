import subprocess
import sys
from pathlib import Path

import pytest

from climora.catalogue import ingestion, landings, modelling, published

OWN = {**ingestion.QUERIES, **modelling.QUERIES, **published.QUERIES, **landings.QUERIES}


@pytest.mark.parametrize("missing", ["xxhash", "sentencepiece", "climora.llm"])
def test_other_queries_do_without_the_libraries_of_the_subpackage(missing):
    code = (
        f"import sys; sys.modules[{missing!r}] = None; import __spark_entry__ as e;"
        "print(*sorted(e.queries())); assert set(e.oracle_sql()) <= set(e.queries()); e.entry"
    )
    done = subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).parents[1], capture_output=True, text=True, check=True)
    assert set(OWN) <= set(done.stdout.split())
    if missing != "sentencepiece":  # that one is opened by its operator only
        assert set(done.stdout.split()) == set(OWN)


def test_names_are_used_once():
    assert len(OWN) == sum(len(m.QUERIES) for m in (ingestion, modelling, published, landings))
