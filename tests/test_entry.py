"""What the driver calls."""

import __spark_entry__


def test_every_sql_belongs_to_a_query():
    known = __spark_entry__.queries()
    assert set(__spark_entry__.oracle_sql()) <= set(known) and len(known) >= 68
    assert all(callable(f) for f in known.values())


def test_the_rest_does_not_import_the_pipelines_operators():
    import subprocess
    import sys

    code = "import sys; sys.modules['shardwright.llm'] = None; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; print(sum(n.startswith('op') and n[2].isdigit() for n in e.queries()))"
    import os

    root = os.path.dirname(os.path.abspath(__spark_entry__.__file__))
    assert subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True).stdout.strip() == "0"
