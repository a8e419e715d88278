"""Every module imports, and every registered query has a docstring and an oracle."""

import importlib
import pkgutil

import tapeworks
import __spark_entry__ as entry
from tapeworks.plans import catalog


def test_every_module_imports(spark):
    names = [m.name for m in pkgutil.walk_packages(tapeworks.__path__, "tapeworks.")]
    assert len(names) >= 20
    for name in names:
        importlib.import_module(name)


def test_registered_queries_are_documented_and_checked(spark):
    qs, sql = entry.queries(), entry.oracle_sql()
    assert len(qs) >= 112
    assert set(catalog.queries()) == set(catalog.oracle_sql())
    assert set(sql) <= set(qs)
    undocumented = [k for k, fn in qs.items() if not (fn.__doc__ or "").strip()]
    assert not undocumented, undocumented


def test_shared_folder_without_a_setting(spark, monkeypatch):
    """A local session without spark.checkpoint.dir gets one folder; a cluster is refused."""
    import pytest
    from tapeworks import session

    class Bare:
        class conf:  # noqa: N801
            @staticmethod
            def get(key, default=None):
                return default

        class sparkContext:  # noqa: N801
            master = "local[2]"

    assert session.checkpoint_root(Bare) == session.checkpoint_root(Bare) != ""
    Bare.sparkContext.master = "spark://far:7077"
    with pytest.raises(ValueError):
        session.checkpoint_root(Bare)
    assert session.scratch_path(spark, "x").startswith(session.checkpoint_root(spark))
