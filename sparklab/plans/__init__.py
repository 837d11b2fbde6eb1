"""Named queries over the fixture tables (the ``queries()`` / ``oracle_sql()`` surface)."""

from sparklab.plans.registry import CHECKS, ORACLES, QUERIES  # noqa: F401


def load_all():
    """Import every plan module so that its queries register."""
    import importlib
    import pkgutil

    import sparklab.plans as pkg

    for m in pkgutil.iter_modules(pkg.__path__):
        if m.name != "registry":
            importlib.import_module(f"sparklab.plans.{m.name}")
    return QUERIES, ORACLES
