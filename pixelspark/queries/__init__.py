"""Named queries on the given tables, each with an equivalent SQL text where one exists."""

from importlib import import_module

MODULES = ("tables", "metrics", "filters", "illumination", "objects", "features", "screening", "tiles")


def load():
    """Import all query modules and return the registry."""
    for name in MODULES:
        import_module(f"{__name__}.{name}")
    return import_module(f"{__name__}.registry")
