"""Bindings of the operators to the driver tables, report marts, and the recipe runner."""

from importlib import import_module

MODULES = (
    "relational",
    "cleaning",
    "ordering",
    "loading",
    "files",
    "checks",
    "streams",
    "dimensions",
    "facts",
    "reports",
    "feeds",
    "recipes",
)


def load() -> None:
    """Import every module that registers queries."""
    for name in MODULES:
        import_module(f"lakeops.plans.{name}")
