"""Registered queries and their independent SQL oracles."""

from importlib import import_module
from pathlib import Path


def load_all() -> None:
    """Import every ``*_queries`` module; each registers its own entries."""
    for path in sorted(Path(__file__).parent.glob("*_queries.py")):
        import_module(f"verification.{path.stem}")
