"""The registered queries and their SQL oracles."""

import importlib

MODULES = ("explore", "relational", "scalars", "marts", "quality", "changes", "files")


def load() -> None:
    for name in MODULES:
        importlib.import_module(f"tradewind.checks.{name}")
