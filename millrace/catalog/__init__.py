"""Query registrations, one module per area."""

from importlib import import_module

MODULES = (
    "relational",
    "aggregation",
    "ordering",
    "scalars",
    "preparation",
    "commerce",
    "claims",
    "activity",
    "news",
    "streams",
    "storage",
    "models",
)


def load() -> None:
    for module in MODULES:
        import_module(f"millrace.catalog.{module}")
