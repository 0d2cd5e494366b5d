"""Named queries over the given tables, each with the SQL that checks it where SQL can."""

from emberline.registry import (  # noqa: F401
    detection_queries,
    evaluation_queries,
    model_queries,
    run_queries,
    source_queries,
)
from emberline.registry.book import BOOK

__all__ = ["BOOK"]
