"""Named queries over the test tables, each with its SQL statement where there is one."""

from tallyfold.plans import articles, extraction, files, graph, learning, numbers, streams, text
from tallyfold.plans.registry import REGISTRY

__all__ = ["REGISTRY", "articles", "extraction", "files", "graph", "learning", "numbers", "streams", "text"]
