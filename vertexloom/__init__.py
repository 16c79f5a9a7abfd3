"""Property-graph operators expressed as Spark DataFrame jobs."""

from vertexloom.graph import Graph

__all__ = ["Graph"]
