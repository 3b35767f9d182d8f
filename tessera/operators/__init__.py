from .graph import graph_edges, neighbors, shortest_paths, traverse

__all__ = ["graph_edges", "neighbors", "shortest_paths", "traverse"]
