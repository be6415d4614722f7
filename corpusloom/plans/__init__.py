"""Whole runs: from landed pages to a store, and from a store to one artefact."""
