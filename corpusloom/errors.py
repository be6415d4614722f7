"""Typed errors; ``kind`` is the stable wire tag."""

from __future__ import annotations

import json


class CorpusError(Exception):
    kind = "Error"

    def detail(self) -> dict:
        return {}

    def envelope(self) -> str:
        """The error as one JSON object."""
        return json.dumps({"kind": self.kind, "message": str(self), "detail": self.detail()}, ensure_ascii=False)


class Truncated(CorpusError):
    kind = "Truncated"

    def __init__(self, field: str, offset: int, needed: int, available: int):
        super().__init__(f"truncated in {field}: {needed} bytes needed at {offset}, {available} there")
        self.field, self.offset, self.needed, self.available = field, offset, needed, available

    def detail(self) -> dict:
        return {"field": self.field, "offset": self.offset, "needed": self.needed, "available": self.available}


class BadMagic(CorpusError):
    kind = "BadMagic"


class UnsupportedPackVersion(CorpusError):
    kind = "UnsupportedPackVersion"


class ChecksumMismatch(CorpusError):
    kind = "ChecksumMismatch"


class IncompatibleSchema(CorpusError):
    kind = "IncompatibleSchema"


class RightsGateRefused(CorpusError):
    kind = "RightsGateRefused"


class Invariant(CorpusError):
    kind = "Invariant"


class InvalidArgument(CorpusError):
    kind = "InvalidArgument"


class CommitConflict(CorpusError):
    """Another run has published first."""

    kind = "CommitConflict"
