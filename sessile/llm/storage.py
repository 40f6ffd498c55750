"""The library's intermediate tables, for the operators of this folder."""

from sessile.storage import discard, materialize, shared_dir

__all__ = ["discard", "materialize", "shared_dir"]
