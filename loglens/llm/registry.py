"""The queries of this subpackage and their DuckDB statements."""
from __future__ import annotations

from importlib import import_module

MODULES = ["bpe", "shards", "mixing", "secrets", "linededup", "rules", "quality", "minhash", "htmltext", "nndescent", "urlfilter", "lanczos", "trie"]

QUERIES: dict = {}
SQL: dict[str, str] = {}
for _m in (import_module(f"{__package__}.{m}") for m in MODULES):
    QUERIES.update(_m.QUERIES)
    SQL.update(_m.SQL)
