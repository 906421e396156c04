from .readers import (
    last_days,
    params,
    read_csv,
    read_docs,
    read_json,
    read_stream,
    records,
    scan,
    spread,
    unwrap,
)

__all__ = [
    "last_days",
    "params",
    "read_csv",
    "read_docs",
    "read_json",
    "read_stream",
    "records",
    "scan",
    "spread",
    "unwrap",
]
