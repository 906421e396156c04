from .rollups import read_rollup, write_rollup
from .writers import append_rows, publish, split_write, write_csv, write_json

__all__ = ["append_rows", "publish", "read_rollup", "split_write", "write_csv", "write_json", "write_rollup"]
