from .streams import batch_sink, drain, record_sink, run_stream, split_bad, table_sink

__all__ = ["batch_sink", "drain", "record_sink", "run_stream", "split_bad", "table_sink"]
