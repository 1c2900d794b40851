from paysignal.streaming.bronze import prepare_bronze, read_source_stream, run_bronze, write_bronze_stream

__all__ = ["prepare_bronze", "read_source_stream", "run_bronze", "write_bronze_stream"]
