from panelkit.streaming.batches import csv_stream, for_each_batch, stream_to_parquet

__all__ = ["csv_stream", "for_each_batch", "stream_to_parquet"]
