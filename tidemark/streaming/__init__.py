from tidemark.streaming.rebuilds import daily_counts_stream, rebuild_calls

__all__ = ["daily_counts_stream", "rebuild_calls"]
