from linkloom.streaming.loop import fetch_stream

__all__ = ["fetch_stream"]
