"""Structured Streaming variants of the batch reports."""

from parcelscope.streaming.label_counts import parcel_label_stream, start_label_counts

__all__ = ["parcel_label_stream", "start_label_counts"]
