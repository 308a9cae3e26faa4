"""Row-wise feature steps on a file stream."""

from .features import read_flight_stream, row_features, start_feature_stream

__all__ = ["read_flight_stream", "row_features", "start_feature_stream"]
