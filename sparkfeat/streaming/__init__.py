"""Streaming form of the feature job (stateless per row, stream-static joins)."""

from ..plans.features import (apply_feature_stats, fit_feature_stats, load_feature_stats,
                              save_feature_stats)
from .features import read_incident_stream, stream_features

__all__ = ["read_incident_stream", "stream_features", "fit_feature_stats", "apply_feature_stats",
           "save_feature_stats", "load_feature_stats"]
