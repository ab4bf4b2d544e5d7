"""Fleet telemetry analytics as DataFrame -> DataFrame functions."""

from fleetspark.settings import DetectorSettings, SampleScope, StreamOptions

__all__ = ["DetectorSettings", "SampleScope", "StreamOptions"]
