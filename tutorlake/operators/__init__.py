"""Transformations from frames to frames. None of them runs a job or keeps state on the driver."""
