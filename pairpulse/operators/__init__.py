"""The layers: pure DataFrame -> DataFrame functions."""
