"""The same operators over streams of frames."""
