"""Where frames, runs and detections come from."""
