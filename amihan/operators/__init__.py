"""Bronze normalisers, silver detections and scores, data-quality checks."""
