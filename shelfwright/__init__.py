"""Set-based data-quality jobs for large audio-visual archives, on Spark."""
