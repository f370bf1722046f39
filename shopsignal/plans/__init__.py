"""Plan-shaping helpers (join strategy, physical layout, cluster settings) and the end-to-end batch run."""
