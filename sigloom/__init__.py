"""Signal analytics on Spark: windowed integer kernels, quality metrics and catalogs as DataFrame programs."""
