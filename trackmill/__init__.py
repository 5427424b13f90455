"""Vehicle telemetry on Spark: landed pages to one flat time-series table, temporal joins, day partitions, analyses."""
