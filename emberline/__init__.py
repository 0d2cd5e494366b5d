"""Analytics over georeferenced, time-stamped detections, expressed as Spark jobs."""
