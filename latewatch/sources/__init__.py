"""Bronze layer: scans of captures, timetable and weather, feed flatteners and sinks."""
