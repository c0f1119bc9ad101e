"""Sources and sinks: landing CSV scans, the layered table store, and the
adapter that maps the TPC-H-style test tables onto the retail model."""
