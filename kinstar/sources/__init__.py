"""Sources and sinks: property-graph boundary, staging store, derived fixtures."""
