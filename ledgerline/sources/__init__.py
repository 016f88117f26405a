"""Sources and sinks: driver Parquet tables, role bindings, distributed
generators and catalog tables."""
