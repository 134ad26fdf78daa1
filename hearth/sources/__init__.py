"""Sources and sinks: raw text files, previous-layer tables, generated calendar,
the TPC-H-derived staging views used for tests and benchmarks."""
