"""Sources and sinks: fixture views over TESTDATA, CSV exchange files, history tables."""
