"""Sources and sinks: schemas and registry, file readers/writers, test-data adapters."""
