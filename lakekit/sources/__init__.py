"""Sources and sinks: landing-folder scans, versioned snapshot store, append-only control log."""
