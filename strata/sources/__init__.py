"""Sources and sinks: landing files, bronze tables, driver test tables, snapshots."""
