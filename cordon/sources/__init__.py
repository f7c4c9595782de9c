"""Sources and sinks: raw trip files, the driver-table projection, inventory checks, writers."""
