"""Multi-table work: the refresh of all layers, the status report and the reports."""
