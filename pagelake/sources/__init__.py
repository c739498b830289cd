"""Sources and sinks: URL lists, the raw HTML store, the page table, CSV and JSON files."""
