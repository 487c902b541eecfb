"""Sources and sinks: portal configs, landed pages, JSON listings, the article store."""
