"""Sources: file readers for the landed data and driver-table adaptations."""
