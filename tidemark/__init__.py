"""Event-time billing, keyed state and fact-table analytics on PySpark."""
