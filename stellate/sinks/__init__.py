"""Layer namespaces, full-replace tables and views."""
