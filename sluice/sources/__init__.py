"""Readers and writers: change logs, tables of a folder, versioned receivers, configuration."""
