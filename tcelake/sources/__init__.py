"""Scans: XML case files, JSON record files, archives, Parquet datasets and the driver-table views."""
